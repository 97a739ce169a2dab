"""Vector layers: GeoJSON, GeoPackage, shapefiles and Parquet, read from any store that Spark reaches."""

from __future__ import annotations

import codecs
import io
import json
import os
import re
import shutil
import sqlite3
import struct
import tempfile
from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError
from cinderspark.operators.dissolve import dissolve
from cinderspark.operators.geometry import Polygons, bounds, from_wkb, polygons_of_rings, ring_area, to_wkb
from cinderspark.sources.geotiff import _reached
from cinderspark.sources.tables import qualified, written

#: Formats by extension.
FORMATS = {".shp": "shapefile", ".gpkg": "gpkg", ".geojson": "geojson", ".json": "geojson", ".parquet": "parquet"}
FEATURES = "source_file string, properties string, geom binary, crs string"
#: Bytes of a file that are read at once; features that are read, or written, at once.
CHUNK, MANY = 1 << 22, 500


def format_of(path: str) -> str:
    """The format that an extension names; another one is an error."""
    found = FORMATS.get("." + path.rsplit(".", 1)[-1].lower())
    if not found:
        raise DataContractError(f"{path} has no extension of {', '.join(FORMATS)}")
    return found


def _of_json(geometry: dict | None) -> bytes | None:
    if not geometry or geometry["type"] not in ("Polygon", "MultiPolygon"):
        return None
    listed = [geometry["coordinates"]] if geometry["type"] == "Polygon" else geometry["coordinates"]
    return to_wkb([[np.array(r, float)[:, :2] for r in p] for p in listed])


class _Json:
    """JSON read from a stream value by value; in hand are a chunk and the value that goes on beyond it."""

    def __init__(self, stream):
        self.stream, self.text, self.at, self.ended = stream, "", 0, False
        head = stream.read(CHUNK)
        self.decoder = codecs.getincrementaldecoder(json.detect_encoding(head))()
        self.text = self.decoder.decode(head)
        self.parse = json.JSONDecoder().raw_decode

    def more(self) -> None:
        self.text, self.at = self.text[self.at :], 0
        data = self.stream.read(max(CHUNK, len(self.text)))
        self.ended = not data
        self.text += self.decoder.decode(data, self.ended)

    def peek(self) -> str:
        """The next sign that is no space; none at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n":
                self.at += 1
            if self.at < len(self.text) or self.ended:
                return self.text[self.at : self.at + 1]
            self.more()

    def skip(self, sign: str) -> None:
        if self.peek() != sign:
            raise DataContractError(f"no {sign} where the file should have one")
        self.at += 1

    def value(self):
        self.peek()
        while True:
            try:
                found, end = self.parse(self.text, self.at)
                if end < len(self.text) or self.ended:
                    self.at = end
                    return found
            except ValueError:
                if self.ended:
                    raise
            self.more()


def _entries(stream) -> Iterator[tuple]:
    """A collection's system and its features, in order of the file."""
    j = _Json(stream)
    j.skip("{")
    while j.peek() != "}":
        key = j.value()
        j.skip(":")
        if key == "features" and j.peek() == "[":
            j.skip("[")
            while j.peek() != "]":
                yield key, j.value()
                if j.peek() != "]":
                    j.skip(",")
            j.skip("]")
        else:
            yield key, j.value()
        if j.peek() != "}":
            j.skip(",")


def _geojson(opened: Callable, layer: str | None) -> Iterator[tuple]:
    """Features, one in hand at a time; a system that stands behind them is looked for first."""
    told = next((v for k, v in _entries(opened()) if k == "crs"), None) or {}
    name = told.get("properties", {}).get("name", "EPSG:4326")
    code = re.search(r"(\d+)$", name)
    crs = "EPSG:4326" if name.endswith("CRS84") or not code else f"EPSG:{code[1]}"
    for key, f in _entries(opened()):
        if key == "features" and f is not None:
            yield json.dumps(f.get("properties") or {}), _of_json(f.get("geometry")), crs


def _gpkg(opened: Callable, layer: str | None) -> Iterator[tuple]:
    """Features, read from the file itself where it is a local or mounted one, else from a temporary copy."""
    stream = opened()
    with tempfile.TemporaryDirectory() as own:
        at = getattr(stream, "local", None)
        if at is None:
            at = f"{own}/layer.gpkg"
            with open(at, "wb") as out:
                shutil.copyfileobj(stream, out, CHUNK)
        db = sqlite3.connect(f"file:{quote(at)}?mode=ro&immutable=1", uri=True)
        try:
            yield from _rows(db, layer)
        finally:
            db.close()


class _Local(io.FileIO):
    """A file with its path."""

    def __init__(self, path: str):
        super().__init__(path)
        self.local = path


def _opener(path: str, content: bytes | None) -> Callable:
    """Opens a file's stream: through Arrow, or of its ``content`` if there is one."""
    if content is not None:
        return lambda: io.BytesIO(content)
    system, at = fs.FileSystem.from_uri(path)
    return (lambda: _Local(at)) if isinstance(system, fs.LocalFileSystem) else lambda: system.open_input_stream(at)


def _rows(db: sqlite3.Connection, layer: str | None) -> Iterator[tuple]:
    db.row_factory = sqlite3.Row
    for name, column, srs in db.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns").fetchall():
        if layer is not None and name != layer:
            continue
        for row in db.execute(f'SELECT * FROM "{name}"'):
            blob = row[column]
            extent = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] if blob else 0
            values = {k: row[k] for k in row.keys() if k not in (column, "fid")}
            yield json.dumps(values), blob[8 + extent :] if blob else None, f"EPSG:{srs}"


def write_gpkg(features: list[tuple[dict, bytes | None]], crs: str = "EPSG:4326", layer: str = "layer") -> bytes:
    """Features (attributes, WKB) as a GeoPackage in memory; without features, an empty layer."""
    db = sqlite3.connect(":memory:")
    if len(features) < MANY:  # each table has a page of its own: small ones, so that a file of a few features has 8 KB, not 40
        db.execute("PRAGMA page_size = 512")
    _fill(db, features, list(dict.fromkeys(k for values, _ in features for k in values)), crs, layer)
    return db.serialize()


def _fill(db: sqlite3.Connection, features, names: list[str], crs: str, layer: str = "layer") -> int:
    """Puts a layer with its features into an empty database, one by one; returns their number."""
    code = int(crs.rpartition(":")[2])
    db.executescript(f"""PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;
      CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
      CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
      CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
      INSERT INTO gpkg_spatial_ref_sys VALUES ('{crs}', {code}, 'EPSG', {code}, 'undefined', NULL);
      INSERT INTO gpkg_contents VALUES ('{layer}', 'features', '{layer}', '', '2025-01-01T00:00:00Z', NULL, NULL, NULL, NULL, {code});
      INSERT INTO gpkg_geometry_columns VALUES ('{layer}', 'geom', 'GEOMETRY', {code}, 0, 0);""")
    n = 0
    db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB{"".join(f", {chr(34)}{n}{chr(34)}" for n in names)})')
    marks = ", ".join("?" * (len(names) + 1))
    columns = ", ".join(["geom", *(f'"{n}"' for n in names)])
    for values, wkb in features:
        blob = struct.pack("<2sBBi", b"GP", 0, 1, code) + wkb if wkb else None
        db.execute(f'INSERT INTO "{layer}" ({columns}) VALUES ({marks})', [blob, *(values.get(k) for k in names)])
        n += 1
    db.commit()
    return n


def _shapes(shp: bytes) -> list[bytes | None]:
    at, out = 100, []
    while at < len(shp):
        size = struct.unpack_from(">I", shp, at + 4)[0] * 2
        kind = struct.unpack_from("<I", shp, at + 8)[0]
        if kind in (5, 15, 25):
            parts, points = struct.unpack_from("<II", shp, at + 44)
            starts = [*struct.unpack_from(f"<{parts}I", shp, at + 52), points]
            xy = np.frombuffer(shp, "<f8", 2 * points, at + 52 + 4 * parts).reshape(-1, 2)
            out.append(to_wkb(polygons_of_rings([xy[a:b] for a, b in zip(starts, starts[1:], strict=False)])))
        else:
            out.append(None)
        at += 8 + size
    return out


def _table(dbf: bytes) -> list[dict]:
    n, head, size = struct.unpack_from("<IHH", dbf, 4)
    fields, at = [], 32
    while dbf[at] != 13:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode(), chr(dbf[at + 11]), dbf[at + 16], dbf[at + 17]))
        at += 32
    out = []
    for i in range(n):
        place, row = head + i * size + 1, {}
        for name, kind, width, digits in fields:
            text = dbf[place : place + width].decode("utf-8", "replace").strip()
            row[name] = None if text == "" else (float(text) if digits else int(text)) if kind in "NF" else text
            place += width
        out.append(row)
    return out


def read_layer(spark: SparkSession, path: str, layer: str | None = None, schema: str | None = None, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """``source_file, properties (JSON), geom (WKB), crs`` of a layer's features, or with ``schema`` its attributes as columns.

    With ``bbox``, only features whose box meets it leave the scan; a Parquet layer's box columns are filtered in its scan.
    A file is read by one task: GeoJSON and GeoPackage feature by feature where Arrow reaches the store, else whole. A shapefile's table and coordinate code are taken from the files of the same name.
    """
    kind = format_of(path)
    if kind == "parquet":
        table = spark.read.parquet(path)
        if bbox:
            table = table.where((F.col("minx") <= bbox[2]) & (F.col("maxx") >= bbox[0]) & (F.col("miny") <= bbox[3]) & (F.col("maxy") >= bbox[1]))
        return table
    if kind == "shapefile":
        base = path[:-4]
        content = lambda ext: spark.read.format("binaryFile").load(base + ext).select(F.col("content").alias(ext[1:]))
        both = spark.read.format("binaryFile").load(path).select("path", "content").join(content(".dbf"))
        try:
            text = spark.read.text(base + ".prj", wholetext=True).first()["value"]
        except Exception as error:
            raise DataContractError("the layer has no coordinate system") from error
        crs = next((f"EPSG:{c}" for c in re.findall(r'AUTHORITY\["EPSG","(\d+)"\]\]\s*$', text)), "EPSG:4326" if "WGS" in text and "PROJCS" not in text else None)
        rows = lambda x: [(json.dumps(a), g, crs) for a, g in zip(_table(x["dbf"]), _shapes(x["content"]), strict=True)]
    else:
        files = spark.read.format("binaryFile").load(path)
        first = files.select("path").first()
        both = files.select("path") if first and _reached(first["path"]) else files.select("path", "content")
        of = {"geojson": _geojson, "gpkg": _gpkg}[kind]
        rows = lambda x: of(_opener(x["path"], x.get("content")), layer)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for x in pdf.to_dict("records"):
                name, found = x["path"].rsplit("/", 1)[-1], iter(rows(x))
                while part := list(islice(found, 10 * MANY)):
                    yield pd.DataFrame([(name, *f) for f in part if bbox is None or _meets(f[1], bbox)], columns=["source_file", "properties", "geom", "crs"])

    found = both.mapInPandas(run, FEATURES)
    return found if schema is None else found.select("source_file", F.from_json("properties", schema).alias("p"), "geom", "crs").select("source_file", "p.*", "geom", "crs")


def _meets(geom: bytes | None, box: tuple[float, float, float, float]) -> bool:
    own = bounds(from_wkb(geom))
    return own is not None and own[0] <= box[2] and own[2] >= box[0] and own[1] <= box[3] and own[3] >= box[1]


def union_of(spark: SparkSession, path: str, cell: float, layer: str | None = None) -> DataFrame:
    """``geom, crs``: all features of a file united to one shape to clip by; a file without a coordinate system, or without features, is an error."""
    found = read_layer(spark, path, layer)
    row = found.select("crs").first()
    if row is None or not row["crs"]:
        raise DataContractError("the layer has no features, or no coordinate system")
    return dissolve(found.withColumn("k", F.lit(1)), "k", cell).select("geom", F.lit(row["crs"]).alias("crs"))


def _feature(values: dict, g: bytes | None) -> str:
    shape = {"type": "MultiPolygon", "coordinates": [[r.tolist() for r in p] for p in from_wkb(g)]} if g else None
    return json.dumps({"type": "Feature", "properties": values, "geometry": shape})


def geojson_parts(features, crs: str = "EPSG:4326") -> Iterator[bytes]:
    """Features (attributes, WKB) as a collection, piece by piece."""
    named = {"type": "name", "properties": {"name": f"urn:ogc:def:crs:EPSG::{crs.rpartition(':')[2]}"}}
    yield f'{{"type": "FeatureCollection", "crs": {json.dumps(named)}, "features": ['.encode()
    for i, f in enumerate(features):
        yield ((", " if i else "") + _feature(*f)).encode()
    yield b"]}"


def to_geojson(features: list[tuple[dict, bytes | None]], crs: str = "EPSG:4326") -> bytes:
    """Features (attributes, WKB) as a collection."""
    return b"".join(geojson_parts(features, crs))


def to_shapefile(features: list[tuple[dict, bytes | None]], crs: str = "EPSG:4326") -> dict[str, bytes]:
    """Features as a shapefile's parts by extension: shapes, their index, a table of text columns, and the system's code."""
    records, index, at = [], [], 50
    boxes = [bounds(from_wkb(g)) for _, g in features]
    for i, (_, g) in enumerate(features):
        rings = [r if (ring_area(r) < 0) == (j == 0) else r[::-1] for p in from_wkb(g) for j, r in enumerate(p)]  # outsides clockwise
        body = struct.pack("<I", 0)
        if rings:
            starts = np.cumsum([0, *map(len, rings)])
            body = struct.pack("<I4d2I", 5, *boxes[i], len(rings), int(starts[-1])) + starts[:-1].astype("<u4").tobytes() + np.concatenate(rings).astype("<f8").tobytes()
        records.append(struct.pack(">II", i + 1, len(body) // 2) + body)
        index.append(struct.pack(">II", at, len(body) // 2))
        at += len(records[-1]) // 2
    known = [b for b in boxes if b]
    whole = (min(b[0] for b in known), min(b[1] for b in known), max(b[2] for b in known), max(b[3] for b in known)) if known else (0.0,) * 4
    head = lambda words: struct.pack(">7I", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2I8d", 1000, 5, *whole, 0, 0, 0, 0)
    names = list(dict.fromkeys(k for a, _ in features for k in a))
    cut = [n[:10] for n in names]
    text = lambda v: ("" if v is None else str(v)).encode()[:254]
    wide = [max([1, *(len(text(a.get(n))) for a, _ in features)]) for n in names]
    fields = b"".join(c.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w, 0]) + b"\0" * 14 for c, w in zip(cut, wide, strict=True))
    table = struct.pack("<B3BIHH20x", 3, 125, 1, 1, len(features), 33 + len(fields), 1 + sum(wide)) + fields + b"\r"
    table += b"".join(b" " + b"".join(text(a.get(n)).ljust(w) for n, w in zip(names, wide, strict=True)) for a, _ in features) + b"\x1a"
    return {".shp": head(at) + b"".join(records), ".shx": head(50 + 4 * len(index)) + b"".join(index), ".dbf": table, ".prj": f'PROJCS["",AUTHORITY["EPSG","{crs.rpartition(":")[2]}"]]'.encode()}


def write_layers(features: DataFrame, folder: str, by: str, attributes: list[str], extension: str = ".gpkg", crs: str = "EPSG:4326", names: DataFrame | None = None, geom: str = "geom") -> DataFrame:
    """A vector file for each value of ``by``, in the format that the extension names; returns ``file, n`` (features written).

    Rows are dealt to files; a file is put together by one task, from its own features, and gets its name when it is whole.
    GeoJSON and GeoPackage are written feature by feature (a large GeoPackage where it will stand, in a local or mounted
    store, else through a temporary file); a shapefile, whose head tells its size, is made in memory.
    ``names`` (column ``by``) lists files that have to be there: those without a feature are empty layers.
    """
    kind = format_of("x" + extension)
    if kind == "parquet":
        raise DataContractError("write Parquet layers with partitionBy")
    folder = qualified(features.sparkSession, folder)
    rows = features.select(F.col(by).cast("string").alias("name"), F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}).alias("p"), F.col(geom).alias("g"))
    if names is not None:
        rows = names.select(F.col(by).cast("string").alias("name")).distinct().join(rows, "name", "left")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["p"].notna()]
        listed = [(json.loads(p), None if g is None else bytes(g)) for p, g in zip(pdf["p"], pdf["g"], strict=True)]
        made = to_shapefile(listed, crs)
        system, at = fs.FileSystem.from_uri(folder)
        system.create_dir(at, recursive=True)
        for ending, data in made.items():
            with system.open_output_stream(f"{at}/.{key[0]}{ending}") as out:
                out.write(data)
            system.move(f"{at}/.{key[0]}{ending}", f"{at}/{key[0]}{ending}")
        return pd.DataFrame({"file": [f"{key[0]}{extension}"], "n": [len(listed)]})

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = fs.FileSystem.from_uri(folder)
        system.create_dir(at, recursive=True)
        listed = (row for batch in batches for i in range(0, batch.num_rows, MANY) for row in zip(*(batch.slice(i, MANY).column(c).to_pylist() for c in ("name", "p", "g")), strict=True))
        told: list[tuple] = []
        for name, group in groupby(listed, lambda row: row[0]):
            features = ((json.loads(p), g) for _, p, g in group if p is not None)
            told.append((f"{name}{extension}", _put(system, f"{at}/.{name}{extension}", features, kind, crs)))
            system.move(f"{at}/.{name}{extension}", f"{at}/{name}{extension}")
            if len(told) >= MANY:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*told, strict=True)], names=["file", "n"])
                told = []
        if told:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*told, strict=True)], names=["file", "n"])

    if kind == "shapefile":
        return written(rows.groupBy("name").applyInPandas(run, "file string, n long"), "layers")
    return written(rows.repartition("name").sortWithinPartitions("name").mapInArrow(stream, "file string, n long"), "layers")


def _put(system: fs.FileSystem, at: str, features: Iterator[tuple], kind: str, crs: str) -> int:
    """Features as a file; returns their number."""
    head = list(islice(features, MANY))
    if kind == "geojson":
        with system.open_output_stream(at, buffer_size=1 << 20) as out:
            for i, part in enumerate(geojson_parts(chain(head, features), crs)):
                out.write(part)
        return i - 1
    if len(head) < MANY:
        with system.open_output_stream(at) as out:
            out.write(write_gpkg(head, crs))
        return len(head)
    with tempfile.TemporaryDirectory() as own:
        local = isinstance(system, fs.LocalFileSystem)
        place = at if local else f"{own}/layer.gpkg"
        if local and os.path.exists(place):  # of a task that was lost
            os.remove(place)
        db = sqlite3.connect(place)
        db.executescript("PRAGMA journal_mode = OFF; PRAGMA synchronous = OFF;")
        n = _fill(db, chain(head, features), list(head[0][0]), crs)
        db.close()
        if not local:
            with open(place, "rb") as made, system.open_output_stream(at) as out:
                shutil.copyfileobj(made, out, CHUNK)
    return n


def feature_json(layer: DataFrame, attributes: list[str], geom: str = "geom") -> DataFrame:
    """``value``: each feature as a line of GeoJSON, ready for ``write.text``."""

    def text(g: bytes | None) -> str | None:
        polygons: Polygons = from_wkb(g)
        return json.dumps({"type": "MultiPolygon", "coordinates": [[r.tolist() for r in p] for p in polygons]}) if polygons else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"value": [json.dumps({"type": "Feature", "properties": json.loads(p), "geometry": json.loads(text(g) or "null")}) for p, g in zip(pdf["p"], pdf["g"], strict=True)]})

    return layer.select(F.to_json(F.struct(*attributes)).alias("p"), F.col(geom).alias("g")).mapInPandas(run, "value string")


def box_feature(label: str, excluded: str, source: str, box: tuple[float, float, float, float]) -> str:
    """One feature for a box, with its corners as properties."""
    a, b, c, d = box
    ring = [[a, b], [c, b], [c, d], [a, d], [a, b]]
    properties = {"label": label, "exclude_region": excluded, "source": source, "minx": a, "miny": b, "maxx": c, "maxy": d}
    return json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": [ring]}}]})
