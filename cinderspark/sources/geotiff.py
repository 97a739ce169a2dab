"""GeoTIFF files as tiles, by their published format: strips or tiles; Deflate, LZW, Zstandard or none; either predictor."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from xml.sax.saxutils import escape, unescape

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError

#: Sizes and letters of the format's field types, and its sample formats.
FIELD = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 7: (1, "B"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q")}
SAMPLE = {1: "u", 2: "i", 3: "f"}
TILES = "raster_id string, band int, band_name string, r0 int, c0 int, h int, w int, dtype string, data binary"


class Bytes:
    """Parts of a file in memory, or of one that Arrow reaches: only what is asked for is read."""

    def __init__(self, data: bytes | None = None, path: str | None = None):
        self.data = data
        if path is not None:
            system, at = fs.FileSystem.from_uri(path)
            self.file = system.open_input_file(at)
            self.head = self.file.read_at(1 << 16, 0)

    def part(self, at: int, n: int) -> bytes:
        if self.data is not None:
            return self.data[at : at + n]
        return self.head[at : at + n] if at + n <= len(self.head) else self.file.read_at(n, at)

    def unpack(self, form: str, at: int) -> tuple:
        return struct.unpack(form, self.part(at, struct.calcsize(form)))


def lzw(data: bytes) -> bytes:
    """The format's LZW: codes from the high bit on, widened one early, a clear code and an end code."""
    out: list[bytes] = []
    table: list[bytes] = []
    bits = held = 0
    width, last = 9, b""
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        while bits >= width:
            code, bits = held >> (bits - width), bits - width
            held &= (1 << bits) - 1
            if code == 256:
                table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
                continue
            if code == 257:
                return b"".join(out)
            word = table[code] if code < len(table) else last + last[:1]
            if last:
                table.append(last + word[:1])
            out.append(word)
            last = word
            width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


class Tiff:
    """The directory of a file, and its blocks on demand."""

    def __init__(self, data: bytes | Bytes):
        self.data = data if isinstance(data, Bytes) else Bytes(data)
        self.order = {b"II": "<", b"MM": ">"}.get(self.data.part(0, 2))
        if not self.order:
            raise DataContractError("no TIFF file")
        unpack, o = self.data.unpack, self.order
        big = unpack(o + "H", 2)[0] == 43
        at = unpack(o + ("Q" if big else "I"), 8 if big else 4)[0]
        n = unpack(o + ("Q" if big else "H"), at)[0]
        at, step, inline = (at + 8, 20, 8) if big else (at + 2, 12, 4)
        self.tags: dict[int, tuple | bytes] = {}
        for i in range(n):
            tag, kind = unpack(o + "HH", at + i * step)
            count = unpack(o + ("Q" if big else "I"), at + i * step + 4)[0]
            size, letter = FIELD[kind]
            place = at + i * step + (12 if big else 8)
            if size * count > inline:
                place = unpack(o + ("Q" if big else "I"), place)[0]
            self.tags[tag] = self.data.part(place, count) if kind == 2 else unpack(f"{o}{count * len(letter)}{letter[0]}", place)
        one = lambda tag, other: self.tags.get(tag, (other,))[0]
        self.width, self.height, self.bands = one(256, 0), one(257, 0), one(277, 1)
        self.dtype = np.dtype(f"{self.order}{SAMPLE[one(339, 1)]}{one(258, 8) // 8}")
        self.packed, self.planar, self.predictor = one(259, 1), one(284, 1) == 2, one(317, 1)
        self.tiled = 322 in self.tags
        self.bw, self.bh = (one(322, 0), one(323, 0)) if self.tiled else (self.width, min(one(278, self.height), self.height))
        if self.packed not in UNPACK or self.predictor not in (1, 2, 3):
            raise DataContractError(f"compression {self.packed} with predictor {self.predictor} isn't read")

    @property
    def nodata(self) -> float | None:
        text = self.tags.get(42113, b"").rstrip(b"\0 ")
        return float(text) if text else None

    @property
    def transform(self) -> tuple[float, ...]:
        scale, tie = self.tags.get(33550), self.tags.get(33922)
        if not scale or not tie:
            return (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
        return (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1])

    @property
    def crs(self) -> str | None:
        keys = self.tags.get(34735, ())
        found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
        code = found.get(3072) or found.get(2048)
        return f"EPSG:{code}" if code else None

    def names(self) -> list[str]:
        """Band descriptions; a band without one is ``band_`` and its number from 0."""
        text = self.tags.get(42112, b"").rstrip(b"\0").decode("utf-8", "replace")
        found = {int(i): unescape(v) for i, v in re.findall(r'<Item name="DESCRIPTION" sample="(\d+)"[^>]*>([^<]*)</Item>', text)}
        return [found.get(i) or f"band_{i}" for i in range(self.bands)]

    def block(self, i: int, h: int, bands: int) -> np.ndarray:
        offsets, sizes = (324, 325) if self.tiled else (273, 279)
        raw = UNPACK[self.packed](self.data.part(self.tags[offsets][i], self.tags[sizes][i]))
        if self.predictor == 3:  # bytes of each row by significance, as differences
            planes = np.cumsum(np.frombuffer(raw, np.uint8)[: h * self.bw * bands * self.dtype.itemsize].reshape(h, -1), axis=1, dtype=np.uint8)
            x = np.ascontiguousarray(planes.reshape(h, self.dtype.itemsize, self.bw * bands).transpose(0, 2, 1)).view(self.dtype.newbyteorder(">"))
            return x.reshape(h, self.bw, bands).astype(self.dtype)
        x = np.frombuffer(raw, self.dtype)[: h * self.bw * bands].reshape(h, self.bw, bands)
        return np.cumsum(x, axis=1, dtype=x.dtype) if self.predictor == 2 else x

    def window(self, r0: int, c0: int, h: int, w: int, band: int) -> np.ndarray:
        """A window of a band (from 0), from the blocks that it meets."""
        out = np.zeros((h, w), self.dtype)
        across, down = -(-self.width // self.bw), -(-self.height // self.bh)
        for br in range(r0 // self.bh, (r0 + h - 1) // self.bh + 1):
            for bc in range(c0 // self.bw, (c0 + w - 1) // self.bw + 1):
                rows = self.bh if self.tiled else min(self.bh, self.height - br * self.bh)
                i = br * across + bc + (band * across * down if self.planar else 0)
                x = self.block(i, rows, 1 if self.planar else self.bands)[:, :, 0 if self.planar else band]
                a, b = max(r0, br * self.bh), min(r0 + h, br * self.bh + rows)
                c, d = max(c0, bc * self.bw), min(c0 + w, bc * self.bw + self.bw)
                out[a - r0 : b - r0, c - c0 : d - c0] = x[a - br * self.bh : b - br * self.bh, c - bc * self.bw : d - bc * self.bw]
        return out


#: How blocks are unpacked, by the format's number of the compression.
UNPACK = {1: bytes, 5: lzw, 8: zlib.decompress, 32946: zlib.decompress, 50000: lambda data: zstandard.ZstdDecompressor().decompressobj().decompress(data)}


def encode(bands: np.ndarray, transform: tuple[float, ...] = (1, 0, 0, 0, -1, 0), crs: str | None = None, nodata: float | None = 0, names: list[str] | None = None, block: int = 256) -> bytes:
    """Bands (n, h, w) as a tiled, deflated file; whole numbers with the horizontal predictor."""
    n, h, w = bands.shape
    kind = bands.dtype.newbyteorder("<")
    whole = kind.kind in "ui"
    blocks = []
    for band in bands:
        for r in range(0, h, block):
            for c in range(0, w, block):
                x = np.zeros((block, block), kind)
                part = band[r : r + block, c : c + block]
                x[: part.shape[0], : part.shape[1]] = part
                if whole:
                    x = np.diff(x, axis=1, prepend=np.zeros((block, 1), kind)).astype(kind)
                blocks.append(zlib.compress(x.tobytes()))
    a, _, x0, _, e, y0 = transform
    entries = {
        256: (4, [w]), 257: (4, [h]), 258: (3, [kind.itemsize * 8] * n), 259: (3, [8]), 262: (3, [1]), 277: (3, [n]), 284: (3, [2]), 317: (3, [2 if whole else 1]), 322: (3, [block]), 323: (3, [block]),
        324: (4, [0] * len(blocks)), 325: (4, [len(b) for b in blocks]), 339: (3, [{"u": 1, "i": 2, "f": 3}[kind.kind]] * n), 33550: (12, [a, -e, 0.0]), 33922: (12, [0.0, 0.0, 0.0, x0, y0, 0.0]),
    }
    if crs:
        code = int(crs.rpartition(":")[2])
        entries[34735] = (3, [1, 1, 0, 2, 1024, 0, 1, 2 if code == 4326 else 1, 2048 if code == 4326 else 3072, 0, 1, code])
    if names:
        items = "".join(f'<Item name="DESCRIPTION" sample="{i}" role="description">{escape(v)}</Item>' for i, v in enumerate(names))
        entries[42112] = (2, f"<GDALMetadata>{items}</GDALMetadata>".encode() + b"\0")
    if nodata is not None:
        entries[42113] = (2, f"{nodata:g}".encode() + b"\0")
    at = 8 + 2 + 12 * len(entries) + 4
    body, table = b"", []
    raw = lambda t, v: v if t == 2 else struct.pack(f"<{len(v)}{FIELD[t][1]}", *v)
    spare = {tag: len(raw(*v)) for tag, v in entries.items() if len(raw(*v)) > 4}
    start = at + sum(s + s % 2 for s in spare.values())
    entries[324] = (4, [start + sum(len(b) for b in blocks[:i]) for i in range(len(blocks))])
    for tag in sorted(entries):
        t, v = entries[tag]
        data = raw(t, v)
        if len(data) > 4:
            table.append(struct.pack("<HHII", tag, t, len(v), at + len(body)))
            body += data + b"\0" * (len(data) % 2)
        else:
            table.append(struct.pack("<HHI", tag, t, len(v)) + data.ljust(4, b"\0"))
    return b"II*\0" + struct.pack("<IH", 8, len(table)) + b"".join(table) + b"\0" * 4 + body + b"".join(blocks)


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


META = ["raster_id", "driver", "width", "height", "count", "dtype", "nodata", "crs", "transform", "res", "bounds", "names"]
META_DDL = "raster_id string, driver string, width int, height int, count int, dtype string, nodata double, crs string, transform array<double>, res array<double>, bounds array<double>, names array<string>"


def _reached(path: str) -> bool:
    """Whether Arrow reads parts of the file; other stores are read whole, through Spark."""
    try:
        return fs.FileSystem.from_uri(path)[0].get_file_info(fs.FileSystem.from_uri(path)[1]).is_file
    except Exception:  # noqa: BLE001  (no such scheme, library or right: Spark's reader is the other way)
        return False


def _listed(spark: SparkSession, path: str, recursive: bool) -> tuple[DataFrame, bool]:
    """``path, content`` of the files; without their content if tasks can read parts of them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", str(recursive).lower()).load(path)
    first = found.select("path").first()
    parts = first is not None and _reached(first["path"])
    return found.select("path", (F.lit(None).cast("binary") if parts else F.col("content")).alias("content")), parts


def _open(path: str, content: bytes | None) -> Tiff:
    return Tiff(Bytes(path=path) if content is None else content)


def metadata(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """One row a file: ``raster_id, driver, width, height, count, dtype, nodata, crs, transform, res, bounds, names``; only headers are read where the store allows it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                t = _open(p, data)
                a, _, x, _, e, y = t.transform
                out.append((_stem(p), "GTiff", t.width, t.height, t.bands, str(t.dtype.name), t.nodata, t.crs, [*map(float, t.transform)], [abs(a), abs(e)], [x, y + e * t.height, x + a * t.width, y], t.names()))
            yield pd.DataFrame(out, columns=META)

    return _listed(spark, path, recursive)[0].mapInPandas(run, META_DDL)


def read(spark: SparkSession, path: str, bands: list[int] | None = None, chunk: int = 2048, recursive: bool = False) -> DataFrame:
    """Tiles of all files: windows of ``chunk`` cells, row by row, of the asked bands (from 1; all by default).

    Where tasks can read parts of files (local, shared and object stores that Arrow knows), files are listed by their headers,
    windows are dealt to tasks, and a task reads the blocks that its windows meet. Else a file is read whole by one task
    through Spark (2 GB at most).
    """
    if chunk <= 0:
        raise DataContractError("a window has at least one cell")
    listed, parts = _listed(spark, path, recursive)

    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                t = _open(p, data)
                found = [(p, b, r, c, min(chunk, t.height - r), min(chunk, t.width - c)) for r in range(0, t.height, chunk) for c in range(0, t.width, chunk) for b in bands or range(1, t.bands + 1)]
                yield pd.DataFrame(found, columns=["path", "band", "r0", "c0", "h", "w"])

    def window(t: Tiff, p: str, b: int, r: int, c: int, h: int, w: int) -> pd.DataFrame:
        kind = t.dtype.newbyteorder("<")
        x = t.window(r, c, h, w, b - 1).astype(kind)
        return pd.DataFrame([(_stem(p), b, t.names()[b - 1], r, c, h, w, kind.str, x.tobytes())], columns=["raster_id", "band", "band_name", "r0", "c0", "h", "w", "dtype", "data"])

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple = (None, None)
        for pdf in frames:
            for x in pdf.itertuples():
                if last[0] != x.path:
                    last = (x.path, _open(x.path, None))
                yield window(last[1], x.path, x.band, x.r0, x.c0, x.h, x.w)

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                t = Tiff(data)
                for r in range(0, t.height, chunk):
                    for c in range(0, t.width, chunk):
                        for b in bands or range(1, t.bands + 1):
                            yield window(t, p, b, r, c, min(chunk, t.height - r), min(chunk, t.width - c))

    if not parts:
        return listed.mapInPandas(whole, TILES)
    windows = listed.mapInPandas(plan, "path string, band int, r0 int, c0 int, h int, w int")
    return windows.repartition("path", "r0").sortWithinPartitions("path", "r0", "c0").mapInPandas(cut, TILES)


def cells(tiles: DataFrame) -> DataFrame:
    """``raster_id, band, band_name, r, c, v double`` of every cell of tiles."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for x in pdf.itertuples():
                v = np.frombuffer(x.data, x.dtype).astype(float)
                i = np.arange(len(v))
                yield pd.DataFrame({"raster_id": x.raster_id, "band": x.band, "band_name": x.band_name, "r": x.r0 + i // x.w, "c": x.c0 + i % x.w, "v": v})

    return tiles.mapInPandas(run, "raster_id string, band int, band_name string, r int, c int, v double")


def _entry(tag: int, kind: int, values: list | bytes, spare: list[bytes], at: int) -> bytes:
    """A directory entry of a large file; values that don't fit go to the spare bytes, which begin at ``at``."""
    data = values if kind == 2 else struct.pack(f"<{len(values)}{FIELD[kind][1]}", *values)
    if len(data) <= 8:
        return struct.pack("<HHQ", tag, kind, len(values)) + data.ljust(8, b"\0")
    place = at + sum(map(len, spare))
    spare.append(data + b"\0" * (-len(data) % 8))
    return struct.pack("<HHQQ", tag, kind, len(values), place)


class Writer:
    """A raster written block by block, in order, to a stream (BigTIFF): no more than one block is held."""

    def __init__(self, out, bands: int, height: int, width: int, kind: np.dtype, transform: tuple[float, ...], crs: str | None, nodata: float | None, block: int = 256):
        self.out, self.shape, self.kind, self.transform, self.crs, self.nodata, self.block = out, (bands, height, width), kind, transform, crs, nodata, block
        self.across, self.down = -(-width // block), -(-height // block)
        self.offsets: list[int] = []
        self.sizes: list[int] = []
        self.at = 16
        out.write(b"II+\0" + struct.pack("<HHQ", 8, 0, 0)[:4] + b"\0" * 8)
        self.blank = self._packed(np.full((block, block), nodata or 0, kind))

    def _packed(self, x: np.ndarray) -> bytes:
        if self.kind.kind in "ui":
            x = np.diff(x, axis=1, prepend=np.zeros((self.block, 1), self.kind)).astype(self.kind)
        return zlib.compress(x.tobytes())

    def put(self, number: int, r: np.ndarray, c: np.ndarray, v: np.ndarray) -> None:
        """Block ``number`` (band, row and column of blocks in order); those left out before it are blank."""
        x = np.full((self.block, self.block), self.nodata or 0, self.kind)
        x[r % self.block, c % self.block] = v
        self.fill(number)
        self._add(self._packed(x))

    def fill(self, until: int) -> None:
        while len(self.offsets) < until:
            self._add(self.blank)

    def _add(self, data: bytes) -> None:
        self.offsets.append(self.at)
        self.sizes.append(len(data))
        self.out.write(data)
        self.at += len(data)

    def close(self) -> tuple[int, bytes]:
        """The directory goes last; returns its place, which the file's head has to name, and that head."""
        n, h, w = self.shape
        self.fill(n * self.across * self.down)
        a, _, x0, _, e, y0 = self.transform
        code = int(self.crs.rpartition(":")[2]) if self.crs else None
        fields = [(256, 4, [w]), (257, 4, [h]), (258, 3, [self.kind.itemsize * 8] * n), (259, 3, [8]), (262, 3, [1]), (277, 3, [n]), (284, 3, [2]), (317, 3, [2 if self.kind.kind in "ui" else 1]), (322, 3, [self.block]), (323, 3, [self.block]), (324, 16, self.offsets), (325, 16, self.sizes), (339, 3, [{"u": 1, "i": 2, "f": 3}[self.kind.kind]] * n), (33550, 12, [a, -e, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x0, y0, 0.0])]
        fields += [(34735, 3, [1, 1, 0, 2, 1024, 0, 1, 2 if code == 4326 else 1, 2048 if code == 4326 else 3072, 0, 1, code])] if code else []
        fields += [(42113, 2, f"{self.nodata:g}".encode() + b"\0")] if self.nodata is not None else []
        spare: list[bytes] = []
        after = self.at + 8 + 20 * len(fields) + 8
        table = b"".join(_entry(*f, spare, after) for f in fields)
        self.out.write(struct.pack("<Q", len(fields)) + table + b"\0" * 8 + b"".join(spare))
        return self.at, b"II+\0" + struct.pack("<HHQ", 8, 0, self.at)


def write(cells: DataFrame, folder: str, height: int, width: int, dtype: str = "uint8", nodata: float | None = 0, transform: tuple[float, ...] = (1, 0, 0, 0, -1, 0), crs: str | None = None, bands: int | None = None, block: int = 256) -> DataFrame:
    """A file for each raster of cells (raster_id, r, c, v[, band]); absent cells are nodata (0 if none). Returns ``raster_id, path, blocks`` (written).

    Cells are dealt to rasters and sorted by block, and a task writes a raster block by block, so that it holds one block of
    it. A file gets its name when it is whole. ``folder``: any place that Arrow's file systems reach from every executor;
    a path without a scheme is taken as Spark takes it. ``bands``: how many; by default the largest number among the cells.
    """
    from cinderspark.sources.tables import qualified, written

    spark = cells.sparkSession
    folder = qualified(spark, folder)
    typed = cells.select("raster_id", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("v").cast("double").alias("v"), (F.col("band") if "band" in cells.columns else F.lit(1)).cast("int").alias("band"))
    bands = bands or int(typed.agg(F.max("band").alias("n")).first()["n"] or 1)
    across, down = -(-width // block), -(-height // block)
    number = ((F.col("band") - 1) * down + F.floor(F.col("r") / block)) * across + F.floor(F.col("c") / block)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = fs.FileSystem.from_uri(folder)
        system.create_dir(at, recursive=True)
        now: tuple = (None, None, None, None)  # raster, block, its cells, writer
        done: list[tuple] = []

        def flush() -> None:
            if now[2]:
                x = pd.concat(now[2])
                now[3].put(now[1], x["r"].to_numpy(), x["c"].to_numpy(), x["v"].to_numpy())

        def close() -> None:
            if now[3] is None:
                return
            flush()
            place, head = now[3].close()
            now[3].out.close()
            body = f"{at}/.{now[0]}-body"
            with system.open_output_stream(f"{at}/.{now[0]}") as out, system.open_input_stream(body) as part:
                part.read(16)
                out.write(head)
                while data := part.read(8 << 20):
                    out.write(data)
            system.delete_file(body)
            system.move(f"{at}/.{now[0]}", f"{at}/{now[0]}.tif")
            done.append((now[0], f"{folder}/{now[0]}.tif", len(now[3].offsets)))

        for pdf in frames:
            for (raster, n), part in pdf.groupby(["raster_id", "n"], sort=False):
                if raster != now[0]:
                    close()
                    now = (raster, n, [], Writer(system.open_output_stream(f"{at}/.{raster}-body"), bands, height, width, np.dtype(dtype).newbyteorder("<"), transform, crs, nodata, block))
                elif n != now[1]:
                    flush()
                    now = (raster, n, [], now[3])
                now[2].append(part)
        close()
        yield pd.DataFrame(done, columns=["raster_id", "path", "blocks"])

    ordered = typed.withColumn("n", number.cast("long")).repartition("raster_id").sortWithinPartitions("raster_id", "n")
    return written(ordered.mapInPandas(run, "raster_id string, path string, blocks long"), "rasters")
