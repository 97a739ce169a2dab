"""Working tables in the folder that every executor shares."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from cinderspark.errors import DataContractError

#: Spark's settings while a working table is written: shuffle files are deleted at the end of its query, and rows go to Python
#: in batches of 1 MB (64 MB otherwise), since a batch of texts is held by the JVM and the worker, and neither gives its memory back.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20)}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local one only where that is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise DataContractError("spark.checkpoint.dir names no folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cinderspark-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark would take it to."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends or at :func:`drop_written`."""
    path = f"{shared_dir(spark)}/cinderspark/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, columns stay prunable.

    What the write has shuffled isn't needed after it, so Spark deletes it at once instead of when the driver collects garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = {k: spark.conf.get(k, None) for k in WRITING}
    try:
        for k, v in WRITING.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_at = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop(df: DataFrame) -> None:
    """Delete the working table that :func:`written` gave; nothing may read from it afterwards."""
    entry = (df.sparkSession, df.written_at)
    if entry in _written:
        _written.remove(entry)
        _delete(*entry)


@contextlib.contextmanager
def scratch():
    """Working tables made inside are deleted at the end, but for those that are appended to the list it gives."""
    before, kept = {path for _, path in _written}, []
    yield kept
    stay = before | {df.written_at for df in kept}
    for entry in [x for x in _written if x[1] not in stay]:
        _written.remove(entry)
        _delete(*entry)


def drop_written(spark: SparkSession | None = None) -> None:
    """Delete the working tables of ``spark`` (of every session, if None). Results read from them must be done with."""
    for entry in [x for x in _written if spark is None or x[0] is spark]:
        _written.remove(entry)
        try:
            _delete(*entry)
        except Exception:  # noqa: BLE001  the session has ended; nothing is left to ask
            continue


atexit.register(drop_written)
