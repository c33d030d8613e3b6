"""Helpers shared by the corpus operators: tables in the shared folder, word patterns, batch slicing."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: The names that Arrow has for schemes of Hadoop's.
SCHEMES = {"s3a://": "s3://", "s3n://": "s3://", "wasbs://": "abfss://", "dbfs:/": "file:///dbfs/", "viewfs://": "hdfs://"}
#: Only for a local master (tests, a laptop).
LOCAL_SHARED = "file:///tmp/checkpoints/geoloom"


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors can reach: ``spark.checkpoint.dir``; without it a local one, which only a local master may use."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return LOCAL_SHARED


#: Folders of tables that may still be read, by session.
_folders: dict[str, set[str]] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what comes after survives the loss of any executor
    without running what came before again.  ``discard`` deletes the table when
    nothing reads it any more; ``sweep`` deletes what is left.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/geoloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    remember(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def remember(spark: SparkSession, path: str) -> None:
    _folders.setdefault(spark.sparkContext.applicationId, set()).add(path)


def hadoop(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them: any scheme that Spark itself can read and write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a folder that executors reach, named as Spark names it."""
    for known, ours in SCHEMES.items():
        if uri.startswith(known):
            uri = ours + uri[len(known) :].lstrip("/")
    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def _delete(spark: SparkSession, path: str) -> None:
    store, at = hadoop(spark, path)
    store.delete(at, True)
    _folders.get(spark.sparkContext.applicationId, set()).discard(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored``, once all that reads them has been written itself."""
    for df in tables:
        _delete(df.sparkSession, df.stored_path)


def sweep(spark: SparkSession) -> int:
    """Deletes all intermediate folders that this session still holds, after its results have been written; returns how many."""
    left = sorted(_folders.get(spark.sparkContext.applicationId, ()))
    for path in left:
        _delete(spark, path)
    return len(left)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what one Arrow batch of whole texts holds; texts may be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows of an Arrow batch for the jobs that run inside: more where rows are a few numbers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str = "text"):
    """Whole text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` characters each; a longer text has a run of its own."""
    begin = size = 0
    for i, x in enumerate(texts):
        if i > begin and size + len(x) > most:
            yield begin, i
            begin, size = i, 0
        size += len(x)
    if begin < len(texts):
        yield begin, len(texts)
