"""Session defaults, and cutting a plan's lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only for a local master (tests, a laptop).
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints/geoloom"


def session(name: str = "geoloom", **settings: str) -> SparkSession:
    """A session with the settings that the engine expects; adaptive execution and ANSI mode are Spark's defaults."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    for k, v in settings.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


#: Folders made for intermediate tables and files, by session.
_folders: dict[str, set[str]] = {}


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = LOCAL_CHECKPOINTS
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that doesn't exist yet, in the shared folder, where all executors reach it; ``sweep`` deletes it."""
    path = f"{_base(spark)}/{name}-{uuid.uuid4().hex}"
    _folders.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: later steps neither repeat the work nor need the executors that did it.

    Unlike a checkpoint's, the table's size is known to the planner, so a side that
    has grown by exploding isn't taken for a small one.
    """
    path = new_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> int:
    """Deletes the intermediate folders of this session, once all results that read them are written; returns how many."""
    left = _folders.pop(spark.sparkContext.applicationId, set())
    for path in left:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(spark._jsc.hadoopConfiguration())
        for name in (path, f"{path}.tif", f"{path}.json"):
            store.delete(spark._jvm.org.apache.hadoop.fs.Path(name), True)
    return len(left)
