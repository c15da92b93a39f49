"""Cutting lineage at shared storage, so that work done once is read back and not repeated."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[str] = []


def tables_written() -> int:
    """How many tables ``materialize`` has written in this driver."""
    return len(_written)


def discard_written(spark: SparkSession, since: int, read_by: DataFrame) -> None:
    """Delete the tables that ``materialize`` wrote after ``since`` and that ``read_by`` does not read.

    For the owner of a chain of jobs: once a job's result is written, nothing needs its tables.
    """
    used = read_by.inputFiles()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _written[since:]:
        folder = path.rpartition("/")[2]
        if not any(f"/{folder}/" in file for file in used):
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def scratch_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a local master may do without: it gets a temporary
    folder, which on a cluster other executors could not read."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/spanweave/{name}-{uuid.uuid4().hex}"


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned and that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        folders = {file.rpartition("/")[0].rpartition("/")[2] for file in table.inputFiles()}
        for path in _written:
            if path.rpartition("/")[2] in folders:
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, name: str = "table", once: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Unlike a cached plan this survives the loss of executors, and unlike an RDD checkpoint readers
    still prune columns, push filters down and know the true size when choosing a join. With ``once`` the
    shuffles of the write are removed when it ends, and not whenever the driver collects garbage.
    """
    path = scratch_path(df.sparkSession, name)
    before = df.sparkSession.conf.get(SHUFFLE_CLEANUP, None)
    if once:
        df.sparkSession.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if once and before is None:
            df.sparkSession.conf.unset(SHUFFLE_CLEANUP)
        elif once:
            df.sparkSession.conf.set(SHUFFLE_CLEANUP, before)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
