"""Stable intermediate tables in the shared scratch folder, and distributed numbering over them."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_scratch: list[str] = []
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only where none is named and all runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_scratch:
        held = tempfile.TemporaryDirectory(prefix="loamgrid-")
        atexit.register(held.cleanup)
        _own_scratch.append("file://" + held.name)
    return _own_scratch[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the scratch folder; ``release`` deletes what is there."""
    path = f"{scratch_root(spark)}/loamgrid/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialise(df: DataFrame, name: str, with_pid: bool = False) -> DataFrame:
    """Write a table into the shared scratch folder and return its scan: lineage ends there.

    Lost executors cost nothing, since files are committed per task. ``with_pid`` adds ``pid``, the number of the
    partition that wrote the row; being stored, it stays the same however often the table is read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df.withColumn("pid", F.spark_partition_id()) if with_pid else df
    out.write.option("compression", "zstd").parquet(path)
    held = spark.read.schema(out.schema).parquet(path)
    held._scratch_path = path
    return held


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if path in _written:
        _written.remove(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``materialise`` that nothing reads any more, such as those of a loop's last round."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path is not None:
            _delete(df.sparkSession, path)


def release(spark: SparkSession) -> int:
    """Delete all tables that ``materialise`` wrote in this process and that still stand; results not read yet are lost."""
    held = list(_written)
    for path in held:
        _delete(spark, path)
    return len(held)


def running_before(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same keys that come before this one.

    ``df`` has the column ``pid`` of ``materialise``. Rows are ordered by (pid, order); a window only ever holds the
    rows of one key in one partition, and the sums per (key, pid) are carried across partitions, so that a key with
    a third of all rows is numbered by many tasks. Keys must not be null.
    """
    held = df.withColumn("_v", value)
    sums = held.groupBy(*keys, "pid").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*keys, "pid", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_b"))
    local = Window.partitionBy(*keys, "pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = held.withColumn("_l", F.coalesce(F.sum("_v").over(local), F.lit(0))).join(base, [*keys, "pid"])
    return out.withColumn(name, F.col("_b") + F.col("_l")).drop("_v", "_b", "_l")
