"""Sinks, each with the count or digest that proves it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.operators.numbering import materialise, running_before


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write and return the number of rows, read back from the footers."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def sink_csv(df: DataFrame, path: str) -> None:
    """Stable column order, quotes only where needed, doubled within."""
    df.write.options(header=True, escape='"', quote='"', emptyValue="", nullValue="").csv(path)


def sink_jsonl(df: DataFrame, path: str, gzip: bool = False, rows_per_file: int = 5000) -> None:
    """One object a line without null keys, in bounded parts."""
    df.write.options(compression="gzip" if gzip else "none", maxRecordsPerFile=rows_per_file, ignoreNullFields=True).json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of the files under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_manifest(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """(path, fault): files that are missing, unexpected or changed against a manifest."""
    have = manifest(spark, path).select("path", F.col("sha256").alias("_h"))
    both = expected.select("path", F.col("sha256").alias("_e")).join(have, "path", "full")
    fault = (
        F.when(F.col("_h").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(F.col("_h") != F.col("_e"), "changed")
    )
    return both.select("path", fault.alias("fault")).filter("fault is not null")


def shard_index(shards: DataFrame, key: str) -> DataFrame:
    """(shard, first, last, documents, content_id): the index of ``json_shards``, a digest over each shard's content ids in order."""
    ids = F.transform(F.sort_array(F.collect_list(F.struct(key, "content_id"))), lambda s: s["content_id"])
    sums = shards.groupBy("shard").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("documents"), ids.alias("_ids"))
    return sums.select("shard", "first", "last", "documents", F.sha2(F.array_join("_ids", ""), 256).alias("content_id"))


def json_shards(df: DataFrame, key: str, per_shard: int = 10_000) -> DataFrame:
    """(key, shard, document, content_id): one JSON document per row, in shards of so many by rank of the key.

    Ranks come from a range partitioning and counts per partition, not from one sorted task.
    """
    docs = df.select(key, F.to_json(F.struct(*df.columns)).alias("document"), F.lit(0).alias("_all"))
    held = materialise(docs.repartitionByRange(F.col(key)), "json-shards", with_pid=True)
    ranked = running_before(held, ["_all"], [F.col(key)], F.lit(1).cast("bigint"), "_place")
    shard = F.floor(F.col("_place") / per_shard).cast("int")
    return ranked.select(key, shard.alias("shard"), "document", F.sha2("document", 256).alias("content_id"))
