"""Snapshot-paged sources: a plan of disjoint id ranges that executors fetch on their own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def page_plan(spark: SparkSession, max_id: int, page_size: int) -> DataFrame:
    """(page, after, upto): id ranges (after, upto] that cover 1..max_id, fixed at the snapshot's highest id."""
    n = -(-max_id // page_size)
    return spark.range(n).select(
        F.col("id").alias("page"), (F.col("id") * page_size).alias("after"), F.least((F.col("id") + 1) * page_size, F.lit(max_id)).alias("upto")
    )


def page_of(id_: Column, page_size: int) -> Column:
    """The page of ``page_plan`` that has the id."""
    return F.floor((id_ - 1) / page_size).cast("bigint")


def fetch_pages(plan: DataFrame, fetch: Callable[[int, int], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of ``fetch(after, upto)`` for each page; a page that fails is fetched again with its task."""
    names = [part.strip().split()[0] for part in schema.split(",")]

    def run(batches):
        for pdf in batches:
            for after, upto in zip(pdf["after"], pdf["upto"]):
                yield pd.DataFrame(list(fetch(int(after), int(upto))), columns=names)

    return plan.mapInPandas(run, schema)


def delta_where(clauses: list[str], column: str, start: str, through: str) -> str:
    """Clauses and a half-open date range, and-combined: from start on, before the day after ``through``."""
    spread = [f"{column} >= DATE '{start}'", f"{column} < date_add(DATE '{through}', 1)"]
    return " AND ".join(f"({c})" for c in [*clauses, *spread])


def scan_json_tree(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Multi-line JSON files below a folder; small files share tasks by the session's file settings."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema else reader).json(path)


def scan_partitioned(spark: SparkSession, path: str, required: tuple[str, ...], **values) -> DataFrame:
    """A partitioned table; a filter on every required partition column is demanded, so that no scan is unbounded."""
    lacking = [c for c in required if c not in values]
    if lacking:
        raise ValueError(f"partition filters are required: {lacking}")
    df = spark.read.parquet(path)
    for column, value in values.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df
