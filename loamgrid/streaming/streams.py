"""Structured Streaming forms of the event operators; each has a batch twin in the query catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 4) -> DataFrame:
    """A stream over a folder of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def unique_events(events: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """Each idempotency key once; state is bounded by the watermark."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, at: str, delay: str, size: str, slide: str | None, by: list[str]) -> DataFrame:
    """Counts by event-time window; late events within the delay still count."""
    frame = F.window(at, size, slide) if slide else F.window(at, size)
    sums = events.withWatermark(at, delay).groupBy(frame, *by).agg(F.count(F.lit(1)).alias("n"))
    return sums.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def session_counts(events: DataFrame, at: str, delay: str, gap: str, by: list[str]) -> DataFrame:
    sums = events.withWatermark(at, delay).groupBy(F.session_window(at, gap), *by).agg(F.count(F.lit(1)).alias("n"))
    return sums.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def joined_streams(left: DataFrame, right: DataFrame, key: str, at: str, within: str, delay: str) -> DataFrame:
    """Pairs of left and right events (key, at, id) of one key, the right one up to ``within`` after the left one.

    Both watermarks and the time bound let the state of old events go.
    """
    a, b = (df.withWatermark(at, delay).alias(n) for df, n in ((left, "a"), (right, "b")))
    near = F.expr(f"a.{key} = b.{key} AND b.{at} >= a.{at} AND b.{at} <= a.{at} + INTERVAL {within}")
    return a.join(b, near).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"))


def run_every(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval: str):
    """A query that publishes on its own every ``interval``; the caller stops it."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval).start()


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process what is there, batch by batch, with replay from the checkpoint after a failure.

    ``sink`` gets (rows, batch id) and must be idempotent: a batch that failed is given again under its number.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def idempotent_parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch replaces its own partition, so a replay leaves one copy."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")

    return write


def whole_parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch replaces the whole result, as complete output asks for."""
    return lambda rows, batch: rows.write.mode("overwrite").parquet(path)


def complete_transactions(changes: DataFrame, transaction: str, sequence: str, size: str) -> DataFrame:
    """Changes of the transactions that are there in full: as many distinct sequence numbers as their rows state.

    Repeated deliveries of a change count once; the rest waits for a later batch.
    """
    seen = changes.groupBy(transaction).agg(F.count_distinct(sequence).alias("_seen"), F.max(size).alias("_size"))
    ready = seen.filter(F.col("_seen") >= F.col("_size")).select(transaction)
    rest = [c for c in changes.columns if c not in (transaction, sequence)]
    once = changes.join(ready, transaction, "left_semi").groupBy(transaction, sequence).agg(F.min(F.struct(*rest)).alias("_r"))
    return once.select(transaction, sequence, "_r.*").select(changes.columns)


def ready_only(rows: DataFrame, versions: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of the newest version of each key that is marked ready (key, version, ready); keys without one give none."""
    newest = versions.filter("ready").groupBy(key).agg(F.max(version).alias(version))
    return rows.join(newest, [key, version], "left_semi")


def tombstone_state(current: DataFrame, batch: DataFrame, key: str, at: str, deleted: str) -> DataFrame:
    """The newest row of each key after a batch; keys whose newest row is a tombstone go."""
    rows = current.unionByName(batch)
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), at).alias("_n"))
    return newest.select(key, "_n.*").filter(~F.col(deleted))
