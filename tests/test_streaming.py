"""Streams over files equal their batch twins, also after a replay."""

from pyspark.sql import functions as F

from loamgrid.streaming import streams


def run(stream, spark, path, mode="append"):
    q = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{path}/cp").option("path", f"{path}/out")
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


def source(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.unionByName(batch.filter("event_id % 5 = 0")).repartitionByRange(4, "ts").write.parquet(f"{tmp_path}/in")
    return batch, streams.event_stream(spark, f"{tmp_path}/in", batch.schema, 1)


def test_unique_events_and_replay(spark, sf_dir, tmp_path):
    batch, stream = source(spark, sf_dir, tmp_path)
    got = run(streams.unique_events(stream, "event_id", "ts", "60 days"), spark, f"{tmp_path}/u")
    assert sorted(r[0] for r in got.select("event_id").collect()) == sorted(r[0] for r in batch.select("event_id").collect())
    sink = streams.idempotent_parquet_sink(f"{tmp_path}/sink")
    streams.run_available(stream, sink, f"{tmp_path}/cp1")
    once = spark.read.parquet(f"{tmp_path}/sink").count()
    streams.run_available(stream, sink, f"{tmp_path}/cp2")
    assert spark.read.parquet(f"{tmp_path}/sink").count() == once


def test_windows(spark, sf_dir, tmp_path):
    batch, stream = source(spark, sf_dir, tmp_path)
    got = run(streams.windowed_counts(stream, "ts", "60 days", "1 day", None, ["event_type"]), spark, f"{tmp_path}/w")
    want = batch.unionByName(batch.filter("event_id % 5 = 0")).groupBy(F.window("ts", "1 day"), "event_type").count()
    have = {(r["start"], r["event_type"]): r["n"] for r in got.collect()}
    all_ = {(r["window"]["start"], r["event_type"]): r["count"] for r in want.collect()}
    assert set(have.items()) <= set(all_.items())
    sessions = streams.session_counts(batch, "ts", "1 day", "12 hours", ["user_id"])
    assert sessions.agg(F.sum("n")).first()[0] == batch.count()


def test_tombstones(spark):
    schema = "k int, at int, v string, gone boolean"
    current = spark.createDataFrame([(1, 1, "a", False), (2, 1, "b", False)], schema)
    batch = spark.createDataFrame([(1, 2, "a2", False), (2, 3, None, True), (3, 1, "c", False)], schema)
    assert sorted((r["k"], r["v"]) for r in streams.tombstone_state(current, batch, "k", "at", "gone").collect()) == [(1, "a2"), (3, "c")]
