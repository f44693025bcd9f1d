"""Gates, signals, progress and evaluation with all of their paths."""

from pyspark.sql import functions as F

from loamgrid.operators import records
from loamgrid.operators import shape as S
from loamgrid.plans.registry import query
from loamgrid.plans.roundtrips_q import _events, _streamed
from loamgrid.sources import writers
from loamgrid.streaming import streams


@query(
    "SELECT c_custkey, round(abs(c_nationkey - 10) * 100 / 10.0, 6) AS percent, CASE WHEN abs(c_nationkey - 10) * 10 <= 30 THEN 'PASS' WHEN c_custkey % 5 = 0 THEN 'EXCEPTION' "
    "WHEN c_custkey % 3 = 0 THEN 'EXPLAINED' ELSE 'BLOCKED' END AS verdict FROM customer"
)
def discrepancy_gate_paths(t):
    """Explanations and approved exceptions beyond the limit."""
    rows = t.customer.select(
        "c_custkey",
        F.col("c_nationkey").alias("measured"),
        F.lit(10).alias("stated"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("resurveyed")).otherwise(" ").alias("why"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(True)).alias("approved"),
    )
    out = S.discrepancy_gate(rows, "measured", "stated", 30.0, "why", "approved")
    return out.select("c_custkey", F.round("percent", 6).alias("percent"), "verdict")


_PLAIN = "trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'))"


@query(
    f"WITH s AS (SELECT p_partkey, p_name, {_PLAIN} AS w, p_size / 100.0 AS vec, p_brand LIKE '%1' AS meta, p_partkey % 200 AS age FROM part), "
    "x AS (SELECT p_partkey, 0.25 * (p_name = 'Part 12')::INT + 0.15 * (w = 'part 12')::INT + 0.15 * len(list_intersect(list_distinct(string_split(w, ' ')), ['12', 'part'])) / 2.0 "
    "+ 0.1 * (1 - levenshtein(w, 'part 12') / greatest(length(w), 7)::DOUBLE) + 0.05 * (array_to_string(list_transform(string_split(w, ' '), lambda z: substr(z, 1, 1)), '') = 'part12')::INT "
    "+ 0.15 * vec + 0.1 * meta::INT + 0.05 * pow(0.5, age / 90.0) AS score FROM s) "
    "SELECT p_partkey, round(round(score, 6), 4) AS score, CASE WHEN round(score, 6) >= 0.9 THEN 'accept' WHEN round(score, 6) >= 0.7 THEN 'review' ELSE 'reject' END AS band FROM x ORDER BY round(score, 6) DESC, p_partkey LIMIT 50"
)
def hybrid_search_signals(t):
    """All eight signals of a hybrid search, combined by weight."""
    rows = t.part.select("p_partkey", "p_name", "p_size", "p_brand")
    signals = S.hybrid_signals(F.col("p_name"), "Part 12", F.col("p_size") / 100.0, F.col("p_brand").like("%1"), F.col("p_partkey") % 200)
    return S.hybrid_rank(rows, signals, "p_partkey", 50).select("p_partkey", F.round("score", 4).alias("score"), "band")


@query(
    "WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) "
    "SELECT count(*) FILTER (rank <= 5) / count(*) AS recall, (SELECT count(*) FILTER (c_acctbal BETWEEN 0 AND 5000) / count(*) FROM customer) AS review_rate FROM r WHERE c_custkey % 4 = 0"
)
def eval_top_k(t):
    """Recall among the first five, and the share of rows in the review band."""
    ranked = S.dedupe_rank(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")])
    relevant = t.customer.filter("c_custkey % 4 = 0").select("c_nationkey", "c_custkey")
    review = t.customer.agg((F.count_if(F.col("c_acctbal").between(0, 5000)) / F.count(F.lit(1))).alias("review_rate"))
    return S.top_k_recall(ranked, relevant, ["c_nationkey", "c_custkey"], 5).crossJoin(F.broadcast(review))


@query(
    "SELECT user_id, round(2.0::DOUBLE * count(*) FILTER (event_type = 'click') + 0.5 * count(*) FILTER (event_type = 'view') + 0.25 * count(*) FILTER (event_type = 'purchase') + "
    "0.1 * count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase')), 2) AS penalty FROM events WHERE ts > TIMESTAMP '2024-01-06' AND ts <= TIMESTAMP '2024-01-20' GROUP BY 1"
)
def recent_contact_window(t):
    """Contacts of the last fourteen days only."""
    kinds = F.when(F.col("event_type") == "click", "call").when(F.col("event_type") == "view", "text").when(F.col("event_type") == "purchase", "email").otherwise("letter")
    rows = t.events.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), kinds.alias("kind"))
    return S.recent_contacts(rows, "user_id", "kind", "ts", "2024-01-20").select("user_id", F.round("penalty", 2).alias("penalty"))


@query(
    "SELECT count(*) AS windows, count(*) FILTER (value > 50) AS terminal, round((count(*) - count(*) FILTER (value > 50)) * (epoch(date_trunc('second', max(ts) FILTER (value > 50))) - "
    "epoch(date_trunc('second', min(ts) FILTER (value > 50)))) / count(*) FILTER (value > 50), 2) AS eta_seconds FROM events"
)
def window_tree_eta(t):
    rows = t.events.select((F.col("value") > 50).alias("done"), F.col("ts").cast("timestamp_ntz").cast("timestamp").alias("ts"))
    return records.progress_eta(rows, "done", "ts").select("windows", "terminal", F.round("eta_seconds", 2).alias("eta_seconds"))


@query(
    "SELECT 'inputs read' AS measure, count(*) AS n FROM orders UNION ALL SELECT 'actions selected', sum(least(n, 20))::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderpriority) "
    "UNION ALL SELECT 'dropped: capacity', sum(greatest(n - 20, 0))::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderpriority)"
)
def capacity_run_summary(t):
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("slot"), F.col("o_totalprice").alias("score"))
    capacity = rows.select("slot").distinct().withColumn("cap", F.lit(20))
    return S.assignment_summary(rows, *S.capacity_assignment(rows, "o_orderkey", "slot", "score", capacity))


@query("SELECT event_id FROM events ORDER BY value DESC, ts DESC, event_id LIMIT 100")
def order_by_score_loaded(t):
    """By score, then by the time it was loaded, both falling."""
    return t.events.orderBy(F.desc("value"), F.desc("ts"), F.asc("event_id")).limit(100).select("event_id")


@query(
    "SELECT label, src, dst, fault FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'knows' ELSE 'located_in' END AS label, 'c' || c_custkey AS src, CASE WHEN c_custkey % 7 = 0 THEN 'r' || (c_nationkey % 5) ELSE 'n' || c_nationkey END AS dst, "
    "CASE WHEN c_custkey % 10 = 0 THEN 'unknown_label' WHEN c_custkey % 7 = 0 THEN 'endpoint_labels' END AS fault FROM customer) WHERE fault IS NOT NULL"
)
def lexicon_endpoints(t):
    """Edges whose ends' labels the lexicon does not allow."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    vertex = lambda df, p, c, label: df.select(name(p, c).alias("id"), F.lit(label).alias("label"))
    vertices = vertex(t.customer, "c", "c_custkey", "company").unionByName(vertex(t.nation, "n", "n_nationkey", "place"))
    vertices = vertices.unionByName(vertex(t.region, "r", "r_regionkey", "region"))
    region = F.concat(F.lit("r"), (F.col("c_nationkey") % 5).cast("string"))
    edges = t.customer.select(
        F.when(F.col("c_custkey") % 10 == 0, "knows").otherwise("located_in").alias("label"),
        name("c", "c_custkey").alias("src"),
        F.when(F.col("c_custkey") % 7 == 0, region).otherwise(name("n", "c_nationkey")).alias("dst"),
    )
    allowed = t.spark.sql("SELECT * FROM VALUES ('located_in', 'company', 'place') AS l(label, src_label, dst_label)")
    return S.endpoint_faults(edges, vertices, allowed)


@query(
    "SELECT CAST(min(r) // 100 AS INTEGER) AS shard, min(c_custkey) AS first, max(c_custkey) AS last, count(*) AS documents FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS r FROM customer) GROUP BY r // 100"
)
def json_shard_index(t):
    shards = writers.json_shards(t.customer.select("c_custkey", "c_name"), "c_custkey", 100)
    return writers.shard_index(shards, "c_custkey").filter("length(content_id) = 64").drop("content_id")


@query(
    "SELECT a.event_id AS left_id, b.event_id AS right_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 2 HOUR "
    "WHERE a.event_type = 'click' AND b.event_type = 'purchase'"
)
def stream_joined(t):
    """Clicks and the purchases within two hours after them, as a join of two streams."""
    side = lambda kind: _events(t).filter(F.col("event_type") == kind).select("user_id", "ts", F.col("event_id").alias("id"))
    return _streamed(t, streams.joined_streams(side("click"), side("purchase"), "user_id", "ts", "2 HOURS", "1 hour")).select("left_id", "right_id")
