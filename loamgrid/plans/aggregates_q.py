"""Aggregations, reconciliation, windows, paging, sets, deduplication."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loamgrid.operators import joins as J
from loamgrid.operators import shape as S
from loamgrid.plans.registry import query

CENTS = "CAST(round({0} * 100) AS BIGINT)"


def cents(column):
    return F.round(F.col(column) * 100).cast("bigint")


@query(
    "SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL "
    "SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events"
)
def count_all(t):
    count = lambda name: getattr(t, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
    out = count("customer")
    for name in ("orders", "lineitem", "events"):
        out = out.unionByName(count(name))
    return out


@query(
    "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, count(*) FILTER (o_totalprice > 250000) AS large, "
    "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1"
)
def group_counts(t):
    """Counts, distinct counts, filtered counts and exact sums by status."""
    return t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("o_custkey").alias("customers"),
        F.count_if(F.col("o_totalprice") > 250000).alias("large"),
        F.sum(cents("o_totalprice")).alias("cents"),
    )


@query(
    "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ' | ' ORDER BY c_mktsegment) AS segments, count(DISTINCT c_mktsegment) AS n, "
    "min(c_mktsegment) AS first FROM customer GROUP BY 1"
)
def collect_distinct_text(t):
    names = F.array_sort(F.collect_set("c_mktsegment")).alias("s")
    grouped = t.customer.groupBy("c_nationkey").agg(names)
    return grouped.select(
        "c_nationkey",
        F.array_join("s", " | ").alias("segments"),
        F.size("s").cast("bigint").alias("n"),
        F.element_at("s", 1).alias("first"),
    )


@query(
    "SELECT p_brand, count(*) AS profiles, count(DISTINCT p_type) AS types, CAST(min(p_size) AS INTEGER) AS least, CAST(max(p_size) AS INTEGER) AS most "
    "FROM part GROUP BY 1"
)
def entity_collapse(t):
    return t.part.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("profiles"),
        F.size(F.collect_set("p_type")).cast("bigint").alias("types"),
        F.min("p_size").alias("least"),
        F.max("p_size").alias("most"),
    )


@query(
    "SELECT o_custkey, strftime(min(least(o_orderdate, l_shipdate)), '%Y-%m-%d') AS first, strftime(max(greatest(o_orderdate, l_shipdate)), "
    "'%Y-%m-%d') AS last FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"
)
def min_max_dates(t):
    """Earliest and latest over several date columns, nulls passed over; lines are pre-aggregated before the join."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    joined = t.orders.join(lines, "o_orderkey", "left").groupBy("o_custkey")
    out = joined.agg(F.min(F.least("o_orderdate", "a")).alias("first"), F.max(F.greatest("o_orderdate", "b")).alias("last"))
    return out.select("o_custkey", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first", "last")])


@query(
    "WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT r_name, n_name, count(*) AS attempted, count(n) AS succeeded, "
    "count(*) - count(n) AS failed, CAST(coalesce(sum(n), 0) AS BIGINT) AS permits, CASE WHEN count(n) = 0 THEN 'none' WHEN count(n) < count(*) THEN 'partial' "
    "ELSE 'full' END AS availability FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey "
    "LEFT JOIN o ON o_custkey = c_custkey GROUP BY 1, 2"
)
def coverage_by_jurisdiction(t):
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = t.customer.join(orders, "c_custkey", "left").groupBy("c_nationkey")
    sums = rows.agg(F.count(F.lit(1)).alias("attempted"), F.count("n").alias("succeeded"), F.coalesce(F.sum("n"), F.lit(0)).alias("permits"))
    named = sums.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    kind = S.decide([(F.col("succeeded") == 0, "none"), (F.col("succeeded") < F.col("attempted"), "partial")], "full")
    return named.select(
        "r_name", "n_name", "attempted", "succeeded", (F.col("attempted") - F.col("succeeded")).alias("failed"), "permits", kind.alias("availability")
    )


@query(
    "SELECT count(*) AS total, CAST(count(*) FILTER (o_orderstatus = 'F') + count(*) FILTER (o_orderstatus = 'O') + count(*) FILTER (o_orderstatus = 'P') "
    "AS BIGINT) AS parts, count(*) = count(*) FILTER (o_orderstatus IN ('F', 'O', 'P')) AS reconciled FROM orders"
)
def reconcile_totals(t):
    parts = sum((F.count_if(F.col("o_orderstatus") == s) for s in "OP"), F.count_if(F.col("o_orderstatus") == "F"))
    out = t.orders.agg(F.count(F.lit(1)).alias("total"), parts.alias("parts"))
    return out.withColumn("reconciled", F.col("total") == F.col("parts"))


@query(
    "SELECT 'quality' AS \"column\", count(quality) AS populated, count(quality) / count(*) AS ratio FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id "
    "UNION ALL SELECT 'lang', count(lang), count(lang) / count(*) FROM documents"
)
def null_completeness(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return S.completeness(rows, ["quality", "lang"])


@query(
    "SELECT status, count(*) AS n, CAST(sum(CASE WHEN late THEN 1 ELSE 0 END) AS BIGINT) AS late FROM (SELECT o_orderstatus AS status, "
    "o_orderdate > TIMESTAMP '1998-01-01' AS late FROM orders) GROUP BY ROLLUP (status)"
)
def batch_status_counts(t):
    late = F.col("o_orderdate").cast("timestamp_ntz") > F.lit("1998-01-01").cast("timestamp_ntz")
    rolled = t.orders.rollup(F.col("o_orderstatus").alias("status"))
    return rolled.agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"))


@query(
    "SELECT p_brand, CASE WHEN count(*) >= 50 THEN round(count(*) FILTER (p_size > 25) / count(*), 4) END AS ratio, count(*) AS sample FROM part GROUP BY 1"
)
def ratio_recipe(t):
    n = F.count(F.lit(1))
    ratio = F.when(n >= 50, F.round(F.count_if(F.col("p_size") > 25) / n, 4))
    return t.part.groupBy("p_brand").agg(ratio.alias("ratio"), n.alias("sample"))


@query("SELECT count(*) AS rows, count(DISTINCT l_suppkey) AS businesses, count(DISTINCT l_suppkey) FILTER (l_discount > 0.08 OR l_tax > 0.07) AS sub_par FROM lineitem")
def rows_vs_distinct(t):
    bad = (F.col("l_discount") > 0.08) | (F.col("l_tax") > 0.07)
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("l_suppkey").alias("businesses"),
        F.count_distinct(F.when(bad, F.col("l_suppkey"))).alias("sub_par"),
    )


@query(
    "SELECT c_nationkey, CASE WHEN abs(a - b) * 100 > 5 * b THEN 'BLOCKED' ELSE 'OK' END AS verdict FROM (SELECT c_nationkey, "
    "count(*) AS a, count(*) FILTER (c_acctbal > 0) AS b FROM customer GROUP BY 1)"
)
def discrepancy_gate(t):
    sums = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("c_acctbal") > 0).alias("b"))
    wide = F.abs(F.col("a") - F.col("b")) * 100 > 5 * F.col("b")
    return sums.select("c_nationkey", F.when(wide, "BLOCKED").otherwise("OK").alias("verdict"))


@query(
    "SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1"
)
def quantiles(t):
    """Nearest-rank percentiles."""
    return S.nearest_rank(t.events, "event_type", "value", {"p50": 0.5, "p95": 0.95})


@query(
    "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderdate DESC, "
    "o_orderpriority, o_orderkey) AS r FROM orders) WHERE r = 1"
)
def row_number_best(t):
    order = [F.col("o_totalprice").desc_nulls_last(), F.desc("o_orderdate"), F.asc("o_orderpriority"), F.asc("o_orderkey")]
    return J.latest_rows(t.orders, "o_custkey", order).select("o_custkey", "o_orderkey")


@query(
    "SELECT o_custkey, max(y) AS year, arg_max(k, (y, k)) AS latest FROM (SELECT o_custkey, year(o_orderdate) AS y, o_orderkey AS k FROM orders) GROUP BY 1"
)
def latest_tax_year(t):
    """Highest year per key, ties by ordinal."""
    rows = t.orders.select("o_custkey", F.year("o_orderdate").cast("bigint").alias("y"), F.col("o_orderkey").alias("k"))
    out = rows.groupBy("o_custkey").agg(F.max("y").alias("year"), F.max_by("k", F.struct("y", "k")).alias("latest"))
    return out


@query(
    "SELECT l_orderkey, min(l_linenumber) AS first_line, arg_min(l_partkey, (l_linenumber, l_partkey)) AS part FROM lineitem GROUP BY 1"
)
def primary_structure(t):
    rows = t.lineitem.groupBy("l_orderkey")
    return rows.agg(F.min("l_linenumber").alias("first_line"), F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("part"))


@query(
    "SELECT o_custkey, best, next, coalesce(best - next < 1000000, false) AS ambiguous FROM (SELECT o_custkey, max(c) FILTER (r = 1) AS best, "
    "max(c) FILTER (r = 2) AS next FROM (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) GROUP BY 1)"
)
def top2_margin(t):
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    rows = t.orders.select("o_custkey", cents("o_totalprice").alias("c"), rank.alias("r")).filter("r <= 2")
    two = rows.groupBy("o_custkey").agg(F.max(F.when(F.col("r") == 1, F.col("c"))).alias("best"), F.max(F.when(F.col("r") == 2, F.col("c"))).alias("next"))
    return two.withColumn("ambiguous", F.coalesce(F.col("best") - F.col("next") < 1000000, F.lit(False)))


@query(
    "SELECT user_id, arg_max(event_type, event_id) AS state, max(event_id) AS last_event FROM events WHERE ts <= TIMESTAMP '2024-01-15' GROUP BY 1 "
    "HAVING arg_max(event_type, event_id) <> 'view'"
)
def latest_before_cutoff(t):
    early = t.events.filter(F.col("ts").cast("timestamp_ntz") <= F.lit("2024-01-15").cast("timestamp_ntz"))
    out = early.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("state"), F.max("event_id").alias("last_event"))
    return out.filter("state <> 'view'")


@query(
    "SELECT o_orderkey, lag(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w AS prior, CAST(round(o_totalprice * 100) AS BIGINT) > lag(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w AS rose "
    "FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
)
def snapshot_vs_prior(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", cents("o_totalprice").alias("c"))
    return rows.withColumn("prior", F.lag("c").over(w)).select("o_orderkey", "prior", (F.col("c") > F.col("prior")).alias("rose"))


@query(
    "WITH x AS (SELECT user_id, dayofmonth(ts) // 10 AS release FROM events) SELECT user_id, min(release) AS first_seen, max(release) AS last_seen, "
    "max(release) = (SELECT max(release) FROM x) AS is_current FROM x GROUP BY 1"
)
def release_lifecycle(t):
    rows = t.events.select("user_id", F.floor(F.dayofmonth("ts") / 10).cast("bigint").alias("release"))
    newest = F.broadcast(rows.agg(F.max("release").alias("newest")))
    seen = rows.groupBy("user_id").agg(F.min("release").alias("first_seen"), F.max("release").alias("last_seen"))
    return seen.crossJoin(newest).select("user_id", "first_seen", "last_seen", (F.col("last_seen") == F.col("newest")).alias("is_current"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey LIMIT 50")
def order_by_date_limit(t):
    top = t.orders.orderBy(F.col("o_orderdate").desc_nulls_first(), "o_orderkey").limit(50)
    return top.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("SELECT p_partkey, p_name, (SELECT count(*) FROM part WHERE p_size > 20) AS total_count FROM part WHERE p_size > 20 ORDER BY p_name, p_partkey LIMIT 25 OFFSET 50")
def paged_search(t):
    rows = t.part.filter("p_size > 20").select("p_partkey", "p_name")
    return S.page(rows, [F.asc("p_name"), F.asc("p_partkey")], 25, 50)


@query("SELECT p_brand, count(*) AS n, (SELECT count(*) FROM part) AS total FROM part GROUP BY 1")
def facet_count(t):
    return S.facets(t.part.select("p_brand"), "p_brand")


@query(
    "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1"
)
def dedupe_first(t):
    """The first of each text, by digest; the rank's limit is applied before the shuffle too."""
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("h"))
    return S.dedupe_first(rows, ["h"], [F.asc("doc_id")]).select("doc_id")


@query(
    "SELECT l_orderkey, l_linenumber, count(DISTINCT (l_partkey, l_suppkey)) AS variants FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT (l_partkey, l_suppkey)) > 1"
)
def dedupe_conflicts(t):
    return S.conflicting_keys(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query(
    "SELECT l_orderkey, arg_max(l_partkey, (l_extendedprice, l_linenumber, l_partkey)) AS part, count(*) AS n_sources FROM lineitem GROUP BY 1"
)
def merge_duplicates(t):
    rows = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("part"), F.struct("l_extendedprice", "l_linenumber", "l_partkey").alias("v"))
    return S.merge_duplicates(rows, "l_orderkey", "v", "part", []).select("l_orderkey", "part", "n_sources")


@query(
    "SELECT count(*) AS raw, count(DISTINCT k) AS \"unique\", count(*) - count(DISTINCT k) AS duplicate FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' "
    "UNION ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')"
)
def union_all_parts(t):
    part = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return S.union_counts([part("F"), part("O")], "k")


@query(
    "WITH w AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0), h AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1) "
    "SELECT coalesce(w.k, h.k) AS k, CASE WHEN n IS NULL THEN 'missing' WHEN w.k IS NULL THEN 'unexpected' ELSE 'duplicate' END AS fault FROM w FULL JOIN h ON h.k = w.k "
    "WHERE n IS NULL OR w.k IS NULL OR n > 1"
)
def symmetric_gate(t):
    required = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"))
    actual = t.orders.filter("o_custkey % 3 = 0").select(F.col("o_custkey").alias("k"))
    return S.symmetric_gate(required, actual, "k")


@query(
    "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT s_suppkey, s_nationkey FROM supplier"
)
def upsert_by_source(t):
    new = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"))
    return S.upsert(t.customer.select("c_custkey", "c_nationkey"), new, ["c_custkey"])


@query(
    "SELECT coalesce(c_custkey, s_suppkey) AS k, coalesce(s_name, c_name) AS name, coalesce(c_nationkey, s_nationkey) AS link "
    "FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0) FULL JOIN supplier ON s_suppkey = c_custkey"
)
def merge_on_conflict(t):
    """Insert or update; an existing link survives."""
    current = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("link"))
    new = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("link"))
    return S.merge_keep(current, new, ["k"], ["link"])


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT'")
def source_scoped_delete(t):
    return t.orders.filter("o_orderpriority <> '1-URGENT'").select("o_orderkey")


@query(
    "WITH a AS (SELECT c_custkey AS path, md5(CAST(c_nationkey AS VARCHAR)) AS h FROM customer WHERE c_custkey % 4 <> 0), "
    "b AS (SELECT c_custkey AS path, md5(CAST(CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_nationkey END AS VARCHAR)) AS h FROM customer WHERE c_custkey % 7 <> 0) "
    "SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'new' WHEN b.path IS NULL THEN 'deleted' WHEN a.h = b.h THEN 'same' ELSE 'changed' END AS change "
    "FROM a FULL JOIN b ON a.path = b.path"
)
def incremental_watermark_diff(t):
    rows = t.customer.select(F.col("c_custkey").alias("path"), "c_nationkey")
    hashed = lambda df, c: df.select("path", F.md5(c.cast("string")).alias("h"))
    before = hashed(rows.filter("path % 4 <> 0"), F.col("c_nationkey"))
    after = hashed(rows.filter("path % 7 <> 0"), F.when(F.col("path") % 5 == 0, -1).otherwise(F.col("c_nationkey")))
    return S.content_diff(before, after, "path", "h")


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'missing' WHEN o_totalprice < 50000 THEN 'stale-profile' WHEN o_orderpriority = '5-LOW' THEN 'summary-only' "
    "ELSE 'skip' END AS reason FROM orders"
)
def repair_selection(t):
    cases = [
        (F.col("o_orderstatus") == "P", "missing"),
        (F.col("o_totalprice") < 50000, "stale-profile"),
        (F.col("o_orderpriority") == "5-LOW", "summary-only"),
    ]
    return t.orders.select("o_orderkey", S.decide(cases, "skip").alias("reason"))


@query(
    "SELECT c_custkey, CASE WHEN n IS NULL THEN 'retry' WHEN p > 0 THEN 'blocked' ELSE 'completed' END AS decision FROM customer LEFT JOIN "
    "(SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders WHERE o_totalprice > 100000 GROUP BY 1) ON o_custkey = c_custkey"
)
def resume_decision(t):
    runs = t.orders.filter("o_totalprice > 100000").groupBy(F.col("o_custkey").alias("c_custkey"))
    sums = runs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("p"))
    joined = t.customer.select("c_custkey").join(sums, "c_custkey", "left")
    return joined.select("c_custkey", S.decide([(F.col("n").isNull(), "retry"), (F.col("p") > 0, "blocked")], "completed").alias("decision"))


@query(
    "SELECT n_nationkey, strftime(coalesce(c - INTERVAL 1 DAY, TIMESTAMP '1995-01-01'), '%Y-%m-%d') AS start, CASE WHEN c IS NULL THEN 'initial' ELSE 'delta' END AS run "
    "FROM nation LEFT JOIN (SELECT c_nationkey, max(o_orderdate) AS c FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey < 20 GROUP BY 1) ON c_nationkey = n_nationkey"
)
def delta_window_plan(t):
    """From the checkpoint less a day of overlap, else an explicit initial date."""
    done = t.orders.join(t.customer.filter("c_nationkey < 20"), F.col("c_custkey") == F.col("o_custkey"))
    checkpoints = done.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.max("o_orderdate").cast("date").alias("c"))
    start = F.coalesce(F.date_sub("c", 1), F.lit("1995-01-01").cast("date"))
    run = F.when(F.col("c").isNull(), "initial").otherwise("delta")
    joined = t.nation.select("n_nationkey").join(checkpoints, "n_nationkey", "left")
    return joined.select("n_nationkey", F.date_format(start, "yyyy-MM-dd").alias("start"), run.alias("run"))


@query(
    "SELECT n_regionkey, c_mktsegment, count(*) AS n, CAST(grouping(n_regionkey) * 2 + grouping(c_mktsegment) AS BIGINT) AS level FROM customer JOIN nation ON n_nationkey = c_nationkey "
    "GROUP BY CUBE (n_regionkey, c_mktsegment)"
)
def cube_counts(t):
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.cube("n_regionkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


@query(
    "SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS moving FROM orders"
)
def moving_sum(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    return t.orders.select("o_orderkey", F.sum(cents("o_totalprice")).over(w).alias("moving"))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 350000")
def set_intersect(t):
    return t.customer.select(F.col("c_custkey").alias("k")).intersect(t.orders.filter("o_totalprice > 350000").select("o_custkey"))


@query(
    "SELECT page_no, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM (SELECT (r - 1) // 100 AS page_no, min(k) AS lo, max(k) AS hi FROM (SELECT p_partkey AS k, row_number() OVER (ORDER BY p_partkey) AS r FROM part) GROUP BY 1)"
)
def json_shard_bounds(t):
    """JSON documents in shards by rank of the key, numbered without a single sorted task."""
    from loamgrid.sources.writers import json_shards

    shards = json_shards(t.part.select("p_partkey", "p_name"), "p_partkey", 100)
    sums = shards.groupBy(F.col("shard").cast("bigint").alias("page_no"))
    return sums.agg(F.min("p_partkey").alias("lo"), F.max("p_partkey").alias("hi"))
