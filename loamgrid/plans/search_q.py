"""Filters, search, text, vectors, rules, mapping, graph, scoring and events."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loamgrid.functions import coerce, geo
from loamgrid.operators import shape as S
from loamgrid.plans.registry import query
from loamgrid.streaming import streams


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42 LIMIT 1")
def eq_lookup(t):
    return t.customer.filter("c_custkey = 42").limit(1).select("c_custkey", "c_name")


@query("SELECT p_partkey FROM part WHERE p_name ILIKE '%an%' OR p_type ILIKE '%an%' OR p_brand ILIKE '%an%'")
def ilike_any(t):
    return t.part.filter(S.ilike_any(["p_name", "p_type", "p_brand"], "an")).select("p_partkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O' AND o_orderpriority NOT LIKE '2%'")
def dynamic_predicates(t):
    """Optional predicates folded into one filter: list, equality, negated prefix."""
    wanted = {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": "O", "o_custkey": None}
    keep = ~F.col("o_orderpriority").like("2%")
    for name, value in wanted.items():
        if value is not None:
            keep = keep & (F.col(name).isin(value) if isinstance(value, list) else F.col(name) == value)
    return t.orders.filter(keep).select("o_orderkey")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_shipdate IS NULL OR l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-31'"
)
def date_window_any(t):
    """Kept without any date, or with one inside the window."""
    dates = F.array_compact(F.array(F.col("l_shipdate").cast("date")))
    lo, hi = (F.lit(d).cast("date") for d in ("1997-01-01", "1997-01-31"))
    keep = (F.size(dates) == 0) | F.exists(dates, lambda d: d.between(lo, hi))
    return t.lineitem.filter(keep).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT c_custkey, 'mail' AS role, printf('%05d', c_custkey) AS zip, '001' AS prefix FROM customer WHERE printf('%05d', c_custkey) LIKE '001%'")
def zip_prefix_match(t):
    """Role addresses whose ZIP starts with a prefix."""
    zips = F.array(F.struct(F.lit("principal").alias("role"), F.lit("99999").alias("zip")), F.struct(F.lit("mail").alias("role"), F.format_string("%05d", "c_custkey").alias("zip")))
    hits = F.filter(zips, lambda a: a["zip"].startswith("001"))
    return t.customer.select("c_custkey", F.explode(hits).alias("h")).select("c_custkey", "h.role", "h.zip", F.lit("001").alias("prefix"))


RING = [(0.0, 0.0), (10.0, 0.0), (10.0, 6.0), (4.0, 9.0), (0.0, 6.0)]


@query(
    "SELECT c_custkey, x BETWEEN 0 AND 10 AND y BETWEEN 0 AND 9 AS in_box, x < 10 AND y < 9 AND (y < 6 OR (y - 6 < 0.75 * x AND (y - 6) * 6 < 3 * (10 - x))) AS inside "
    "FROM (SELECT c_custkey, c_custkey % 13 + 0.5 AS x, c_custkey % 11 + 0.25 AS y FROM customer)"
)
def point_in_polygon(t):
    """A box test, then ray casting."""
    x, y = F.col("c_custkey") % 13 + 0.5, F.col("c_custkey") % 11 + 0.25
    return t.customer.select("c_custkey", geo.in_box(x, y, (0, 0, 10, 9)).alias("in_box"), geo.in_polygon(x, y, RING).alias("inside"))


@query(
    "SELECT count(*) AS points, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents FROM customer WHERE c_custkey % 13 + 0.5 BETWEEN 2 AND 5 AND c_custkey % 11 + 0.25 BETWEEN 1 AND 4"
)
def sum_in_area(t):
    rows = t.customer.filter(geo.in_box(F.col("c_custkey") % 13 + 0.5, F.col("c_custkey") % 11 + 0.25, (2, 1, 5, 4)))
    return rows.agg(F.count(F.lit(1)).alias("points"), F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("cents"))


@query("SELECT l_orderkey, CAST(count(*) AS BIGINT) AS vertices, count(*) > 1 AS ringed, bool_and(l_quantity BETWEEN 1 AND 45) AS all_inside FROM lineitem GROUP BY 1")
def parcel_geometry(t):
    """Vertices per parcel and whether all lie in the county's box."""
    point = F.struct(F.col("l_quantity").cast("double").alias("lon"), F.lit(0.0).alias("lat"))
    rings = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(point).alias("ring"))
    stats = geo.ring_stats(F.array("ring"))
    return rings.select(
        "l_orderkey",
        stats["vertices"].cast("bigint").alias("vertices"),
        (F.size("ring") > 1).alias("ringed"),
        geo.all_in_box(F.col("ring"), (1, -1, 45, 1)).alias("all_inside"),
    )


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\\b(?:license|licensed)\\b')")
def keyword_regex(t):
    return t.documents.filter(F.col("text").rlike(r"(?i)\b(?:license|licensed)\b")).select("doc_id")


@query("SELECT p_partkey, p_brand = 'Brand#13' AS exact FROM part WHERE list_contains(string_split(lower(p_type || '/' || p_brand || '/' || replace(p_name, ' ', '/')), '/'), 'brand#13')")
def hierarchy_member(t):
    path = F.concat_ws("/", "p_type", "p_brand", F.regexp_replace("p_name", " ", "/"))
    return t.part.filter(S.path_member(path, "Brand#13")).select("p_partkey", (F.col("p_brand") == "Brand#13").alias("exact"))


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE NOT coalesce(toxic = 1, false)")
def tri_state_exclude(t):
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    return rows.filter(S.tri_state_filter(F.col("toxic") == 1, "exclude")).select("doc_id")


@query("SELECT DISTINCT lower(source) AS dataset FROM documents WHERE lower(source) NOT IN ('src0', 'src1', 'src2')")
def allowlist_gate(t):
    """Datasets that are not on the list: the gate is open if there are none."""
    return t.documents.select(F.lower("source").alias("dataset")).distinct().filter(~F.col("dataset").isin("src0", "src1", "src2"))


@query("SELECT CAST(hour(ts) AS INTEGER) AS h, hour(ts) >= 22 OR hour(ts) < 6 AS night, count(*) AS n FROM events GROUP BY 1, 2")
def time_window_membership(t):
    hour = F.hour(F.col("ts").cast("timestamp_ntz"))
    night = coerce.hour_in_window(F.col("h"), F.lit(22), F.lit(6))
    return t.events.select(hour.alias("h")).groupBy("h", night.alias("night")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1 ORDER BY n DESC, c_mktsegment LIMIT 3")
def read_only_sql_guard(t):
    sql = "SELECT c_mktsegment, count(*) AS n FROM properties WHERE c_acctbal > 0 GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment LIMIT 3"
    return S.guarded_sql(t.spark, sql, properties=t.customer)


@query(
    "SELECT c_custkey, c_acctbal > 0 AND coalesce(ok, false) AS passed, array_to_string(list_filter([CASE WHEN NOT coalesce(big, false) THEN 'big' END, CASE WHEN NOT coalesce(open, false) THEN 'open' END, "
    "CASE WHEN NOT c_acctbal > 0 THEN 'solvent' END], lambda x: x IS NOT NULL), ',') AS failed FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_totalprice > 200000 AND o_orderstatus = 'O') AS ok, "
    "bool_or(o_totalprice > 200000) AS big, bool_or(o_orderstatus = 'O') AS open FROM orders GROUP BY 1) ON o_custkey = c_custkey"
)
def rules_pass_fail(t):
    return _rules(t).select("c_custkey", "passed", F.array_join("failed", ",").alias("failed"))


def _rules(t):
    rules = [
        S.Rule("solvent", "entity", "c_acctbal > 0", ("c_acctbal",)),
        S.Rule("big", "child", "o_totalprice > 200000", ("o_totalprice",)),
        S.Rule("open", "child", "o_orderstatus = 'O'", ("o_orderstatus",)),
    ]
    children = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderstatus")
    return S.evaluate_rules(t.customer.select("c_custkey", "c_acctbal"), children, "c_custkey", rules)


@query(
    "SELECT r AS rule, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN NOT coalesce(big, false) THEN 'big' END, CASE WHEN NOT coalesce(open, false) THEN 'open' END, CASE WHEN NOT c_acctbal > 0 THEN 'solvent' END], "
    "lambda x: x IS NOT NULL)) AS r FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_totalprice > 200000) AS big, bool_or(o_orderstatus = 'O') AS open FROM orders GROUP BY 1) ON o_custkey = c_custkey) GROUP BY 1"
)
def rule_failure_stats(t):
    return _rules(t).select(F.explode("failed").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, '{\"party\":{\"name\":\"' || c_name || '\",\"tier\":\"none\"},\"nation\":\"' || c_nationkey || '\"}' AS mapped FROM customer")
def dot_path_mapping(t):
    source = F.to_json(F.struct(F.struct(F.col("c_name").alias("full")).alias("name"), F.col("c_nationkey").alias("nation")))
    operations = [("name.full", "party.name", None), ("name.tier", "party.tier", "none"), ("nation", "nation", None)]
    return t.customer.select("c_custkey", S.map_paths(source, operations).alias("mapped"))


@query(
    "SELECT p_partkey, CAST((CASE WHEN p_size > 10 THEN 1 ELSE 0 END + 1) / 2 AS DOUBLE) AS ratio, CASE WHEN p_size > 10 THEN '' ELSE 'size' END AS missing FROM part"
)
def mapping_coverage(t):
    mapped = F.when(F.col("p_size") > 10, F.array(F.lit("name"), F.lit("size"))).otherwise(F.array(F.lit("name")))
    report = S.mapping_coverage(F.array(F.lit("name"), F.lit("size")), mapped, F.array(F.lit("name"), F.lit("size"), F.lit("other")))
    return t.part.select("p_partkey", report["ratio"].alias("ratio"), F.array_join(report["missing"], ",").alias("missing"))


@query("SELECT doc_id, CAST(idx AS INTEGER) AS rank, w FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) - 1 AS idx FROM documents)")
def posexplode_words(t):
    return t.documents.select("doc_id", F.posexplode_outer(F.split("text", " ")).alias("rank", "w"))


def _graph(t):
    people = t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"))
    places = t.nation.filter("n_nationkey < 20").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"))
    src = F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("src")
    dst = F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("dst")
    return people.unionByName(places), t.customer.filter("c_custkey % 10 <> 0").select(src, dst)


@query(
    "WITH v AS (SELECT 'c' || c_custkey AS id FROM customer UNION ALL SELECT 'n' || n_nationkey FROM nation WHERE n_nationkey < 20), e AS (SELECT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst FROM customer WHERE c_custkey % 10 <> 0), "
    "x AS (SELECT src AS id FROM e UNION SELECT dst FROM e) SELECT id, 'missing_vertex' AS fault FROM x WHERE id NOT IN (SELECT id FROM v) UNION ALL SELECT id, 'isolated' FROM v WHERE id NOT IN (SELECT id FROM x)"
)
def graph_integrity(t):
    return S.graph_faults(*_graph(t))


@query(
    "SELECT DISTINCT c_custkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'O' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"
)
def traversal_negated_edge(t):
    """Fixed-depth traversal with a negated edge."""
    edge = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(edge("O"), "c_custkey", "left_semi").join(edge("P"), "c_custkey", "left_anti")


@query(
    "WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(score, 4) AS score FROM (SELECT vec_id, "
    "list_dot_product(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * "
    "sqrt(list_dot_product(CAST(e AS DOUBLE[]), CAST(e AS DOUBLE[])))) AS score FROM embeddings, q WHERE label = 1) ORDER BY round(score, 6) DESC, vec_id LIMIT 10"
)
def cosine_topk(t):
    """Filter, then the nearest ten by cosine; the query vector is one row."""
    query_vector = list(t.embeddings.filter("vec_id = 0").select("embedding").first()[0])
    out = S.cosine_top_k(t.embeddings, query_vector, 10, F.col("label") == 1)
    return out.select("vec_id", F.round("score", 4).alias("score"))


@query()
def hybrid_search(t):
    """Combined lexical signals with confidence bands; word segmentation differs between engines, so tests hold it."""
    scored = t.part.select("p_partkey", "p_name", F.round(S.hybrid_score(F.col("p_name"), "part 12"), 6).alias("score"))
    return scored.withColumn("band", S.confidence_band(F.col("score"))).orderBy(F.desc("score"), "p_partkey").limit(50)


@query(
    "SELECT doc_id, CAST(i AS INTEGER) AS chunk, sha256(doc_id || ':' || i || ':' || md5(text)) AS chunk_id, CAST(length(substr(text, 1 + i * 500, 500)) AS INTEGER) AS n FROM (SELECT doc_id, text, "
    "unnest(range(greatest(1, CAST(ceil(length(text) / 500) AS BIGINT)))) AS i FROM documents)"
)
def chunk_documents(t):
    return S.chunk_text(t.documents, 500).select("doc_id", "chunk", "chunk_id", F.length("content").alias("n"))


@query(
    "SELECT count(*) FILTER (p AND quality = 1) / count(*) FILTER (p) AS precision, count(*) FILTER (p AND quality = 1) / count(*) FILTER (quality = 1) AS recall, "
    "count(*) FILTER (p AND quality = 0) AS false_accept, count(*) FILTER (NOT p AND quality = 1) AS false_reject FROM (SELECT quality, n_chars > 500 AS p FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"
)
def eval_metrics(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    p, good = F.col("n_chars") > 500, F.col("quality") == 1
    hit = F.count_if(p & good)
    return rows.agg(
        (hit / F.count_if(p)).alias("precision"),
        (hit / F.count_if(good)).alias("recall"),
        F.count_if(p & ~good).alias("false_accept"),
        F.count_if(~p & good).alias("false_reject"),
    )


@query(
    "SELECT o_orderkey, round(0.45 * least(o_totalprice / 500000, 1) + 0.30 * w + 0.15 * (o_custkey % 100) / 100 - 0.10 * (o_orderkey % 7) / 7, 6) AS score FROM "
    "(SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 1.0 ELSE 0.5 END AS w FROM orders)"
)
def frontier_priority_score(t):
    w = F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.5)
    score = S.weighted(
        (0.45, F.least(F.col("o_totalprice") / 500000, F.lit(1.0))),
        (0.30, w),
        (0.15, F.col("o_custkey") % 100 / 100),
        (-0.10, F.col("o_orderkey") % 7 / 7),
    )
    return t.orders.select("o_orderkey", F.round(score, 6).alias("score"))


@query(
    "SELECT user_id, round(2.0 * count(*) FILTER (event_type = 'click') + 0.5 * count(*) FILTER (event_type = 'view') + 0.25 * count(*) FILTER (event_type = 'purchase'), 2) AS penalty FROM events GROUP BY 1"
)
def recent_contact_penalty(t):
    n = lambda k: F.count_if(F.col("event_type") == k)
    penalty = S.recent_contact_penalty(n("click"), n("view"), n("purchase"), F.lit(0))
    return t.events.groupBy("user_id").agg(F.round(penalty, 2).alias("penalty"))


@query(
    "SELECT s_suppkey, CAST(h AS INTEGER) AS hour, round(greatest(0, 1 - least(abs(h * 60 + 30 - c), 1440 - abs(h * 60 + 30 - c)) / 240.0), 6) AS bonus FROM (SELECT s_suppkey, unnest(range(24)) AS h, "
    "(s_suppkey % 24 * 60 + 240) % 1440 AS c, s_suppkey % 24 AS s FROM supplier) WHERE (h - s + 24) % 24 < 8"
)
def candidate_hour_bonus(t):
    """Items by legal hours, with the bonus of the window's centre; windows cross midnight."""
    start = (F.col("s_suppkey") % 24).cast("int")
    end = (start + 8) % 24
    rows = t.supplier.select("s_suppkey", start.alias("s"), end.alias("e"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    rows = rows.filter(coerce.hour_in_window(F.col("hour"), F.col("s"), F.col("e")))
    bonus = S.window_center_bonus(F.col("hour"), F.col("s") * 60, F.col("e") * 60)
    return rows.select("s_suppkey", "hour", F.round(bonus, 6).alias("bonus"))


@query(
    "SELECT o_orderkey, o_orderpriority AS slot, CASE WHEN r <= 20 THEN 'selected' ELSE 'capacity' END AS outcome FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)"
)
def capacity_assignment(t):
    """Greedy approximation of the slot assignment: the best items of each slot, the rest as overflow with its reason."""
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("slot"), F.col("o_totalprice").alias("score"))
    capacity = rows.select("slot").distinct().withColumn("cap", F.lit(20))
    chosen, rest = S.capacity_assignment(rows, "o_orderkey", "slot", "score", capacity)
    picked = chosen.select("o_orderkey", "slot", F.lit("selected").alias("outcome"))
    return picked.unionByName(rest.select("o_orderkey", "slot", F.col("reason").alias("outcome")))


@query("SELECT component, round(cost * 1.25, 4) AS planned, cost * 1.25 <= 100 AS allowed FROM (VALUES ('scan', 10.0), ('match', 40.0), ('export', 90.0)) v(component, cost)")
def cost_plan(t):
    rows = t.spark.sql("SELECT * FROM VALUES ('scan', 10.0D), ('match', 40.0D), ('export', 90.0D) AS v(component, cost)")
    planned = F.col("cost") * 1.25
    return rows.select("component", F.round(planned, 4).alias("planned"), (planned <= 100).alias("allowed"))


@query("SELECT user_id, event_type, min(event_id) AS first_event FROM events GROUP BY 1, 2")
def event_idempotency(t):
    """One event per idempotency key: the batch twin of the streaming operator."""
    return t.events.groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_event"))


@query("SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) // 3600 AS hour_no, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_counts(t):
    counts = streams.windowed_counts(t.events.select("ts", "event_type"), "ts", "0 seconds", "1 hour", None, ["event_type"])
    hours = F.datediff(F.col("start").cast("date"), F.lit("1970-01-01")).cast("bigint") * 24 + F.hour("start")
    return counts.select(hours.alias("hour_no"), "event_type", "n")


@query(
    "SELECT user_id, count(*) AS sessions FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR ts - p > INTERVAL 12 HOUR GROUP BY 1"
)
def session_counts(t):
    found = streams.session_counts(t.events.select("ts", "user_id"), "ts", "0 seconds", "12 hours", ["user_id"])
    return found.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"))


@query("SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles FROM conversations GROUP BY 1")
def conversation_turns(t):
    turns = F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("t")
    grouped = t.conversations.groupBy("conv_id").agg(turns)
    return grouped.select("conv_id", F.size("t").cast("bigint").alias("turns"), F.array_join(F.transform("t", lambda x: x["role"]), ">").alias("roles"))
