"""Joins, enrichment flags and matching over the stand-ins that SURVEY names."""

from pyspark.sql import functions as F

from loamgrid.operators import joins as J
from loamgrid.plans.registry import query


@query(
    "WITH f AS (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01'), "
    "l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM f) WHERE r = 1), "
    "n AS (SELECT o_custkey, count(*) AS n FROM f GROUP BY 1) "
    "SELECT c_custkey, o_orderkey AS latest_order, strftime(o_orderdate, '%Y-%m-%d') AS latest_date, coalesce(n, 0) AS n_orders, "
    "coalesce(n, 0) > 0 AS has_orders FROM customer LEFT JOIN l ON l.o_custkey = c_custkey LEFT JOIN n ON n.o_custkey = c_custkey"
)
def latest_record_join(t):
    """Each customer's latest qualifying order, flag and count: one aggregation of the filtered orders and one join."""
    cutoff = F.lit("1996-01-01").cast("timestamp_ntz")
    orders = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate").cast("timestamp_ntz") < cutoff))
    top = F.max(F.struct("o_orderdate", "o_orderkey")).alias("top")
    latest = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(top, F.count(F.lit(1)).alias("n"))
    return t.customer.select("c_custkey").join(latest, "c_custkey", "left").select(
        "c_custkey",
        F.col("top.o_orderkey").alias("latest_order"),
        F.date_format("top.o_orderdate", "yyyy-MM-dd").alias("latest_date"),
        F.coalesce("n", F.lit(0)).alias("n_orders"),
        F.col("n").isNotNull().alias("has_orders"),
    )


@query(
    "SELECT c_custkey, n_name AS nation, coalesce(r_name, c_mktsegment) AS area FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey "
    "LEFT JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA'"
)
def profile_view(t):
    """Left joins of a read-model view, own column where the joined one lacks."""
    region = t.region.filter("r_name <> 'ASIA'")
    joined = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    joined = joined.join(region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return joined.select("c_custkey", F.col("n_name").alias("nation"), F.coalesce("r_name", "c_mktsegment").alias("area"))


def _keys(t, width=200):
    key = lambda n, b: F.concat_ws("|", F.col(n).cast("string"), F.floor(F.col(b) / width).cast("string"))
    left = t.customer.select("c_custkey", key("c_nationkey", "c_acctbal").alias("key"))
    right = t.supplier.select("s_suppkey", key("s_nationkey", "s_acctbal").alias("key"))
    return left, right


@query(
    "WITH c AS (SELECT c_custkey, c_nationkey || '|' || CAST(floor(c_acctbal / 200) AS BIGINT) AS key FROM customer), "
    "s AS (SELECT s_suppkey, s_nationkey || '|' || CAST(floor(s_acctbal / 200) AS BIGINT) AS key FROM supplier) "
    "SELECT min(c_custkey) AS c_custkey, key, (SELECT string_agg(DISTINCT s_suppkey, ',' ORDER BY s_suppkey) FROM s WHERE s.key = c.key) AS ids "
    "FROM c GROUP BY key HAVING count(*) = 1 AND key IN (SELECT key FROM s)"
)
def unique_address_join(t):
    left, right = _keys(t)
    out = J.unique_key_join(left, right, "key", "c_custkey", "s_suppkey")
    return out.select("c_custkey", "key", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000) AS big_spender FROM customer")
def flag_semi_join(t):
    big = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return J.flag_join(t.customer.select("c_custkey"), big, "c_custkey", "big_spender")


@query(
    "SELECT o_orderkey, coalesce(n, 0) AS n_lines, coalesce(n, 0) > 0 AS has_lines FROM orders LEFT JOIN "
    "(SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"
)
def count_join(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return J.count_join(t.orders.select("o_orderkey"), lines, "o_orderkey", "n_lines", "has_lines")


@query(
    "WITH u AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1) SELECT o.o_custkey, count(DISTINCT o_totalprice) AS variants "
    "FROM orders o JOIN u ON u.o_custkey = o.o_custkey AND u.d = o.o_orderdate GROUP BY 1 HAVING count(DISTINCT o_totalprice) > 1"
)
def latest_conflicts(t):
    """Customers whose latest orders tie and differ: what a latest join refuses."""
    return J.latest_conflicts(t.orders, "o_custkey", "o_orderdate", ["o_totalprice"])


@query(
    "SELECT o_orderkey, max(l_shipdate) IS NOT NULL AS shipped, strftime(max(l_shipdate), '%Y-%m-%d') AS latest FROM orders "
    "LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"
)
def latest_shipment(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", F.lit(True).alias("shipped"))
    out = J.latest_join(t.orders.select("o_orderkey"), lines, "o_orderkey", "l_shipdate", ["shipped"], check=False)
    return out.select(
        "o_orderkey", F.coalesce("shipped", F.lit(False)).alias("shipped"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("latest")
    )


@query(
    "SELECT d.doc_id, CASE WHEN bool_or(quality = 1) THEN true WHEN bool_or(toxic = 0 AND quality <> 1) THEN false END AS member "
    "FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.doc_id"
)
def membership_tri_state(t):
    yes, sure = F.col("quality") == 1, F.col("toxic") == 0
    return J.tri_state_join(t.documents.select("doc_id"), t.labels, "doc_id", yes, sure, "member")


def _cascade_sql():
    part = (
        "k{i} AS (SELECT key, min(s_suppkey) AS id FROM (SELECT s_suppkey, s_nationkey || '|' || CAST(floor(s_acctbal / {w}) AS BIGINT) "
        "AS key FROM supplier) GROUP BY key HAVING count(DISTINCT s_suppkey) = 1)"
    )
    joins = " ".join(
        f"LEFT JOIN k{i} ON k{i}.key = c_nationkey || '|' || CAST(floor(c_acctbal / {w}) AS BIGINT)" for i, w in enumerate((50, 200, 1000))
    )
    return (
        f"WITH {', '.join(part.format(i=i, w=w) for i, w in enumerate((50, 200, 1000)))} SELECT c_custkey, coalesce(k0.id, k1.id, k2.id) AS match, "
        "CASE WHEN k0.id IS NOT NULL THEN 'license' WHEN k1.id IS NOT NULL THEN 'phone' WHEN k2.id IS NOT NULL THEN 'name' END AS method, "
        f"CAST(CASE WHEN k0.id IS NOT NULL THEN 1 WHEN k1.id IS NOT NULL THEN 0.95 WHEN k2.id IS NOT NULL THEN 0.8 END AS DOUBLE) AS confidence FROM customer {joins}"
    )


def _cascade(t):
    key = lambda n, b, w: F.concat_ws("|", F.col(n).cast("string"), F.floor(F.col(b) / w).cast("string"))
    keys = lambda n, b: [key(n, b, w).alias(f"k{w}") for w in (50, 200, 1000)]
    left = t.customer.select("c_custkey", *keys("c_nationkey", "c_acctbal"))
    right = t.supplier.select("s_suppkey", *keys("s_nationkey", "s_acctbal"))
    passes = [("k50", "license", 1.0), ("k200", "phone", 0.95), ("k1000", "name", 0.8)]
    return J.cascade_match(left, "c_custkey", right, "s_suppkey", passes)


@query(_cascade_sql())
def cascade_match(t):
    return _cascade(t)


@query(f"SELECT method, count(*) AS identities FROM ({_cascade_sql()}) WHERE method IS NOT NULL GROUP BY 1")
def match_method_counts(t):
    return _cascade(t).filter("method is not null").groupBy("method").agg(F.count(F.lit(1)).alias("identities"))


@query()
def fuzzy_best_match(t):
    """Part names against each other within a brand: candidates for review only. Jaro-Winkler has no equal in the checking engine."""
    left = t.part.filter("p_partkey % 2 = 0").select("p_partkey", "p_brand", F.upper("p_name").alias("name"))
    right = t.part.filter("p_partkey % 2 = 1").select(F.col("p_partkey").alias("other_id"), "p_brand", F.upper("p_name").alias("name"))
    return J.fuzzy_candidates(left, right, "p_partkey", "other_id", "name", F.concat("p_brand", F.substring("name", 1, 3)))


@query(
    "SELECT l_orderkey AS parent, min(l_suppkey) AS link FROM lineitem GROUP BY 1 HAVING count(*) = count(l_suppkey) AND min(l_suppkey) = max(l_suppkey)"
)
def permit_company_rollup(t):
    contacts = t.lineitem.select(F.col("l_orderkey").alias("parent"), F.col("l_suppkey").alias("link"))
    return J.contact_rollup(contacts, "parent", "link")


@query(
    "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END, 100000 + o_custkey) AS company FROM orders"
)
def fill_null_link_once(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("company"))
    links = t.orders.select("o_orderkey", (F.col("o_custkey") + 100000).alias("new"))
    return J.fill_null_link(rows, links, "o_orderkey", "company")


@query(
    "WITH r AS (SELECT s_suppkey AS match, s_nationkey || '|' || floor(s_acctbal / 500)::BIGINT AS k1, (s_nationkey % 5) || '|' || floor(s_acctbal / 200)::BIGINT AS k2 FROM supplier), "
    "a AS (SELECT k1 AS k, min(match) AS id FROM r GROUP BY 1 HAVING count(*) = 1), b AS (SELECT k2 AS k, min(match) AS id FROM r GROUP BY 1 HAVING count(*) = 1), "
    "c AS (SELECT c_custkey, c_nationkey || '|' || floor(c_acctbal / 500)::BIGINT AS k1, (c_nationkey % 5) || '|' || floor(c_acctbal / 200)::BIGINT AS k2 FROM customer) "
    "SELECT c_custkey, coalesce(a.id, b.id) AS match FROM c LEFT JOIN a ON a.k = c.k1 LEFT JOIN b ON b.k = c.k2"
)
def cross_source_match(t):
    """First key, then second as fallback; keys of several ids link nothing."""
    key = lambda n, balance, width: F.concat_ws("|", n.cast("string"), F.floor(F.col(balance) / width).cast("string"))
    keys = lambda n, balance: [key(F.col(n), balance, 500).alias("k1"), key(F.col(n) % 5, balance, 200).alias("k2")]
    right = t.supplier.select(*keys("s_nationkey", "s_acctbal"), F.col("s_suppkey").alias("match"))
    left = t.customer.select("c_custkey", *keys("c_nationkey", "c_acctbal"))
    return J.two_pass_match(left, right, "k1", "k2", "match").select("c_custkey", "match")


@query(
    "SELECT o_orderkey, c_custkey AS parent FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'O'"
)
def parent_fk_resolution(t):
    parents = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    stage = t.orders.filter("o_orderstatus = 'O'")
    return stage.join(parents, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", F.col("c_custkey").alias("parent"))


@query(
    "WITH e AS (SELECT o_custkey, count(*) AS eligible FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), "
    "s AS (SELECT o_custkey, count(*) AS scheduled FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) "
    "SELECT c_custkey, coalesce(eligible, 0) AS eligible, coalesce(scheduled, 0) AS scheduled FROM customer "
    "LEFT JOIN e ON e.o_custkey = c_custkey LEFT JOIN s ON s.o_custkey = c_custkey WHERE c_nationkey < 5"
)
def exact_lineage_join(t):
    """Both sides aggregated before the join, in one pass over orders."""
    status = F.col("o_orderstatus")
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(status == "O").alias("eligible"), F.count_if(status == "P").alias("scheduled")
    )
    out = t.customer.filter("c_nationkey < 5").select("c_custkey").join(sums, "c_custkey", "left")
    return out.fillna(0, ["eligible", "scheduled"])


@query(
    "SELECT c_nationkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 200000 "
    "AND o_orderstatus <> 'P' GROUP BY 1"
)
def left_join_on_predicate(t):
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_totalprice") > 200000) & (F.col("o_orderstatus") != "P")
    return t.customer.join(t.orders, on, "left").groupBy("c_nationkey").agg(F.count("o_orderkey").alias("n"))


@query(
    "SELECT o_orderkey, 'outside_top' AS reason FROM orders WHERE o_orderkey NOT IN "
    "(SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100)"
)
def left_anti_overflow(t):
    top = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    return J.not_selected(t.orders.select("o_orderkey"), top, "o_orderkey", "outside_top")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def anti_existing_ids(t):
    return t.customer.select("c_custkey").join(t.supplier.select(F.col("s_suppkey").alias("c_custkey")), "c_custkey", "left_anti")


@query(
    "SELECT l_orderkey AS id, l_linestatus AS label, CASE WHEN o_orderkey IS NULL THEN 'missing' WHEN o_orderstatus <> l_linestatus "
    "THEN 'label_mismatch' END AS fault FROM (SELECT DISTINCT l_orderkey, l_linestatus FROM lineitem) LEFT JOIN "
    "(SELECT * FROM orders WHERE o_orderkey % 5 <> 0) ON o_orderkey = l_orderkey"
)
def vertex_ref_check(t):
    refs = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("label")).distinct()
    targets = t.orders.filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"))
    return J.reference_check(refs, targets, "id", "label").select("id", "label", "fault")


@query(
    "SELECT c_custkey, (SELECT string_agg(o_orderkey, ',' ORDER BY o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS orders FROM customer"
)
def bundle_fetch(t):
    """A parent with its children as sorted structs."""
    children = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    out = J.bundle(t.customer.select("c_custkey"), "c_custkey", orders=(children, ["o_orderkey", "o_totalprice"]))
    return out.select("c_custkey", F.array_join(F.transform("orders", lambda o: o["o_orderkey"].cast("string")), ",").alias("orders"))


@query(
    "WITH ids AS (SELECT o_custkey AS id FROM orders WHERE o_totalprice > 400000 UNION SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000) "
    "SELECT id, c_name FROM ids JOIN customer ON c_custkey = id"
)
def lookup_resolution_union(t):
    one = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("id"))
    two = t.supplier.filter("s_acctbal > 9000").select(F.col("s_suppkey").alias("id"))
    ids = one.union(two).filter("id is not null").distinct()
    return ids.join(t.customer, F.col("c_custkey") == F.col("id")).select("id", "c_name")


@query(
    "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE c_nationkey IS DISTINCT FROM s_nationkey"
)
def address_mismatch(t):
    pair = t.customer.join(t.supplier, F.col("c_custkey") == F.col("s_suppkey"))
    return pair.filter(~F.col("c_nationkey").eqNullSafe(F.col("s_nationkey"))).select("c_custkey", "s_suppkey")


@query(
    "SELECT o_orderkey, o_totalprice BETWEEN b.lo AND b.hi AS inside FROM orders, (SELECT avg(o_totalprice) - 1000 AS lo, avg(o_totalprice) + 1000 AS hi FROM orders) b"
)
def bbox_cross_join(t):
    """Against a one-row boundary table, which is broadcast."""
    mean = F.avg("o_totalprice")
    box = F.broadcast(t.orders.agg((mean - 1000).alias("lo"), (mean + 1000).alias("hi")))
    return t.orders.crossJoin(box).select("o_orderkey", F.col("o_totalprice").between(F.col("lo"), F.col("hi")).alias("inside"))
