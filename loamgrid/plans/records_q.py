"""Record-level operators over the stand-ins."""

from pyspark.sql import functions as F

from loamgrid.operators import records as R
from loamgrid.plans.registry import query
from loamgrid.sources import paged


@query(
    "SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS number, CASE WHEN s_suppkey % 2 = 0 THEN 'NE' END AS direction, 'OLD OAK' AS name, 'Blvd' AS suffix, "
    "'TAMPA' AS city, 'FL' AS state, printf('%05d', s_suppkey) AS zip5, '0001' AS plus4 FROM supplier"
)
def parse_street_parts(t):
    key = F.col("s_suppkey").cast("string")
    way = F.when(F.col("s_suppkey") % 2 == 0, " ne").otherwise("")
    line = F.concat(key, way, F.lit(" old oak boulevard, Tampa, fl "), F.format_string("%05d-0001", "s_suppkey"))
    return t.supplier.select("s_suppkey", R.street_parts(line).alias("p")).select("s_suppkey", "p.*")


@query(
    "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Warranty Deed' WHEN 1 THEN 'Quitclaim Deed' WHEN 2 THEN 'Special Warranty Deed' ELSE 'Miscellaneous' END AS deed FROM part"
)
def deed_types(t):
    which = F.col("p_size") % 4
    raw = F.when(which == 0, "WD-warranty").when(which == 1, "quit claim").when(which == 2, "x: SPECIAL  warranty").otherwise("plat map")
    return t.part.select("p_partkey", R.deed_type(raw).alias("deed"))


@query(
    "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_mktsegment END AS situs, CASE WHEN c_custkey % 2 = 0 THEN 2.5 ELSE 2.0 END AS acres FROM customer"
)
def situs_and_acres(t):
    """Situs before mailing columns, and acres from square feet where none are stated."""
    free = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise("  ")
    stated = F.when(F.col("c_custkey") % 2 == 0, "2.5")
    return t.customer.select(
        "c_custkey", R.situs_first(free, F.col("c_mktsegment")).alias("situs"), R.acres(stated, F.lit("87120")).alias("acres")
    )


@query(
    "SELECT n_nationkey, CASE WHEN n_name LIKE 'U%' THEN 'u-area' WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'county' END AS jurisdiction FROM nation"
)
def route_jurisdiction(t):
    city = F.when(F.col("n_name").startswith("U"), "greater  utown").when(F.col("n_nationkey") % 2 == 0, "a, evenville, b").otherwise("nowhere")
    routes = [("u-area", ["Utown"]), ("even", ["Evenville"])]
    return t.nation.select("n_nationkey", R.route_jurisdiction(city, routes, "county").alias("jurisdiction"))


@query("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS owner FROM customer")
def permit_row_projection(t):
    return R.public_columns(R.refuse_columns(t.customer, {"ssn", "email"}), ["c_custkey", "c_name", "owner"])


@query("SELECT o_orderkey, o_custkey, n_nationkey FROM orders LEFT JOIN nation ON n_nationkey = o_custkey")
def property_by_parcel_join(t):
    """Each child finds one parent at most; several would raise."""
    children = t.orders.select("o_orderkey", "o_custkey")
    parents = t.nation.select(F.col("n_nationkey").cast("bigint").alias("o_custkey"), "n_nationkey")
    return R.one_parent_each(children, parents, "o_custkey", "n_nationkey")


@query(
    "WITH c AS (SELECT s_suppkey, upper(s_name) AS name, CAST(s_nationkey AS VARCHAR) AS phone, 'L' || s_suppkey % 50 AS license FROM supplier), "
    "w AS (SELECT c_custkey AS want, substr(upper(replace(c_name, 'Customer', 'Supplier')), 1, length(c_name) - 1) AS name, 'n' || c_nationkey AS phone, 'L' || c_custkey AS license FROM customer) "
    "SELECT want, string_agg(DISTINCT s_suppkey, ',' ORDER BY s_suppkey) AS ids FROM w JOIN c ON (substr(c.name, 1, 4) = substr(w.name, 1, 4) AND starts_with(c.name, w.name)) OR c.phone = w.phone OR c.license = w.license GROUP BY 1"
)
def candidate_company_lookup(t):
    companies = t.supplier.select(
        "s_suppkey",
        F.upper("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("phone"),
        F.concat(F.lit("L"), (F.col("s_suppkey") % 50).cast("string")).alias("license"),
    )
    name = F.upper(F.regexp_replace("c_name", "Customer", "Supplier"))
    wanted = t.customer.select(
        F.col("c_custkey").alias("want"),
        F.substr(name, F.lit(1), F.length("c_name") - 1).alias("name"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("phone"),
        F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("license"),
    )
    out = R.company_candidates(companies, wanted, "s_suppkey")
    return out.select("want", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query(
    "SELECT CASE WHEN r = 1 THEN '' || l_orderkey ELSE l_orderkey || '#' || r END AS parcel, part FROM (SELECT l_orderkey, l_partkey AS part, row_number() OVER "
    "(PARTITION BY l_orderkey ORDER BY l_partkey) AS r FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem))"
)
def split_multipolygon(t):
    parcels = t.lineitem.groupBy(F.col("l_orderkey").alias("parcel")).agg(F.array_sort(F.collect_set("l_partkey")).alias("polygons"))
    return R.split_multipolygons(parcels, "parcel", "polygons").withColumnRenamed("polygon", "part")


@query("SELECT page_id, CAST(page_id * 1000 AS INTEGER) AS total, CAST(CASE WHEN page_id % 2 = 0 THEN page_id + 3 END AS INTEGER) AS pages FROM pages")
def page_result_counts(t):
    text = F.concat(F.lit("Showing: "), F.format_number(F.col("page_id") * 1000, 0), F.lit(" results"))
    link = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("http://x/?page="), (F.col("page_id") + 3).cast("string"))).otherwise("http://x/")
    return t.pages.select("page_id", R.page_counts(text, F.array(link, F.lit("/y"))).alias("c")).select("page_id", "c.*")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 1.0 ELSE 0.5 END AS coverage FROM customer")
def labeled_field_coverage(t):
    labels = F.array(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.lit("Phone 904-555")).otherwise("absent"))
    output = F.concat(F.lit("{"), F.col("c_name"), F.lit(" phone904555}"))
    return t.customer.select("c_custkey", R.field_coverage(labels, output).cast("double").alias("coverage"))


@query(
    "SELECT 'vertex' AS kind, label, count(*) AS n FROM (SELECT DISTINCT 'company' AS label, c_custkey AS k FROM customer UNION SELECT DISTINCT 'place', c_nationkey FROM customer) GROUP BY label "
    "UNION ALL SELECT 'edge', 'located_in', count(*) FROM customer"
)
def graph_emit(t):
    """Entities and relationships from one pass, each once."""
    company = F.concat(F.lit("c:"), F.col("c_custkey").cast("string"))
    place = F.concat(F.lit("n:"), F.col("c_nationkey").cast("string"))
    vertices, edges = R.emit_graph(
        t.customer,
        [("company", company, F.to_json(F.struct("c_name"))), ("place", place, F.to_json(F.struct("c_nationkey")))],
        [("located_in", company, place)],
    )
    count = lambda df, kind: df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "label", "n")
    return count(vertices, "vertex").unionByName(count(edges, "edge"))


@query(
    "SELECT c_custkey AS id, 'segment' AS property, 'format' AS fault FROM customer WHERE c_mktsegment NOT LIKE '%U%' UNION ALL "
    "SELECT c_custkey, 'nation', 'required' FROM customer WHERE c_nationkey < 3 UNION ALL SELECT c_custkey, 'extra', 'unknown_property' FROM customer WHERE c_custkey % 50 = 0"
)
def lexicon_checks(t):
    pairs = F.array_compact(
        F.array(
            F.struct(F.lit("segment").alias("k"), F.col("c_mktsegment").alias("v")),
            F.when(F.col("c_nationkey") >= 3, F.struct(F.lit("nation").alias("k"), F.col("c_nationkey").cast("string").alias("v"))),
            F.when(F.col("c_custkey") % 50 == 0, F.struct(F.lit("extra").alias("k"), F.lit("x").alias("v"))),
        )
    )
    vertices = t.customer.select(F.col("c_custkey").alias("id"), F.lit("company").alias("label"), F.map_from_entries(pairs).alias("props"))
    lexicon = t.spark.sql("SELECT * FROM VALUES ('company', 'segment', false, 'U'), ('company', 'nation', true, '^[0-9]+$') AS l(label, property, required, pattern)")
    return R.lexicon_faults(vertices, lexicon)


@query(
    "SELECT source, 'digest' AS fault FROM (SELECT DISTINCT source FROM documents) WHERE source LIKE '%1' UNION ALL SELECT source, 'more_than_expected' FROM documents GROUP BY 1 HAVING count(*) > 40"
)
def coverage_validate(t):
    digest = F.when(F.col("source").endswith("1"), "bad").otherwise(F.sha2("source", 256))
    day = lambda d: F.lit(d).cast("date")
    rows = t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("ingested"))
    snapshot = rows.select("source", "ingested", F.lit(40).alias("expected"), day("2024-01-01").alias("first"), day("2024-01-02").alias("last"), digest.alias("digest"))
    return R.coverage_faults(snapshot)


@query(
    "SELECT strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1"
)
def eastern_partition_dates(t):
    """UTC instants by New York date (winter: five hours behind)."""
    day = R.eastern_date(F.col("ts").cast("timestamp_ntz").cast("timestamp"))
    return t.events.groupBy(F.date_format(day, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name || ' on 2024-03-08, FRIDAY, since 2024-03-01' AS rule FROM customer")
def rule_date_placeholders(t):
    template = F.concat("c_name", F.lit(" on {{today}}, {{weekday}}, since {{week_ago}}"))
    return t.customer.select("c_custkey", R.date_placeholder(template, "2024-03-08").alias("rule"))


@query(
    "SELECT o_orderkey, round(b + abs(b) * (0.40 * q + 0.25 * u) + abs(b) * (1 + q + 0.5 * u) * f, 4) AS score FROM (SELECT o_orderkey, CAST(o_orderkey % 1000 AS DOUBLE) AS b, "
    "CAST(o_custkey % 5 AS DOUBLE) / 4 AS q, CAST(o_custkey % 3 AS DOUBLE) / 2 AS u, CAST(o_orderkey % 2 AS DOUBLE) / 2 AS f FROM orders)"
)
def assignment_score(t):
    part = lambda c, m, d: (F.col(c) % m).cast("double") / d
    score = R.assignment_score(part("o_orderkey", 1000, 1), part("o_custkey", 5, 4), part("o_custkey", 3, 2), part("o_orderkey", 2, 2))
    return t.orders.select("o_orderkey", F.round(score, 4).alias("score"))


@query(
    "SELECT doc_id, score FROM (SELECT doc_id, len(list_intersect(list_distinct(regexp_split_to_array(lower(text), '[^a-zA-Z0-9]+')), "
    "['license', 'licensed', 'mit', 'the', 'under'])) / 5 AS score FROM documents) WHERE score >= 0.5 ORDER BY score DESC, doc_id LIMIT 100"
)
def full_text_search(t):
    """Share of query words in a text."""
    return R.full_text_search(t.documents, "licensed under the mit license", "doc_id", 0.5, 100)


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events WHERE user_id IN (SELECT user_id FROM events WHERE value > 95) GROUP BY 1")
def derived_index(t):
    """Current values of touched owners only, from full history."""
    return R.derived_current(t.events, t.events.filter("value > 95"), "user_id", "event_type", ["ts", "event_id"])


@query("SELECT r AS page, count(*) AS n FROM (SELECT (o_orderkey - 1) // 1000 AS r FROM orders WHERE o_orderkey > 0) GROUP BY 1")
def snapshot_pages(t):
    """Orders dealt to the disjoint id ranges of a snapshot plan."""
    own = t.orders.filter("o_orderkey > 0").select(paged.page_of(F.col("o_orderkey"), 1000).alias("page"))
    return own.groupBy("page").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-03-11'")
def arcgis_delta_where(t):
    where = paged.delta_where(["o_orderstatus = 'F'"], "o_orderdate", "1997-03-01", "1997-03-10")
    return t.orders.filter(where).select("o_orderkey")


@query(
    "SELECT c_custkey, coalesce(q, 0) + coalesce(e, 0) AS phone_score, coalesce(q, 0) + coalesce(e, 0) > 3 AS good FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS q, "
    "count(*) FILTER (o_orderpriority = '2-HIGH') AS e FROM orders GROUP BY 1) ON o_custkey = c_custkey"
)
def candidate_scores(t):
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("phone_score"))
    out = t.customer.select("c_custkey").join(sums, "c_custkey", "left").fillna(0, ["phone_score"])
    return out.withColumn("good", F.col("phone_score") > 3)


@query(
    "SELECT user_id, round(0.35 * (max(value) / 1000) + 0.30 * (count(*) FILTER (event_type = 'click') / count(*)) + 0.20 * 0.5 + 0.15 * (user_id % 2), 4) AS score FROM events GROUP BY 1"
)
def phone_confidence_score(t):
    clicks = F.count_if(F.col("event_type") == "click") / F.count(F.lit(1))
    sums = t.events.groupBy("user_id").agg((F.max("value") / 1000).alias("v"), clicks.alias("r"))
    score = R.phone_confidence(F.col("v"), F.col("r"), F.lit(0.5), (F.col("user_id") % 2).cast("double"))
    return sums.select("user_id", F.round(score, 4).alias("score"))


@query(
    "SELECT n AS span, count(*) AS windows, count(*) FILTER (n < 6) AS terminal, count(*) FILTER (n >= 6) AS split FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1"
)
def window_tree_progress(t):
    windows = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("span"))
    return R.window_progress(windows.withColumn("done", F.col("span") < 6), "span", "done")


@query(
    "SELECT count(*) AS windows, CAST(sum(n) AS BIGINT) AS events FROM (SELECT b, count(*) AS n FROM (SELECT unnest([epoch_us(ts) // 21600000000, epoch_us(ts) // 21600000000 - 1]) AS b FROM events) GROUP BY 1)"
)
def sliding_throughput(t):
    """Half-day windows every six hours: each event counts in two."""
    stamped = t.events.select(F.col("ts").cast("timestamp_ntz").cast("timestamp").alias("ts"))
    rates = R.throughput(stamped, "ts", 1000.0, "12 hours", "6 hours")
    return rates.agg(F.count(F.lit(1)).alias("windows"), F.sum("n").alias("events"))


@query(
    "SELECT doc_id, round(0.9 * o / 2, 6) AS score, 'accept' AS band FROM (SELECT doc_id, len(list_intersect(list_distinct(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')), ['mit', 'license'])) AS o "
    "FROM documents WHERE lang = 'en') WHERE round(0.9 * o / 2, 6) >= 0.9 ORDER BY doc_id LIMIT 20"
)
def retrieval_pipeline(t):
    return R.retrieve(t.documents, "mit license", "doc_id", "text", F.col("lang") == "en", 0.9, 20)
