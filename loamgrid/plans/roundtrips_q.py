"""Sinks read back by their scans, trees of files, streams, and operators over nested and free text."""

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from loamgrid.functions import geo, owners, text
from loamgrid.operators import flatten, joins, permits, records
from loamgrid.operators.numbering import scratch_path
from loamgrid.plans.registry import query
from loamgrid.sources import paged, readers, writers
from loamgrid.streaming import streams


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority || ', \"x\"' AS priority, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS status FROM orders")
def csv_round_trip(t):
    """Commas and quotes in cells; a missing cell comes back as the empty string."""
    path = scratch_path(t.spark, "csv")
    priority = F.concat("o_orderpriority", F.lit(', "x"')).alias("priority")
    status = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status")
    writers.sink_csv(t.orders.select(F.col("o_orderkey").alias("key"), priority, status), path)
    return readers.scan_csv(t.spark, path, ["key", "priority", "status"])


@query("SELECT c_custkey, c_name, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def jsonl_round_trip(t):
    """Gzipped lines in bounded parts, null keys left out."""
    path = scratch_path(t.spark, "jsonl")
    segment = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).alias("segment")
    writers.sink_jsonl(t.customer.select("c_custkey", "c_name", segment), path, gzip=True, rows_per_file=500)
    return readers.scan_jsonl(t.spark, path, "c_custkey bigint, c_name string, segment string")


@query("SELECT o_orderstatus AS status, o_orderkey, (SELECT count(*) FROM orders) AS written FROM orders WHERE o_orderstatus <> 'P'")
def hive_round_trip(t):
    """A partitioned copy with its row count, read back by a glob over its folders."""
    path = scratch_path(t.spark, "hive")
    n = writers.sink_parquet(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status")), path, ["status"])
    return readers.scan_parquet_hive(t.spark, path, "status=[FO]*").select("status", "o_orderkey", F.lit(n).alias("written"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def partitioned_scan(t):
    """A scan that demands a filter on each partition column."""
    path = scratch_path(t.spark, "partitions")
    writers.sink_parquet(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")), path, ["status", "priority"])
    return paged.scan_partitioned(t.spark, path, ("status", "priority"), status="F", priority="1-URGENT").select("o_orderkey")


@query("SELECT n_nationkey, n_name FROM nation")
def json_tree_scan(t):
    """One JSON document a file, below a tree of folders."""
    path = scratch_path(t.spark, "json-tree")
    t.nation.select("n_nationkey", "n_name", F.col("n_nationkey").alias("place")).coalesce(1).write.partitionBy("place").json(path)
    return paged.scan_json_tree(t.spark, path, "n_nationkey int, n_name string")


@query("SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'changed' ELSE 'missing' END AS fault, count(*) AS files FROM nation WHERE n_nationkey % 3 > 0 GROUP BY 1")
def archive_verified(t):
    """Files against a manifest of which a third agrees, and others have another digest or no file."""
    path = scratch_path(t.spark, "archive")
    t.nation.select("n_name", F.col("n_nationkey").alias("place")).coalesce(1).write.partitionBy("place").json(path)
    place = F.regexp_extract("path", r"place=(\d+)", 1).cast("int")
    gone = (place % 3 > 0) & (place % 2 > 0)
    told = writers.manifest(t.spark, path).select(
        F.when(gone, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")).alias("path"),
        F.when(place % 3 > 0, F.lit("0" * 64)).otherwise(F.col("sha256")).alias("sha256"),
    )
    faults = writers.verify_manifest(t.spark, path, told).filter("fault <> 'unexpected'")
    return faults.groupBy("fault").agg(F.count(F.lit(1)).alias("files"))


def _zipped(key, rows):
    """One archive a nation: a customer a file, with files that the scan leaves out."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for i, (name, segment) in enumerate(zip(rows["c_name"], rows["c_mktsegment"])):
            folder = "data\\" if i % 2 else "data/"
            z.writestr(f"{folder}{name}.json", '{"segment": "%s"}' % segment)
        for name in ("data/relationship_a.json", "data/bafkx.json", "other/x.json", "data/list.json", "data/x.txt"):
            z.writestr(name, "[1]" if "list" in name else "{}")
    return pd.DataFrame({"path": [str(key[0])], "content": [held.getvalue()]})


@query("SELECT CAST(c_nationkey AS VARCHAR) AS archive, c_name || '.json' AS name, c_mktsegment AS segment FROM customer")
def zip_json_tree(t):
    rows = t.customer.select("c_nationkey", "c_name", "c_mktsegment")
    archives = rows.groupBy("c_nationkey").applyInPandas(_zipped, "path string, content binary")
    return readers.zip_json(archives).select("archive", "name", F.get_json_object("json", "$.segment").alias("segment"))


@query(
    "WITH p AS (SELECT o_custkey, max(o_totalprice) FILTER (o_orderkey % 2 = 0) AS m, count(*) AS n FROM orders GROUP BY 1) "
    "SELECT 's' || c_custkey AS request_identifier, CASE WHEN c_custkey % 4 = 0 THEN 's' || c_custkey ELSE 'P-' || c_custkey END AS parcel_identifier, "
    "CAST(c_custkey AS DOUBLE) AS market_value, CASE WHEN c_custkey % 5 > 0 THEN 'CO ' || c_name || ' | ANN LEE' ELSE 'ANN LEE' END AS owners_text, "
    "CAST(CASE WHEN c_custkey % 5 > 0 THEN 2 ELSE 1 END AS BIGINT) AS owner_count, '2001-0' || (1 + c_custkey % 9) || '-01' AS last_sale_date, "
    "c_custkey % 3 = 0 AS has_permits, 1900 + c_nationkey AS built_year, CAST(c_nationkey AS DOUBLE) AS lot_size_acre FROM customer"
)
def flatten_county_rows(t):
    """A tree of JSON files a property, flattened by one aggregation."""
    c = t.customer.withColumn("k", F.col("c_custkey").cast("string"))
    body = lambda **fields: F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    even = lambda test, column: F.when(test, column)
    built = (F.col("c_nationkey") + 1900).cast("string")
    files = {
        "property.json": body(parcel_identifier=even(F.col("c_custkey") % 4 != 0, F.concat(F.lit(" P-"), "k")), property_structure_built_year=built),
        "lot.json": body(lot_area_sqft=F.col("c_nationkey") * 43560),
        "tax_1.json": body(tax_year=F.lit(2024), property_market_value_amount=F.col("k")),
        "tax_2.json": body(tax_year=F.lit(2020), property_market_value_amount=F.lit(1)),
        "sales_history_1.json": body(ownership_transfer_date=F.concat(F.lit("2001-0"), (F.col("c_custkey") % 9 + 1).cast("string"), F.lit("-01"))),
        "sales_history_2.json": body(ownership_transfer_date=F.lit("1999-12-31")),
        "person_1.json": body(first_name=F.lit("ANN"), last_name=F.lit("LEE")),
        "person_2.json": body(first_name=F.lit("ANN"), last_name=F.lit(" LEE ")),
        "company_1.json": even(F.col("c_custkey") % 5 > 0, body(name=F.concat(F.lit("CO "), "c_name"))),
        "property_improvement_1.json": even(F.col("c_custkey") % 3 == 0, F.lit("{}")),
    }
    tree = F.array(*[F.struct(F.lit(n).alias("name"), j.alias("json")) for n, j in files.items()])
    rows = c.select(F.concat(F.lit("s"), "k").alias("strap"), F.inline(tree)).filter("json is not null")
    out = flatten.flatten_properties(rows, "roll", "Example", "FL")
    names = ["request_identifier", "parcel_identifier", "market_value", "owners_text", "owner_count", "last_sale_date", "has_permits", "lot_size_acre"]
    return out.select(*names, F.col("built_year").cast("int").alias("built_year"))


@query("SELECT c_custkey, '{\"c_custkey\":' || c_custkey || CASE WHEN c_nationkey % 2 = 0 THEN ',\"name\":\"' || c_name || '\"' ELSE '' END || '}' AS json FROM customer")
def drop_null_keys(t):
    name = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).alias("name")
    return t.customer.select("c_custkey", flatten.sparse_json(F.struct("c_custkey", name)).alias("json"))


@query(
    "SELECT p_partkey, type, usage FROM part LEFT JOIN (SELECT CAST(n_nationkey AS INTEGER) AS p_size, n_name AS type, r_name AS usage FROM nation JOIN region ON r_regionkey = n_regionkey) USING (p_size)"
)
def use_code_mapping(t):
    """Codes by a dimension table; a code that it lacks has neither type nor usage."""
    codes = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    codes = codes.select(F.col("n_nationkey").cast("int").alias("p_size"), F.col("n_name").alias("type"), F.col("r_name").alias("usage"))
    return flatten.decode_use(t.part.select("p_partkey", "p_size"), codes, "p_size").select("p_partkey", "type", "usage")


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def schema_precondition(t):
    """The columns and types must be there before anything runs."""
    joins.require_columns(t.customer, c_custkey="bigint", c_name="string", c_nationkey="int")
    return t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT CAST(c_custkey AS VARCHAR) AS place_id, c_name AS name_primary, CASE WHEN c_nationkey % 2 = 0 THEN 'services_and_business/financial_service/atm' ELSE 'shops/' || c_mktsegment END AS taxonomy_path, "
    "c_nationkey % 2 = 0 AS hosted_service, 'Town ' || c_nationkey AS address_locality, 'a,b' AS datasets FROM customer WHERE c_custkey % 13 + 0.5 BETWEEN 2 AND 9 AND c_custkey % 11 + 0.25 BETWEEN 1 AND 8"
)
def clipped_places(t):
    """Nested places within a boundary: list access, list to path, the flag of a full path, distinct datasets."""
    x, y = F.col("c_custkey") % 13 + 0.5, F.col("c_custkey") % 11 + 0.25
    atm = F.array(*map(F.lit, ("services_and_business", "financial_service", "atm")))
    path = F.when(F.col("c_nationkey") % 2 == 0, atm).otherwise(F.array(F.lit("shops"), "c_mktsegment"))
    source = lambda s: F.struct(F.lit(s).alias("dataset"))
    places = t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.col("c_name").alias("primary")).alias("names"),
        F.struct(F.element_at(path, -1).alias("primary"), path.alias("hierarchy")).alias("taxonomy"),
        F.lit(0.9).alias("confidence"),
        F.array(F.struct(F.concat(F.lit("Town "), F.col("c_nationkey").cast("string")).alias("locality")), F.struct(F.lit("x").alias("locality"))).alias("addresses"),
        F.array(source("B"), source("a"), source("b")).alias("sources"),
        F.struct(x.alias("xmin"), x.alias("xmax"), y.alias("ymin"), y.alias("ymax")).alias("bbox"),
        x.alias("lon"),
        y.alias("lat"),
    )
    out = flatten.clip_places(places, [(2, 1), (9, 1), (9, 8), (2, 8)])
    return out.select("place_id", "name_primary", "taxonomy_path", "hosted_service", "address_locality", F.array_join("datasets", ",").alias("datasets"))


@query("SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, CASE WHEN o_orderkey % 7 = 0 THEN false ELSE o_orderstatus IN ('F') END AS done FROM orders")
def match_rules(t):
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status")
    rows = t.orders.select("o_orderkey", "o_orderpriority", status)
    return flatten.match_rule(rows, {"urgent": ("o_orderpriority", ["1-URGENT", "2-HIGH"]), "done": ("status", ["F"])}).select("o_orderkey", "urgent", "done")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'CBC' || printf('%06d', c_custkey) ELSE 'CBC' || printf('%06d', c_custkey) || ',A' || printf('%05d', c_nationkey) END AS licenses FROM customer")
def extract_licenses(t):
    """Licence numbers in prose, normalised, each once."""
    own = F.concat(F.lit("cbc-"), F.format_string("%06d", "c_custkey"))
    other = F.when(F.col("c_custkey") % 2 == 0, F.upper(own)).otherwise(F.concat(F.lit("a-"), F.format_string("%05d", "c_nationkey")))
    prose = F.concat(F.lit("They hold License Number of "), own, F.lit(" and license number of "), other, F.lit("; see license no 12."))
    return t.customer.select("c_custkey", F.array_join(text.license_numbers_in(prose), ",").alias("licenses"))


@query(
    "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ' Builders' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE NULL END AS name FROM customer"
)
def alternate_names(t):
    """One word, page furniture and overlong texts are no names."""
    k = F.col("c_custkey") % 4
    raw = F.when(k == 0, F.concat("c_name", F.lit(" Builders"))).when(k == 1, F.lit("Word")).when(k == 2, F.lit("Visit our Website now")).otherwise(F.repeat(F.lit("long name "), 17))
    raw = F.when(k == 1, F.regexp_replace("c_name", "[^A-Za-z]", "")).otherwise(raw)
    return t.customer.select("c_custkey", text.alternate_name(raw, ascii_only=True).alias("name"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '12:' || c_custkey WHEN 1 THEN CAST(c_custkey AS VARCHAR) ELSE 'host/' || c_custkey END AS identity FROM customer")
def business_identity(t):
    key, k = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    provider = F.when(k == 0, F.lit("12"))
    found = flatten.profile_identity(provider, F.when(k < 2, key), F.lit(None).cast("string"), F.when(k == 2, F.concat(F.lit("host/"), key)))
    return t.customer.select("c_custkey", found.alias("identity"))


@query("SELECT s_suppkey, s_suppkey % 2 = 0 AS same FROM supplier")
def canonical_address_compare(t):
    key = F.col("s_suppkey").cast("string")
    right = F.when(F.col("s_suppkey") % 2 == 0, F.concat(key, F.lit(" n  oak st"))).otherwise(F.concat(key, F.lit(" N Oak Ave")))
    return t.supplier.select("s_suppkey", flatten.same_address(F.concat(key, F.lit(" North Oak Street.")), right).alias("same"))


@query(
    "SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN '0' || (600 + c_nationkey) || ':' || c_custkey || CASE WHEN c_custkey % 3 = 1 THEN ':7' ELSE '' END END AS ids, "
    "CASE WHEN c_custkey % 2 = 0 THEN 'AB' || printf('%010d', c_custkey) END AS parcel FROM customer"
)
def profile_url_ids(t):
    """Ids that end a profile's address, and twelve-character parcel keys."""
    key, k = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    path = F.concat(F.lit("/us/profile/roofing/acme-0"), (F.col("c_nationkey") + 600).cast("string"), F.lit("-"), key)
    url = F.when(k == 0, F.concat(F.lit("https://www.Example.org"), path, F.lit("/?a=1")))
    url = url.when(k == 1, F.concat(F.lit("https://example.org"), path, F.lit("/addressId/7"))).otherwise(F.concat(F.lit("http://example.org"), path))
    digits = F.format_string("%010d", "c_custkey")
    parcel = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" ab-"), digits)).otherwise(digits)
    return t.customer.select("c_custkey", text.profile_url_ids(url, "example.org").alias("ids"), text.parcel12(parcel).alias("parcel"))


@query(
    "SELECT l_partkey, CASE WHEN l_partkey % 5 = 0 THEN 'multi-polygon' WHEN count(*) > 20 THEN 'complex-polygon' ELSE 'simple-polygon' END AS kind, "
    "CAST(CASE WHEN l_partkey % 5 = 0 THEN 2 ELSE 1 END AS INTEGER) AS rings, CAST(count(*) * CASE WHEN l_partkey % 5 = 0 THEN 2 ELSE 1 END AS INTEGER) AS vertices FROM lineitem GROUP BY 1"
)
def parcel_geometry_kinds(t):
    point = F.struct(F.col("l_quantity").cast("double").alias("lon"), F.lit(0.0).alias("lat"))
    rings = t.lineitem.groupBy("l_partkey").agg(F.collect_list(point).alias("ring"))
    stats = geo.ring_stats(F.when(F.col("l_partkey") % 5 == 0, F.array("ring", "ring")).otherwise(F.array("ring")))
    return rings.select("l_partkey", stats["complexity"].alias("kind"), stats["rings"].alias("rings"), stats["vertices"].alias("vertices"))


@query(
    "SELECT c_custkey AS page_id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS DOUBLE) / 2 END AS rating, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS reviews, "
    "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS accredited, 'https://site' || c_custkey || '.com' AS website FROM customer WHERE c_custkey % 7 > 0"
)
def profiles_of_pages(t):
    """JSON-LD trees flattened by type; tri-state accreditation; the first outside link that is no social one."""
    key = F.col("c_custkey").cast("string")
    score = F.concat(F.lit(', "aggregateRating": {"@type": "AggregateRating", "ratingValue": "'), (F.col("c_nationkey") / 2).cast("string"), F.lit('", "reviewCount": '), key, F.lit("}"))
    business = F.concat(F.lit('<script type="application/ld+json">{"@graph": [{"@type": "LocalBusiness", "name": "'), "c_name", F.lit('"'), F.when(F.col("c_custkey") % 2 == 0, score).otherwise(""), F.lit("}]}</script>"))
    said = F.when(F.col("c_custkey") % 3 == 0, "<b>Accredited</b> since").when(F.col("c_custkey") % 3 == 1, "<b>Not</b> accredited").otherwise("")
    links = F.concat(F.lit('<a href="https://facebook.com/x">f</a><a href="https://site'), key, F.lit('.com">s</a>'))
    html = F.concat(F.when(F.col("c_custkey") % 7 > 0, business).otherwise("<script type='application/ld+json'>{broken</script>"), said, links)
    out = records.profiles_from_pages(t.customer.select(F.col("c_custkey").alias("page_id"), html.alias("html")))
    return out.select("page_id", "name", "rating", "reviews", "accredited", "website")


@query("SELECT 'n' || n_nationkey AS id, n_name AS label FROM nation WHERE n_nationkey < 10 UNION ALL SELECT DISTINCT 'n' || c_nationkey, 'new' FROM customer WHERE c_nationkey >= 10")
def upsert_vertices(t):
    """Vertices are added where their id is absent; those there stay."""
    name = lambda c: F.concat(F.lit("n"), F.col(c).cast("string")).alias("id")
    current = t.nation.filter("n_nationkey < 10").select(name("n_nationkey"), F.col("n_name").alias("label"))
    return flatten.add_vertices(current, t.customer.select(name("c_nationkey"), F.lit("new").alias("label")))


def _streamed(t, stream, mode="append"):
    """The rows of a stream over the events, through its checkpoint and sink."""
    path = scratch_path(t.spark, "stream")
    sink = streams.whole_parquet_sink(f"{path}/out") if mode == "complete" else streams.idempotent_parquet_sink(f"{path}/out")
    streams.run_available(stream, sink, f"{path}/checkpoint", mode)
    return t.spark.read.parquet(f"{path}/out")


def _events(t):
    """The events as a stream of the table's file."""
    events = t.events
    return streams.event_stream(t.spark, f"{t.sf_dir}/events.parquet*", events.schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT DISTINCT user_id || '/' || event_type AS key FROM events")
def stream_unique_events(t):
    """Each idempotency key once, by the stateful operator."""
    keyed = _events(t).select("ts", F.concat_ws("/", "user_id", "event_type").alias("key"))
    return _streamed(t, streams.unique_events(keyed, "key", "ts", "400 days")).select("key")


@query("SELECT CAST(epoch(time_bucket(INTERVAL 1 DAY, ts)) AS BIGINT) // 86400 AS day_no, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windowed_counts(t):
    counts = streams.windowed_counts(_events(t).select("ts", "event_type"), "ts", "1 hour", "1 day", None, ["event_type"])
    out = _streamed(t, counts, "complete")
    return out.select(F.floor(F.unix_timestamp("start") / 86400).alias("day_no"), "event_type", "n")


@query(
    "SELECT user_id, count(*) AS sessions FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR ts - p > INTERVAL 8 HOUR GROUP BY 1"
)
def stream_session_counts(t):
    found = streams.session_counts(_events(t).select("ts", "user_id"), "ts", "1 hour", "8 hours", ["user_id"])
    return _streamed(t, found, "complete").groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"))


@query(
    "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'click'"
)
def tombstones(t):
    """The newest row of each key after a batch; a key whose newest row is a deletion goes."""
    rows = t.events.select("user_id", "event_id", (F.col("event_type") == "click").alias("deleted"))
    state = streams.tombstone_state(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"), "user_id", "event_id", "deleted")
    return state.select("user_id", "event_id")


@query("SELECT o_custkey AS tx, o_orderkey AS seq FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 5 + o_custkey % 10)")
def complete_transactions(t):
    """Changes of transactions that are there in full; repeated deliveries count once."""
    rows = t.orders.select(F.col("o_custkey").alias("tx"), F.col("o_orderkey").alias("seq"), (F.col("o_custkey") % 10 + 5).alias("size"))
    again = rows.unionByName(rows.filter("seq % 4 = 0"))
    return streams.complete_transactions(again, "tx", "seq", "size").select("tx", "seq")


@query(
    "WITH v AS (SELECT c_custkey AS k, max(c_nationkey) AS version FROM customer WHERE c_nationkey % 3 > 0 GROUP BY 1) SELECT o_orderkey FROM orders JOIN v ON k = o_custkey AND version = o_orderkey % 25"
)
def ready_gate(t):
    """Rows of the newest version that is marked ready."""
    versions = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("bigint").alias("version"), (F.col("c_nationkey") % 3 > 0).alias("ready"))
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 25).alias("version"))
    return streams.ready_only(rows, versions, "k", "version").select("o_orderkey")


def _registry(t):
    """Registry lines of customers as companies: an agent for all, two officers for some, shared addresses."""
    key = F.format_string("%012d", "c_custkey")
    place = F.concat(F.lit("1 Main Street "), (F.col("c_custkey") % 40).cast("string"))
    chief = F.when(F.col("c_custkey") % 2 == 0, F.lit("LEE ANN"))
    rows = t.customer.select(
        key.alias("k"), "c_name", place.alias("place"), F.lit("Town").alias("town"), F.when(F.col("c_custkey") % 3 == 0, F.lit("PO BOX 1")).alias("mail"),
        F.lit("AGENT CO").alias("agent"), chief.alias("chief"), F.when(chief.isNotNull(), F.lit("2 Oak Road")).alias("oak"), F.lit("P").alias("title"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("ROE BO")).alias("second"),
    )
    fields = {"documentNumber": "k", "entityName": "c_name", "address1": "place", "city": "town", "mailAddress1": "mail", "registeredAgentName": "agent"}
    lines = readers.format_fixed_width(rows, fields, ({"name": "chief", "title": "title", "address": "oak"}, {"name": "second"}))
    return readers.parse_fixed_width(lines)


@query(
    "SELECT printf('%012d', c_custkey) AS document, CAST(CASE WHEN c_custkey % 4 = 0 THEN 2 WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS officers, "
    "CASE WHEN c_custkey % 2 = 0 THEN 'P LEE ANN 2 Oak Road' END AS first_officer FROM customer"
)
def registry_officers(t):
    first = F.get("officers", F.lit(0))
    shown = F.when(first.isNotNull(), F.concat_ws(" ", first["title"], first["name"], first["address"]))
    return _registry(t).select(F.col("documentNumber").alias("document"), F.size("officers").cast("bigint").alias("officers"), shown.alias("first_officer"))


@query(
    "WITH c AS (SELECT *, (c_custkey % 2 = 0)::INT AS chief, (c_custkey % 4 = 0)::INT AS second, (c_custkey % 3 = 0)::INT AS mail FROM customer) "
    "SELECT 'company' AS label, count(*)::BIGINT AS n FROM c UNION ALL SELECT 'business_registration', count(*)::BIGINT FROM c UNION ALL "
    "SELECT 'business_registration_address', (count(*) + sum(mail))::BIGINT FROM c UNION ALL SELECT 'business_registration_party', (count(*) + sum(chief + second))::BIGINT FROM c UNION ALL "
    "SELECT 'address', (count(DISTINCT c_custkey % 40) + max(mail) + max(chief))::BIGINT FROM c UNION ALL "
    "SELECT 'company_has_business_registration', count(*)::BIGINT FROM c UNION ALL SELECT 'business_registration_has_address', (count(*) + sum(mail))::BIGINT FROM c UNION ALL "
    "SELECT 'business_registration_address_has_address', (count(*) + sum(mail))::BIGINT FROM c UNION ALL SELECT 'business_registration_has_party', (count(*) + sum(chief + second))::BIGINT FROM c UNION ALL "
    "SELECT 'business_registration_party_has_address', sum(chief)::BIGINT FROM c"
)
def registry_graph(t):
    """Five classes and five relationships, each vertex and edge once."""
    vertices, edges = permits.registry_graph(_registry(t))
    return vertices.groupBy("label").agg(F.count(F.lit(1)).alias("n")).unionByName(edges.groupBy("label").agg(F.count(F.lit(1)).alias("n")))


@query(
    "SELECT substr(sha256('duval' || chr(0) || 'metro' || chr(0) || o_orderkey), 1, 32) AS property_improvement_id, substr(printf('%010d', o_custkey), 1, 6) || '-' || substr(printf('%010d', o_custkey), 7) AS parcel_identifier, "
    "'E-' || o_orderkey AS permit_number, CASE WHEN o_orderkey % 3 = 0 THEN 'Electrical' ELSE 'E' END AS improvement_type, "
    "CASE o_orderstatus WHEN 'F' THEN 'Finalized' WHEN 'O' THEN 'Expired' ELSE 'Status 9' END AS improvement_status, strftime(o_orderdate, '%Y-%m-%d') AS permit_issue_date, "
    "CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 5 DAY, '%Y-%m-%d') END AS permit_close_date, CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate + INTERVAL 5 DAY, '%Y-%m-%d') END AS expiration_date, "
    "round(o_totalprice, 2) AS estimated_job_value, o_orderkey || ' OAK ST, ' || CASE WHEN o_orderkey % 5 = 0 THEN '#7, ' ELSE '' END || 'METRO, FL, 32246' AS work_address FROM orders"
)
def permits_of_map_features(t):
    """Features of a map service as permit rows."""
    key = F.col("o_orderkey").cast("string")
    stamp = lambda days: (F.datediff(F.date_add(F.col("o_orderdate").cast("date"), days), F.lit("1970-01-01")).cast("bigint") * 86_400_000)
    none = F.lit(None).cast("bigint")
    features = t.orders.select(
        F.col("o_orderkey").alias("RecordID"), none.alias("OBJECTID"), F.format_string("%06d %04d", (F.col("o_custkey") / 10000).cast("bigint"), F.col("o_custkey") % 10000).alias("RE"),
        F.concat(F.lit("E-"), key).alias("FullPermitNumber"), F.when(F.col("o_orderkey") % 3 == 0, F.lit(2)).otherwise(7).alias("PermitTypeID"),
        F.when(F.col("o_orderstatus") == "F", 23).when(F.col("o_orderstatus") == "O", 4).otherwise(9).alias("Status"), F.lit("New").alias("TypeOfWork"),
        stamp(0).alias("DateEntered"), stamp(5).alias("DateUpdated"), none.alias("DateLastInspection"), none.alias("PaidDay"),
        F.concat(key, F.lit(" OAK ST")).alias("ADDR"), F.when(F.col("o_orderkey") % 5 == 0, F.lit("7")).otherwise(" ").alias("APTNUM"), F.lit(None).cast("string").alias("CITY"),
        F.lit("32246").alias("ZIPCODE"), F.lit("Home").alias("ProposedUseDesc"), F.lit("").alias("Comments"), F.col("o_totalprice").cast("decimal(18,2)").alias("TotalCost"),
        F.lit("Acme").alias("CompanyName"), none.alias("AssociatePermitID"),
    )
    out = permits.permits_of_features(features, {23: "Finalized", 4: "Expired"}, {2: "Electrical"}, "Duval", "metro", "map", "METRO", "FL")
    names = ["property_improvement_id", "parcel_identifier", "permit_number", "improvement_type", "improvement_status", "permit_issue_date"]
    return out.select(*names, "permit_close_date", "expiration_date", "estimated_job_value", "work_address")


@query(
    "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'person:Mary Ann Smith-Jones,Jr.;company:' || upper(c_name) || ' LLC' WHEN 1 THEN 'company:SMITH & SONS HOLDINGS' "
    "WHEN 2 THEN 'person:Dr.,John Q Public;person:Jane Doe' ELSE '' END AS owners FROM customer"
)
def parsed_owners(t):
    """Companies and persons of an owner field, with titles, repeats and parties that are neither."""
    k = F.col("c_custkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("SMITH-JONES, MARY  ANN JR & "), F.upper("c_name"), F.lit(" LLC and smith-jones, mary ann jr")))
    raw = raw.when(k == 1, F.lit(" SMITH & SONS HOLDINGS")).when(k == 2, F.lit("DR PUBLIC, JOHN Q & DOE JANE & X")).otherwise(F.lit("4711"))
    shown = lambda o: F.concat(o["kind"], F.lit(":"), F.concat_ws(",", o["prefix"], o["name"], o["suffix"]))
    return t.customer.select("c_custkey", F.array_join(F.transform(owners.parse_owners(raw), shown), ";").alias("owners"))
