"""Scans, sinks and coercions over the provided tables."""

from pyspark.sql import functions as F

from loamgrid.functions import coerce, identity, text
from loamgrid.plans.registry import query
from loamgrid.sources import readers


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def scan_pruned_columns(t):
    """Only the columns asked for reach the scan."""
    df = readers.scan_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_returnflag", "l_linestatus"])
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND "
    "o_orderdate < TIMESTAMP '1997-02-01' AND o_orderstatus = 'F'"
)
def scan_pushed_range(t):
    """Half-open date range and status, pushed to the scan."""
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    at = F.col("o_orderdate").cast("timestamp_ntz")
    keep = (at >= day("1997-01-01")) & (at < day("1997-02-01")) & (F.col("o_orderstatus") == "F")
    return t.orders.filter(keep).select("o_orderkey", "o_totalprice")


@query(
    "SELECT printf('%012d', p_partkey) AS \"documentNumber\", p_name AS \"entityName\", "
    "CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'I' END AS \"statusCode\", p_type AS \"filingTypeCode\", "
    "upper(p_brand) AS city, CASE WHEN p_size % 2 = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status, "
    "CAST(0 AS BIGINT) AS officers FROM part"
)
def registry_fixed_width(t):
    """Registry lines written and parsed back; the status code is decoded."""
    rows = t.part.select(
        F.format_string("%012d", "p_partkey").alias("k"),
        "p_name",
        F.when(F.col("p_size") % 2 == 0, "A").otherwise("I").alias("s"),
        "p_type",
        F.upper("p_brand").alias("c"),
    )
    fields = {"documentNumber": "k", "entityName": "p_name", "statusCode": "s", "filingTypeCode": "p_type", "city": "c"}
    back = readers.parse_fixed_width(readers.format_fixed_width(rows, fields))
    status = coerce.decode(F.col("statusCode"), {"A": "ACTIVE", "I": "INACTIVE"})
    return back.select(*fields, status.alias("status"), F.size("officers").cast("bigint").alias("officers"))


@query(
    "SELECT p_partkey, try_cast(regexp_extract(p_name, '[0-9]+') AS DOUBLE) AS number, CAST(trunc(p_retailprice) AS BIGINT) AS whole, "
    "nullif(trim(p_name), '') AS name FROM part"
)
def coerce_numbers(t):
    raw = F.nullif(F.regexp_extract("p_name", "[0-9]+", 0), F.lit(""))
    price = F.concat(F.lit(" "), F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit("\t"))
    name = F.concat(F.lit(" "), F.col("p_name"), F.lit("\n"))
    return t.part.select(
        "p_partkey", coerce.to_number(raw).alias("number"), coerce.to_integer(price).alias("whole"), coerce.to_text(name).alias("name")
    )


@query(
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS us, strftime(o_orderdate, '%Y-%m-%d') AS iso, "
    "CAST(NULL AS VARCHAR) AS none, strftime(o_orderdate, '%Y-%m-%d') AS packed FROM orders"
)
def portal_dates(t):
    at = lambda f: F.date_format("o_orderdate", f)
    return t.orders.select(
        "o_orderkey",
        coerce.portal_date(at("M/d/yyyy")).alias("us"),
        coerce.portal_date(F.concat(at("yyyy-MM-dd"), F.lit("T00:00:00"))).alias("iso"),
        coerce.portal_date(F.concat(F.lit("no data "), at("yyyy"))).alias("none"),
        F.date_format(coerce.registry_date(at("yyyyMMdd")), "yyyy-MM-dd").alias("packed"),
    )


@query(
    "SELECT c_custkey, CASE WHEN round(c_acctbal, 2) >= 0 THEN round(c_acctbal, 2) END AS money, round(c_acctbal, 2) AS signed FROM customer"
)
def portal_money(t):
    shown = F.concat(F.lit("$ "), F.format_number(F.round("c_acctbal", 2), 2))
    return t.customer.select("c_custkey", coerce.portal_money(shown).alias("money"), coerce.money_signed(shown).alias("signed"))


@query(
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS iso, "
    "CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minutes FROM events"
)
def event_times(t):
    """Epoch milliseconds to days, database text to ISO-Z, clock text to minutes."""
    ntz = F.col("ts").cast("timestamp_ntz")
    shown = F.concat(F.date_format(ntz, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
    days = F.datediff(ntz.cast("date"), F.lit("1970-01-01")).cast("bigint") * 86_400_000
    return t.events.select(
        "event_id",
        F.date_format(coerce.epoch_ms_date(days.cast("string")), "yyyy-MM-dd").alias("day"),
        coerce.utc_timestamp_text(shown).alias("iso"),
        coerce.clock_minutes(F.date_format(ntz, "HH:mm:ss")).alias("minutes"),
    )


@query(
    "SELECT p_partkey, CASE WHEN p_size = 1 THEN 'single_family' WHEN p_size = 2 THEN 'mobile_home' WHEN p_size IN (3, 8) THEN 'multi_family' "
    "WHEN p_size = 4 THEN 'condo' WHEN p_size BETWEEN 10 AND 39 THEN 'commercial' WHEN p_size BETWEEN 40 AND 49 THEN 'industrial' "
    "WHEN p_size BETWEEN 50 AND 69 THEN 'agricultural' WHEN p_size = 0 THEN 'vacant_residential' ELSE 'other' END AS band FROM part"
)
def use_bands(t):
    return t.part.select("p_partkey", coerce.use_band(F.format_string("%04d", "p_size")).alias("band"))


@query(
    "SELECT o_orderkey, CASE upper(trim(o_orderpriority)) WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 3 ELSE 0 END AS weight, "
    "round((least(greatest(o_totalprice / 1000, 300), 850) - 300) / 550, 6) AS scaled FROM orders"
)
def enum_weights_and_scaling(t):
    weight = coerce.enum_weight(F.lower(F.concat(F.lit(" "), F.col("o_orderpriority"))), {"1-URGENT": 5, "2-HIGH": 3})
    scaled = coerce.min_max(F.col("o_totalprice") / 1000, 300, 850)
    return t.orders.select("o_orderkey", weight.alias("weight"), F.round(scaled, 6).alias("scaled"))


@query(
    "SELECT c_custkey, upper(regexp_replace(c_name, '[^A-Za-z0-9]+', ' ', 'g')) AS strict, "
    "trim(regexp_replace(upper(regexp_replace(c_name, '[^A-Za-z0-9]+', ' ', 'g')), '\\bAIR\\b', '', 'g')) AS loose, "
    "'904' || printf('%07d', c_custkey) AS phone, 'CCC' || printf('%07d', c_custkey) AS license FROM customer"
)
def normal_names(t):
    named = F.concat("c_name", F.lit(", Inc. LLC"))
    phone = F.concat(F.lit("+1 (904) "), F.format_string("%07d", "c_custkey"))
    return t.customer.select(
        "c_custkey",
        text.business_name(named).alias("strict"),
        text.business_name(F.concat(named, F.lit("")), loose=True).alias("loose"),
        text.phone10(phone).alias("phone"),
        text.license_number(F.concat(F.lit("ccc-"), F.format_string("%07d", "c_custkey"))).alias("license"),
    )


@query(
    "SELECT s_suppkey, 'N ' || s_suppkey || ' OAK ST' AS street, printf('%05d', s_suppkey) AS zip5, '1234' AS plus4, "
    "s_suppkey || ' Oak Rd' AS line_street, 'Palm City' AS line_city, printf('%05d', s_suppkey) AS line_zip FROM supplier"
)
def addresses(t):
    key = F.col("s_suppkey").cast("string")
    zip_ = F.format_string("%05d", "s_suppkey")
    parts = text.split_zip(F.concat(zip_, F.lit("-1234")))
    line = text.parse_address_line(F.concat(key, F.lit(" Oak Rd, Palm City, FL "), zip_))
    return t.supplier.select(
        "s_suppkey",
        text.registry_address(F.concat(F.lit("north "), key, F.lit(" oak street."))).alias("street"),
        parts["zip5"].alias("zip5"),
        parts["plus4"].alias("plus4"),
        line["street"].alias("line_street"),
        line["city"].alias("line_city"),
        line["postal_code"].alias("line_zip"),
    )


@query(
    "WITH s AS (SELECT s_suppkey, 'address:v1|country:2:us|state:2:fl|postal_code:5:' || printf('%05d', s_suppkey) || '|street:' || "
    "strlen(s_suppkey || ' oak rd') || ':' || s_suppkey || ' oak rd|unit:0:' AS signature FROM supplier) "
    "SELECT s_suppkey, signature, sha256(signature) AS token, substr(sha256('duval:' || s_suppkey), 1, 32) AS property_id FROM s"
)
def address_identities(t):
    street = F.concat(F.lit("  "), F.col("s_suppkey").cast("string"), F.lit("  OAK Rd "))
    signature = identity.address_signature(street, F.lit(None), F.lit("FL"), F.format_string("%05d-0001", "s_suppkey"))
    return t.supplier.select("s_suppkey", signature.alias("signature")).select(
        "s_suppkey",
        "signature",
        identity.address_token(F.col("signature")).alias("token"),
        identity.sha_prefix(F.concat(F.lit("duval:"), F.col("s_suppkey").cast("string"))).alias("property_id"),
    )


@query(
    "SELECT o_orderkey, substr(sha256('duval' || chr(0) || o_orderstatus || chr(0) || o_orderkey), 1, 32) AS permit_id, "
    "'sha256/' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 2) || '/' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 3, 2) || '/' || "
    "sha256(CAST(o_orderkey AS VARCHAR)) AS blob FROM orders"
)
def permit_and_blob_ids(t):
    key = F.col("o_orderkey").cast("string")
    return t.orders.select(
        "o_orderkey",
        identity.permit_id(F.lit("duval"), F.col("o_orderstatus"), key).alias("permit_id"),
        identity.blob_key(key).alias("blob"),
    )


@query(
    "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) <> '' AS titled, "
    "CAST(len(regexp_extract_all(html, '<a [^>]*href=')) AS BIGINT) AS links FROM pages"
)
def html_pages(t):
    """Titles and links by an HTML parser."""
    parsed = readers.scan_html(t.pages)
    return parsed.select("page_id", (F.col("title") != "").alias("titled"), F.size("links").cast("bigint").alias("links"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.' || json_keys(props)[1]) AS VARCHAR) AS first_value FROM events")
def json_props(t):
    keys = F.json_object_keys("props")
    return t.events.select("event_id", F.from_json("props", "map<string,string>")[F.element_at(keys, 1)].alias("first_value"))


@query(
    "SELECT c_custkey, 'customer ' || c_nationkey AS owner, 'us-' || lower(c_mktsegment) AS slug, "
    "substr(printf('%010d', c_custkey), 1, 6) || '-' || substr(printf('%010d', c_custkey), 7, 4) AS parcel, "
    "printf('%010d', c_custkey) AS folio, 'host.com/p/' || c_custkey AS profile FROM customer"
)
def misc_normalisers(t):
    digits = F.format_string("%010d", "c_custkey")
    url = F.concat(F.lit("https://WWW.Host.com/p/"), F.col("c_custkey").cast("string"), F.lit("/?x=1#y"))
    return t.customer.select(
        "c_custkey",
        F.lower(F.element_at(text.owner_names(F.concat(F.lit("CUSTOMER "), F.col("c_nationkey").cast("string"))), 1)).alias("owner"),
        text.county_slug(F.concat(F.lit(" US "), "c_mktsegment")).alias("slug"),
        text.parcel_dashed(digits).alias("parcel"),
        text.folio10(F.concat(digits, F.lit("-r"))).alias("folio"),
        text.url_identity(url).alias("profile"),
    )
