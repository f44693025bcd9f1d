"""From trees of JSON files to flat rows, and places clipped to a county."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.functions import geo, identity, text
from loamgrid.functions.coerce import to_integer, to_number, to_text

#: Full category paths of places that only host a service.
HOSTED_PATHS = (
    "services_and_business/financial_service/atm",
    "services_and_business/real_estate/real_estate_service/rental_service/rental_kiosk",
    "services_and_business/b2b_service/supplier_or_distributor/propane_supplier",
    "services_and_business/financial_service/money_transfer_service",
    "services_and_business/financial_service/trusts",
)


def _owner(json: Column) -> Column:
    """A company's name, else the person's names in order."""
    part = lambda k: to_text(F.get_json_object(json, f"$.{k}"))
    person = F.nullif(F.concat_ws(" ", part("first_name"), part("middle_name"), part("last_name")), F.lit(""))
    return F.coalesce(part("name"), person)


def flatten_properties(files: DataFrame, source: str, county: str, state: str) -> DataFrame:
    """One flat row per property from (strap, name, json) rows of its files, one aggregation by strap.

    Latest tax: highest year, ties to the last file by name; latest sale: latest date, ties likewise. Owners are
    distinct, in order of their files. Situs text comes first, structured columns are the fallback.
    """
    name, body = F.col("name"), F.col("json")
    field = lambda k: F.get_json_object(body, f"$.{k}")
    one = lambda n: F.max(F.when(name == f"{n}.json", body)).alias(n)
    first = lambda prefix: F.min(F.when(name.rlike(rf"^{prefix}(_\d+)?\.json$"), F.struct(F.length(name), name, body.alias("j"))))["j"]
    tax = F.when(name.rlike(r"^tax_\d+\.json$"), F.struct(F.coalesce(to_number(field("tax_year")), F.lit(0.0)).alias("y"), name, body.alias("j")))
    sale_day = F.coalesce(to_text(field("ownership_transfer_date")), F.lit(""))
    sale = F.when(name.rlike(r"^sales_history_\d+\.json$"), F.struct(sale_day.alias("d"), name, body.alias("j")))
    owner = F.when(name.rlike(r"^(person|company)_\d+\.json$"), F.struct(name, _owner(body).alias("o")))
    permit = F.count_if(name.rlike(r"^property_improvement_\d+\.json$"))
    single = ("property", "address", "unnormalized_address", "lot", "parcel")
    rows = files.groupBy("strap").agg(
        *[one(n) for n in single],
        first("structure").alias("structure"),
        first("layout").alias("layout"),
        F.max(tax)["j"].alias("tax"),
        F.max(sale)["j"].alias("sale"),
        F.transform(F.sort_array(F.collect_list(owner)), lambda s: s["o"]).alias("owners"),
        permit.alias("permit_count"),
    )
    get = lambda c, k: F.get_json_object(c, f"$.{k}")
    situs = F.coalesce(to_text(get("unnormalized_address", "full_address")), to_text(get("address", "unnormalized_address")))
    rows = rows.withColumn("_situs", text.parse_address_line(situs)).withColumn("owners", F.array_distinct(F.array_compact("owners")))
    sign = identity.address_signature(F.col("_situs.street"), to_text(get("address", "unit_identifier")), F.lit(state), F.col("_situs.postal_code"))
    number = lambda c, k: to_number(get(c, k))
    word = lambda c, k: to_text(get(c, k))
    some = F.size("owners") > 0
    sqft = number("lot", "lot_area_sqft")
    return rows.withColumn("_sign", sign).select(
        identity.uuid5_shaped(F.concat(F.lit(f"{source}:"), "strap")).alias("property_id"),
        F.col("strap").alias("request_identifier"),
        F.coalesce(word("property", "parcel_identifier"), word("parcel", "parcel_identifier"), "strap").alias("parcel_identifier"),
        F.lit(source).alias("source_system"),
        F.lit(county).alias("county_name"),
        F.lit(state).alias("state_code"),
        F.col("_situs.street").alias("address_street"),
        F.col("_situs.city").alias("address_city"),
        F.col("_situs.postal_code").alias("address_zip"),
        identity.address_uuid(F.col("_sign")).alias("address_uuid"),
        identity.address_token(F.col("_sign")).alias("address_token"),
        F.coalesce(number("lot", "lot_size_acre"), sqft / 43560).alias("lot_size_acre"),
        sqft.alias("lot_area_sqft"),
        F.coalesce(word("structure", "exterior_wall_material_primary"), word("structure", "exterior_wall_material")).alias("exterior_wall_material"),
        word("structure", "roof_covering_material").alias("roof_covering_material"),
        word("property", "property_type").alias("property_type"),
        word("property", "property_usage_type").alias("property_usage_type"),
        F.coalesce(to_integer(get("property", "property_structure_built_year")), to_integer(get("layout", "built_year"))).alias("built_year"),
        F.coalesce(number("property", "livable_floor_area"), number("layout", "livable_area_sq_ft")).alias("livable_floor_area"),
        number("tax", "property_assessed_value_amount").alias("assessed_value"),
        number("tax", "property_market_value_amount").alias("market_value"),
        number("tax", "property_land_amount").alias("land_value"),
        F.get("owners", F.lit(0)).alias("owner_name"),
        F.when(some, F.array_join("owners", " | ")).alias("owners_text"),
        F.when(some, F.size("owners").cast("bigint")).alias("owner_count"),
        word("sale", "ownership_transfer_date").alias("last_sale_date"),
        number("sale", "purchase_price_amount").alias("last_sale_price"),
        word("property", "subdivision").alias("subdivision"),
        (F.col("permit_count") > 0).alias("has_permits"),
        "permit_count",
        F.lit(False).alias("has_registry_tenant"),
        F.lit(False).alias("has_rated_contractor"),
    )


def clip_places(places: DataFrame, ring: list[tuple[float, float]]) -> DataFrame:
    """Places within a county's boundary: a range filter on the bbox that scans can prune by, then the exact test.

    ``places`` has id, names, taxonomy, confidence, addresses, sources, bbox and the point's lon and lat. Paths of
    hosted services are flagged.
    """
    xs, ys = zip(*ring)
    near = [F.col("bbox.xmin") >= min(xs), F.col("bbox.xmax") <= max(xs), F.col("bbox.ymin") >= min(ys), F.col("bbox.ymax") <= max(ys)]
    kept = places.filter(reduce(lambda a, b: a & b, near)).filter(geo.in_polygon(F.col("lon"), F.col("lat"), ring))
    path = F.array_join("taxonomy.hierarchy", "/")
    return kept.select(
        F.col("id").alias("place_id"),
        F.col("names.primary").alias("name_primary"),
        F.col("taxonomy.primary").alias("taxonomy_primary"),
        path.alias("taxonomy_path"),
        path.isin(*HOSTED_PATHS).alias("hosted_service"),
        "confidence",
        F.get("addresses", F.lit(0))["locality"].alias("address_locality"),
        F.array_sort(F.array_distinct(F.transform("sources", lambda s: F.lower(s["dataset"])))).alias("datasets"),
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
    )


def sparse_json(row: Column) -> Column:
    """A struct as JSON without its null keys."""
    return F.to_json(row)


def match_rule(df: DataFrame, rules: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """A boolean column for each named rule (field, values): the value is listed; a null field is false."""
    return df.withColumns({k: F.coalesce(F.col(f).isin(*v), F.lit(False)) for k, (f, v) in rules.items()})


def profile_identity(provider: Column, business: Column, profile: Column, url: Column) -> Column:
    """provider:business, else the first id there is; a profile without any raises."""
    both = F.when(provider.isNotNull() & business.isNotNull(), F.concat(provider, F.lit(":"), business))
    found = F.coalesce(both, to_text(business), to_text(profile), to_text(url))
    return F.coalesce(found, F.raise_error(F.lit("a profile has no stable identity")))


def same_address(a: Column, b: Column) -> Column:
    """Whether two address lines agree in their registry form."""
    return text.registry_address(a).eqNullSafe(text.registry_address(b))


def decode_use(df: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """Rows with the type and usage of their use code, from a dimension table that is small by nature."""
    return df.join(codes, code, "left")


def add_vertices(current: DataFrame, new: DataFrame) -> DataFrame:
    """New vertices only where their id is absent; existing ones stay as they are. Of new ones with one id the least counts."""
    columns = [c for c in new.columns if c != "id"]
    once = new.groupBy("id").agg(F.min(F.struct(*columns)).alias("_n")).select("id", "_n.*").select(new.columns)
    return current.unionByName(once.join(current.select("id"), "id", "left_anti"))
