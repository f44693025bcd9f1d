"""Trees to rows, clipped places, views and schemas."""

import json

import pytest
from pyspark.sql import functions as F

from loamgrid.operators import flatten
from loamgrid.operators.joins import ConflictError
from loamgrid.plans import schemas, views


def test_flatten_properties(spark):
    tree = {
        "property.json": {"parcel_identifier": " P-1 ", "property_type": "SingleFamily", "property_structure_built_year": "1984"},
        "unnormalized_address.json": {"full_address": "3400 RUGBY CT, PALM HARBOR FL 34684"},
        "lot.json": {"lot_area_sqft": 87120},
        "structure_2.json": {"exterior_wall_material": "Brick"},
        "structure_10.json": {"exterior_wall_material": "Wood"},
        "tax_1.json": {"tax_year": 2023, "property_market_value_amount": 5},
        "tax_2.json": {"tax_year": 2024, "property_market_value_amount": "7.5"},
        "sales_history_1.json": {"ownership_transfer_date": "2001-02-03", "purchase_price_amount": 9},
        "sales_history_2.json": {"ownership_transfer_date": "1999-01-01", "purchase_price_amount": 1},
        "person_1.json": {"first_name": "ANN", "last_name": "LEE"},
        "person_2.json": {"first_name": "ANN", "last_name": "LEE"},
        "company_1.json": {"name": "ACME"},
        "property_improvement_1.json": {},
    }
    files = [("s1", n, json.dumps(b)) for n, b in tree.items()] + [("s2", "property.json", "{}")]
    out = flatten.flatten_properties(spark.createDataFrame(files, "strap string, name string, json string"), "county_appraiser", "Pinellas", "FL")
    r = {x["request_identifier"]: x for x in schemas.conform(out, schemas.PROPERTY, "property_id").collect()}
    a, b = r["s1"], r["s2"]
    assert (a["parcel_identifier"], a["address_city"], a["address_zip"], a["built_year"]) == ("P-1", "PALM HARBOR", "34684", 1984)
    assert (a["lot_size_acre"], a["exterior_wall_material"], a["market_value"]) == (2.0, "Brick", 7.5)
    assert (a["last_sale_date"], a["owners_text"], a["owner_count"], a["permit_count"]) == ("2001-02-03", "ACME | ANN LEE", 2, 1)
    assert a["address_uuid"] and a["has_permits"] and b["address_uuid"] is None
    assert (b["parcel_identifier"], b["owner_count"], b["has_permits"]) == ("s2", None, False)
    assert tuple(schemas.key_faults(out, "property_id").first()) == (2, 2, 0)


def test_conform_refuses(spark):
    df = spark.createDataFrame([("a", "x")], "property_id string, ssn string")
    with pytest.raises(ConflictError):
        schemas.conform(df, schemas.PROPERTY, "property_id")
    with pytest.raises(ConflictError):
        schemas.conform(df.select(F.lit(1).alias("property_id")), schemas.PROPERTY, "property_id")
    assert len(schemas.PROPERTY) == 39 and len(schemas.PERMIT) == 20


def test_clip_places(spark):
    schema = (
        "id string, names struct<primary:string>, taxonomy struct<primary:string,hierarchy:array<string>>, confidence double, "
        "addresses array<struct<locality:string>>, sources array<struct<dataset:string>>, bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>, lon double, lat double"
    )
    row = lambda i, x, y, path: (i, (i,), (path[-1], path), 0.9, [("Town",)], [("META",), ("meta",)], (x, x, y, y), x, y)
    data = [row("in", 1.0, 1.0, ["a", "b"]), row("corner", 3.9, 3.9, ["a"]), row("out", 9.0, 9.0, ["a"]), row("atm", 0.5, 0.5, ["services_and_business", "financial_service", "atm"])]
    out = {r["place_id"]: r for r in flatten.clip_places(spark.createDataFrame(data, schema), [(0, 0), (4, 0), (0, 4)]).collect()}
    assert set(out) == {"in", "atm"} and out["atm"]["hosted_service"] and not out["in"]["hosted_service"]
    assert out["in"]["datasets"] == ["meta"] and out["in"]["address_locality"] == "Town"


def test_small_forms(spark):
    df = spark.createDataFrame([("p", "b", None, None, "1 Oak Street"), (None, None, None, "u", "9 Elm")], "a string, b string, c string, d string, e string")
    got = df.select(flatten.profile_identity(*[F.col(x) for x in "abcd"]), flatten.same_address(F.col("e"), F.lit("1 OAK ST.")), flatten.sparse_json(F.struct("a", "b"))).collect()
    assert [tuple(r) for r in got] == [("p:b", True, '{"a":"p","b":"b"}'), ("u", False, "{}")]
    with pytest.raises(Exception, match="stable identity"):
        df.select(flatten.profile_identity(*[F.lit(None).cast("string")] * 4)).collect()
    rules = {"inbound": ("a", ["p"]), "outbound": ("b", ["z"])}
    assert [(r["inbound"], r["outbound"]) for r in flatten.match_rule(df, rules).collect()] == [(True, False), (False, False)]
    now, new = spark.createDataFrame([(1, "x")], "id int, v string"), spark.createDataFrame([(1, "y"), (2, "z"), (2, "z")], "id int, v string")
    assert sorted(tuple(r) for r in flatten.add_vertices(now, new).collect()) == [(1, "x"), (2, "z")]


def test_views(spark):
    f = lambda rows, schema: spark.createDataFrame(rows, schema)
    parcels = f([("k1", "P1", "j1")], "parcel_id string, parcel_identifier string, jurisdiction_key string")
    properties = f([("p1", "X", "t", "u", "l", 1990, "s", "z", "k1"), ("p2", "Y", "t", "u", "l", None, "s", "z", None)],
        "property_id string, parcel_identifier string, property_type string, property_usage_type string, property_legal_description_text string, property_structure_built_year int, subdivision string, zoning string, parcel_id string")
    assert {r["property_id"]: r["jurisdiction_key"] for r in views.property_profiles(properties, parcels).collect()} == {"p1": "j1", "p2": None}
    permits = f([("i1", "n", "t", "s", "ss", "r", None, None, None, "k1", "OWN", "a9", "work", "c1"), ("i2", "n", "t", "s", "ss", "r", None, None, None, None, "OWN", "a1", "work", None)],
        "property_improvement_id string, permit_number string, improvement_type string, improvement_status string, source_status string, record_status string, application_received_date date, permit_issue_date date, permit_close_date date, parcel_id string, parcel_identifier string, address_id string, work_location string, contractor_company_id string")
    addresses = f([("a1", "key", "full", "1", "OAK", "St", None, "TOWN", "FL", "12345", 1.0, 2.0)],
        "address_id string, normalized_address_key string, unnormalized_address string, street_number string, street_name string, street_suffix_type string, unit_identifier string, city_name string, state_code string, postal_code string, latitude double, longitude double")
    companies = f([("c1", "ACME", "ACME")], "company_id string, name string, normalized_name string")
    out = {r["property_improvement_id"]: (r["parcel_identifier"], r["unnormalized_address"], r["contractor_name"]) for r in views.permit_search(permits, parcels, addresses, companies).collect()}
    assert out == {"i1": ("P1", "work", "ACME"), "i2": ("OWN", "full", None)}
    registrations = f([("c1", "b1", "D1", "ACTIVE", "x", None, "f")], "company_id string, business_registration_id string, document_number string, status string, filing_type string, filed_date date, fei_number string")
    assert views.company_profiles(companies, registrations).first()["document_number"] == "D1" and views.address_profiles(addresses).count() == 1
