"""Read models over the relational core: left joins with the joined column before the own one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def property_profiles(properties: DataFrame, parcels: DataFrame) -> DataFrame:
    own = ["property_id", "parcel_identifier", "property_type", "property_usage_type", "property_legal_description_text"]
    own += ["property_structure_built_year", "subdivision", "zoning"]
    sites = parcels.select("parcel_id", "jurisdiction_key")
    joined = properties.select(*own, F.col("parcel_id").alias("_parcel")).join(sites, F.col("_parcel") == F.col("parcel_id"), "left")
    return joined.select(*own, "parcel_id", "jurisdiction_key")


def permit_search(permits: DataFrame, parcels: DataFrame, addresses: DataFrame, companies: DataFrame) -> DataFrame:
    p, a, b, c = permits.alias("p"), parcels.alias("a"), addresses.alias("b"), companies.alias("c")
    joined = p.join(a, F.col("a.parcel_id") == F.col("p.parcel_id"), "left")
    joined = joined.join(b, F.col("b.address_id") == F.col("p.address_id"), "left")
    joined = joined.join(c, F.col("c.company_id") == F.col("p.contractor_company_id"), "left")
    own = ["property_improvement_id", "permit_number", "improvement_type", "improvement_status", "source_status", "record_status"]
    own += ["application_received_date", "permit_issue_date", "permit_close_date", "parcel_id"]
    return joined.select(
        *[F.col(f"p.{x}") for x in own],
        F.coalesce("a.parcel_identifier", "p.parcel_identifier").alias("parcel_identifier"),
        F.col("p.address_id"),
        F.coalesce("b.unnormalized_address", "p.work_location").alias("unnormalized_address"),
        F.col("b.city_name"),
        F.col("b.postal_code"),
        F.col("p.contractor_company_id"),
        F.col("c.name").alias("contractor_name"),
    )


def company_profiles(companies: DataFrame, registrations: DataFrame) -> DataFrame:
    held = registrations.select(
        F.col("company_id").alias("_c"), "business_registration_id", "document_number", "status", "filing_type", "filed_date", "fei_number"
    )
    joined = companies.select("company_id", "name", "normalized_name").join(held, F.col("company_id") == F.col("_c"), "left")
    return joined.drop("_c")


def address_profiles(addresses: DataFrame) -> DataFrame:
    columns = ["address_id", "normalized_address_key", "unnormalized_address", "street_number", "street_name", "street_suffix_type"]
    columns += ["unit_identifier", "city_name", "state_code", "postal_code", "latitude", "longitude"]
    return addresses.select(*columns)
