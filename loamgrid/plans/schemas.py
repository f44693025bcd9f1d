"""Explicit schemas of the published tables, and checks against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loamgrid.operators.joins import ConflictError

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "boolean": T.BooleanType()}


def _schema(text: str) -> T.StructType:
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


#: One flat row per property.
PROPERTY = _schema(
    "property_id string, property_cid string, request_identifier string, parcel_identifier string, source_system string, "
    "county_name string, state_code string, address_street string, address_city string, address_zip string, address_uuid string, "
    "address_token string, latitude double, longitude double, lot_size_acre double, lot_area_sqft double, "
    "exterior_wall_material string, roof_covering_material string, property_type string, property_usage_type string, "
    "built_year bigint, livable_floor_area double, total_area double, assessed_value double, market_value double, "
    "land_value double, avm_value double, owner_name string, owners_text string, owner_count bigint, owner_occupied boolean, "
    "last_sale_date string, last_sale_price double, subdivision string, has_permits boolean, permit_count bigint, "
    "has_registry_tenant boolean, has_rated_contractor boolean, hoa_flag boolean"
)
#: One row per permit; dates are ISO text.
PERMIT = _schema(
    "property_improvement_id string, property_id string, parcel_identifier string, permit_number string, improvement_type string, "
    "improvement_status string, improvement_action string, permit_issue_date string, application_received_date string, "
    "final_inspection_date string, permit_close_date string, completion_date string, expiration_date string, opened_date string, "
    "source_system string, county_name string, project_description string, description string, estimated_job_value double, fee double"
)
#: Columns that say where a row comes from.
PROVENANCE = ("source_system", "source_record_key", "source_record_hash", "source_artifact_uri", "loaded_at")


def conform(df: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """The rows with exactly the schema's columns, absent ones null; other columns or types are an error.

    ``key`` must be a column of the schema that the rows have.
    """
    have = dict(df.dtypes)
    unknown = sorted(set(have) - set(schema.names))
    wrong = sorted(f.name for f in schema if f.name in have and have[f.name] != f.dataType.simpleString())
    if unknown or wrong or key not in have:
        raise ConflictError(f"unknown columns {unknown}, other types {wrong}, key {key}")
    from pyspark.sql import functions as F

    return df.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def key_faults(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, null keys; a published table has as many keys as rows and none null."""
    from pyspark.sql import functions as F

    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"), F.count_if(F.col(key).isNull()).alias("nulls"))
