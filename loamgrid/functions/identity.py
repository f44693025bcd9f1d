"""Deterministic identities, bit for bit."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamgrid.functions.text import nfkc

#: Fixed value: the namespace of address identities.
ADDRESS_NAMESPACE = "47541537-6230-5494-bf31-221c5f53ccd5"


def _uuid5_shape(digest: Column) -> Column:
    """A UUID of version 5 from the first 32 hex digits of a digest."""
    part = lambda a, n: F.substring(digest, a, n)
    variant = F.lower(F.hex(F.conv(part(17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def uuid5(name: Column, namespace: str) -> Column:
    return _uuid5_shape(F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8"))))


def uuid5_shaped(name: Column) -> Column:
    """The same without a namespace, for a source whose ids were minted so."""
    return _uuid5_shape(F.sha1(F.encode(name, "UTF-8")))


def sha_prefix(value: Column, digits: int = 32) -> Column:
    return F.substring(F.sha2(value, 256), 1, digits)


def permit_id(county: Column, jurisdiction: Column, source_id: Column) -> Column:
    """32 hex digits over the three parts, parted by NUL."""
    return sha_prefix(F.concat_ws("\0", county, jurisdiction, source_id))


def normal_field(value: Column, ascii_only: bool = False) -> Column:
    """NFKC, trimmed, blanks as one space, lower case; null is empty."""
    plain = value.cast("string") if ascii_only else nfkc(value.cast("string"))
    return F.coalesce(F.lower(F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))), F.lit(""))


def address_signature(
    street: Column, unit: Column, state: Column, postal_code: Column, country: Column | None = None, ascii_only: bool = False
) -> Column:
    """The length-prefixed signature of an address; null if country, state, five digits of ZIP or street lack."""
    field = lambda c: normal_field(c, ascii_only)
    digits = F.regexp_replace(field(postal_code), r"\D", "")
    home = field(F.coalesce(country, F.lit("us")) if country is not None else F.lit("us"))
    fields = [("country", home), ("state", field(state)), ("postal_code", F.substring(digits, 1, 5)), ("street", field(street))]
    whole = (F.length(digits) >= 5) & (fields[0][1] != "") & (fields[1][1] != "") & (fields[3][1] != "")
    part = lambda name, v: F.concat(F.lit(f"{name}:"), F.octet_length(v).cast("string"), F.lit(":"), v)
    parts = [part(n, v) for n, v in [*fields, ("unit", field(unit))]]
    return F.when(whole, F.concat_ws("|", F.lit("address:v1"), *parts))


def address_token(signature: Column) -> Column:
    return F.sha2(signature, 256)


def address_uuid(signature: Column) -> Column:
    return uuid5(signature, ADDRESS_NAMESPACE)


def registry_address_id(*parts: Column) -> Column:
    """24 hex digits over the JSON array of the parts."""
    return F.concat(F.lit("registry:address:"), sha_prefix(F.to_json(F.array(*parts)), 24))


def graph_id(label: str, **properties: Column) -> Column:
    """A content id: SHA-256 over JSON with sorted keys of the label and the properties that are set."""
    body = F.struct(*[properties[k].alias(k) for k in sorted(properties)])
    return F.sha2(F.to_json(F.struct(F.lit(label).alias("label"), body.alias("properties"))), 256)


def canonical_digest(value) -> str:
    """SHA-256 of JSON with recursively sorted keys, for driver-side documents such as manifests."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def blob_key(content: Column) -> Column:
    """A content-addressed path."""
    digest = F.sha2(content, 256)
    return F.concat(F.lit("sha256/"), F.substring(digest, 1, 2), F.lit("/"), F.substring(digest, 3, 2), F.lit("/"), digest)
