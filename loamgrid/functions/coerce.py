"""Exact coercions of raw source text to typed values. All are built-in expressions, so codegen spans them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the sources' runtime calls white space: all of Unicode's, byte order mark included.
_TRIM = r"^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$"
_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def to_text(value: Column) -> Column:
    """Trimmed text; null if nothing is left."""
    return F.nullif(F.regexp_replace(value.cast("string"), _TRIM, ""), F.lit(""))


def to_number(value: Column) -> Column:
    """A finite double, or null. Decimal and exponent forms; 0x, 0o and 0b integers, without a sign."""
    text = F.regexp_replace(value.cast("string"), _TRIM, "")
    number = text.try_cast("double")
    found = F.when(text.rlike(_NUMBER) & (F.abs(number) < float("inf")), number)
    for mark, base, digits in (("x", 16, "[0-9a-f]"), ("o", 8, "[0-7]"), ("b", 2, "[01]")):
        hit = text.rlike(f"(?i)^0{mark}{digits}{{1,15}}$")
        found = F.coalesce(found, F.when(hit, F.conv(F.substring(text, 3, 15), base, 10).cast("double")))
    return found


def to_integer(value: Column) -> Column:
    """The number without its fraction."""
    return to_number(value).cast("bigint")


def money_signed(value: Column) -> Column:
    """A number without dollar signs, commas and blanks."""
    return to_number(F.regexp_replace(value.cast("string"), r"[$,\s]", ""))


def portal_money(value: Column) -> Column:
    """The same, null if negative."""
    found = money_signed(value)
    return F.when(found >= 0, found)


def portal_date(value: Column) -> Column:
    """ISO text from an ISO prefix or m/d/yyyy, else null. The calendar is not checked, as in the sources."""
    raw = to_text(value)
    us = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    part = lambda i: F.lpad(F.regexp_extract(raw, us, i), 2, "0")
    american = F.concat_ws("-", F.regexp_extract(raw, us, 3), part(1), part(2))
    iso = F.regexp_extract(raw, r"^(\d{4}-\d{2}-\d{2})", 1)
    missing = raw.isNull() | raw.rlike("(?i)no data|not available")
    return F.when(~missing, F.when(iso != "", iso).when(raw.rlike(us), american))


def registry_date(value: Column) -> Column:
    """A date from eight digits that the calendar has."""
    text = F.trim(value)
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def epoch_ms_date(value: Column) -> Column:
    """The UTC day of an epoch in milliseconds."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(to_number(value.cast("string")) / 86_400_000).cast("int"))


def utc_timestamp_text(value: Column) -> Column:
    """ISO text with milliseconds and Z from ISO-Z or a database's +00 text; null for any other form."""
    iso, plus = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,6})?Z$", r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,6})?\+00(:?00)?$"
    ok = value.rlike(iso) | value.rlike(plus)
    bare = F.regexp_replace(F.regexp_replace(value, r"(Z|\+00(:?00)?)$", ""), " ", "T")
    return F.when(ok, F.date_format(F.try_to_timestamp(bare), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def clock_minutes(value: Column) -> Column:
    """Minutes since midnight of HH:MM[:SS]; null if blank."""
    parts = F.split(F.trim(value), ":")
    return F.when(F.trim(value) != "", parts[0].try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int"))


def decode(value: Column, labels: dict[str, str]) -> Column:
    """The label of a code, else the code itself."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), value)


def enum_weight(value: Column, weights: dict[str, int]) -> Column:
    """The weight of an upper-case, trimmed value, else 0."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(F.trim(F.coalesce(value.cast("string"), F.lit(""))))), F.lit(0))


def min_max(value: Column, low: float, high: float) -> Column:
    """Clamped to [low, high] and scaled to [0, 1]; null is 0."""
    clamped = F.least(F.greatest(value.cast("double"), F.lit(float(low))), F.lit(float(high)))
    return F.when(value.isNull(), 0.0).otherwise((clamped - low) / (high - low))


#: Land-use codes, as (lowest, highest, band).
USE_BANDS = (
    (0, 0, "vacant_residential"),
    (1, 1, "single_family"),
    (2, 2, "mobile_home"),
    (3, 3, "multi_family"),
    (8, 8, "multi_family"),
    (4, 4, "condo"),
    (10, 39, "commercial"),
    (40, 49, "industrial"),
    (50, 69, "agricultural"),
    (70, 79, "institutional"),
    (80, 89, "government"),
)


def use_band(code: Column) -> Column:
    """The band of a numeric land-use code, read from the text's leading integer; else ``other``."""
    number = F.regexp_extract(F.trim(code.cast("string")), r"^([+-]?\d+)", 1).try_cast("int")
    out = F.lit("other")
    for low, high, band in USE_BANDS:
        out = F.when(number.between(low, high), F.lit(band)).otherwise(out)
    return out


def hour_in_window(hour: Column, start: Column, end: Column) -> Column:
    """Whether hour lies in [start, end); a window whose end is not after its start crosses midnight."""
    return F.when(start < end, (hour >= start) & (hour < end)).otherwise((hour >= start) | (hour < end))
