"""Normalisers for names, phones, licences and addresses."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

from loamgrid.functions.coerce import to_text

#: Legal forms that end a business name, and trade words that a loose name leaves out.
LEGAL_SUFFIXES = (
    "CO", "COMPANY", "CORP", "CORPORATION", "INC", "INCORPORATED", "LLC", "LLP", "LP", "LTD", "LIMITED", "PA", "PC", "PLLC",
)
TRADE_WORDS = (
    "AIR", "CONTRACTING", "CONTRACTOR", "CONTRACTORS", "ELECTRIC", "ELECTRICAL", "HEATING", "ROOFING", "SERVICE", "SERVICES",
)
#: Street words and their registry forms.
STREET_FORMS = {
    "STREET": "ST", "AVENUE": "AVE", "DRIVE": "DR", "ROAD": "RD", "BOULEVARD": "BLVD", "PARKWAY": "PKWY", "LANE": "LN",
    "COURT": "CT", "PLACE": "PL", "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W",
}
#: How prose states a licence number.
LICENSE_PROSE = r"(?i)license number of\s+([A-Z0-9][A-Z0-9-]{3,30})"
#: Texts that are no alternate name.
NOT_A_NAME = (
    r"(?i)additional|business categor|contact information|copyright|department of business|licens(?:e|ing)|phone number"
    r"|privacy policy|social media|terms of use|website|www\.|https?:|@"
)


@pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Unicode compatibility composition, for which Spark has no expression."""
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


@pandas_udf(StringType())
def without_accents(values: pd.Series) -> pd.Series:
    """Compatibility decomposition less its diacritics."""

    def plain(v: str) -> str:
        if v.isascii():
            return v.replace("^", "").replace("`", "")
        drop = lambda c: unicodedata.category(c) == "Mn" or unicodedata.category(c) in ("Sk", "Lm")
        return "".join(c for c in unicodedata.normalize("NFKD", v) if not drop(c))

    return values.map(plain, na_action="ignore")


def name_words(value: Column, ascii_only: bool = False) -> Column:
    """Upper-case words of letters and digits; an ampersand is AND. ``ascii_only`` spares the Python function."""
    plain = value if ascii_only else without_accents(value)
    upper = F.regexp_replace(F.upper(plain), "&", " AND ")
    return F.filter(F.split(F.regexp_replace(upper, "[^A-Z0-9]+", " "), " "), lambda w: w != "")


def business_name(value: Column, loose: bool = False, ascii_only: bool = False) -> Column:
    """Words less trailing legal forms, of which at least one word stays; the loose form leaves out trade words too."""
    joined = F.array_join(name_words(value, ascii_only), " ")
    core = F.regexp_replace(joined, f"(?<=[A-Z0-9])( ({'|'.join(LEGAL_SUFFIXES)}))+$", "")
    if not loose:
        return F.coalesce(core, F.lit(""))
    words = F.filter(F.split(core, " "), lambda w: ~w.isin(*TRADE_WORDS))
    return F.coalesce(F.array_join(words, " "), F.lit(""))


def phone10(value: Column) -> Column:
    """Ten digits, a leading 1 dropped; else null."""
    digits = F.regexp_replace(value.cast("string"), r"\D", "")
    return F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).when(
        F.length(digits) == 10, digits
    )


def license_number(value: Column) -> Column:
    """Upper-case letters and digits, four at least; else null."""
    kept = F.regexp_replace(F.upper(value.cast("string")), "[^A-Z0-9]", "")
    return F.when(F.length(kept) >= 4, kept)


def license_numbers_in(text: Column) -> Column:
    """The distinct licence numbers named in free text."""
    found = F.regexp_extract_all(text, F.lit(LICENSE_PROSE), F.lit(1))
    return F.array_distinct(F.array_compact(F.transform(found, license_number)))


def alternate_name(value: Column, ascii_only: bool = False) -> Column:
    """The value if it may be a name: 2 to 16 words, at most 160 characters, no page boilerplate."""
    words = F.size(name_words(value, ascii_only))
    return F.when(F.length(value).between(2, 160) & words.between(2, 16) & ~value.rlike(NOT_A_NAME), value)


def registry_address(value: Column) -> Column:
    """Upper case with short street words; other characters than letters and digits are one space."""
    out = F.upper(value)
    for word, short in STREET_FORMS.items():
        out = F.regexp_replace(out, rf"\b{word}\b", short)
    return F.trim(F.regexp_replace(out, "[^A-Z0-9]+", " "))


def zip5(value: Column) -> Column:
    return F.substring(F.regexp_replace(value.cast("string"), r"\D", ""), 1, 5)


def split_zip(value: Column) -> Column:
    """struct(zip5, plus4), null where digits lack."""
    digits = F.regexp_replace(value.cast("string"), r"\D", "")
    five = F.when(F.length(digits) >= 5, F.substring(digits, 1, 5))
    four = F.when(F.length(digits) >= 9, F.substring(digits, 6, 4))
    return F.struct(five.alias("zip5"), four.alias("plus4"))


def parse_address_line(value: Column) -> Column:
    """struct(street, city, postal_code) of one line: segments by comma, a trailing state and ZIP or ZIP taken off."""
    parts = F.filter(F.transform(F.split(to_text(value), ","), lambda s: F.trim(s)), lambda s: s != "")
    last = F.element_at(parts, -1)
    tail = r"\b(?:[A-Za-z]{2}\s+)?(\d{5})(?:-\d{4})?\s*$"
    code = F.nullif(F.regexp_extract(last, tail, 1), F.lit(""))
    head = F.trim(F.regexp_replace(last, tail, ""))
    rest = F.slice(parts, 1, F.size(parts) - 1)
    kept = F.when(code.isNull(), parts).when(head == "", rest).otherwise(F.concat(rest, F.array(head)))
    city = F.array_join(F.slice(kept, 2, F.greatest(F.size(kept) - 1, F.lit(0))), ", ")
    street = F.get(kept, F.lit(0))
    return F.struct(street.alias("street"), F.nullif(city, F.lit("")).alias("city"), code.alias("postal_code"))


def folio10(value: Column) -> Column:
    """Ten digits of a folio whose letters and digits may end in R; else null."""
    kept = F.regexp_replace(F.regexp_replace(F.upper(value), "[^A-Z0-9]", ""), "R$", "")
    return F.when(kept.rlike(r"^\d{10}$"), kept)


def parcel_digits(value: Column) -> Column:
    """Digits only: lossy, for lookup and never for identity."""
    return F.regexp_replace(value.cast("string"), r"\D", "")


def parcel_dashed(value: Column) -> Column:
    """NNNNNN-NNNN of ten digits; else null."""
    digits = parcel_digits(value)
    return F.when(F.length(digits) == 10, F.concat_ws("-", F.substring(digits, 1, 6), F.substring(digits, 7, 4)))


def parcel12(value: Column) -> Column:
    """Twelve letters or digits once blanks and dashes are gone, upper-case; else null."""
    kept = F.regexp_replace(F.upper(F.trim(value)), r"[-\s]", "")
    return F.when(kept.rlike("^[A-Z0-9]{12}$"), kept)


def county_slug(value: Column, separator: str = "-") -> Column:
    slug = F.regexp_replace(F.lower(F.trim(value)), "[^a-z0-9]+", separator)
    return F.trim(slug, F.lit(separator))


def url_identity(url: Column) -> Column:
    """host/path of a profile's address: no scheme, www, query or trailing slash, lower-case host."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z]+://", ""), r"[?#].*$", "")
    host = F.regexp_replace(F.lower(F.substring_index(rest, "/", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/]*(/.*)$", 1), "/+$", "")
    return F.concat(host, path)


def profile_url_ids(url: Column, host: str) -> Column:
    """The ids that end the address of a profile page on ``host`` or a subdomain, joined by colons; null for others.

    Such an address is https, has /profile/ in its path, and ends in -1234-567 and perhaps /addressId/8.
    """
    pattern = rf"^(?i:https)://(?:[^/?#@]*\.)?(?i:{re.escape(host)})(?::\d+)?(/[^?#]*)"
    path = F.regexp_replace(F.regexp_extract(F.trim(url), pattern, 1), "/+$", "")
    ids = lambda i: F.nullif(F.regexp_extract(path, r"(?i)-(\d{4})-(\d+)(?:/addressId/(\d+))?$", i), F.lit(""))
    return F.when(path.rlike("(?i)/profile/") & ids(1).isNotNull(), F.concat_ws(":", ids(1), ids(2), ids(3)))


def owner_names(value: Column) -> Column:
    """Distinct owners of a free-text field, split at & and ;, in order; companies keep their form, persons become
    ``First Middle Last`` where the source has ``LAST, FIRST MIDDLE``."""
    company = rf"\b({'|'.join(LEGAL_SUFFIXES)}|TRUST|BANK|ASSOCIATION|CHURCH|CITY|COUNTY|STATE)\b"
    parts = F.filter(F.transform(F.split(F.upper(value), r"\s*(?:&|;| AND )\s*"), lambda s: F.trim(s)), lambda s: s != "")

    def person(s: Column) -> Column:
        bare = F.regexp_replace(s, r"\b(MR|MRS|MS|DR|JR|SR|II|III|IV)\b\.?", " ")
        turned = F.concat_ws(" ", F.regexp_extract(bare, r"^([^,]*),(.*)$", 2), F.regexp_extract(bare, r"^([^,]*),(.*)$", 1))
        return F.trim(F.regexp_replace(F.when(bare.contains(","), turned).otherwise(bare), r"\s+", " "))

    return F.array_distinct(F.transform(parts, lambda s: F.when(s.rlike(company), s).otherwise(F.initcap(person(s)))))


def jaro_winkler_of(left: str, right: str) -> float:
    """Similarity with the prefix boost at every score and half transpositions kept fractional."""
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    reach = max(max(len(left), len(right)) // 2 - 1, 0)
    free, own = [True] * len(right), []
    for i, c in enumerate(left):
        for k in range(max(0, i - reach), min(i + reach + 1, len(right))):
            if free[k] and right[k] == c:
                free[k] = False
                own.append(c)
                break
    if not own:
        return 0.0
    other = [c for c, unused in zip(right, free) if not unused]
    moved = sum(a != b for a, b in zip(own, other))
    m = len(own)
    jaro = (m / len(left) + m / len(right) + (m - moved / 2) / m) / 3
    prefix = next((i for i, (a, b) in enumerate(zip(left[:4], right[:4])) if a != b), min(4, len(left), len(right)))
    return jaro + prefix * 0.1 * (1 - jaro)


def jaro_winkler_bound(left: Column, right: Column) -> Column:
    """What the similarity can be at most, by lengths and first letters alone."""
    short, long = F.least(F.length(left), F.length(right)), F.greatest(F.length(left), F.length(right))
    jaro = (F.lit(2.0) + short / F.greatest(long, F.lit(1))) / 3
    prefix = F.lit(0)
    for k in range(4, 0, -1):
        same = (F.substring(left, 1, k) == F.substring(right, 1, k)) & (short >= k)
        prefix = F.greatest(prefix, F.when(same, F.lit(k)).otherwise(F.lit(0)))
    return jaro + prefix * 0.1 * (1 - jaro)


@pandas_udf(DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler_of(a or "", b or "") for a, b in zip(left, right)], dtype="float64")
