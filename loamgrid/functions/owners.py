"""Owners of a property from one free-text field: companies as they stand, persons by the parts of their names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of which any one makes a party a company.
COMPANY_WORDS = (
    "INC", "INCORPORATED", "CO", "COMPANY", "CORP", "CORPORATION", "LLC", "LC", "LTD", "LLP", "LLLP", "PLC", "PLLC", "PC", "PA", "GP", "LP", "TR", "TRS",
    "TRUST", "FBO", "IRA", "ETAL", "ASSOC", "ASSN", "ASPHA", "FOUNDATION", "FNDN", "PARTNERS", "PARTNERSHIP", "HOLDINGS", "INVESTMENTS", "PROPERTIES",
    "PROPERTY", "REALTY", "MANAGEMENT", "MGMT", "SOLUTIONS", "SERVICES", "SERVICE", "ENTERPRISE", "ENTERPRISES", "VENTURES", "BANK", "MORTGAGE", "FINANCIAL",
    "FUND", "CAPITAL", "TRUSTEE", "TRUSTEES", "AUTHORITY", "DEPARTMENT", "DEPT", "CITY", "COUNTY", "TOWN", "STATE", "UNIVERSITY", "COLLEGE", "SCHOOL",
    "HOSPITAL", "MEDICAL", "CLINIC", "CHURCH", "TEMPLE", "MOSQUE", "SYNAGOGUE", "MINISTRY", "MINISTRIES", "ASSOCIATION", "ASSOCIATES", "APARTMENTS",
    "PRODUCTIONS", "LOGISTICS", "TRANSPORT", "SUPPLY", "SUPPLIES", "DISTRIBUTION", "DESIGN", "DEVELOPMENT", "STUDIO", "ESTATES", "ESTATE", "HOMES",
    "HOMESITES", "HOLDING", "SYSTEMS", "TECHNOLOGIES", "TECHNOLOGY", "SOLN", "COOP",
)
#: Texts that make a party a company wherever they stand, also within a word; of a pair both must.
COMPANY_TEXTS = (
    ("LIMITED", "LIABILITY"), ("STATE", "OF"), ("CITY", "OF"), ("COUNTY", "OF"), ("UNITED", "STATES"), ("COMMUNITY", "DEVELOPMENT"),
    ("ECONOMIC", "DEVELOPMENT"), ("APARTMENTS",), ("ASSOCIATES",), ("ASSOCIATION",), ("AUTOMOTIVE",), ("BANK",), ("CAPITAL",), ("CHURCH",), ("CLINIC",),
    ("CO-OP",), ("COMPANY",), ("CONSTRUCTION",), ("CORPORATION",), ("DEPARTMENT",), ("ENTERPRISE",), ("ESTATE",), ("FOUNDATION",), ("FUND",), ("GROUP",),
    ("HOLDINGS",), ("HOSPITAL",), ("HOUSING",), ("INSURANCE",), ("INVESTMENT",), ("LLC",), ("LLP",), ("LLLP",), ("LTD",), ("MANAGEMENT",), ("MINISTRIES",),
    ("MINISTRY",), ("MORTGAGE",), ("PARTNERSHIP",), ("PARTNERS",), ("PROPERTIES",), ("PROPERTY",), ("REALTY",), ("RESORT",), ("SERVICES",),
    ("SOLUTIONS",), ("SCHOOL",), ("TRUST",), ("UNIVERSITY",), ("VENTURES",),
)
#: Titles before and after a person's name.
PREFIXES = {
    "MR": "Mr.", "MRS": "Mrs.", "MS": "Ms.", "MISS": "Miss", "MX": "Mx.", "DR": "Dr.", "PROF": "Prof.", "REV": "Rev.", "FR": "Fr.", "SR": "Sr.", "BR": "Br.",
    "CAPT": "Capt.", "COL": "Col.", "MAJ": "Maj.", "LT": "Lt.", "SGT": "Sgt.", "HON": "Hon.", "JUDGE": "Judge", "RABBI": "Rabbi", "IMAM": "Imam",
    "SHEIKH": "Sheikh", "SIR": "Sir", "DAME": "Dame",
}
SUFFIXES = {
    "JR": "Jr.", "SR": "Sr.", "II": "II", "III": "III", "IV": "IV", "PHD": "PhD", "MD": "MD", "ESQ": "Esq.", "JD": "JD", "LLM": "LLM", "MBA": "MBA", "RN": "RN",
    "DDS": "DDS", "DVM": "DVM", "CFA": "CFA", "CPA": "CPA", "PE": "PE", "PMP": "PMP", "EMERITUS": "Emeritus", "RET": "Ret.",
}
#: What first and last names, and middle names, look like once they are formed.
NAME_FORM = r"^[A-Z][a-z]*([ \-',.][A-Za-z][a-z]*)*$"
MIDDLE_FORM = r"^[A-Z][A-Za-z\s\-',.]*$"


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _words(value: Column) -> Column:
    return F.filter(F.split(value, " "), lambda w: w != "")


def is_company(party: Column) -> Column:
    """Whether a cleaned party names a company, trust or public body."""
    upper = F.upper(party)
    tokens = F.split(F.regexp_replace(upper, "[.']", " "), "[^A-Z0-9&]+")
    found = F.arrays_overlap(tokens, F.array(*map(F.lit, COMPANY_WORDS)))
    for texts in COMPANY_TEXTS:
        held = F.lit(True)
        for word in texts:
            held = held & upper.contains(word)
        found = found | held
    return found


def name_form(value: Column) -> Column:
    """Lower case with capitals after blanks, hyphens, apostrophes and dots; null without any letter."""
    out = F.trim(F.regexp_replace(F.lower(F.regexp_replace(value, r"[^A-Za-z\s\-',.]", " ")), r"\s+", " "))
    for mark in (" ", "-", "'", r"\."):
        glue = mark[-1]
        out = F.array_join(F.transform(F.split(out, mark), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), glue)
    return F.nullif(F.regexp_replace(out, r"\.+$", ""), F.lit(""))


def _title(word: Column, labels: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(known, F.regexp_replace(F.upper(word), "[^A-Z]", ""))


def _person(party: Column) -> Column:
    """struct of a person's parts; ``LAST, FIRST MIDDLE`` with a comma, else ``LAST FIRST MIDDLE``."""

    def of(words: Column) -> Column:
        prefix = F.when(F.size(words) > 1, _title(words[0], PREFIXES))
        bare = F.when(prefix.isNotNull(), F.slice(words, 2, F.size(words))).otherwise(words)
        return _let(F.struct(prefix.alias("prefix"), F.array_join(bare, " ").alias("rest")), lambda x: parts(x["prefix"], x["rest"]))

    def parts(prefix: Column, rest: Column) -> Column:
        cut = F.split(rest, ",")
        comma = F.size(cut) > 1
        own = _words(F.trim(F.when(comma, cut[1]).otherwise(rest)))
        return _let(F.struct(comma.alias("comma"), F.trim(cut[0]).alias("left"), own.alias("own")), lambda x: named(prefix, x["comma"], x["left"], x["own"]))

    def named(prefix: Column, comma: Column, left: Column, own: Column) -> Column:
        at = F.array_max(F.transform(own, lambda w, i: F.when(_title(w, SUFFIXES).isNotNull(), i).otherwise(F.lit(-1))))
        suffix = F.when(at >= 0, _title(F.get(own, at), SUFFIXES))
        kept = F.filter(own, lambda w, i: i != F.coalesce(at, F.lit(-1)))
        return _let(F.struct(suffix.alias("suffix"), kept.alias("kept")), lambda x: formed(prefix, comma, left, x["suffix"], x["kept"]))

    def formed(prefix: Column, comma: Column, left: Column, suffix: Column, kept: Column) -> Column:
        last = F.when(comma, left).otherwise(F.get(kept, F.lit(0)))
        given = F.when(comma, kept).otherwise(F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))))
        middle = F.array_join(F.slice(given, 2, F.greatest(F.size(given), F.lit(1))), " ")
        shaped = lambda c, form: _let(name_form(c), lambda n: F.when(n.rlike(form), n))
        first, last, middle = shaped(F.get(given, F.lit(0)), NAME_FORM), shaped(last, NAME_FORM), shaped(middle, MIDDLE_FORM)
        return F.struct(first.alias("first"), middle.alias("middle"), last.alias("last"), prefix.alias("prefix"), suffix.alias("suffix"))

    return _let(_words(party), of)


def parse_owners(value: Column) -> Column:
    """array<struct(kind, name, first, middle, last, prefix, suffix)>: the parties of a field, each once, in order.

    Parties are parted by & and ``and``, unless the field names a company of which a single word would be left over.
    A person needs a first and a last name; parties that have neither these nor a company's name are left out. Repeats
    are told without regard to case and prefix. Null and empty fields have no owners.
    """
    clean = F.trim(F.regexp_replace(value, r"\s+", " "))
    parted = lambda s: F.filter(F.transform(F.split(F.regexp_replace(s, r"(?i)\sand\s", " & "), r"\s*&\s*"), lambda p: F.trim(p)), lambda p: p != "")
    torn = lambda ps: F.exists(ps, lambda p: ~is_company(p) & (F.size(_words(p)) < 2))
    parties = _let(clean, lambda s: _let(parted(s), lambda ps: F.when((F.size(ps) > 1) & is_company(s) & torn(ps), F.array(s)).otherwise(ps)))
    text = F.lit(None).cast("string")

    def owner(p: Column) -> Column:
        company = F.struct(
            F.lit("company").alias("kind"), p.alias("name"), text.alias("first"), text.alias("middle"), text.alias("last"), text.alias("prefix"), text.alias("suffix")
        )
        person = lambda x: F.struct(
            F.lit("person").alias("kind"), F.concat_ws(" ", x["first"], x["middle"], x["last"]).alias("name"),
            x["first"].alias("first"), x["middle"].alias("middle"), x["last"].alias("last"), x["prefix"].alias("prefix"), x["suffix"].alias("suffix"),
        )
        return F.when(is_company(p), company).otherwise(_let(_person(p), person))

    key = lambda o: F.lower(F.concat_ws("|", o["kind"], o["name"], F.coalesce(o["suffix"], F.lit(""))))
    valid = F.filter(F.transform(F.coalesce(parties, F.array().cast("array<string>")), owner), lambda o: (o["kind"] == "company") | (o["first"].isNotNull() & o["last"].isNotNull()))
    once = lambda os: _let(F.transform(os, key), lambda keys: F.filter(os, lambda o, i: F.array_position(keys, key(o)) == i + 1))
    return _let(valid, once)
