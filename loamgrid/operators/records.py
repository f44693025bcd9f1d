"""Record-level operators: addresses, deeds, jurisdictions, property rows, pages, parcels, graphs, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamgrid.functions.coerce import to_number, to_text
from loamgrid.operators.joins import ConflictError

#: Street suffixes by their written forms.
STREET_SUFFIXES = {
    "ST": "St", "STREET": "St", "AVE": "Ave", "AVENUE": "Ave", "BLVD": "Blvd", "BOULEVARD": "Blvd", "RD": "Rd", "ROAD": "Rd",
    "DR": "Dr", "DRIVE": "Dr", "LN": "Ln", "LANE": "Ln", "CT": "Ct", "COURT": "Ct", "CIR": "Cir", "CIRCLE": "Cir",
    "HWY": "Hwy", "HIGHWAY": "Hwy", "PL": "Pl", "PLACE": "Pl", "TER": "Ter", "TERRACE": "Ter", "WAY": "Way", "PKWY": "Pkwy",
    "RDG": "Rdg", "RIDGE": "Rdg", "RUN": "Run", "LOOP": "Loop",
}
#: Lengths that wanted names may have; a company is looked up once for each.
MOST_LENGTHS = 200
DIRECTIONALS = ("N", "S", "E", "W", "NE", "NW", "SE", "SW")
#: Deed codes.
DEED_CODES = {
    "AG": "Contract for Deed",
    "AS": "Assignment of Contract",
    "BS": "Bargain and Sale Deed",
    "CE": "Miscellaneous",
    "CD": "Correction Deed",
    "CT": "Miscellaneous",
    "DL": "Deed in Lieu of Foreclosure",
    "GD": "Grant Deed",
    "GF": "Gift Deed",
    "JT": "Joint Tenancy Deed",
    "LB": "Lady Bird Deed",
    "LD": "Lady Bird Deed",
    "MS": "Miscellaneous",
    "PB": "Miscellaneous",
    "PR": "Personal Representative Deed",
    "QC": "Quitclaim Deed",
    "RD": "Miscellaneous",
    "RW": "Right of Way Deed",
    "SD": "Sheriff's Deed",
    "SM": "Special Master’s Deed",
    "SW": "Special Warranty Deed",
    "TD": "Tax Deed",
    "TO": "Transfer on Death Deed",
    "TR": "Trustee's Deed",
    "WD": "Warranty Deed",
}
#: Patterns of deed descriptions; the first that fits decides.
DEED_PATTERNS = (
    (r"special\s+warranty", "Special Warranty Deed"),
    (r"\bwarranty\b", "Warranty Deed"),
    (r"quit[\s-]*claim", "Quitclaim Deed"),
    (r"\bgrant\b", "Grant Deed"),
    (r"bargain", "Bargain and Sale Deed"),
    (r"lady\s+bird", "Lady Bird Deed"),
    (r"transfer\s+on\s+death|tod\b", "Transfer on Death Deed"),
    (r"sheriff", "Sheriff's Deed"),
    (r"\btax\b", "Tax Deed"),
    (r"trustee", "Trustee's Deed"),
    (r"personal\s+representative", "Personal Representative Deed"),
    (r"correction", "Correction Deed"),
    (r"lieu\s+of\s+foreclosure", "Deed in Lieu of Foreclosure"),
    (r"life\s+estate", "Life Estate Deed"),
    (r"joint\s+tenancy", "Joint Tenancy Deed"),
    (r"tenancy\s+in\s+common", "Tenancy in Common Deed"),
    (r"community\s+property", "Community Property Deed"),
    (r"\bgift\b", "Gift Deed"),
    (r"interspousal", "Interspousal Transfer Deed"),
    (r"wild\s+deed?", "Wild Deed"),
    (r"special\s+master", "Special Master’s Deed"),
    (r"court\s+order", "Court Order Deed"),
    (r"quiet\s+title", "Quiet Title Deed"),
    (r"administrator", "Administrator's Deed"),
    (r"guardian", "Guardian's Deed"),
    (r"receiver", "Receiver's Deed"),
    (r"right\s+of\s+way", "Right of Way Deed"),
    (r"vacation\s+of\s+plat", "Vacation of Plat Deed"),
    (r"assignment\s+of\s+contract", "Assignment of Contract"),
    (r"release\s+of\s+contract", "Release of Contract"),
    (r"contract\s+for\s+deed", "Contract for Deed"),
)


#: What ends the leading code of a deed, and the code itself.
DEED_CODE_END, DEED_CODE = "[-:]", r"^[^:-]+[:-]\s*"


def label_map(labels: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])


def street_parts(value: Column) -> Column:
    """struct of number, direction, name, suffix, city, state, zip5 and plus4 of ``line[, city], ST 12345[-6789]``."""
    cut = F.split(value, r"\s*,\s*")
    tokens = F.split(F.trim(cut[0]), r"\s+")
    some = F.size(tokens) >= 2
    first = F.upper(F.get(tokens, F.lit(1)))
    directed = first.isin(*DIRECTIONALS)
    rest = F.slice(tokens, F.when(directed, 3).otherwise(2), F.greatest(F.size(tokens), F.lit(1)))
    suffix = F.when(F.size(rest) >= 2, F.upper(F.element_at(rest, -1)))
    name = F.array_join(F.when(F.size(rest) >= 2, F.slice(rest, 1, F.size(rest) - 1)).otherwise(rest), " ")
    tail = F.when(F.size(cut) == 3, F.get(cut, F.lit(2))).when(F.size(cut) == 2, F.get(cut, F.lit(1)))
    pattern = r"(?i)^([A-Z]{2})\s+(\d{5})(?:-(\d{4}))?$"
    part = lambda i: F.nullif(F.regexp_extract(F.coalesce(tail, F.lit("")), pattern, i), F.lit(""))
    return F.struct(
        F.when(some, tokens[0]).alias("number"),
        F.when(some & directed, first).alias("direction"),
        F.when(some, F.nullif(F.upper(name), F.lit(""))).alias("name"),
        F.when(some, F.coalesce(F.try_element_at(label_map(STREET_SUFFIXES), suffix), suffix)).alias("suffix"),
        F.when(F.size(cut) == 3, F.upper(F.trim(F.get(cut, F.lit(1))))).alias("city"),
        F.upper(part(1)).alias("state"),
        part(2).alias("zip5"),
        part(3).alias("plus4"),
    )


def deed_type(instrument: Column) -> Column:
    """The deed's type: by a leading code, else by the first pattern that its text fits."""
    raw = to_text(instrument)
    code = F.upper(F.trim(F.element_at(F.split(raw, DEED_CODE_END), 1)))
    source = F.lower(F.concat_ws(" ", F.regexp_replace(raw, DEED_CODE, ""), raw))

    def by_words(s: Column) -> Column:
        out = F.when(s.contains("agreement") & s.contains("deed"), "Contract for Deed").otherwise("Miscellaneous")
        for pattern, label in reversed(DEED_PATTERNS):
            out = F.when(s.rlike(pattern), label).otherwise(out)
        return out

    worded = F.transform(F.array(source), by_words)[0]  # binds the text once: thirty copies of it would not compile
    return F.when(raw.isNotNull(), F.coalesce(F.try_element_at(label_map(DEED_CODES), code), worded))


def situs_first(*candidates: Column) -> Column:
    """The first address that has text: the situs before any structured mailing columns."""
    return F.coalesce(*[to_text(c) for c in candidates])


def acres(stated: Column, square_feet: Column) -> Column:
    """Stated acres, else from square feet."""
    return F.coalesce(to_number(stated), to_number(square_feet) / 43560)


def route_jurisdiction(city: Column, routes: list[tuple[str, list[str]]], default: str | None) -> Column:
    """The first jurisdiction, in order, with an alias that the city is, ends with, or contains between commas."""
    norm = F.upper(F.regexp_replace(F.trim(F.coalesce(city, F.lit(""))), r"\s+", " "))
    out = F.lit(default)
    for key, aliases in reversed(routes):
        hit = F.lit(False)
        for alias in (a.strip().upper() for a in aliases):
            hit = hit | (norm == alias) | norm.endswith(f" {alias}") | norm.contains(f", {alias},")
        out = F.when(hit, F.lit(key)).otherwise(out)
    return out


def refuse_columns(df: DataFrame, prohibited: set[str]) -> DataFrame:
    """The rows, if no column is prohibited or named twice."""
    names = [c.lower() for c in df.columns]
    bad = sorted({c for c in names if c in {p.lower() for p in prohibited} or names.count(c) > 1})
    if bad:
        raise ConflictError(f"prohibited or repeated columns: {bad}")
    return df


def public_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the public columns, absent ones as null text."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def one_parent_each(children: DataFrame, parents: DataFrame, key: str, parent_id: str) -> DataFrame:
    """Children with the id of their parent by key; a key of several parents is an error."""
    named = parents.groupBy(key).agg(F.min(parent_id).alias(parent_id), F.max(parent_id).alias("_max"))
    joined = children.join(named, key, "left")
    clash = F.raise_error(F.concat(F.lit(f"several {parent_id} for "), F.col(key).cast("string")))
    return joined.withColumn(parent_id, F.when(F.col(parent_id) == F.col("_max"), F.col(parent_id)).when(F.col("_max").isNotNull(), clash)).drop("_max")


def company_candidates(companies: DataFrame, wanted: DataFrame, id_: str) -> DataFrame:
    """(wanted key, ids): companies whose normalised name equals or starts with a wanted name, or whose phone or
    licence is the wanted one, as sorted sets; tables have name, phone and licence, ``wanted`` also ``want``.

    A company's name is looked up by its beginnings of the wanted names' lengths: an equi-join whatever names share.
    """
    c = companies.select(id_, "name", "phone", "license")
    w = wanted.select("want", F.col("name").alias("_n"), F.col("phone").alias("_p"), F.col("license").alias("_l"))
    lengths = [r[0] for r in w.filter("_n <> ''").select(F.length("_n").alias("k")).distinct().limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS:
        raise ConflictError(f"wanted names of more than {MOST_LENGTHS} lengths")
    heads = F.array_distinct(F.array(*[F.when(F.length("name") >= k, F.substring("name", 1, k)) for k in sorted(lengths)] or [F.lit(None).cast("string")]))
    by_name = w.join(c.select(id_, F.explode(F.array_compact(heads)).alias("_n")), "_n")
    by_phone, by_license = w.join(c, F.col("_p") == F.col("phone")), w.join(c, F.col("_l") == F.col("license"))
    hits = by_name.select("want", id_).unionByName(by_phone.select("want", id_)).unionByName(by_license.select("want", id_))
    return hits.groupBy("want").agg(F.sort_array(F.collect_set(id_)).alias("ids"))


def split_multipolygons(parcels: DataFrame, id_: str, polygons: str) -> DataFrame:
    """One row per polygon, the id with #n from the second on."""
    rows = parcels.select(F.col(id_).alias("_id"), F.posexplode(polygons).alias("_n", "polygon"))
    suffix = F.when(F.col("_n") > 0, F.concat(F.lit("#"), (F.col("_n") + 1).cast("string"))).otherwise("")
    return rows.select(F.concat(F.col("_id").cast("string"), suffix).alias(id_), "polygon")


def page_counts(text: Column, links: Column) -> Column:
    """struct(total, pages): the stated number of results, and the highest page number among the links."""
    total = F.regexp_replace(F.regexp_extract(text, r"(?i)Showing:\s*([\d,]+)\s+results?", 1), ",", "")
    numbers = F.transform(links, lambda u: F.regexp_extract(u, r"[?&]page=(\d+)", 1).try_cast("int"))
    return F.struct(total.try_cast("int").alias("total"), F.array_max(numbers).alias("pages"))


def field_coverage(labels: Column, output: Column) -> Column:
    """The share of labelled texts that the output contains, as written or compacted to letters and digits (six at least)."""
    compact = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    found = lambda s: output.contains(s) | ((F.length(compact(s)) >= 6) & compact(output).contains(compact(s)))
    return F.size(F.filter(labels, found)) / F.nullif(F.size(labels), F.lit(0))


def emit_graph(rows: DataFrame, vertices: list[tuple[str, Column, Column]], edges: list[tuple[str, Column, Column]]) -> tuple[DataFrame, DataFrame]:
    """(vertices (id, label, props), edges (label, src, dst)), each once, from one pass of arrays over the rows.

    vertices: (label, id, JSON properties); edges: (label, source id, target id). Null ids emit nothing.
    """
    vs = F.array(*[F.struct(i.alias("id"), F.lit(n).alias("label"), p.alias("props")) for n, i, p in vertices])
    es = F.array(*[F.struct(F.lit(n).alias("label"), a.alias("src"), b.alias("dst")) for n, a, b in edges])
    nodes = rows.select(F.explode(F.filter(vs, lambda v: v["id"].isNotNull())).alias("v")).select("v.*")
    links = rows.select(F.explode(F.filter(es, lambda e: e["src"].isNotNull() & e["dst"].isNotNull())).alias("e")).select("e.*")
    first = nodes.groupBy("id", "label").agg(F.min("props").alias("props"))
    return first, links.distinct()


def lexicon_faults(vertices: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(id, property, fault) of vertices (id, label, props map) against (label, property, required, pattern)."""
    rows = vertices.select("id", "label", F.explode_outer("props").alias("property", "value"))
    have = rows.filter("property is not null")
    known = lexicon.select("label", "property", "pattern", F.lit(True).alias("_known"))
    checked = have.join(known, ["label", "property"], "left")
    fault = F.when(F.col("_known").isNull(), "unknown_property").when(~F.rlike("value", F.col("pattern")), "format")
    wrong = checked.select("id", "property", fault.alias("fault")).filter("fault is not null")
    labels = lexicon.select("label").distinct()
    strange = vertices.join(labels, "label", "left_anti").select("id", F.lit(None).cast("string").alias("property"), F.lit("unknown_label").alias("fault"))
    need = vertices.select("id", "label").join(lexicon.filter("required").select("label", "property"), "label")
    lacking = need.join(have.select("id", "property"), ["id", "property"], "left_anti").select("id", "property", F.lit("required").alias("fault"))
    strange_ids = strange.select("id")
    return wrong.join(strange_ids, "id", "left_anti").unionByName(strange).unionByName(lacking)


def coverage_faults(snapshot: DataFrame) -> DataFrame:
    """(source, fault) of coverage rows (source, ingested, expected, first, last, digest)."""
    counted = snapshot.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("source")))
    cases = F.array_compact(
        F.array(
            F.when(F.col("_n") > 1, "repeated_source"),
            F.when((F.col("ingested") < 0) | (F.col("expected") < 0), "negative_count"),
            F.when(F.col("first") > F.col("last"), "dates_out_of_order"),
            F.when(F.col("ingested") > F.col("expected"), "more_than_expected"),
            F.when(~F.coalesce(F.col("digest"), F.lit("")).rlike("^[0-9a-f]{64}$"), "digest"),
        )
    )
    return counted.select("source", F.explode(cases).alias("fault")).distinct()


def eastern_date(utc: Column) -> Column:
    """The partition date in New York of a UTC timestamp."""
    return F.to_date(F.from_utc_timestamp(utc, "America/New_York"))


def date_placeholder(template: Column, today: str) -> Column:
    """Rule texts with {{today}}, {{week_ago}} and {{weekday}} filled in against a fixed clock."""
    day = F.lit(today).cast("date")
    out = F.replace(template, F.lit("{{today}}"), F.date_format(day, "yyyy-MM-dd"))
    out = F.replace(out, F.lit("{{week_ago}}"), F.date_format(F.date_sub(day, 7), "yyyy-MM-dd"))
    return F.replace(out, F.lit("{{weekday}}"), F.upper(F.date_format(day, "EEEE")))


def assignment_score(balance: Column, quality: Column, bureau: Column, day_fit: Column) -> Column:
    """Balance, and bonuses in proportion to its size: quality, bureau score and time fit, which better items amplify."""
    base = F.abs(balance)
    lift = 1 + quality + 0.5 * bureau
    return balance + base * (0.40 * quality + 0.25 * bureau) + base * lift * day_fit


def full_text_search(docs: DataFrame, query: str, id_: str, min_score: float, most: int) -> DataFrame:
    """(id, score): the share of the query's words that a text has, best first."""
    words = sorted(set(query.lower().split()))
    own = F.split(F.lower(F.col("text")), r"[^\p{Alnum}]+")
    score = F.size(F.array_intersect(own, F.array(*map(F.lit, words)))) / F.lit(float(len(words)))
    scored = docs.select(id_, score.alias("score")).filter(F.col("score") >= min_score)
    return scored.orderBy(F.desc("score"), id_).limit(most)


def derived_current(history: DataFrame, touched: DataFrame, key: str, value: str, at: list[str]) -> DataFrame:
    """The current value of the touched keys, from their whole history."""
    own = history.join(touched.select(key).distinct(), key, "left_semi")
    return own.groupBy(key).agg(F.max_by(value, F.struct(*at)).alias(value))


def phone_confidence(verified: Column, recency: Column, source: Column, contact: Column) -> Column:
    """Fixed weights of four signals in [0, 1]."""
    return 0.35 * verified + 0.30 * recency + 0.20 * source + 0.15 * contact


def window_progress(windows: DataFrame, span: str, terminal: str) -> DataFrame:
    """(span, windows, terminal, split): how far a tree of harvest windows has come, by the width of its nodes."""
    done = F.count_if(F.col(terminal))
    return windows.groupBy(span).agg(F.count(F.lit(1)).alias("windows"), done.alias("terminal"), (F.count(F.lit(1)) - done).alias("split"))


def progress_eta(windows: DataFrame, terminal: str, at: str) -> DataFrame:
    """One row: windows, terminal ones, seconds between the first and last done, and the seconds that the rest would take."""
    done = F.count_if(F.col(terminal))
    stamp = F.when(F.col(terminal), F.unix_timestamp(at))
    sums = windows.agg(F.count(F.lit(1)).alias("windows"), done.alias("terminal"), (F.max(stamp) - F.min(stamp)).alias("seconds"))
    eta = (F.col("windows") - F.col("terminal")) * F.col("seconds") / F.nullif(F.col("terminal"), F.lit(0))
    return sums.withColumn("eta_seconds", eta)


def throughput(events: DataFrame, at: str, remaining: float, size: str = "60 seconds", slide: str = "30 seconds") -> DataFrame:
    """(start, n, eta_seconds): rate over sliding windows and the time that the remaining rows would take at it."""
    counts = events.groupBy(F.window(at, size, slide)).agg(F.count(F.lit(1)).alias("n"))
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return counts.select(F.col("window.start").alias("start"), "n", (F.lit(float(remaining)) * seconds / F.col("n")).alias("eta_seconds"))


def retrieve(docs: DataFrame, query: str, id_: str, text: str, where: Column, threshold: float, most: int) -> DataFrame:
    """(id, score, band): filter first, exact match, then token overlap, combined, cut at the threshold, best first."""
    words = sorted({w for w in query.lower().split() if w})
    own = F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{Alnum}]+"))
    overlap = F.size(F.array_intersect(own, F.array(*map(F.lit, words)))) / F.lit(float(len(words)))
    exact = (F.lower(F.trim(text)) == query.lower()).cast("double")
    scored = docs.filter(where).select(id_, F.round(F.greatest(exact, 0.9 * overlap), 6).alias("score"))
    band = F.when(F.col("score") >= 0.9, "accept").when(F.col("score") >= 0.7, "review").otherwise("reject")
    return scored.filter(F.col("score") >= threshold).orderBy(F.desc("score"), id_).limit(most).withColumn("band", band)


PROFILE_SCHEMA = "page_id bigint, kind string, name string, telephone string, rating double, reviews bigint, accredited boolean, website string"


def profiles_from_pages(pages: DataFrame) -> DataFrame:
    """Business profiles of pages (page_id, html): JSON-LD trees flattened by type, ratings, and the first outside link.

    ``accredited`` is true or false only where the page says so. A page without any business gives no row.
    """
    import pandas as pd

    def nodes(tree):
        if isinstance(tree, list):
            for item in tree:
                yield from nodes(item)
        elif isinstance(tree, dict):
            yield tree
            for value in tree.values():
                yield from nodes(value)

    def profile(key: int, html: str):
        import json
        import re

        found = []
        for block in re.findall(r"<script[^>]*application/ld\+json[^>]*>(.*?)</script>", html, re.S | re.I):
            try:
                found += nodes(json.loads(block))
            except ValueError:
                continue
        business = next((n for n in found if "Business" in str(n.get("@type", "")) or n.get("@type") == "Organization"), None)
        if business is None:
            return None
        score = next((n for n in found if n.get("@type") == "AggregateRating"), {})
        number = lambda v: float(v) if re.fullmatch(r"\d+(\.\d+)?", str(v)) else None
        said = re.search(r"\b(not\s+)?accredited\b", re.sub(r"<[^>]*>", " ", html), re.I)
        links = re.findall(r"href=[\"'](https?://[^\"']+)", html)
        social = r"facebook|twitter|linkedin|instagram|youtube|x\.com"
        site = next((u for u in links if not re.search(social, u, re.I)), None)
        rating, reviews = number(score.get("ratingValue")), number(score.get("reviewCount"))
        accredited = None if said is None else said[1] is None
        kind = business["@type"] if isinstance(business["@type"], str) else "/".join(business["@type"])
        return key, kind, business.get("name"), business.get("telephone"), rating, reviews and int(reviews), accredited, site

    def run(batches):
        for pdf in batches:
            rows = [profile(k, h or "") for k, h in zip(pdf["page_id"], pdf["html"])]
            out = pd.DataFrame([r for r in rows if r], columns=[c.split()[0] for c in PROFILE_SCHEMA.split(", ")])
            yield out.astype({"reviews": "Int64", "accredited": "boolean"})

    return pages.select("page_id", "html").mapInPandas(run, PROFILE_SCHEMA)
