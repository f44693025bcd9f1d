"""Sources: scans as DataFrames, with explicit schemas and the missing-value rules of each format."""

from __future__ import annotations

import io
import json
import zipfile
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Field, first column (from 1) and length of a registry line; one officer's columns follow six times.
REGISTRY_FIELDS = (
    ("documentNumber", 1, 12),
    ("entityName", 13, 192),
    ("statusCode", 205, 1),
    ("filingTypeCode", 206, 15),
    ("address1", 221, 42),
    ("address2", 263, 42),
    ("city", 305, 28),
    ("state", 333, 2),
    ("zip", 335, 10),
    ("country", 345, 2),
    ("mailAddress1", 347, 42),
    ("mailAddress2", 389, 42),
    ("mailCity", 431, 28),
    ("mailState", 459, 2),
    ("mailZip", 461, 10),
    ("mailCountry", 471, 2),
    ("filedDate", 473, 8),
    ("feiNumber", 481, 14),
    ("moreThanSixOfficersFlag", 495, 1),
    ("lastTransactionDate", 496, 8),
    ("stateCountry", 504, 2),
    ("reportYear1", 506, 4),
    ("reportDate1", 511, 8),
    ("reportYear2", 519, 4),
    ("reportDate2", 524, 8),
    ("reportYear3", 532, 4),
    ("reportDate3", 537, 8),
    ("registeredAgentName", 545, 42),
    ("registeredAgentType", 587, 1),
    ("registeredAgentAddress", 588, 42),
    ("registeredAgentCity", 630, 28),
    ("registeredAgentState", 658, 2),
    ("registeredAgentZip", 660, 9),
)
#: Offset of each officer group, and field, place within the group and length.
OFFICER_STARTS = (669, 797, 925, 1053, 1181, 1309)
OFFICER_FIELDS = (
    ("title", 0, 4),
    ("type", 4, 1),
    ("name", 5, 42),
    ("address", 47, 42),
    ("city", 89, 28),
    ("state", 117, 2),
    ("zip", 119, 9),
)


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_parquet_hive(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """Files under a glob with the partition columns of their folders."""
    return spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/{glob}")


def scan_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Quoted cells with doubled quotes; blank rows go; a missing cell is the empty string, as all cells are text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).options(header=True, multiLine=True, escape='"', quote='"', mode="PERMISSIVE")
    raw = reader.option("ignoreLeadingWhiteSpace", False).option("enforceSchema", True).csv(path)
    filled = raw.select(*[F.regexp_replace(F.coalesce(c, F.lit("")), "\r", "").alias(c) for c in columns])
    return filled.filter(F.concat(*columns) != "")


def scan_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON object a line, gzip by suffix; blank lines go."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def scan_features(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """GeoJSON-like lines: an envelope's features one by one, a lone feature as it is."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    many = F.from_json("value", f"features array<{schema}>")["features"]
    rows = F.coalesce(many, F.array(F.from_json("value", schema)))
    return lines.select(F.explode_outer(rows).alias("f")).filter("f is not null").select("f.*")


def parse_fixed_width(lines: DataFrame, column: str = "value") -> DataFrame:
    """Registry lines as 33 text columns and an array of named officers; lines without a key go."""
    line = F.col(column)
    cut = lambda at, n: F.nullif(F.trim(F.substring(line, at, n)), F.lit(""))
    fields = [cut(at, n).alias(name) for name, at, n in REGISTRY_FIELDS]
    officers = F.array(*[F.struct(*[cut(s + at, n).alias(f) for f, at, n in OFFICER_FIELDS]) for s in OFFICER_STARTS])
    named = F.filter(officers, lambda o: o["name"].isNotNull())
    return lines.select(*fields, named.alias("officers")).filter("documentNumber is not null")


def format_fixed_width(rows: DataFrame, fields: dict[str, str], officers: tuple[dict[str, str], ...] = ()) -> DataFrame:
    """A registry line from columns by field name, for round trips; other fields are blank.

    ``officers`` has the columns of each officer by officer field, six at most.
    """
    out, at = [], 1
    places = [(name, start, n, fields) for name, start, n in REGISTRY_FIELDS]
    for first, own in zip(OFFICER_STARTS, officers):
        places += [(name, first + start, n, own) for name, start, n in OFFICER_FIELDS]
    for name, start, n, given in places:
        if start > at:
            out.append(F.lit(" " * (start - at)))
        value = F.coalesce(F.col(given[name]).cast("string"), F.lit("")) if name in given else F.lit("")
        out.append(F.rpad(value, n, " "))
        at = start + n
    return rows.select(F.concat(*out).alias("value"))


def scan_fixed_width(spark: SparkSession, path: str) -> DataFrame:
    return parse_fixed_width(spark.read.text(path))


def scan_zip_json(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, json) of each JSON object data/*.json in zip archives; see ``zip_json``."""
    return zip_json(spark.read.format("binaryFile").load(path).select("path", "content"))


def zip_json(files: DataFrame) -> DataFrame:
    """(archive, name, json) from archives (path, content): JSON objects below data/, relationship files and content ids
    left out, either slash parting folders."""

    def run(batches):
        for pdf in batches:
            out = []
            for archive, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(z.namelist()):
                        place = name.replace("\\", "/")
                        leaf = place.rsplit("/", 1)[-1]
                        if place.startswith("data/") and leaf.endswith(".json") and not leaf.startswith(("relationship_", "bafk")):
                            found = json.loads(z.read(name))
                            if isinstance(found, dict):
                                out.append((archive, leaf, json.dumps(found)))
            yield pd.DataFrame(out, columns=["archive", "name", "json"])

    return files.mapInPandas(run, "archive string, name string, json string")


class _Labels(HTMLParser):
    """Text by element id, links and table rows of a page."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.ids: dict[str, list[str]] = {}
        self.open: list[tuple[str, str | None]] = []
        self.links: list[str] = []
        self.rows: list[list[str]] = []
        self.title = ""

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        if tag == "a" and found.get("href"):
            self.links.append(found["href"])
        if tag == "tr":
            self.rows.append([])
        if tag in ("td", "th") and self.rows:
            self.rows[-1].append("")
        if tag not in self.VOID:
            self.open.append((tag, found.get("id")))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        tags = [t for t, _ in self.open]
        if "script" in tags or "style" in tags:
            return
        for _, id_ in self.open:
            if id_:
                self.ids.setdefault(id_, []).append(data)
        if "title" in tags:
            self.title += data
        if self.rows and self.rows[-1] and ("td" in tags or "th" in tags):
            self.rows[-1][-1] += data


HTML_SCHEMA = "page_id bigint, title string, ids map<string,string>, links array<string>, table_rows array<array<string>>"


def scan_html(pages: DataFrame) -> DataFrame:
    """Labelled texts, links and table rows of page sources (page_id, html)."""

    def run(batches):
        clean = lambda s: " ".join(s.split())
        for pdf in batches:
            out = []
            for key, html in zip(pdf["page_id"], pdf["html"]):
                p = _Labels()
                p.feed(html or "")
                ids = {k: clean(" ".join(v)) for k, v in p.ids.items()}
                out.append((key, clean(p.title), ids, p.links, [[clean(c) for c in r] for r in p.rows if r]))
            yield pd.DataFrame(out, columns=["page_id", "title", "ids", "links", "table_rows"])

    return pages.select("page_id", "html").mapInPandas(run, HTML_SCHEMA)
