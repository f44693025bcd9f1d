"""A training corpus in five stages: quality rules, line dedup, near-dedup, mixing, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result, written as Parquet and read again, is the next one's
docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import materialise, table
from loamgrid.llm.line_dedup import dedupe_lines
from loamgrid.llm.mixing import mix_documents
from loamgrid.llm.packing import pack_documents
from loamgrid.llm.quality_rules import clean_rows
from loamgrid.llm.simhash import near_duplicates

#: A document that loses more than this share of its words to repeats of others is a copy and goes.
MAX_REPEATED_SHARE = 0.5
#: Differing bits at which texts count as near-duplicates here: more than in the operator's own query, as texts with a
#: word changed here and there should go too.
NEAR_RADIUS = 4


def _columns(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars told anew."""
    text = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return out.withColumns(text).select(docs.columns)


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs``, written with a number for each row that stays the same however often they are read."""
    return materialise(docs.withColumn(row, F.monotonically_increasing_id()), "stage-rows")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that failed.

    Each row is judged by its text alone, whatever its doc_id, also null or repeated. A null or empty text fails the
    base rules and goes; very long texts are judged whole; repeated rows stay or go together; an empty table stays
    empty; further columns stay as they are, n_chars being counted anew.
    """
    return _columns(docs, clean_rows(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated line windows; a document of mostly such lines goes.

    A row is a document of its own, its doc_id being null or repeated or not; null and empty texts, and texts of fewer
    than three lines, stay; of equal rows the first keeps its text; an empty table stays empty; further columns stay
    as they are, n_chars being counted anew.
    """
    out = dedupe_lines(docs)
    return _columns(docs, out.filter(F.col("n_removed_words") <= MAX_REPEATED_SHARE * F.col("n_words_before")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id.

    A row is a document of its own: rows without a doc_id come after all others, and of rows that share a doc_id and
    a group the one of the least text hash stays, of equal rows any one. Null and wordless texts are one group. An empty
    table stays empty; further columns stay as they are.
    """
    row = "__near_row"
    rows = _numbered(docs, row)
    groups = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), NEAR_RADIUS)
    order = F.struct(F.isnull("doc_id").alias("last"), "doc_id", F.xxhash64("text").alias("text"), F.col(row).alias("row"))
    ranked = rows.select(F.col(row).alias("n"), order.alias("o")).join(groups.select(F.col("doc_id").alias("n"), "component_id"), "n")
    first = ranked.groupBy("component_id").agg(F.min("o").alias("o")).select(F.col("o.row").alias(row))
    return rows.join(first, row, "left_semi").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, as often as it needs them.

    A row is a document of its own, its doc_id being null or repeated or not; a null source is a source; a document
    without words is never taken; an empty table stays empty; further columns stay as they are.
    """
    row, copies, copy = "__mix_row", "__mix_copies", "__mix_copy"
    rows = _numbered(docs, row)
    taken = mix_documents(rows, keep=(row,)).filter("taken > 0")
    times = taken.select(row, F.ceil(F.col("taken") / F.col("size")).cast("int").alias(copies))
    out = rows.join(times, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return out.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences.

    A row is a document of its own, its doc_id being null or repeated or not; a null or empty text is one piece, its
    closing id; very long texts are cut; an empty table gives no pieces; further columns are left behind.
    """
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Fingerprints (XXH64) and tokens have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, "stage-" + name.replace(" ", "-"))
    return docs
