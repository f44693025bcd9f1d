"""The queries of this subpackage, for the driver's entry: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import table
from loamgrid.llm.license_scan import scan_licenses
from loamgrid.llm.line_dedup import dedupe_lines
from loamgrid.llm.media import media_columns
from loamgrid.llm.mixing import mix_documents
from loamgrid.llm.packing import pack_documents
from loamgrid.llm.quality_rules import judge_documents
from loamgrid.llm.resampling import resample_documents
from loamgrid.llm.sharding import shard_documents
from loamgrid.llm.simhash import near_duplicates
from loamgrid.llm.sql import LINE_DEDUP_SQL, license_scan_sql, quality_rules_sql, url_filter_sql
from loamgrid.llm.url_filter import filter_urls


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op4_line_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        F.md5(kept.cast("binary")).alias("text_md5"),
        F.octet_length(kept).cast("bigint").alias("text_bytes"),
        "n_removed_lines",
    )


def op5_line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("clean_text")


def op6_license_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_bfd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"), 16)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_chunked_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))


def op9_sainte_lague_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_documents(table(spark, sf_dir, "documents"))
    some = "filter(transform(shard_taken, (n, j) -> if(n > 0, concat(j, ':', n), null)), x -> x is not null)"
    shards = F.array_join(F.expr(some), ",").alias("shards")
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", shards)


def op10_link_graph_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_simhash_bk_trees,
        op3_importance_resampling,
        op4_line_window_dedup,
        op5_line_first_cleaning,
        op6_license_sentence_rules,
        op7_bfd_sharding,
        op8_chunked_media,
        op9_sainte_lague_mixing,
        op10_link_graph_url_filter,
    )
}

#: Packing, fingerprints, sharding, chunks, apportionment and sampling have no SQL form: tests hold them
#: against brute force.
ORACLE_SQL = {
    "op4_line_window_dedup": LINE_DEDUP_SQL,
    "op5_line_first_cleaning": quality_rules_sql(),
    "op6_license_sentence_rules": license_scan_sql(),
    "op10_link_graph_url_filter": url_filter_sql(),
}
