"""Enrichment joins: the left side keeps its rows, keys decide only where they are unique, unknown stays unknown."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamgrid.functions.text import jaro_winkler, jaro_winkler_bound


class ConflictError(ValueError):
    """Data that an operator refuses to choose between."""


def require_columns(df: DataFrame, **types: str) -> None:
    """The columns must exist with these types, as ``simpleString`` gives them."""
    have = dict(df.dtypes)
    wrong = {c: have.get(c) for c, t in types.items() if have.get(c) != t}
    if wrong:
        raise ConflictError(f"columns lack or differ: {wrong}")


def unique_keys(df: DataFrame, key: str, id_: str) -> DataFrame:
    """(key, id) of the non-null keys that name exactly one id."""
    named = df.filter(F.col(key).isNotNull()).groupBy(key)
    return named.agg(F.min(id_).alias(id_), F.max(id_).alias("_max")).filter(F.col(id_) == F.col("_max")).drop("_max")


def unique_key_join(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> DataFrame:
    """(left_id, key, right ids): right rows of keys that exactly one left row has; all their ids, sorted."""
    once = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(left_id).alias(left_id), F.count(F.lit(1)).alias("_n"))
    grouped = right.groupBy(key).agg(F.sort_array(F.collect_set(right_id)).alias("ids"))
    return once.filter("_n = 1").drop("_n").join(grouped, key)


def flag_join(left: DataFrame, right: DataFrame, on: str, flag: str) -> DataFrame:
    """Left rows with a boolean: whether the right side has their key."""
    keys = right.select(on).distinct().withColumn("_hit", F.lit(True))
    return left.join(keys, on, "left").withColumn(flag, F.col("_hit").isNotNull()).drop("_hit")


def count_join(left: DataFrame, right: DataFrame, on: str, count: str, flag: str) -> DataFrame:
    """Left rows with the number of right rows of their key, 0 by default, and whether there is any."""
    counts = right.groupBy(on).agg(F.count(F.lit(1)).alias(count))
    out = left.join(counts, on, "left").withColumn(count, F.coalesce(count, F.lit(0)))
    return out.withColumn(flag, F.col(count) > 0)


def latest_rows(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in the given total order."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_conflicts(df: DataFrame, key: str, at: str, payload: list[str]) -> DataFrame:
    """Keys whose latest date carries rows that differ in the payload."""
    body = F.struct(F.col(at).alias("at"), F.struct(*payload).alias("p"))
    latest = df.groupBy(key).agg(F.max(at).alias("_at"))
    tied = df.join(latest, key).filter(F.col(at) == F.col("_at"))
    return tied.groupBy(key).agg(F.count_distinct(body).alias("variants")).filter("variants > 1")


def latest_join(left: DataFrame, right: DataFrame, on: str, at: str, payload: list[str], check: bool = True) -> DataFrame:
    """Left rows with the payload of their latest right row; tied rows that differ are an error, or without ``check`` the
    greatest payload counts."""
    if check and not latest_conflicts(right, on, at, payload).isEmpty():
        raise ConflictError(f"rows of one {on} tie on {at} and differ")
    top = right.groupBy(on).agg(F.max(F.struct(F.col(at).alias("_at"), F.struct(*payload).alias("p")))["p"].alias("_top"), F.max(at).alias(at))
    return left.join(top, on, "left").select(left["*"], at, "_top.*")


def tri_state_join(left: DataFrame, members: DataFrame, on: str, active: Column, authoritative: Column, flag: str) -> DataFrame:
    """True if any record is active, false only on an authoritative negative, else null."""
    state = members.groupBy(on).agg(F.bool_or(active).alias("_yes"), F.bool_or(authoritative & ~active).alias("_no"))
    verdict = F.when(F.col("_yes"), True).when(F.col("_no"), False)
    return left.join(state, on, "left").withColumn(flag, verdict).drop("_yes", "_no")


def cascade_match(left: DataFrame, left_id: str, right: DataFrame, right_id: str, passes: list[tuple[str, str, float]]) -> DataFrame:
    """(left_id, match, method, confidence): the first pass (key, method, confidence) with a unique hit decides.

    Each pass is an equi-join with the keys that name one id on the right; keys are null where they lack.
    """
    out = left
    for i, (key, _, _) in enumerate(passes):
        out = out.join(unique_keys(right, key, right_id).withColumnRenamed(right_id, f"_m{i}"), key, "left")
    hits = [F.col(f"_m{i}") for i in range(len(passes))]
    chain = lambda values: reduce(lambda rest, hv: F.when(hv[0].isNotNull(), hv[1]).otherwise(rest), list(zip(hits, values))[::-1], F.lit(None))
    method = chain([F.lit(m) for _, m, _ in passes])
    confidence = chain([F.lit(c) for *_, c in passes])
    return out.select(left_id, F.coalesce(*hits).alias("match"), method.alias("method"), confidence.alias("confidence"))


def fuzzy_candidates(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, name: str, block: Column,
    threshold: float = 0.9, margin: float = 0.05,
) -> DataFrame:
    """The best and next candidate of each left row by Jaro-Winkler, for review; a close next one makes it ambiguous.

    Only rows of one block are compared. Distinct names of a block are compared once and joined back within it; pairs
    whose lengths and first letters alone keep them below the threshold never reach the Python function.
    """
    names = lambda df: df.select(name, block.alias("_b")).filter(F.col(name) != "").distinct()
    pairs = names(left).join(names(right).withColumnRenamed(name, "_other"), "_b").repartition("_b", name)
    scored = pairs.filter(jaro_winkler_bound(F.col(name), F.col("_other")) >= threshold - 1e-9)
    scored = scored.withColumn("score", jaro_winkler(name, "_other")).filter(F.col("score") >= threshold)
    ids = right.select(block.alias("_b"), F.col(name).alias("_other"), F.col(right_id).alias("candidate"))
    both = left.select(left_id, name, block.alias("_b")).join(scored, ["_b", name]).join(ids, ["_b", "_other"])
    best = both.groupBy(left_id, "candidate").agg(F.max("score").alias("score"))
    order = Window.partitionBy(left_id).orderBy(F.desc("score"), F.asc("candidate"))
    ranked = best.withColumn("_r", F.row_number().over(order)).withColumn("next_score", F.lead("score").over(order))
    close = F.col("score") - F.col("next_score") < margin
    status = F.when(close, "ambiguous").otherwise("review")
    return ranked.filter("_r = 1").select(left_id, "candidate", "score", "next_score", status.alias("status"))


def fill_null_link(rows: DataFrame, links: DataFrame, on: str, column: str) -> DataFrame:
    """Set ``column`` from ``links`` (on, new) only where it is null; a key with several links is an error."""
    several = F.raise_error(F.concat(F.lit(f"several links for {on} "), F.col(on).cast("string")))
    one = links.groupBy(on).agg(F.min("new").alias("new"), F.max("new").alias("_max"))
    links = one.select(on, F.when(F.col("_max").isNull() | (F.col("new") == F.col("_max")), F.col("new")).otherwise(several).alias("new"))
    return rows.join(links, on, "left").withColumn(column, F.coalesce(column, "new")).drop("new")


def contact_rollup(contacts: DataFrame, parent: str, link: str) -> DataFrame:
    """(parent, link): parents whose contacts are all linked, and to one id."""
    sums = contacts.groupBy(parent).agg(
        F.count(F.lit(1)).alias("_n"), F.count(link).alias("_linked"), F.min(link).alias(link), F.max(link).alias("_max")
    )
    return sums.filter((F.col("_n") == F.col("_linked")) & (F.col(link) == F.col("_max"))).select(parent, link)


def two_pass_match(left: DataFrame, right: DataFrame, first: str, second: str, right_id: str) -> DataFrame:
    """Left rows with the right id of their unique first key, else of their unique second key, else null."""
    one = unique_keys(right, first, right_id).withColumnRenamed(right_id, "_1")
    two = unique_keys(right, second, right_id).withColumnRenamed(right_id, "_2")
    out = left.join(one, first, "left").join(two, second, "left")
    return out.withColumn(right_id, F.coalesce("_1", "_2")).drop("_1", "_2")


def not_selected(all_rows: DataFrame, selected: DataFrame, on: str, reason: str) -> DataFrame:
    """The rows left over, with a reason."""
    return all_rows.join(selected.select(on).distinct(), on, "left_anti").withColumn("reason", F.lit(reason))


def reference_check(refs: DataFrame, targets: DataFrame, id_: str, label: str) -> DataFrame:
    """References with the fault they have: ``missing``, ``label_mismatch``, or null."""
    found = targets.select(F.col(id_), F.col(label).alias("_label"), F.lit(True).alias("_hit"))
    fault = F.when(F.col("_hit").isNull(), "missing").when(F.col("_label") != F.col(label), "label_mismatch")
    return refs.join(found, id_, "left").withColumn("fault", fault).drop("_label", "_hit")


def bundle(parent: DataFrame, key: str, **children: tuple[DataFrame, list[str]]) -> DataFrame:
    """Parents with an array of structs for each child table (rows, fields), sorted by the fields in order."""
    out = parent
    for name, (rows, fields) in children.items():
        packed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
        out = out.join(packed, key, "left")
    return out
