"""Deduplication, merging, reconciliation, ranking, paging, scoring: operators over one or two tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamgrid.operators.joins import ConflictError
from loamgrid.operators.numbering import materialise, running_before


def dedupe_first(df: DataFrame, keys: list[str], ordinal: list[Column]) -> DataFrame:
    """The first row of each key by the declared ordinal."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordinal))
    return df.withColumn("_r", rank).filter("_r = 1").drop("_r")


def dedupe_rank(df: DataFrame, keys: list[str], ordinal: list[Column]) -> DataFrame:
    """The rows with their rank, from 1, among those of their key."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordinal)))


def conflicting_keys(df: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Keys whose rows differ in the payload; identical repeats are no conflict."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(*payload)).alias("variants")).filter("variants > 1")


def dedupe_or_raise(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows; a key with two different ones is an error."""
    rows = df.distinct()
    if not rows.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ConflictError(f"rows of one {keys} differ")
    return rows


def merge_duplicates(df: DataFrame, key: str, value: str, order: str, arrays: list[str]) -> DataFrame:
    """One row per key: the row of the highest value, arrays of all rows joined, and the number of sources."""
    top = F.max_by(F.struct(*[c for c in df.columns if c != key and c not in arrays]), F.struct(value, order)).alias("_top")
    lists = [F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(order, a))), lambda s: s[a])).alias(a) for a in arrays]
    return df.groupBy(key).agg(top, *lists, F.count(F.lit(1)).alias("n_sources")).select(key, "_top.*", *arrays, "n_sources")


def union_counts(parts: list[DataFrame], key: str) -> DataFrame:
    """One row: raw, distinct and duplicate keys of the parts together."""
    rows = parts[0].select(key)
    for part in parts[1:]:
        rows = rows.unionByName(part.select(key))
    raw, unique = F.count(F.lit(1)), F.count_distinct(key)
    return rows.agg(raw.alias("raw"), unique.alias("unique"), (raw - unique).alias("duplicate"))


def symmetric_gate(required: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, fault): missing, unexpected or duplicate keys."""
    want = required.select(key).distinct().withColumn("_w", F.lit(True))
    have = actual.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    fault = F.when(F.col("_n").isNull(), "missing").when(F.col("_w").isNull(), "unexpected").when(F.col("_n") > 1, "duplicate")
    return want.join(have, key, "full").select(key, fault.alias("fault")).filter("fault is not null")


def upsert(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new replace those of their keys; the rest stays."""
    return current.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def merge_keep(current: DataFrame, new: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Upsert on the natural key that leaves the columns ``keep`` of existing rows as they are; idempotent."""
    a, b = current.alias("a"), new.withColumn("_new", F.lit(True)).alias("b")
    out = a.join(b, keys, "full")
    columns = [
        F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)
        if c in keep
        else F.when(F.col("b._new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
        for c in current.columns
        if c not in keys
    ]
    return out.select(*keys, *columns).select(current.columns)


def content_diff(before: DataFrame, after: DataFrame, path: str, digest: str) -> DataFrame:
    """(path, change): new, changed, deleted or same, by content hash."""
    a = before.select(path, F.col(digest).alias("_a"))
    b = after.select(path, F.col(digest).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "deleted").when(F.col("_a") == F.col("_b"), "same")
    ).otherwise("changed")
    return a.join(b, path, "full").select(path, change.alias("change"))


def decide(cases: list[tuple[Column, str]], otherwise: str) -> Column:
    """The name of the first case that holds: selection and resume decisions."""
    out = F.lit(otherwise)
    for test, name in reversed(cases):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """A page in a total order, with the number of all rows on each row.

    The count is an aggregate of its own joined back, so that rows need not meet in one task before the limit.
    """
    total = df.agg(F.count(F.lit(1)).alias("total_count"))
    return df.orderBy(*order).offset(offset).limit(limit).crossJoin(F.broadcast(total))


def facets(df: DataFrame, by: str) -> DataFrame:
    """(by, n, total): counts in falling order, then by label."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.crossJoin(F.broadcast(total)).orderBy(F.desc("n"), F.asc_nulls_last(by))


def ilike_any(columns: list[str], text: str) -> Column:
    """Whether any of the columns contains the text in any case; % and _ keep their meaning, as in the sources."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.col(c).ilike(f"%{text}%"), F.lit(False))
    return out


def path_member(path: Column, segment: str) -> Column:
    """Whether a /-path has the segment, in any case."""
    return F.array_contains(F.split(F.lower(path), "/"), segment.lower())


def tri_state_filter(flag: Column, mode: str) -> Column:
    """include: all rows; exclude: none with a true flag, unknown ones stay; only: true flags."""
    return {"include": F.lit(True), "exclude": ~F.coalesce(flag, F.lit(False)), "only": F.coalesce(flag, F.lit(False))}[mode]


_FORBIDDEN = re.compile(r"(?i)\b(insert|update|delete|merge|drop|create|alter|truncate|grant|refresh|cache|set|use|load)\b")


def guarded_sql(spark: SparkSession, sql: str, limit: int = 100, most: int = 1000, **views: DataFrame) -> DataFrame:
    """Run one SELECT or WITH statement over the given views, at most ``most`` rows."""
    bare = re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S).strip().rstrip(";")
    if ";" in bare or not re.match(r"(?i)(select|with)\b", bare) or _FORBIDDEN.search(bare):
        raise ValueError("one SELECT statement only")
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql.strip().rstrip(";")).limit(min(limit, most))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, populated, ratio) for each column, from one pass."""
    n = F.count(F.lit(1))
    made = [F.struct(F.lit(c).alias("column"), F.count(c).alias("populated"), (F.count(c) / n).alias("ratio")) for c in columns]
    return df.agg(F.array(*made).alias("x")).select(F.inline("x"))


def weighted(*terms: tuple[float, Column]) -> Column:
    """The sum of weight times value."""
    out = F.lit(0.0)
    for weight, value in terms:
        out = out + F.lit(float(weight)) * value.cast("double")
    return out


def window_center_bonus(hour: Column, start: Column, end: Column) -> Column:
    """1 at the centre of a window in minutes, falling to 0 at half its width; windows may cross midnight."""
    width = F.when(start < end, end - start).otherwise(1440 - start + end)
    centre = F.pmod(start + width / 2, F.lit(1440.0))
    apart = F.abs(hour * 60 + 30 - centre)
    ring = F.least(apart, 1440 - apart)
    return F.greatest(F.lit(0.0), 1 - ring / F.greatest(width / 2, F.lit(1.0)))


def recent_contact_penalty(calls: Column, texts: Column, emails: Column, letters: Column) -> Column:
    """Fixed weights of contacts within the window."""
    return weighted((2.0, calls), (0.5, texts), (0.25, emails), (0.1, letters))


def capacity_assignment(candidates: DataFrame, item: str, slot: str, score: str, capacity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(selected, overflow): each item's best slot, then the best ``capacity`` items of each slot.

    A greedy approximation of a minimum-cost flow, by two ranks; ``capacity`` is (slot, cap). Overflow has a reason.
    Places in a slot's queue come from a range partitioning and counts per partition, so a slot with a third of all
    items is ranked by many tasks. Slots must not be null.
    """
    best = Window.partitionBy(item).orderBy(F.desc(score), F.asc(slot))
    own = candidates.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")
    order = [F.desc(score), F.asc(item)]
    queued = materialise(own.repartitionByRange(F.col(slot), *order), "capacity-queue", with_pid=True)
    placed = running_before(queued, [slot], order, F.lit(1).cast("bigint"), "place").withColumn("place", F.col("place") + 1)
    ranked = placed.drop("pid").join(capacity, slot, "left")
    fits = F.col("place") <= F.coalesce("cap", F.lit(0))
    return ranked.filter(fits).drop("cap"), ranked.filter(~fits).drop("cap").withColumn("reason", F.lit("capacity"))


def nearest_rank(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """(group, a column per share): the least value that at least that share of the group's non-null values don't exceed.

    Values are counted first; their running counts come from a range partitioning, so no task holds a group's values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    held = materialise(counts.repartitionByRange(group, value), "rank-counts", with_pid=True)
    before = running_before(held, [group], [F.col(value)], F.col("_n"), "_before")
    totals = held.groupBy(group).agg(F.sum("_n").alias("_all"))
    rows = before.join(totals, group)
    at = lambda p: F.greatest(F.ceil(F.col("_all") * p), F.lit(1))
    pick = lambda p: F.max(F.when((F.col("_before") < at(p)) & (at(p) <= F.col("_before") + F.col("_n")), F.col(value)))
    return rows.groupBy(group).agg(*[pick(p).alias(name) for name, p in shares.items()])


def min_cost_assignment(costs: list[list[float]], capacity: list[int], overflow_cost: float) -> list[int | None]:
    """The slot of each item at the least total cost, or None for overflow: successive shortest paths on the driver.

    For the bounded batches that a solver gets after a top-n; not for tables.
    """
    n, m = len(costs), len(capacity)
    slot_of: list[int | None] = [None] * n
    load = [0] * m
    for start in range(n):
        dist = [costs[start][s] for s in range(m)]
        came: list[int | None] = [None] * m  # the slot whose item moves on to this one
        mover: list[int | None] = [start] * m
        changed = True
        while changed:
            changed = False
            for item, s in enumerate(slot_of):
                if s is None:
                    continue
                for t in range(m):
                    through = dist[s] - costs[item][s] + costs[item][t]
                    if t != s and through < dist[t] - 1e-12:
                        dist[t], came[t], mover[t], changed = through, s, item, True
        free = [s for s in range(m) if load[s] < capacity[s]]
        evict = [(dist[s] - costs[i][s] + overflow_cost, s, i) for i, s in enumerate(slot_of) if s is not None]
        options = [(dist[s], s, None) for s in free] + evict + [(overflow_cost, None, None)]
        cost, s, out = min(options, key=lambda x: x[0])
        if s is None:
            continue
        if out is not None:
            slot_of[out] = None
        else:
            load[s] += 1
        while s is not None:
            item, previous = mover[s], came[s]
            slot_of[item] = s
            s = previous
    return slot_of


@dataclass(frozen=True)
class Rule:
    """A named predicate: over an entity, or over each of its children where ``scope`` is ``child``."""

    name: str
    scope: str
    predicate: str
    columns: tuple[str, ...] = field(default=())


_LITERAL = re.compile(r"'(?:[^']|'')*'|\"[^\"]*\"")
#: Words of a predicate that are no columns.
_PREDICATE_WORDS = frozenset(
    "and or not is null true false in between like ilike rlike case when then else end interval day days hour hours distinct from escape".split()
)


def predicate_columns(predicate: str) -> set[str]:
    """The columns that an SQL predicate names: words outside literals that are neither functions nor operators."""
    bare = _LITERAL.sub(" ", predicate)
    quoted = set(re.findall(r"`([^`]+)`", bare))
    words = re.findall(r"(?<![\w.])([A-Za-z_]\w*)(?:\.\w+)*(?!\w)(?!\s*\()", re.sub(r"`[^`]+`", " ", bare))
    return quoted | {w for w in words if w.lower() not in _PREDICATE_WORDS}


def compile_rules(rules: list[Rule], entity: set[str], child: set[str]) -> list[tuple[Rule, Column]]:
    """SQL predicates as columns; a rule whose text or list names a column outside its scope fails closed, here."""
    out = []
    for rule in rules:
        allowed = {"entity": entity, "child": child}.get(rule.scope)
        if allowed is None or not set(rule.columns) | predicate_columns(rule.predicate) <= allowed:
            raise ConflictError(f"rule {rule.name} does not fit the scope {rule.scope}")
        out.append((rule, F.coalesce(F.expr(rule.predicate), F.lit(False))))
    return out


def evaluate_rules(entities: DataFrame, children: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """(key, passed, failed): an entity passes if its own rules hold and one child at least holds all child rules.

    An entity rule counts as failed once; a child rule only if every child fails it. ``failed`` is sorted.
    """
    compiled = compile_rules(rules, set(entities.columns), set(children.columns))
    own = [(r, c) for r, c in compiled if r.scope == "entity"]
    per = [(r, c) for r, c in compiled if r.scope == "child"]
    good = F.lit(True)
    for _, c in per:
        good = good & c
    sums = [F.bool_or(c).alias(f"_any_{i}") for i, (_, c) in enumerate(per)]
    kids = children.groupBy(key).agg(F.bool_or(good).alias("_child_ok"), *sums)
    joined = entities.join(kids, key, "left")
    failed = [F.when(~c, F.lit(r.name)) for r, c in own]
    failed += [F.when(~F.coalesce(F.col(f"_any_{i}"), F.lit(False)), F.lit(r.name)) for i, (r, _) in enumerate(per)]
    fine = F.coalesce("_child_ok", F.lit(not per))
    for _, c in own:
        fine = fine & c
    return joined.select(key, fine.alias("passed"), F.array_sort(F.array_compact(F.array(*failed))).alias("failed"))


def map_paths(source: Column, operations: list[tuple[str, str, str | None]]) -> Column:
    """A JSON object from operations (source path, target path, default) on a JSON text.

    A default stands in only where the path is missing; a null that is there stays null. Target paths nest by dots.
    """
    tree: dict = {}
    for path, target, default in operations:
        parts = [p.replace("'", "") for p in path.split(".")]
        jpath = "$" + "".join(f".{p}" for p in parts)
        parent = "$" + "".join(f".{p}" for p in parts[:-1])
        value = F.get_json_object(source, jpath)
        keys = F.json_object_keys(F.get_json_object(source, parent) if len(parts) > 1 else source)
        there = F.coalesce(F.array_contains(keys, parts[-1]), F.lit(False))
        node = tree
        *outer, last = target.split(".")
        for p in outer:
            node = node.setdefault(p, {})
        node[last] = F.when(~there, F.lit(default)).otherwise(value)

    def build(node) -> Column:
        if isinstance(node, dict):
            return F.struct(*[build(v).alias(k) for k, v in node.items()])
        return node

    return F.to_json(build(tree), {"ignoreNullFields": "false"})


def mapping_coverage(required: Column, mapped: Column, present: Column) -> Column:
    """struct(ratio, missing, ignored): required paths that are mapped, those that lack, and present ones left out."""
    missing = F.array_sort(F.array_except(required, mapped))
    ratio = F.size(F.array_intersect(required, mapped)) / F.nullif(F.size(required), F.lit(0))
    return F.struct(ratio.alias("ratio"), missing.alias("missing"), F.array_sort(F.array_except(present, mapped)).alias("ignored"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def cosine_top_k(vectors: DataFrame, query: list[float], k: int, where: Column | None = None, id_: str = "vec_id") -> DataFrame:
    """The k nearest vectors by cosine; filters apply before ranking."""
    rows = vectors if where is None else vectors.filter(where)
    scored = rows.withColumn("score", F.round(cosine(F.col("embedding"), F.array(*map(F.lit, map(float, query)))), 6))
    return scored.orderBy(F.desc("score"), F.asc(id_)).limit(k)


def hybrid_score(text: Column, query: str) -> Column:
    """Exact, token-overlap and edit-distance signals of a text against a query, weighted .4, .4, .2."""
    words = lambda c: F.filter(F.split(F.lower(c), "[^\\p{Alnum}]+"), lambda w: w != "")
    q = F.lit(query.lower())
    overlap = F.size(F.array_intersect(words(text), words(q))) / F.greatest(F.size(F.array_distinct(words(q))), F.lit(1))
    near = 1 - F.levenshtein(F.lower(text), q) / F.greatest(F.length(text), F.length(q), F.lit(1))
    return weighted((0.4, (F.lower(text) == q).cast("double")), (0.4, overlap), (0.2, near))


def confidence_band(score: Column, accept: float = 0.90, review: float = 0.70) -> Column:
    return F.when(score >= accept, "accept").when(score >= review, "review").otherwise("reject")


def chunk_text(docs: DataFrame, size: int, id_: str = "doc_id") -> DataFrame:
    """(id, chunk, chunk_id, content): texts in pieces of ``size`` characters with ids from source, place and content."""
    n = F.greatest(F.ceil(F.length("text") / size).cast("int"), F.lit(1))
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(F.col("text"), i * size + 1, F.lit(size)))
    rows = docs.select(F.col(id_), F.md5("text").alias("_h"), F.posexplode(pieces).alias("chunk", "content"))
    cid = F.sha2(F.concat_ws(":", F.col(id_).cast("string"), F.col("chunk").cast("string"), "_h"), 256)
    return rows.select(id_, "chunk", cid.alias("chunk_id"), "content")


def graph_faults(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, fault): edge ends without a vertex, repeated ids, vertices without an edge; (null, empty_graph) without any vertex."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    missing = ends.join(vertices.select("id").distinct(), "id", "left_anti").select("id", F.lit("missing_vertex").alias("fault"))
    alone = vertices.select("id").distinct().join(ends, "id", "left_anti").select("id", F.lit("isolated").alias("fault"))
    twice = vertices.groupBy("id").count().filter("count > 1").select("id", F.lit("duplicate").alias("fault"))
    none = vertices.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(None).cast("string").alias("id"), F.lit("empty_graph").alias("fault"))
    return reduce(DataFrame.unionByName, (missing, alone, twice, none.select(F.col("id").cast(missing.schema["id"].dataType), "fault")))


def endpoint_faults(edges: DataFrame, vertices: DataFrame, allowed: DataFrame) -> DataFrame:
    """(label, src, dst, fault) of edges whose ends' labels the lexicon (label, src_label, dst_label) does not allow.

    An edge label that the lexicon lacks is ``unknown_label``; ends without a vertex are left to ``graph_faults``.
    """
    end = lambda name: vertices.select(F.col("id").alias(name), F.col("label").alias(f"{name}_label"))
    labelled = edges.join(end("src"), "src").join(end("dst"), "dst")
    known = allowed.select("label").distinct().withColumn("_known", F.lit(True))
    fits = allowed.select("label", "src_label", "dst_label").distinct().withColumn("_fits", F.lit(True))
    checked = labelled.join(known, "label", "left").join(fits, ["label", "src_label", "dst_label"], "left")
    fault = F.when(F.col("_known").isNull(), "unknown_label").when(F.col("_fits").isNull(), "endpoint_labels")
    return checked.select("label", "src", "dst", fault.alias("fault")).filter("fault is not null")


#: Weights of the signals of ``hybrid_signals``.
SIGNAL_WEIGHTS = {
    "exact": 0.25, "normal": 0.15, "overlap": 0.15, "near": 0.1, "acronym": 0.05, "vector": 0.15, "metadata": 0.1, "recency": 0.05,
}


def hybrid_signals(text: Column, query: str, vector: Column, metadata: Column, age_days: Column, half_life: float = 90.0) -> dict[str, Column]:
    """The signals in [0, 1] of a text against a query: exact and normalised match, token overlap, edit distance, the
    query as the text's initials, vector similarity, metadata match, and recency that halves every ``half_life`` days.

    A null signal counts 0. Combine them with ``SIGNAL_WEIGHTS``.
    """
    squeezed = lambda c: F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    plain = re.sub(r"[^a-z0-9]+", " ", query.lower()).strip()
    asked = sorted(set(plain.split()))
    own = F.split(squeezed(text), " ")
    initials = F.array_join(F.transform(own, lambda w: F.substring(w, 1, 1)), "")
    number = lambda test: F.coalesce(test, F.lit(False)).cast("double")
    near = 1 - F.levenshtein(squeezed(text), F.lit(plain)) / F.greatest(F.length(squeezed(text)), F.lit(len(plain)), F.lit(1))
    none = lambda c: F.coalesce(c, F.lit(0.0))
    return {
        "exact": number(text == query),
        "normal": number(squeezed(text) == plain),
        "overlap": none(F.size(F.array_intersect(own, F.array(*map(F.lit, asked)))) / F.lit(float(max(1, len(asked))))),
        "near": none(near),
        "acronym": number(initials == plain.replace(" ", "")),
        "vector": none(F.greatest(vector, F.lit(0.0))),
        "metadata": number(metadata),
        "recency": none(F.pow(F.lit(0.5), F.greatest(age_days, F.lit(0)) / half_life)),
    }


def hybrid_rank(rows: DataFrame, signals: dict[str, Column], id_: str, most: int, weights: dict[str, float] = SIGNAL_WEIGHTS) -> DataFrame:
    """(id, score, band): signals combined by weight, best first, ties by id."""
    score = F.round(weighted(*[(weights[k], c) for k, c in signals.items()]), 6)
    scored = rows.select(id_, score.alias("score"))
    return scored.withColumn("band", confidence_band(F.col("score"))).orderBy(F.desc("score"), id_).limit(most)


def top_k_recall(ranked: DataFrame, relevant: DataFrame, by: list[str], k: int) -> DataFrame:
    """One row: the share of relevant rows that are among the first ``k`` of their query; ``ranked`` has rank from 1."""
    hits = relevant.join(ranked.filter(F.col("rank") <= k).select(*by).withColumn("_hit", F.lit(True)), by, "left")
    return hits.agg((F.count("_hit") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("recall"))


def recent_contacts(contacts: DataFrame, key: str, kind: str, at: str, now: str, days: int = 14) -> DataFrame:
    """(key, penalty): the contact penalty of calls, texts, emails and letters in the ``days`` days up to ``now``."""
    end = F.lit(now).cast(contacts.schema[at].dataType)
    kept = contacts.filter((F.col(at) > end - F.expr(f"INTERVAL '{days}' DAY")) & (F.col(at) <= end))
    n = lambda k: F.count_if(F.col(kind) == k)
    return kept.groupBy(key).agg(recent_contact_penalty(n("call"), n("text"), n("email"), n("letter")).alias("penalty"))


def discrepancy_gate(rows: DataFrame, measured: str, stated: str, most_percent: float, explanation: str, approved: str) -> DataFrame:
    """Rows with their discrepancy in percent of the stated value and a verdict.

    Within the limit PASS; beyond it EXPLAINED with an explanation, EXCEPTION with an approved exception, else BLOCKED; no
    stated value to compare with is BLOCKED too.
    """
    percent = F.abs(F.col(measured) - F.col(stated)) * 100 / F.nullif(F.col(stated).cast("double"), F.lit(0.0))
    told = F.length(F.trim(F.coalesce(F.col(explanation), F.lit("")))) > 0
    verdict = (
        F.when(F.col("percent") <= most_percent, "PASS")
        .when(F.coalesce(F.col(approved), F.lit(False)), "EXCEPTION")
        .when(F.col("percent").isNotNull() & told, "EXPLAINED")
        .otherwise("BLOCKED")
    )
    return rows.withColumn("percent", percent).withColumn("verdict", verdict)


def assignment_summary(read: DataFrame, selected: DataFrame, overflow: DataFrame) -> DataFrame:
    """(measure, n): inputs read, actions selected, and what was left over by reason."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("measure"), "n")
    left = overflow.groupBy(F.concat(F.lit("dropped: "), "reason").alias("measure")).agg(F.count(F.lit(1)).alias("n"))
    return count(read, "inputs read").unionByName(count(selected, "actions selected")).unionByName(left)
