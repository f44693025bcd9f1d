"""Mixing sources to target weights by Sainte-Laguë apportionment.

Tokens are allocated to sources by highest quotients, all but the last of them at once; the awards, dealt in turn
to the shards, give each shard an integer quota of each source. A source's tokens, along a seeded order of its
documents, are cut into equal blocks, and the blocks, in a seeded order of their own, fill the shards' quotas one after
the other.
"""

from __future__ import annotations

import heapq
import math
import random
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import discard, materialise, running_before

#: Seats that are awarded one by one at most, besides about one for each source; those before come in closed form.
MAX_BLOCKS = 1 << 16
#: Sources whose table is sent to all tasks; with more it is joined by a shuffle.
MOST_BROADCAST = 50_000
#: Sources that the driver plans for at most, a row each; a table with more is refused.
MOST_SOURCES = 2_000_000
#: Words of a block.
BLOCK_WORDS = 1024


@dataclass(frozen=True)
class Plan:
    """block: tokens of a seat, always 1; sources: (name, size, target, seats, seats of each shard)."""

    block: int
    sources: list[tuple[str | None, int, float, int, list[int]]]


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of total by weight, none above ``most`` times its size; what is cut is shared again by weight."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = most * float(sizes[i])
            left -= out[i]
            free.discard(i)
    return out


def first_seats(goals: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats of each party after some number of awards, ``seats`` at most, in closed form.

    All seats of a quotient goal / (k + 1/2) of a divisor or more are the first ones to be awarded; a divisor that
    shares out half a seat a party less than ``seats`` can't round up to more than these.
    """
    share = seats - len(goals) / 2
    if share <= 0 or not sum(goals):
        return [0] * len(goals)
    divisor = sum(goals) / share
    out = [min(m, math.floor(g / divisor + 0.5)) for g, m in zip(goals, most)]
    return out if sum(out) <= seats else [max(0, n - 1) for n in out]


def sainte_lague(goals: list[float], seats: int, most: list[int], so_far: list[int] | None = None) -> list[int]:
    """The party that gets each seat, in order: highest goal / (2 * seats so far + 1), none beyond its most."""
    held = so_far or [0] * len(goals)
    heap = [(-g / (2 * n + 1), i, n) for i, (g, n) in enumerate(zip(goals, held)) if g > 0 and n < most[i]]
    heapq.heapify(heap)
    out = []
    while heap and len(out) < seats:
        _, i, won = heapq.heappop(heap)
        out.append(i)
        if won + 1 < most[i]:
            heapq.heappush(heap, (-goals[i] / (2 * won + 3), i, won + 1))
    return out


def plan_mix(totals: list[tuple[str | None, int]], weights: tuple[float, ...], most: int, n_shards: int) -> Plan:
    """totals: (source, tokens) by code point of the source, null last; weights repeat along them."""
    sizes = [s for _, s in totals]
    total = sum(sizes)
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], total, most)
    limits = [most * s for s in sizes]
    first = first_seats(goals, total - MAX_BLOCKS, limits)
    awards = sainte_lague(goals, total - sum(first), limits, first)
    quotas, dealt = [], 0
    for n in first:
        quotas.append([n // n_shards + ((j - dealt) % n_shards < n % n_shards) for j in range(n_shards)])
        dealt += n
    for k, i in enumerate(awards, dealt):
        quotas[i][k % n_shards] += 1
    return Plan(1, [(n, s, g, sum(q), q) for (n, s), g, q in zip(totals, goals, quotas)])


def block_order(name: str | None, quota: int, words: int, seed: int) -> tuple[int, int]:
    """(a, c): block b of the source comes as number (a * b + c) mod blocks; a and the number of blocks share no factor."""
    blocks, rng = max(1, -(-quota // words)), random.Random(f"{seed}:{name}")
    a = rng.randrange(1 << 19, 1 << 20)
    while math.gcd(a, blocks) > 1:
        a += 1
    return a % blocks, rng.randrange(blocks)


def served_pieces(words: int) -> Column:
    """array<struct<at, n>>: where the words of a document that the quota serves lie once the blocks are in order.

    From the columns start, size, source_size, quota, and a, c, n_blocks of the order. The last block is shorter; those
    that come after it move up.
    """
    number = lambda b: f"((a * ({b}) + c) % n_blocks)"
    moved = f"if({number('b')} > {number('n_blocks - 1')}, n_blocks * {words} - quota, 0L)"
    low, high = f"greatest(x.lo, b * {words})", f"least(x.hi, (b + 1) * {words})"
    piece = f"named_struct('at', {number('b')} * {words} + {low} - b * {words} - {moved}, 'n', {high} - {low})"
    laps = "sequence(0L, quota div greatest(source_size, 1L))"
    lap = "named_struct('lo', k * source_size + start, 'hi', least(quota, k * source_size + start + size))"
    blocks = f"transform(sequence(x.lo div {words}, (x.hi - 1) div {words}), b -> {piece})"
    return F.expr(f"flatten(transform(filter(transform({laps}, k -> {lap}), x -> x.hi > x.lo), x -> {blocks}))")


def shard_words() -> Column:
    """array<bigint>: how many of the words in ``pieces`` lie between each two of ``ends``."""
    overlap = "greatest(0L, least(p.at + p.n, ends[j + 1]) - greatest(p.at, ends[j]))"
    return F.expr(f"transform(sequence(0, size(ends) - 2), j -> aggregate(pieces, 0L, (s, p) -> s + {overlap}))")


def mix_documents(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, n_shards: int = 16, seed: int = 17,
    block_words: int = BLOCK_WORDS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): source, size, source_size, target, taken, start, quota,
    shard_taken.

    Size is the number of words (runs other than 0x20 and 0x09-0x0D; none in a null text). A source's documents,
    ordered by a seeded hash, form a cycle of tokens; its quota is cut from the cycle's start, so ``taken``, the
    words of a document within it, sums to exactly the quota per source, a word or two from its target however
    small the source is, and never exceeds ``most`` times the document's size. ``start`` is the document's place in
    the cycle, ``quota`` the source's tokens. The quota's tokens, cut into blocks of ``block_words`` (the last may be
    shorter), fill the shards in a seeded order of the blocks, each up to its quota of the source; a block at a border
    is split. ``shard_taken`` has the words that each of the ``n_shards`` shards takes of the document; they sum to
    ``taken``, all shards get equally many words, but for one, and each source's in the same shares. A null source is
    a source; a document without words is kept with taken 0; repeated rows are served each; ties of the hash fall
    back to doc_id and size; an empty table gives an empty result. ``keep`` names further columns of ``docs`` to keep,
    named otherwise than these.

    Scale: texts are read once, for counts. The driver gets one row per source (a dimension of the corpus, not its
    rows; more than MOST_SOURCES are an error) and awards about one seat a source and MAX_BLOCKS more one by one.
    Starts are prefix sums over a range partitioning by (source, hash), so that a source with a third of all rows is
    spread over many tasks; where its blocks go follows from their numbers alone, without a sort of blocks.
    """
    spark = docs.sparkSession
    counted = materialise(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
            *keep,
        ),
        "mix-sizes",
    )
    found = counted.groupBy("source").agg(F.sum("size").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    totals = sorted(((r["source"], r["n"]) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    plan = plan_mix(totals, weights, most, n_shards)
    rows = []
    for i, (name, size, goal, quota, shares) in enumerate(plan.sources):
        order = block_order(name, quota, block_words, seed)
        rows.append((name, i, size, goal, quota, *order, max(1, -(-quota // block_words)), [0, *accumulate(shares)]))
    schema = "name string, code int, source_size bigint, target double, quota bigint, a bigint, c bigint, n_blocks bigint, ends array<bigint>"
    sources = spark.createDataFrame(rows, schema)
    few = len(rows) <= MOST_BROADCAST
    own = F.broadcast(sources.drop("a", "c", "n_blocks", "ends")) if few else sources.drop("a", "c", "n_blocks", "ends")
    coded = counted.join(own, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    spread = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    ranged = coded.withColumn("_h", spread).repartitionByRange("code", "_h", "doc_id")
    held = materialise(ranged, "mix-order", with_pid=True)
    discard(counted)
    out = running_before(held, ["code"], [F.col("_h"), F.col("doc_id"), F.col("size")], F.col("size"), "start")
    orders = sources.select("code", "a", "c", "n_blocks", "ends")
    out = out.join(F.broadcast(orders) if few else orders, "code")
    out = out.withColumn("pieces", served_pieces(block_words)).withColumn("shard_taken", shard_words())
    taken = F.aggregate("shard_taken", F.lit(0).cast("bigint"), lambda s, n: s + n)
    return out.withColumn("taken", taken).select(
        "doc_id", "source", "size", "source_size", "target", "quota", "start", "taken", "shard_taken", *keep
    )
