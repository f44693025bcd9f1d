"""SimHash near-dedup with BK-trees.

Fingerprints that differ in few bits are found in BK-trees, whose children are keyed by their Hamming distance to
the parent: a search at radius r follows only edges within r of its own distance. The corpus is cut into shard trees
by blocks of the fingerprints' bits: r differing bits touch r blocks at most, so linked fingerprints agree in all the
others and meet in the tree of some of these. Trees travel to their queries by shuffle, not by broadcast, since
together they hold every fingerprint and so grow with the corpus.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import discard, materialise, slices, word_parts

SEED = 42
SHINGLE = 3
RADIUS = 2
#: Beyond this radius too many shard trees would hold each fingerprint.
MAX_RADIUS = 6
#: Fingerprints of one key that go to one tree; more are dealt to finer trees.
DENSE = 1 << 14
#: Hashes whose bits are counted at a time.
COUNT_ROWS = 1 << 16


def shingle_hashes(text: str, width: int = SHINGLE) -> Iterator[list[int]]:
    """XXH64 of the shingles of lower-cased words, part by part; one of the whole sequence if there are fewer words."""
    digest, held, some = xxhash.xxh64_intdigest, [], False
    for part in word_parts(text, lower=True):
        words = held + part if held else part
        if len(words) >= width:
            some = True
            yield [digest(b" ".join(words[i : i + width]), SEED) for i in range(len(words) - width + 1)]
        held = words[-(width - 1) :] if width > 1 else []
    if held and not some:
        yield [digest(b" ".join(held), SEED)]


def fingerprint(hashes: Iterable[list[int]]) -> int:
    """Bits set in over half the hashes, as a signed 64-bit number; 0 for none."""
    ones, n = np.zeros(64, np.int64), 0
    for found in hashes:
        for at in range(0, len(found), COUNT_ROWS):
            part = np.array(found[at : at + COUNT_ROWS], ">u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(found)
    return int(np.packbits(2 * ones > n).view(">i8")[0]) if n else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of each row."""

    def run(batches):
        for batch in slices(batches):
            found = [fingerprint(shingle_hashes(text or "")) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, fp bigint")


class BKTree:
    """A BK-tree that also knows which of its fingerprints are already linked.

    A subtree whose members are all linked with each other, and with the fingerprint searched for, can add nothing
    and is passed over. Each search joins all groups that it touches, so groups stay exact, while a dense cluster
    costs about one path per member instead of a visit to every pair.
    """

    def __init__(self, radius: int) -> None:
        self.radius = radius
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []
        self.group: list[int] = []
        self.whole: list[bool] = []

    def root(self, v: int) -> int:
        while self.group[v] != v:
            self.group[v] = self.group[self.group[v]]
            v = self.group[v]
        return v

    def add(self, value: int) -> list[int]:
        """Insert a value; numbers of earlier ones, one for each group of linked values that it joins."""
        new = len(self.value)
        self.value.append(value)
        self.children.append({})
        self.group.append(new)
        self.whole.append(True)
        if not new:
            return []
        path, v = [], 0
        while True:
            path.append(v)
            distance = (value ^ self.value[v]).bit_count()
            below = self.children[v].get(distance)
            if below is None:
                break
            v = below
        joined, stack, radius = [], [0], self.radius
        for near in reversed(path):  # most likely neighbours first: then the search has groups to pass over
            if (value ^ self.value[near]).bit_count() <= radius:
                stack.append(near)
        while stack:
            v = stack.pop()
            mine, theirs = self.root(new), self.root(v)
            if mine == theirs and self.whole[v]:
                continue
            apart = (value ^ self.value[v]).bit_count()
            if apart <= radius and mine != theirs:
                self.group[max(mine, theirs)] = min(mine, theirs)
                joined.append(v)
            for edge, child in self.children[v].items():
                if apart - radius <= edge <= apart + radius:
                    stack.append(child)
        self.children[path[-1]][distance] = new
        for v in reversed(path):
            mine = self.root(v)
            if len(joined) > 1:
                self.whole[v] = all(self.whole[c] and self.root(c) == mine for c in self.children[v].values())
            else:
                self.whole[v] = self.whole[v] and self.root(new) == mine
        return joined


def links_within(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Index pairs within the radius that join exactly what all such pairs would join."""
    if len(values) == 2:
        return [(0, 1)] if (values[0] ^ values[1]).bit_count() <= radius else []
    tree = BKTree(radius)
    return [(at, k) for k, value in enumerate(values) for at in tree.add(value)]


def block_plan(radius: int) -> tuple[list[tuple[int, int]], int]:
    """((first bit, bits) of each block, blocks that make a key): at least so many blocks agree at ``radius``.

    Four blocks, two to a key (6 keys of 32 bits), serve radius 2; beyond it radius + 3 blocks, three to a key, such as
    35 keys of 27 bits for radius 4.
    """
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"radius must be within 0 and {MAX_RADIUS}")
    blocks, shared = (4, 2) if radius <= 2 else (radius + 3, 3)
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])], shared


def block_keys(fp: Column, radius: int = RADIUS) -> Column:
    """struct(key, mask) for each choice of blocks: its number and the blocks' bits, and where those bits are."""
    blocks, shared = block_plan(radius)
    keys = []
    for n, chosen in enumerate(combinations(blocks, shared)):
        key, mask = F.lit(n).cast("bigint"), 0
        for first, bits in chosen:
            part = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
            key = F.shiftleft(key, bits).bitwiseOR(part)
            mask |= ((1 << bits) - 1) << first
        keys.append(F.struct(key.alias("key"), F.lit(signed(mask)).cast("bigint").alias("mask")))
    return F.array(*keys)


def signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def finer_masks(mask: int, radius: int) -> list[int]:
    """For fingerprints that agree in the bits of ``mask``: masks of more bits, in one of which linked ones agree too.

    The other bits are cut into blocks as the whole fingerprint is.
    """
    plan, shared = block_plan(radius)
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // len(plan) for i in range(len(plan) + 1)]
    parts = [sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]
    return [mask | sum(chosen) for chosen in combinations(parts, shared)]


def _groups(batches, dense: int):
    """(rows, whole) of each key, rows being arrays fp, rep, mask, sorted by key; a key of more than ``dense`` rows comes
    in pieces that are not whole."""
    key, held, n, whole = None, [], 0, True
    for batch in batches:
        keys, *rows = (batch.column(i).to_numpy() for i in range(4))
        edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for start, end in zip(edges[:-1], edges[1:]):
            if end == start:
                continue
            if keys[start] != key:
                if held:
                    yield [np.concatenate(x) for x in zip(*held)], whole
                key, held, n, whole = keys[start], [], 0, True
            held.append([x[start:end] for x in rows])
            n += end - start
            if n > dense:
                whole = False
                yield [np.concatenate(x) for x in zip(*held)], False
                held, n = [], dense
    if held:
        yield [np.concatenate(x) for x in zip(*held)], whole


def shard_links(nodes: DataFrame, radius: int, dense: int = DENSE) -> DataFrame:
    """(a, b) with a < b: links between nodes (fp, rep), by the shard trees: those that join what all such pairs would join.

    A key of more than ``dense`` fingerprints is no tree: its fingerprints are dealt once more, by choices of blocks of the
    bits that the key leaves open, to trees over all tasks. At radius 2 that leaves 16 bits, so 65,536 distinct
    fingerprints a tree at most; what stays dense is a cluster, in which a tree passes over what is linked already.
    """
    names = ["kind", "x", "y", "mask"]

    def as_batch(rows):
        kinds = (pa.int8(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=names)

    def run(batches, most=dense):
        """Rows (0, a, b, 0) are links, rows (1, fp, rep, mask) are left to finer trees."""
        pairs: list[tuple[int, int]] = []

        def linked():
            a, b = zip(*pairs)
            return as_batch([[0] * len(pairs), a, b, [0] * len(pairs)])

        for (fps, reps, masks), whole in _groups(batches, most):
            if not whole:
                yield as_batch([np.ones(len(fps), np.int8), fps, reps, masks])
                continue
            once = np.concatenate([[True], fps[1:] != fps[:-1]])  # two choices of blocks may end in one mask
            fps, reps = fps[once], reps[once]
            if len(fps) > 1:
                own = reps.tolist()
                values = [x & 0xFFFFFFFFFFFFFFFF for x in fps.tolist()]
                pairs += [tuple(sorted((own[i], own[k]))) for i, k in links_within(values, radius)]
                if len(pairs) >= 10_000:
                    yield linked()
                    pairs = []
        if pairs:
            yield linked()

    def finer(batches):
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            fps, reps, masks = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            for mask in np.unique(masks).tolist():
                if mask not in known:
                    known[mask] = np.array(finer_masks(mask, radius), np.uint64)
                at = masks == np.uint64(mask)
                for new in known[mask]:
                    key = ((fps[at] & new) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(int(new) * 0xC2B2AE3D27D4EB4F % (1 << 64))
                    columns = [key, np.full(len(key), new), fps[at], reps[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["key", "mask", "fp", "rep"])

    routed = nodes.select(F.explode(block_keys(F.col("fp"), radius)).alias("k"), "fp", "rep").select("k.key", "k.mask", "fp", "rep")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def searched(rows, search):
        ordered = rows.select("key", "fp", "rep", "mask").repartition(parts, "key").sortWithinPartitions("key", "fp")
        return materialise(ordered.mapInArrow(search, "kind tinyint, x bigint, y bigint, mask bigint"), "simhash-links")

    links_in = lambda df: df.filter("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b"))
    out = searched(routed, run)
    links, left = links_in(out), out.filter("kind = 1").select(F.col("x").alias("fp"), F.col("y").alias("rep"), "mask")
    if not left.isEmpty():
        again = left.mapInArrow(finer, "key bigint, mask bigint, fp bigint, rep bigint")
        links = links.unionByName(links_in(searched(again, lambda batches: run(batches, sys.maxsize))))
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label): for every node of links (a, b), the smallest node that it reaches.

    Alternating large-star and small-star steps: logarithmically many rounds, each a join of two written tables
    (so that the star of a huge component is split over tasks) and sums with map-side combining.
    """
    edges = materialise(links.filter("a <> b"), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "links-low")
        large = both.join(low, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        starred = materialise(large.distinct(), "links-large")
        discard(edges, low)
        down = starred.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = materialise(down.groupBy("a").agg(F.min("b").alias("m")), "links-low")
        small = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links-small")
        discard(starred, low)
        ends = edges.select(
            F.inline(
                F.array(
                    F.struct(F.col("a").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")),
                    F.struct(F.col("b").alias("n"), F.lit(0).alias("low"), F.lit(1).alias("high")),
                )
            )
        )
        sums = ends.groupBy("n").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
        if sums.filter("low > 1 or (low > 0 and high > 0)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    Words are runs other than 0x20 and 0x09-0x0D of the text with A-Z lower-cased; shingles are three words, repeats
    included; a shorter text is one shingle; null and wordless texts have fingerprint zero and link like any other.
    Fingerprints link at ``radius`` or fewer differing bits (``block_plan``); ``component_id`` is the
    smallest doc_id reached. A null doc_id takes the component of its fingerprint and links nothing of its own; the
    component of a fingerprint that only null doc_ids have is null.
    Repeated rows stay; further columns are ignored; an empty table gives an empty result.

    Scale: texts are read once. Copies meet by fingerprint with map-side combining, so a group of copies is one node
    whatever its size; nodes go to six shard trees each at radius 2, sorted by key and streamed, a tree of more than DENSE
    nodes being dealt to finer ones; the links that come back are those that join groups, never all pairs.
    """
    block_plan(radius)
    prints = materialise(fingerprints(docs), "simhash-prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    labels = components(shard_links(nodes.filter("rep is not null"), radius))
    named = nodes.join(labels, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("label", "rep").alias("component_id")
    )
    named = materialise(named, "simhash-named")
    discard(nodes)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fp").select("doc_id", hexed, "component_id")
