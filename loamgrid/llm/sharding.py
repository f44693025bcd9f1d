"""Sharding by best-fit-decreasing bin packing.

Groups of equal texts are indivisible. Sorted by size, each enters the shard with the tightest remaining capacity
that still holds it, found in a balanced tree; the capacity is the least at which the shards suffice.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import discard, materialise, running_before

#: Groups that the driver packs by name: those above 1/LARGE of a shard's even share of bytes, or of rows, at most
#: 2 * shards * LARGE. The others are packed as counts per size.
LARGE = 1 << 9
#: Sizes up to this are told apart exactly; beyond it to SIZE_BITS significant bits, rounded up.
EXACT_SIZE, SIZE_BITS = 1 << 20, 11
#: Rows of placements that are sent to all tasks at most; more are met by a shuffle.
MOST_BROADCAST = 100_000


class CapacityTree:
    """A treap of (remaining capacity, bin): add, remove and the least entry of at least a size in O(log n)."""

    def __init__(self) -> None:
        self.root: list | None = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return zlib.crc32(b"%d,%d" % key)

    @classmethod
    def _split(cls, node, key):
        """(entries below key, entries from key on)."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = cls._split(node[3], key)
            return node, right
        left, node[2] = cls._split(node[2], key)
        return left, node

    @classmethod
    def _merge(cls, a, b):
        if a is None or b is None:
            return a or b
        if a[1] >= b[1]:
            a[3] = cls._merge(a[3], b)
            return a
        b[2] = cls._merge(a, b[2])
        return b

    def add(self, remaining: int, bin_: int) -> None:
        key = (remaining, bin_)
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self._priority(key), None, None]), right)

    def remove(self, remaining: int, bin_: int) -> None:
        left, right = self._split(self.root, (remaining, bin_))
        _, right = self._split(right, (remaining, bin_ + 1))
        self.root = self._merge(left, right)

    def tightest(self, size: int) -> tuple[int, int] | None:
        node, found = self.root, None
        while node is not None:
            if node[0] >= (size, -1):
                found, node = node[0], node[2]
            else:
                node = node[3]
        return found


def fill_counts(units: list[tuple[int, int]], capacity: int) -> list[list[tuple[int, int]]]:
    """units: (size, count) by falling size. For each the bins that its items enter in turn: (bin, items).

    The tightest bin that holds an item stays the tightest for the next one of its size until it is too full, so it
    takes as many as fit at once. A size above the capacity gets bins of its own.
    """
    tree, bins, out = CapacityTree(), 0, []
    for size, count in units:
        placed = []
        while count:
            found = tree.tightest(size)
            if found is None:
                found = (max(capacity, size), bins)
                bins += 1
            else:
                tree.remove(*found)
            n = min(count, found[0] // size) if size else count
            tree.add(found[0] - n * size, found[1])
            placed.append((found[1], n))
            count -= n
        out.append(placed)
    return out


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, given in falling order; a size above the capacity gets a bin of its own."""
    return [placed[0][0] for placed in fill_counts([(size, 1) for size in sizes], capacity)]


def least_capacity(units: list[tuple[int, int]], n_bins: int) -> tuple[int, list[list[tuple[int, int]]]]:
    """(capacity, what ``fill_counts`` gives): the least capacity, to 1/20,000 of the even share, at which n_bins suffice."""
    total = sum(size * n for size, n in units)
    step = max(1, total // n_bins // 20_000)
    suffice = lambda placed: max((b for own in placed for b, _ in own), default=0) < n_bins
    high = low = max([-(-total // n_bins), *[size for size, _ in units[:1]]], default=0)
    while not suffice(placed := fill_counts(units, high)):
        high += max(step, high - low)
    while high - low > step:
        middle = (low + high) // 2
        if suffice(tried := fill_counts(units, middle)):
            high, placed = middle, tried
        else:
            low = middle
    return high, placed


def size_class(size: Column) -> Column:
    """The size, or for one above EXACT_SIZE the next with SIZE_BITS significant bits."""
    unit = F.pow(F.lit(2.0), F.floor(F.log2(size.cast("double"))) - (SIZE_BITS - 1)).cast("bigint")
    return F.when(size <= EXACT_SIZE, size).otherwise((size + unit - 1) - (size + unit - 1) % unit)


def shard_documents(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): size, text_crc32, shard, slot, group_sha256.

    Size is the UTF-8 bytes of the text and 1 more; a null text has none and is a group apart from the empty text.
    Documents of equal texts share a shard, unless their group alone is larger than a shard's even share: such a
    group is cut by row into pieces of a sixteenth of that share, since no law of near-equal sizes holds otherwise.
    Repeated rows count each; null doc_ids are placed like others; an empty table gives no rows; columns of docs
    beyond the two are ignored.

    Scale: texts are read once, for digests and sizes; groups are summed with map-side combining. The driver gets
    the few large groups and a count of groups for each size (EXACT_SIZE sizes and some thousand beyond at most), and
    packs group by group from these, as items of one size are alike. The k-th group of a size, by digest, takes the
    k-th place of that size. Rows meet their small group's shard by digest, large groups by a broadcast of those
    few, so that no digest that is shuffled has more than 1/(shards * LARGE) of the rows; slots come from counts per
    partition, never from a sort of a whole shard.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = materialise(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("null")).alias("group_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
        with_pid=True,
    )
    summed = rows.groupBy("group_sha256").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    classed = summed.withColumn("class", size_class(F.col("bytes")))
    groups = materialise(classed.repartitionByRange("class", "group_sha256"), "shard-groups", with_pid=True)
    total, n_rows = groups.agg(F.sum("bytes"), F.sum("n")).first()
    share = max(1, -(-(total or 0) // n_shards))
    hot = (F.col("bytes") > max(share // LARGE, 1)) | (F.col("n") > max((n_rows or 0) // (n_shards * LARGE), 1))
    large = groups.filter(hot).select("group_sha256", "bytes").collect()
    n_parts = [(r["group_sha256"], -(-r["bytes"] * 16 // share) if r["bytes"] > share else 1) for r in large]
    large_df = F.broadcast(spark.createDataFrame(n_parts, "group_sha256 string, n_parts bigint"))
    part = F.pmod(F.xxhash64("doc_id", "row"), F.col("n_parts"))
    parted = rows.join(large_df, "group_sha256", "left").withColumn("part", part)
    cut = parted.filter("n_parts > 1").groupBy("group_sha256", "part").agg(F.sum("size").alias("bytes")).collect()
    whole = {sha for sha, n in n_parts if n == 1}
    named = [(r["bytes"], 1, (r["group_sha256"], 0)) for r in large if r["group_sha256"] in whole]
    named += [(r["bytes"], 1, (r["group_sha256"], r["part"])) for r in cut]
    small = groups.filter(~hot)
    counted = [(r["class"], r["n"], r["class"]) for r in small.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()]
    units = sorted(named, key=lambda x: (-x[0], x[2])) + counted
    units.sort(key=lambda x: -x[0])
    _, placed = least_capacity([(size, n) for size, n, _ in units], n_shards) if units else (0, [])
    by_name, by_class = [], []
    for (_, _, key), own in zip(units, placed):
        if isinstance(key, tuple):
            by_name.append((*key, own[0][0]))
        else:
            ends = list(accumulate(n for _, n in own))
            by_class.append((key, ends, [b for b, _ in own]))
    places = spark.createDataFrame(by_class, "class bigint, ends array<bigint>, shards array<int>")
    places = F.broadcast(places) if len(by_class) <= MOST_BROADCAST else places
    ranked = running_before(small, ["class"], [F.col("group_sha256")], F.lit(1).cast("bigint"), "rank").join(places, "class")
    homes = ranked.select("group_sha256", F.expr("shards[size(filter(ends, x -> x <= rank))]").alias("shard"))
    of_large = F.broadcast(spark.createDataFrame(by_name, "group_sha256 string, part bigint, shard int"))
    columns = ["doc_id", "size", "text_crc32", "group_sha256", "pid", "row", "shard"]
    one = parted.filter("n_parts is null").join(homes, "group_sha256").select(columns)
    two = parted.filter("n_parts is not null").join(of_large, ["group_sha256", "part"]).select(columns)
    out = materialise(one.unionByName(two), "shard-placed")
    discard(rows, groups)
    order = [F.col("doc_id"), F.col("group_sha256"), F.col("row")]
    return running_before(out, ["shard"], order, F.lit(1).cast("bigint"), "slot").drop("pid", "row")
