"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams, one of target text and one of the raw corpus, give each document the
log of how much likelier it is under the target; documents are drawn without replacement in proportion to that
weight by taking the top k after adding Gumbel noise.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import discard, materialise, running_before, slices, word_parts

#: Labelled target documents that the target model is fitted on at most (those of the least seeded hashes).
MAX_TARGET_DOCS = 20_000
BUCKET_BITS = 14
SEED = 7
#: Word hashes that a task keeps.
CACHE_WORDS = 400_000
#: Words that are hashed at a time.
PART_WORDS = 1 << 18


@dataclass(frozen=True)
class Model:
    """Log ratio of target to raw probability of each bucket; share of the corpus that is to be drawn."""

    ratio: np.ndarray
    share: float


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh64_intdigest(word, SEED)
        if len(word) <= 48:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = out
        return out


def buckets(words: list[bytes], hashes: WordHashes, bits: int = BUCKET_BITS) -> np.ndarray:
    """Buckets of a text's words and pairs of words; case is kept, as it tells shouting from prose."""
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ one[1:]
    two = (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (np.concatenate([one, two]) >> np.uint64(64 - bits)).astype(np.int64)


def parts(text: str | None):
    """The words of a text in runs that overlap by one word, so that no pair is lost or counted twice."""
    held: list[bytes] = []
    for words in word_parts(text or ""):
        for at in range(0, len(words), PART_WORDS):
            now = words[at : at + PART_WORDS]
            if held:
                yield held, now[:1]
            held = now
    if held:
        yield held, []


def gumbel(doc_id: int | None, seed: int) -> float:
    """Noise that depends on the document and the seed only."""
    raw = hashlib.blake2b(f"{seed}:{doc_id}".encode(), digest_size=8).digest()
    return -math.log(-math.log((int.from_bytes(raw, "big") + 0.5) / 2.0**64))


def fit(docs: DataFrame, labels: DataFrame, max_target: int, bits: int) -> Model:
    """The raw model counts every document; the target model those labelled of good quality and not toxic."""
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    known = labels.filter("doc_id is not null and quality is not null")
    known = known.select(F.col("doc_id").cast("bigint"), "quality", good.alias("good"))
    n, n_fine = known.agg(F.count(F.lit(1)), F.count_if(F.col("quality") == 1)).first()
    least = F.xxhash64(F.lit(SEED), F.col("doc_id"))
    target = known.filter("good").select("doc_id").distinct().orderBy(least, "doc_id").limit(max_target)
    marked = docs.join(F.broadcast(target.withColumn("_target", F.lit(True))), "doc_id", "left")

    def run(batches):
        hashes, sums = WordHashes(), np.zeros((2, 1 << bits), np.int64)
        for batch in slices(batches):
            for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for words, after in parts(text):
                    found = buckets(words + after, hashes, bits)
                    counts = np.bincount(found, minlength=1 << bits)
                    if after:
                        counts -= np.bincount(buckets(after, hashes, bits), minlength=1 << bits)
                    sums[0] += counts
                    if mark:
                        sums[1] += counts
        some = np.flatnonzero(sums[0])
        columns = [pa.array(some.astype(np.int64)), pa.array(sums[0][some]), pa.array(sums[1][some])]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "raw", "target"])

    counted = marked.select("text", "_target").mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    sums = np.ones((2, 1 << bits))
    for r in rows:
        sums[:, r["bucket"]] += (r["raw"], r["target"])
    log = np.log(sums) - np.log(sums.sum(axis=1, keepdims=True))
    return Model(log[1] - log[0], n_fine / n if n else 1.0)


def resample_documents(
    docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED,
    max_target: int = MAX_TARGET_DOCS, bits: int = BUCKET_BITS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, log_weight, key, rank (from 1), kept.

    ``key`` is log_weight and Gumbel noise; the k documents of the highest keys are kept, ties by doc_id, where k is
    ``share`` of all rows, by default the share of labelled documents that are of good quality. A null
    or wordless text weighs 0. Repeated rows share weight and noise and are ranked each. Without labels every
    weight is 0 up to smoothing and all rows are kept. Columns of ``docs`` and ``labels`` beyond (doc_id, text) and
    (doc_id, quality, toxic) are ignored; an empty table gives an empty result.

    Scale: two passes over texts. Tasks send counts per bucket, 2^bits rows; the model that goes back is as small;
    the broadcast list of target ids has ``max_target`` at most. Ranks come from a range partitioning by key.
    """
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(chosen, labels, max_target, bits)
    ratio = model.ratio

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            keys, sizes, weights = batch.column(0).to_pylist(), [], []
            for text in batch.column(1).to_pylist():
                n, weight = 0, 0.0
                for words, after in parts(text):
                    n += len(words)
                    weight += float(ratio[buckets(words + after, hashes, bits)].sum())
                    if after:
                        weight -= float(ratio[buckets(after, hashes, bits)].sum())
                sizes.append(n)
                weights.append(weight)
            noisy = [w + gumbel(k, seed) for k, w in zip(keys, weights)]
            columns = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(weights), pa.array(noisy)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "log_weight", "key"])

    scored = chosen.mapInArrow(run, "doc_id bigint, n_words bigint, log_weight double, key double")
    order = [F.desc("key"), F.asc("doc_id")]
    scores = materialise(scored, "resample-scores")
    held = materialise(scores.repartitionByRange(*order), "resample-order", with_pid=True)
    discard(scores)
    k = round((model.share if share is None else share) * held.count())
    ranked = running_before(held.withColumn("_all", F.lit(0)), ["_all"], order, F.lit(1).cast("bigint"), "rank")
    ranked = ranked.withColumn("rank", F.col("rank") + 1)
    return ranked.withColumn("kept", F.col("rank") <= k).drop("_all", "pid")
