"""Best-fit packing of token sequences: best-two-fit.

A bin is filled greedily with the longest documents that fit; then its smallest document is taken out and replaced
by two unpacked ones that fill the wider gap more tightly.

Lengths are integers of at most ``max_len``, so the packer works on counts per length: a bin's pattern, once found,
is repeated as often as the counts allow, which is what filling bin after bin would do. The work on the driver thus
depends on ``max_len`` only, and the packing is global however many documents there are.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import give_back, materialise, running_before, worker_wide

TOKENIZER = "word_bpe_49k.json"
#: Words, and ids of words, that a worker keeps in each of two generations.
CACHE_WORDS, CACHE_IDS = 400_000, 4_000_000
#: Bytes of texts that are tokenised, words whose ids are laid out, and parts of words that the library gets, at a time.
TOKEN_BYTES, TAKE_WORDS, CALL_PARTS = 4 << 20, 1 << 18, 256


class TextIds:
    """Little-endian unsigned 32-bit ids of texts, as the tokenizers library gives them with any vocabulary file."""

    def __init__(self, spec: dict) -> None:
        from tokenizers import Tokenizer

        self.spec = spec
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        return [self.encode(text) for text in texts]


class Kept:
    """Ids of words: those of a word with number k are flat[bounds[k]:bounds[k + 1]]."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat, self.bounds = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def add(self, words: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.bounds) - 1
        self.numbers.update(zip(words, range(first, first + len(words))))
        self.flat = np.concatenate([self.flat, flat])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts, dtype=np.int64)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and how many each has."""
        starts = self.bounds[numbers]
        counts = self.bounds[numbers + 1] - starts
        ends = np.cumsum(counts)
        at = np.repeat(starts - ends + counts, counts)
        at += np.arange(len(at))
        return self.flat[at], counts


class WordIds(TextIds):
    """The same for byte-pair vocabularies over lower-case words with word ends, many words at a time.

    Texts are split at ASCII blanks and their words numbered as Arrow columns, so that Python sees a word once in a
    batch; a text's ids are then laid out from its words' numbers. New words of ASCII and Latin-1 are lower-cased and
    cut into parts here, and the library's model merges parts that are new, many in a call: each part ends in the one
    id that has the word end. Other words go to the library as they are, since its Unicode tables are not Python's, as
    do, as a whole, texts that may have special tokens, letters whose lower case depends on their neighbours, or
    characters that only Python takes for white space.
    """

    NORMALIZERS = ["NFC", "Replace", "Lowercase"]
    ODD = ("<|", "\u03a3", "\x1c", "\x1d", "\x1e", "\x1f")
    PLAIN = re.compile("[^\x85\xa0\u0100-\U0010ffff]+")

    @classmethod
    def fits(cls, spec: dict) -> bool:
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = [x.get("type") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        special = {x["content"] for x in spec.get("added_tokens", [])} <= {"<|startoftext|>", "<|endoftext|>"}
        ends = spec["model"].get("end_of_word_suffix") == "</w>" and not spec["model"].get("ignore_merges")
        if not (steps == cls.NORMALIZERS and split == ["Split", "ByteLevel"] and special and ends):
            return False
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        signs = [chr(b) for b in printed] + [chr(256 + k) for k in range(256 - len(printed))]
        return all(c in spec["model"]["vocab"] and f"{c}</w>" in spec["model"]["vocab"] for c in signs)

    def __init__(self, spec: dict) -> None:
        import regex
        from tokenizers import Tokenizer

        super().__init__(spec)
        self.parts = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        signs = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        split = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, signs]}
        bare = {"normalizer": None, "pre_tokenizer": split, "post_processor": None, "added_tokens": []}
        self.merger = Tokenizer.from_str(json.dumps(spec | bare))
        vocab = spec["model"]["vocab"]
        self.is_last = np.zeros(max(vocab.values()) + 1, bool)
        self.is_last[[k for token, k in vocab.items() if token.endswith("</w>")]] = True
        self.kept, self.older = Kept(), Kept()

    @staticmethod
    def ids(tokenizer, calls: Iterable[list[str]]) -> list[np.ndarray]:
        """The ids of each text; the library's encodings, which are large, don't outlive a call."""
        found = (tokenizer.encode_batch_fast(texts, add_special_tokens=False) for texts in calls)
        return [np.array(x.ids, "<u4") for x in chain.from_iterable(found)]

    def merge(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of normalised parts of words one after another, and how many each has."""
        calls = ([" ".join(parts[at : at + CALL_PARTS])] for at in range(0, len(parts), CALL_PARTS))
        flat = np.concatenate(self.ids(self.merger, calls))
        counts = np.diff(np.flatnonzero(self.is_last[flat]), prepend=-1)
        if len(counts) != len(parts):
            raise ValueError(f"{len(parts)} parts of words, {len(counts)} word ends")
        return flat, counts

    def number(self, words: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """The numbers of distinct words; those in the older generation are taken over, ``learn`` gets the rest."""
        found = list(map(self.kept.numbers.get, words))
        new = [w for w, k in zip(words, found) if k is None]
        past = list(map(self.older.numbers.get, new))
        old = [w for w, k in zip(new, past) if k is not None]
        if old:
            self.kept.add(old, *self.older.take(np.array([k for k in past if k is not None], np.int64)))
            new = [w for w, k in zip(new, past) if k is None]
        if new:
            learn(new)
        get = self.kept.numbers.__getitem__
        return np.array([get(w) if k is None else k for w, k in zip(words, found)], np.int64)

    def learn_parts(self, parts: list[str]) -> None:
        self.kept.add(parts, *self.merge(parts))

    def learn(self, words: list[str]) -> None:
        fits = [w != "" and (w.isascii() or self.PLAIN.fullmatch(w) is not None) for w in words]
        plain, other = list(compress(words, fits)), [w for w, fit in zip(words, fits) if not fit]
        if other:
            calls = (other[at : at + CALL_PARTS] for at in range(0, len(other), CALL_PARTS))
            ids = self.ids(self.tokenizer, calls)
            self.kept.add(other, np.concatenate(ids), np.array(list(map(len, ids))))
        coded = pa.array(self.parts(" ".join(plain).lower()), pa.string()).dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        used, sizes = coded.indices.to_numpy(), np.array(list(map(len, parts)), np.int64)
        numbers = self.number(parts, self.learn_parts)[used]
        # A word's parts have all its characters, so that parts and words end together.
        ends = np.searchsorted(np.cumsum(sizes[used]), np.cumsum(list(map(len, plain)))) + 1
        n_parts = np.diff(ends, prepend=0)
        single = n_parts == 1
        self.kept.numbers.update(zip(compress(plain, single.tolist()), numbers[ends[single] - 1].tolist()))
        flat, counts = self.kept.take(numbers[np.repeat(~single, n_parts)])
        before = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(n_parts[~single])]
        self.kept.add(list(compress(plain, (~single).tolist())), flat, np.diff(before, prepend=0))

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self.kept.numbers) > CACHE_WORDS or len(self.kept.flat) > CACHE_IDS:
            self.kept, self.older = Kept(), self.kept
        odd = [any(mark in t for mark in self.ODD) for t in texts]
        cut = pc.ascii_split_whitespace(pa.array(["" if o else t for t, o in zip(texts, odd)], pa.large_string()))
        coded = cut.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = self.number(words, self.learn)
        used, bounds = coded.indices.to_numpy(), cut.offsets.to_numpy()
        taken = [self.kept.take(numbers[used[at : at + TAKE_WORDS]]) for at in range(0, len(used), TAKE_WORDS)]
        flat = np.concatenate([np.empty(0, "<u4"), *(ids for ids, _ in taken)])
        ends = np.concatenate([[0], *(n for _, n in taken)]).cumsum()[bounds].tolist()
        return [self.encode(t) if o else flat[a:b].tobytes() for t, o, a, b in zip(texts, odd, ends, ends[1:])]


def text_ids(name: str) -> TextIds:
    """For a public vocabulary's name or a path; the fast form where the file allows it."""
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    with open(name, encoding="utf-8") as file:
        spec = json.load(file)
    return WordIds(spec) if WordIds.fits(spec) else TextIds(spec)


def _byte_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about TOKEN_BYTES of texts, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // TOKEN_BYTES)) + 1
    for a, b in pairwise([0, *cuts.tolist(), batch.num_rows]):
        if a < b:
            yield batch.slice(a, b - a)


def token_pieces(docs: DataFrame, tokenizer: str, max_len: int, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a text's ids and a closing 0, cut into pieces of max_len."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    if with_ids:
        schema, kinds = schema + ", ids array<bigint>", [*kinds, pa.list_(pa.int64())]

    def run(batches):
        words = worker_wide(f"text_ids {tokenizer}", lambda: text_ids(tokenizer))

        def cut(batch):
            rows, texts = [], [text or "" for text in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), words.of(texts)):
                ids += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * max_len)):
                    part = ids[at : at + 4 * max_len]
                    row = [key, k, at // 4, len(part) // 4, zlib.crc32(part)]
                    rows.append([*row, np.frombuffer(part, "<u4").tolist()] if with_ids else row)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

        yield from map(cut, chain.from_iterable(map(_byte_slices, batches)))
        give_back()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


@dataclass
class Patterns:
    """Bins by pattern; uses[length]: (first rank, bins, first bin, uses in a bin, offset in the bin)."""

    n_bins: int = 0
    uses: dict[int, list[tuple[int, int, int, int, int]]] = field(default_factory=dict)


def _fill(counts: dict[int, int], lengths: list[int], max_len: int) -> dict[int, int]:
    """The next bin: {length: uses}."""
    used: dict[int, int] = {}

    def longest(limit: int, but: int = 0) -> int:
        """The longest unpacked length of at most ``limit``; one of ``but`` is spoken for."""
        i = bisect.bisect_right(lengths, limit) - 1
        while i >= 0 and counts[lengths[i]] - used.get(lengths[i], 0) - (lengths[i] == but) <= 0:
            i -= 1
        return lengths[i] if i >= 0 else 0

    gap = max_len
    while gap and (take := longest(gap)):
        used[take] = used.get(take, 0) + 1
        gap -= take
    if gap and sum(used.values()) > 1:
        out = min(used)
        used[out] -= 1
        best, wide = (out, 0), gap + out
        i = bisect.bisect_right(lengths, wide - lengths[0]) - 1
        while i >= 0 and 2 * lengths[i] > best[0] + best[1] and best[0] + best[1] < wide:
            a = lengths[i]
            if counts[a] - used.get(a, 0) > 0 and (b := longest(min(a, wide - a), a)) and a + b > best[0] + best[1]:
                best = (a, b)
            i -= 1
        for x in filter(None, best):
            used[x] = used.get(x, 0) + 1
    return {k: n for k, n in used.items() if n}


def best_two_fit(histogram: dict[int, int], max_len: int) -> Patterns:
    """Pack ``histogram[length]`` documents of each length into bins of max_len."""
    counts = {k: n for k, n in histogram.items() if n > 0}
    lengths, done, out = sorted(counts), dict.fromkeys(counts, 0), Patterns()
    while lengths:
        pattern = _fill(counts, lengths, max_len)
        times, offset = min(counts[k] // n for k, n in pattern.items()), 0
        for k, n in sorted(pattern.items(), reverse=True):
            out.uses.setdefault(k, []).append((done[k], times, out.n_bins, n, offset))
            done[k] += times * n
            counts[k] -= times * n
            offset += k * n
            if not counts[k]:
                lengths.remove(k)
        out.n_bins += times
    return out


def place(length: np.ndarray, rank: np.ndarray, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of the rank-th document of each length."""
    bins, offsets = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        k = int(length[rows[0]])
        first, _, base, n, at = np.array(patterns.uses[k], np.int64).T
        use = np.searchsorted(first, rank[rows], "right") - 1
        within = rank[rows] - first[use]
        bins[rows] = base[use] + within // n[use]
        offsets[rows] = at[use] + within % n[use] * k
    return bins, offsets


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, max_len: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset [, ids].

    A document is its ids and a closing id 0; only a longer one than ``max_len`` is cut, into pieces of ``max_len``.
    A null or empty text is one piece, the closing 0. Rows that repeat a doc_id are packed each; further columns are
    ignored; an empty table gives no rows. ``tokenizer`` is a public vocabulary's name or a path that executors see.

    Scale: texts are read and tokenised once, and only placements are written. The driver gets a count per length.
    Ranks within a length come from counts per (length, partition); no task holds a length's documents together.
    """
    pieces = materialise(token_pieces(docs, tokenizer, max_len, with_ids), "pack-pieces", with_pid=True)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    patterns = best_two_fit(counts, max_len)
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = running_before(pieces, ["length"], order, F.lit(1).cast("bigint"), "rank").drop("pid")
    columns = [c for c in pieces.columns if c != "pid"]

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            at = [table.column(c).to_numpy() for c in ("length", "rank")]
            bins, offsets = place(at[0].astype(np.int64), at[1].astype(np.int64), patterns)
            kept = table.select(columns)
            kept = kept.append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))
            yield from kept.to_batches()

    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    kinds += ", ids array<bigint>" * with_ids + ", sequence_id bigint, offset bigint"
    return ranked.select(*columns, "rank").mapInArrow(run, kinds)
