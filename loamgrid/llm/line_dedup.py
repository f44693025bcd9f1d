"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a document are hashed; windows found more than once anywhere are repeats; all but
the first occurrence are removed, the positions that overlapping windows cover being merged.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import materialise, slices, word_parts

WINDOW = 3
#: White space within a line; other characters count as words.
BLANKS = " \t\x0b\x0c\r"
#: Windows that a task holds as objects at a time.
BATCH_WINDOWS = 1 << 16


def lines_of(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, text without surrounding blanks) of each line; nothing of a text is held but one line."""
    at = 0
    while at >= 0:
        end = text.find("\n", at)
        stop = len(text) if end < 0 else end
        yield at, stop, text[at:stop].strip(BLANKS)
        at = -1 if end < 0 else end + 1


def window_hashes(text: str, width: int = WINDOW) -> Iterator[bytes]:
    """A 128-bit hash for each ``width`` consecutive lines with words; none in a shorter text."""
    held: deque[bytes] = deque(maxlen=width)
    for _, _, line in lines_of(text):
        if line:
            held.append(line.encode("utf-8", "surrogatepass"))
            if len(held) == width:
                yield hashlib.blake2b(b"\n".join(held), digest_size=16).digest()


def without_windows(text: str, starts: list[int], width: int = WINDOW) -> tuple[str, int, int]:
    """(text without the lines that the windows at these starts cover, lines removed, words removed).

    ``starts`` are sorted. A line without words goes with the line before it.
    """
    keep, gone, words, drop, kept_from = [], 0, 0, False, 0
    number, next_, until = -1, 0, 0
    for at, _, line in lines_of(text):
        if line:
            number += 1
            while next_ < len(starts) and starts[next_] <= number:
                until = starts[next_] + width
                next_ += 1
            now = number < until
            if now:
                gone += 1
                words += sum(map(len, word_parts(line)))
            if now and not drop:
                keep.append(text[kept_from:at])
            elif drop and not now:
                kept_from = at
            drop = now
    if not drop:
        keep.append(text[kept_from:])
        return "".join(keep), gone, words
    return "".join(keep)[:-1] if keep else "", gone, words


def text_key(text: str) -> int:
    """A signed 64-bit hash of the text, to tell rows of one doc_id apart in the same way on every run."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def windows_of(rows: DataFrame, width: int) -> DataFrame:
    """(hash, id, text_key, row, at) of every window of rows (row, id, text)."""

    names = ["hash", "id", "text_key", "row", "at"]

    def batch_of(found):
        hashes, ids, keys, numbers, places = zip(*found)
        columns = [pa.array(hashes, pa.binary()), *(pa.array(x, pa.int64()) for x in (ids, keys, numbers)), pa.array(places, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        found = []
        for batch in slices(batches):
            for number, id_, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                key = text_key(text) if text else 0
                for at, window in enumerate(window_hashes(text or "", width)):
                    found.append((window, id_, key, number, at))
                    if len(found) >= BATCH_WINDOWS:
                        yield batch_of(found)
                        found = []
        if found:
            yield batch_of(found)

    return rows.mapInArrow(run, "hash binary, id bigint, text_key bigint, row bigint, at int")


def dedupe_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with repeated windows removed from ``text``, and n_removed_lines, n_removed_words, n_words_before.

    The first occurrence of a window, by doc_id and then place, stays; later ones go, within a document too. Lines
    are compared without surrounding white space; blank lines are passed over. A text of fewer than ``width`` lines
    with words and a null text stay as they are. A row is a document of its own: rows that share a doc_id come in the
    order of a hash of their texts and lose only their own lines; of rows with equal doc_id and text any one is the
    first; a null doc_id comes after all others. All columns of ``docs`` are kept, in order; those named like the
    three new ones are replaced. An empty table gives an empty result.

    Scale: rows are written once with their number, which stays the same however often they are read; windows travel
    as 44 bytes, are counted with map-side combining, and the repeated hashes, a written table, meet them in a join of
    two scans that adaptive execution broadcasts by measured size or splits where a window is in a third of all
    documents. Texts move once, to meet their own row's places.
    """
    row = "__line_row"
    docs = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "line-docs")
    last = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1))
    windows = materialise(windows_of(docs.select(row, last, F.col("text").cast("string")), width), "line-windows")
    place = F.struct("id", "text_key", "row", "at")
    counted = windows.groupBy("hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = materialise(counted.filter("n > 1").select("hash", "first"), "line-repeats")
    later = windows.join(repeated, "hash").filter(place > F.col("first"))
    starts = later.groupBy(F.col("row").alias("__line_of")).agg(F.sort_array(F.collect_set("at")).alias("__line_starts"))
    new = ("n_removed_lines", "n_removed_words", "n_words_before")
    kept = docs.select([c for c in docs.columns if c not in new])
    at = kept.columns.index("text")
    joined = kept.join(starts, F.col(row) == F.col("__line_of"), "left").drop(row, "__line_of")
    schema = kept.drop(row).schema
    for name in new:
        schema = schema.add(name, "long")
    if schema["text"].dataType.simpleString() != "string":
        raise TypeError("text must be a string column")

    def run(batches):
        for batch in slices(batches):
            starts_of = batch.column(batch.num_columns - 1).to_pylist()
            texts, lines, words, before = [], [], [], []
            for text, own in zip(batch.column(at).to_pylist(), starts_of):
                cleaned, n, w = without_windows(text, own, width) if own and text is not None else (text, 0, 0)
                texts.append(cleaned)
                lines.append(n)
                words.append(w)
                before.append(sum(map(len, word_parts(text or ""))))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            columns += [pa.array(x, pa.int64()) for x in (lines, words, before)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)
