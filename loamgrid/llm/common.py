"""What the operators share: tables, batches of rows, and the numbering of the library."""

from __future__ import annotations

import ctypes
import re
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loamgrid.operators.numbering import discard, materialise, running_before, scratch_root

__all__ = [
    "discard", "give_back", "materialise", "running_before", "scratch_root", "slices", "stable_rows", "table", "word_parts",
    "worker_wide",
]

#: Rows that a Python function holds as objects at a time.
SLICE_ROWS = 256
#: Characters of a text whose words are objects at a time.
PART_CHARS = 1 << 20
_BLANK = re.compile("[ \t\n\x0b\x0c\r]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that long texts don't meet in memory.

    What another operator has kept in this worker (``worker_wide``) goes first: a worker outlives its stage.
    """
    held = _worker()
    if held:
        held.clear()
        give_back()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_parts(text: str, lower: bool = False) -> Iterator[list[bytes]]:
    """The words of a text, runs other than 0x20 and 0x09-0x0D in UTF-8, of about PART_CHARS characters at a time.

    A long text's words thus never are objects all at once. ``lower`` turns A-Z into a-z.
    """
    most, at = PART_CHARS, 0
    while len(text) - at > most:
        gap = _BLANK.search(text, at + most)
        if gap is None:
            break
        raw = text[at : gap.start()].encode("utf-8", "surrogatepass")
        yield (raw.lower() if lower else raw).split()
        at = gap.end()
    raw = (text[at:] if at else text).encode("utf-8", "surrogatepass")
    yield (raw.lower() if lower else raw).split()


def stable_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` in a form that has the same rows in the same partitions however often it is read.

    A projection of files is so as it stands; anything else is written first.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes = [line.lstrip(" :+-") for line in plan.toString().splitlines()]
    if plan.deterministic() and all(n.startswith(("Project [", "Filter (", "Relation [")) for n in nodes if n):
        return df
    return materialise(df, name)


def _worker() -> dict:
    """What is kept in this Python worker, by name."""
    return sys.modules.setdefault("_loamgrid_worker", types.ModuleType("_loamgrid_worker")).__dict__.setdefault("kept", {})


def worker_wide(name: str, make):
    """What ``make`` returns, made once in a Python worker and kept for the tasks that it runs later, until one of them
    reads its rows by ``slices``."""
    held = _worker()
    if name not in held:
        held[name] = make()
    return held[name]


def give_back() -> None:
    """Return freed memory to the system; else a worker stays as large as its largest moment was."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
