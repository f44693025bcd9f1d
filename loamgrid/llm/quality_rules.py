"""Quality rules by line-first cleaning.

Each line of a text is judged on its own by punctuation, navigation and boilerplate rules; lines that fail are
removed; a document that loses too much of its text in this way, or that fails the base rules, is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import slices, word_parts


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict on the document."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: Symbols, and words that end in a run of marks, as shares of a line's words.
    max_symbol_share: float = 0.1
    max_mark_run_share: float = 0.2
    #: A line of at most so many words without a final mark is an unfinished sentence; a very short one is navigation.
    unfinished_words: int = 20
    nav_words: int = 3
    #: A line with so many separators between words is navigation.
    nav_separators: int = 2
    #: One word makes up more than this share of a line of at least ten words.
    max_word_share: float = 0.5
    #: The document goes when failed lines hold more than this share of its words.
    max_lost_share: float = 0.3


SYMBOLS = "#*$%&|<>"
FINAL = (".", "!", "?", "…", ":", ";", '"', "'", ")", "”", "’", "»", "。", "！", "？")
SEPARATORS = ("|", "»", "›", "•", "·", ">", "::", "/")
MARK_RUNS = ("!!", "??", "!?", "?!")
#: Phrases of page furniture in English, German, French and Spanish.
BOILERPLATE = (
    r"\b(?:(?:lorem ipsum|cookie policy|privacy policy|terms of (?:use|service)|all rights reserved|enable javascript|"
    r"javascript is (?:disabled|required)|click here|read more|sign (?:in|up)|log ?in|subscribe to our|"
    r"skip to (?:main )?content|back to top|share (?:this|on)|follow us|powered by|page [0-9]+ of [0-9]+|"
    r"alle rechte vorbehalten|impressum|cookies akzeptieren|hier klicken|mehr erfahren|weiterlesen|"
    r"nach oben|seite [0-9]+ von [0-9]+|folgen sie uns|newsletter abonnieren|"
    r"tous droits r[éÉ]serv[éÉ]s|mentions l[éÉ]gales|accepter les cookies|cliquez ici|lire la suite|en savoir plus|"
    r"haut de page|suivez-nous|page [0-9]+ sur [0-9]+|"
    r"todos los derechos reservados|aviso legal|aceptar (?:las )?cookies|leer m[áÁ]s|volver arriba|"
    r"s[íÍ]guenos)\b|datenschutz|haga clic aqu|iniciar sesi)"
)
#: A line with such a phrase is boilerplate if it has at most so many words.
BOILERPLATE_WORDS = 25
#: Texts of more characters, and lines of more words, are counted by hashes of their words, eight bytes each.
LONG_TEXT, LONG_LINE = 1 << 21, 1 << 18
_BOILERPLATE = re.compile(BOILERPLATE, re.IGNORECASE | re.ASCII)
_SEPARATORS = frozenset(s.encode() for s in SEPARATORS)
_MARK_RUNS = frozenset(s.encode() for s in MARK_RUNS)

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_lines bigint, n_punctuation_lines bigint, n_navigation_lines bigint, "
    "n_boilerplate_lines bigint, lost_words bigint"
)


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that are found twice or more."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    seen, covered, end = Counter(grams), 0, 0
    for i, gram in enumerate(grams):
        if seen[gram] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def word_numbers(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in order: eight bytes a word, however long the text."""
    found = [np.fromiter(map(xxhash.xxh64_intdigest, part), np.uint64, len(part)) for part in word_parts(text)]
    return np.concatenate(found)


def repeat_numbers(ids: np.ndarray) -> int:
    """``repeat_words`` of words given by their hashes."""
    if len(ids) < 4:
        return 0
    grams = ids[:-2] * np.uint64(0x9E3779B97F4A7C15) + ids[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + ids[2:]
    ordered = np.sort(grams)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    hit = twice[np.minimum(np.searchsorted(twice, grams), len(twice) - 1)] == grams
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : len(ids) - 2 + k] |= hit
    return int(covered.sum())


@dataclass(frozen=True)
class LineCounts:
    """A line's words, those that end in a run of marks, those that are separators, and uses of its commonest word."""

    words: int
    mark_runs: int
    separators: int
    most: int


def line_counts(line: str) -> LineCounts:
    n = marks = separators = most = 0
    for part in word_parts(line):
        whole, n = not n, n + len(part)
        marks += sum(w[-2:] in _MARK_RUNS for w in part)
        separators += sum(map(_SEPARATORS.__contains__, part))
    if n >= 10:
        counts = Counter(part).values() if whole and n < LONG_LINE else np.unique(word_numbers(line), return_counts=True)[1]
        most = int(max(counts))
    return LineCounts(n, marks, separators, most)


def line_verdict(line: str, has: LineCounts, rules: LineRules) -> str:
    """'' for a line that stays, else the family of the rule it fails."""
    n = has.words
    if sum(map(line.count, SYMBOLS)) > rules.max_symbol_share * n:
        return "punctuation"
    if has.mark_runs > rules.max_mark_run_share * n:
        return "punctuation"
    if n <= rules.unfinished_words and not line.rstrip(" \t\x0b\x0c\r").endswith(FINAL):
        return "navigation" if n <= rules.nav_words else "punctuation"
    if has.separators >= rules.nav_separators:
        return "navigation"
    if n <= BOILERPLATE_WORDS and _BOILERPLATE.search(line):
        return "boilerplate"
    if n >= 10 and has.most > rules.max_word_share * n:
        return "boilerplate"
    return ""


def judge(text: str | None, rules: LineRules) -> tuple[list, str]:
    """(the numbers of SCHEMA after doc_id, the text without its failed lines)."""
    text = text or ""
    gaps = sum(map(text.count, " \t\n\x0b\x0c\r"))
    if len(text) <= LONG_TEXT:
        words = text.encode("utf-8", "surrogatepass").split()
        n, repeats = len(words), repeat_words(words)
        del words
    else:
        ids = word_numbers(text)
        n, repeats = len(ids), repeat_numbers(ids)
        del ids
    seen: set[str] = set()
    duplicates = lost = 0
    failed = Counter()
    keep, n_lines = [], 0
    for line in text.split("\n"):
        has = line_counts(line)
        if not has.words:
            keep.append(line)
            continue
        n_lines += 1
        verdict = line_verdict(line, has, rules)
        if line in seen:
            duplicates += 1
            verdict = verdict or "boilerplate"
        seen.add(line)
        if verdict:
            failed[verdict] += 1
            lost += has.words
        else:
            keep.append(line)
    base = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    kept = not base and lost <= rules.max_lost_share * n
    numbers = [n, len(text) - gaps, sum(map(text.count, SYMBOLS)), duplicates, repeats, base, kept, n_lines]
    return [*numbers, failed["punctuation"], failed["navigation"], failed["boilerplate"], lost], "\n".join(keep)


def judge_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): SCHEMA's counts, ``kept``, and ``clean_text``.

    ``clean_text`` is the text without the lines that failed, null for rejected documents. A map without a shuffle.
    A null or empty text has no words: it fails the base rules, with zero counts. Texts of any length are read
    whole; a very long one (LONG_TEXT) takes some multiple of its own size in memory, not an object a word, and its
    repeats are told by 64-bit hashes of words. Repeated rows and null doc_ids are judged like any other row; further columns are ignored, an empty
    table gives an empty result. Words are runs of bytes other than 0x20 and 0x09-0x0D.
    """
    schema = SCHEMA + ", clean_text string"
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.int64()] * 5

    def run(batches):
        for batch in slices(batches):
            rows, clean = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                numbers, cleaned = judge(text, rules)
                rows.append([key, *numbers])
                clean.append(cleaned if numbers[6] else None)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] + [pa.array(clean, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def clean_rows(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns in order, with ``text`` less the lines that failed."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            judged = [judge(text, rules) for text in batch.column(at).to_pylist()]
            kept = [numbers[6] for numbers, _ in judged]
            columns = list(batch.columns)
            columns[at] = pa.array([text for _, text in judged], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
