"""Plain versions of the operators' definitions, over lists of rows, to hold results against."""

import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(n, linked):
    group = list(range(n))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(n):
        for k in range(i):
            if linked(i, k):
                a, b = sorted((root(i), root(k)))
                group[b] = a
    return [root(i) for i in range(n)]


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = words(lower)
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, radius=2):
    """{doc_id: (hex fingerprint, component)}, doc_ids being distinct."""
    rows = sorted(rows)
    prints = [fingerprint(text) for _, text in rows]
    groups = components(len(rows), lambda i, k: (prints[i] ^ prints[k]).bit_count() <= radius)
    return {key: (f"{fp:016x}", rows[g][0]) for (key, _), fp, g in zip(rows, prints, groups)}


def base_rules(text):
    own = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    duplicates = len(lines) - len(set(lines))
    grams = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    seen, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if seen[gram] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
    return len(own), sum(map(len, own)), symbols, duplicates, len(covered), failed


def dedupe_lines(rows, width=3):
    """{doc_id: text}, doc_ids being distinct."""
    windows, first, out = {}, {}, {}
    for key, text in sorted(rows):
        lines = (text or "").split("\n")
        at = [i for i, line in enumerate(lines) if words(line)]
        windows[key] = [(tuple(lines[k].strip(" \t\x0b\x0c\r") for k in at[j : j + width]), at[j : j + width]) for j in range(len(at) - width + 1)]
        for j, (w, _) in enumerate(windows[key]):
            first.setdefault(w, (key, j))
    for key, text in rows:
        gone = {i for j, (w, at) in enumerate(windows[key]) if first[w] != (key, j) for i in at}
        keep, drop = [], False
        for i, line in enumerate((text or "").split("\n")):
            drop = i in gone if words(line) else drop
            if not drop:
                keep.append(line)
        out[key] = "\n".join(keep) if text is not None else None
    return out


def pieces(encode, text, most=2048):
    ids = [*encode(text or ""), 0]
    cut = [ids[i : i + most] for i in range(0, len(ids), most)]
    return [(k, k * most, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cut)]
