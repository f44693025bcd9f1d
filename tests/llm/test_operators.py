"""Operators against brute force on the small tables, and on rows with every oddity that they must stand."""

import hashlib
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loamgrid.llm import common, license_scan, media, mixing, packing, quality_rules, resampling, sharding, simhash, url_filter
from loamgrid.llm.line_dedup import dedupe_lines
from loamgrid.llm.queries import QUERIES
from tests.llm import brute

ODD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, "one", None, "a"),
    (3, "one", None, "a"),
    (4, " \t\n ", "en", "b"),
    (5, "x y z. " * 3000, "en", "b"),
    (6, "Ünïcode\x1cwörds and　Σίσυφος <|endoftext|> don't 42 !!", "en", "b"),
    (None, "no id at all\nsecond line\nthird line\nfourth", "en", "c"),
    (7, "a\nb\nc\nd\n\n\na\nb\nc\nlast", "en", "c"),
    (8, "a\0", "en", "c"),
    (9, "a", "en", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    names = ("size", "pid", "unit", "rank", "target", "digest", "fp", "key", "place", "n_removed_lines", "kept", "start")
    return docs.withColumns({name: F.lit("clash") for name in names})


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]


OPERATORS = {
    "packing": lambda d: packing.pack_documents(d),
    "simhash": lambda d: simhash.near_duplicates(d),
    "resampling": lambda d: resampling.resample_documents(d, d.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))),
    "line_dedup": dedupe_lines,
    "quality_rules": quality_rules.judge_documents,
    "clean_rows": quality_rules.clean_rows,
    "license_scan": license_scan.scan_licenses,
    "sharding": sharding.shard_documents,
    "media": media.media_columns,
    "mixing": mixing.mix_documents,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(odd, name):
    out = OPERATORS[name](odd).collect()
    if name not in ("packing", "clean_rows"):
        assert sorted(r["doc_id"] or -1 for r in out) == sorted(k or -1 for k, *_ in ODD)
    assert OPERATORS[name](odd.limit(0)).collect() == []


def packed_whole(out, most):
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(spans[-1]) <= most
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    return by


def test_packing(spark, sf_dir, rows, odd):
    tokenizer = packing.text_ids(packing.TOKENIZER).tokenizer
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    for docs, own in ((spark.read.parquet(f"{sf_dir}/documents.parquet"), rows), (odd, ODD)):
        out = packing.pack_documents(docs).collect()
        want = sorted(((r[0] or -1, *p) for r in own for p in brute.pieces(encode, r[1])))
        assert sorted((r[0] or -1, *r[1:5]) for r in out) == want
        packed_whole(out, 2048)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = packing.pack_documents(docs, with_ids=True, max_len=512).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in out)
    packed_whole(out, 512)
    assert packing.text_ids("byte_bpe_50k.json").of(["a b"]) != []


def test_ids_of_all_code_points():
    words = packing.text_ids(packing.TOKENIZER)
    assert isinstance(words, packing.WordIds)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 15):
        texts = [f"{c} Ab{c}Cd" for c in points[at : at + (1 << 15)]]
        want = words.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(x, "<u4").tolist() for x in words.of(texts)] == [w.ids for w in want]


def test_parts_of_words_are_merged_once():
    words, merged = packing.text_ids(packing.TOKENIZER), []
    merge = words.merge
    words.merge = lambda parts: merged.extend(parts) or merge(parts)
    for texts in (["Abc, d\u00e9j\u00e0", ""], ["abc. D\u00e9j\u00e0!", " ABC\nd\u00e9j\u00e0 abc, it's"], ["ABC! abc"]):
        want = words.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(x, "<u4").tolist() for x in words.of(texts)] == [w.ids for w in want]
    assert sorted(merged) == sorted(["abc", ",", "d\u00e9j\u00e0", ".", "!", "it", "'s"])


def test_a_worker_drops_what_another_operator_kept():
    """A worker outlives its stage: a tokenizer and its words, some 200 MB, went on beside the next operators."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(300))], names=["n"])
    first = common.worker_wide("test", lambda: [1])
    assert common.worker_wide("test", lambda: [2]) is first
    assert sum(part.num_rows for part in common.slices(iter([batch]))) == 300
    assert common.worker_wide("test", lambda: [2]) == [2]
    common._worker().clear()


def test_freed_memory_goes_back():
    """Tokenising tasks leave a worker no larger than what it keeps."""
    size = "import re; now = lambda: int(re.search(r'Rss:\\s+(\\d+)', open('/proc/self/smaps_rollup').read())[1]) // 1024"
    work = "made = [bytes(2000) for _ in range(100_000)]; pins = made[::5000]; full = now(); del made"
    code = f"{size}\nfrom loamgrid.llm.common import give_back\n{work}\ngive_back(); print(full, now())"
    full, after = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, check=True).stdout.split())
    assert full - after > 150


def test_ids_over_generations_and_slices(monkeypatch):
    """Words that are dropped, taken over and learnt again; texts split anywhere; blanks that are not ASCII."""
    rng = random.Random(5)
    own = ["The", "the,", "l'\u00e9t\u00e9", "DON'T", "\u00c9T\u00c9", "x" * 300, "''s", "4\u00b2", "a\u00a0b", "c\x85d", "e\u3000f", "\u0130i", "\u00b5m", "\x00\x7f"]
    own += ["\ufb01n", "e\u0301", "\u4e2d\u6587", "\U0001f600!", "\u00df\u00aa", "\u00ad", "\u2028", "<|endoftext|>", "\u03a3\u03a3", "a\x1cb"]
    words = packing.text_ids(packing.TOKENIZER)
    monkeypatch.setattr(packing, "CACHE_WORDS", 6)
    monkeypatch.setattr(packing, "TAKE_WORDS", 3)
    monkeypatch.setattr(packing, "CALL_PARTS", 2)
    monkeypatch.setattr(packing, "TOKEN_BYTES", 50, raising=False)
    texts = ["".join(rng.choice(own) + rng.choice([" ", "\n", "\t ", "\r\n"]) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    want = [x.ids for x in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [x for at in range(0, 300, 7) for x in words.of(texts[at : at + 7])]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    batch = pa.RecordBatch.from_arrays([pa.array(range(301)), pa.array([*texts, None])], names=["doc_id", "text"])
    assert pa.Table.from_batches(packing._byte_slices(batch)) == pa.Table.from_batches([batch])
    assert list(packing._byte_slices(batch.slice(0, 0))) == []


def plain_two_fit(lengths, most):
    """Bin after bin: fill with the longest that fit, then swap the smallest for the two that leave the least gap."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        bin_, gap = [], most
        while (fits := [x for x in left if x <= gap]) and gap:
            bin_.append(fits[0])
            left.remove(fits[0])
            gap -= fits[0]
        if gap and len(bin_) > 1:
            out = min(bin_)
            sums = [a + b for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= gap + out]
            if max([x for x in left if x <= gap + out] + sums, default=0) > out:
                best = max([*sums, *[x for x in left if x <= gap + out]])
                if best > out and best in sums:
                    bin_.remove(out)
                    left.append(out)
                    a, b = next((a, b) for i, a in enumerate(left) for b in left[i + 1 :] if a + b == best)
                    bin_ += [a, b]
                    left.remove(a)
                    left.remove(b)
                    left.sort(reverse=True)
        bins.append(bin_)
    return bins


@pytest.mark.parametrize("seed", range(3))
def test_packing_against_bin_by_bin(seed):
    rng = random.Random(seed)
    for _ in range(60):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 120))]
        counts = {k: lengths.count(k) for k in set(lengths)}
        patterns = packing.best_two_fit(counts, 40)
        spans = []
        for k, n in counts.items():
            at, offsets = packing.place(np.full(n, k), np.arange(n), patterns)
            spans += [{"sequence_id": b, "offset": o, "length": k} for b, o in zip(at.tolist(), offsets.tolist())]
        held = packed_whole(spans, 40)
        assert len(held) == patterns.n_bins == len(plain_two_fit(lengths, 40))
        fills = lambda bins: sorted(sum(b) for b in bins)
        assert fills([[n for _, n in b] for b in held.values()]) == fills(plain_two_fit(lengths, 40))


def test_best_two_fit():
    """Greedy takes 6 and 3 of 10; the 3 gives way to 2 and 2."""
    patterns = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert patterns.n_bins == 2 and patterns.uses[2] == [(0, 1, 0, 2, 6)]
    random.seed(3)
    counts = {random.randint(1, 300): random.randint(1, 9) for _ in range(80)}
    patterns = packing.best_two_fit(counts, 300)
    spans = []
    for k, n in counts.items():
        bins, offsets = packing.place(np.full(n, k), np.arange(n), patterns)
        spans += [{"sequence_id": b, "offset": o, "length": k} for b, o in zip(bins.tolist(), offsets.tolist())]
    assert len(packed_whole(spans, 300)) == patterns.n_bins <= 1.1 * sum(k * n for k, n in counts.items()) / 300 + 1


def test_simhash(spark, sf_dir, rows, odd):
    for docs, own in ((spark.read.parquet(f"{sf_dir}/documents.parquet"), rows), (odd, ODD)):
        want = brute.near_duplicates([(k, t) for k, t, *_ in dict.fromkeys(own) if k is not None])
        got = {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(docs).collect() if r[0] is not None}
        assert got == want


@pytest.mark.parametrize("radius", range(7))
def test_linked_fingerprints_share_a_key(radius):
    """Whatever bits differ, some choice of blocks avoids them all."""
    blocks, shared = simhash.block_plan(radius)
    assert sum(bits for _, bits in blocks) == 64 and len(blocks) - radius >= shared
    random.seed(radius)
    for _ in range(200):
        touched = {next(i for i, (a, n) in enumerate(blocks) if a <= b < a + n) for b in random.sample(range(64), radius)}
        assert len(blocks) - len(touched) >= shared


def test_simhash_at_a_wider_radius(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = [f"w{i}" for i in range(400)]
    texts = [(10_000 + k, " ".join("x" if i in {37 * j + k for j in range(k)} else w for i, w in enumerate(words))) for k in range(12)]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + texts
    got = {r[0]: r[2] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()}
    assert got == {k: c for k, (_, c) in brute.near_duplicates(rows, 4).items()}
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs, 7)


@pytest.mark.parametrize("seed", range(4))
def test_bk_tree_links_what_all_pairs_link(seed):
    random.seed(seed)
    centres = [random.getrandbits(64) for _ in range(6)]
    values = {c ^ sum(1 << random.randrange(64) for _ in range(random.randrange(5))) for c in centres for _ in range(60)}
    values = sorted(v & (1 << 64) - 1 for v in values)
    links = set(simhash.links_within(values, 2))
    near = lambda i, k: (values[i] ^ values[k]).bit_count() <= 2
    assert all(near(i, k) for i, k in links)
    pairs = links | {(k, i) for i, k in links}
    assert brute.components(len(values), near) == brute.components(len(values), lambda i, k: (i, k) in pairs)


@pytest.mark.parametrize("radius, dense", [(2, 20), (2, 300), (4, 60)])
def test_dense_keys_are_split(spark, radius, dense):
    """Fingerprints that share most bits, in keys of more than ``dense``, link as all pairs do."""
    random.seed(radius * 7 + dense)
    centres = [random.getrandbits(64) for _ in range(3)]
    values = {c ^ sum(1 << b for b in random.sample(range(64), random.randrange(6))) for c in centres for _ in range(150)}
    values |= {centres[0] ^ (k << 20) for k in range(150)}
    values = sorted(values)
    nodes = spark.createDataFrame([(simhash.signed(v), i) for i, v in enumerate(values)], "fp bigint, rep bigint").repartition(3)
    links = {tuple(r) for r in simhash.shard_links(nodes, radius, dense).collect()}
    near = lambda i, k: (values[i] ^ values[k]).bit_count() <= radius
    assert all(i < k and near(i, k) for i, k in links)
    assert brute.components(len(values), near) == brute.components(len(values), lambda i, k: (k, i) in links)


@pytest.mark.parametrize("radius", [2, 4, 6])
def test_finer_masks_hold_linked_fingerprints(radius):
    random.seed(radius)
    for _ in range(100):
        mask = sum(1 << b for b in random.sample(range(64), random.randrange(45)))
        free = [b for b in range(64) if not mask >> b & 1]
        apart = sum(1 << b for b in random.sample(free, radius))
        masks = simhash.finer_masks(mask, radius)
        assert all(m & mask == mask and m != mask for m in masks) and any(not m & apart for m in masks)


def test_components(spark):
    random.seed(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (5, 150)]
    random.shuffle(edges)
    out = dict(tuple(r) for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert all(out.get(n, n) == (0 if n < 200 else 200) for e in edges for n in e)


def test_line_dedup(spark, sf_dir, rows, odd):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in dedupe_lines(docs).collect()}
    assert got == brute.dedupe_lines([r[:2] for r in rows])
    out = dedupe_lines(odd)
    assert out.columns[: len(SCHEMA.split(","))] == ["doc_id", "text", "lang", "source"]
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[7] == "a\nb\nc\nd\n\n\nlast" and got[1] is None and got[None].startswith("no id")
    four = [(1, "k1\nk2\nk3\nk4\nown"), (2, "x\nk1\nk2\n\nk3\nk4\n\ny"), (3, "k1\nk2")]
    got = {r["doc_id"]: r["text"] for r in dedupe_lines(spark.createDataFrame(four, "doc_id bigint, text string")).collect()}
    assert got == {1: four[0][1], 2: "x\ny", 3: "k1\nk2"}


def test_quality_rules(spark, sf_dir, rows, odd):
    for docs, own in ((spark.read.parquet(f"{sf_dir}/documents.parquet"), rows), (odd, ODD)):
        out = quality_rules.judge_documents(docs).collect()
        assert sorted((r[0] or -1, *r[1:7]) for r in out) == sorted((k or -1, *brute.base_rules(t)) for k, t, *_ in own)
    body = " ".join(f"word{i} stands" for i in range(40)) + "."
    verdict = lambda text: quality_rules.judge(text, quality_rules.LineRules())
    numbers, clean = verdict(f"Home\n{body}\nClick here to sign in.\nWOW!! BUY!! NOW!!\n{body[5:]}")
    assert numbers[8:11] == [1, 1, 1] and clean == f"{body}\n{body[5:]}"
    assert verdict(body)[0][6] and not verdict(body.replace(" ", " $$$ "))[0][6]


def test_quality_rules_on_labels(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules.judge_documents(docs).join(labels, "doc_id").filter("not base_failed").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert not any(r["kept"] for r in rows if r["quality"] == 0)


def test_license_scan(spark):
    mit = license_scan.SENTENCES
    texts = {
        1: "Own words first.\nReleased under the MIT License.",
        2: "prose. This work is licensed under the GNU General Public\nLicense, version 3. More prose.",
        3: f"Header\n\n{mit['mit-grant']}\n\n{mit['mit-condition']}\n\n{mit['as-is']}",
        4: f"{mit['bsd-grant']}\n\n1. {mit['bsd-source']}\n2. {mit['bsd-binary']}\n3. {mit['bsd-endorse']}",
        5: f"{mit['bsd-grant']}\n\n{mit['bsd-source']}\n{mit['bsd-binary']}\n",
        6: "The licence of a poet; released under no licence",
        7: None,
        8: "LICENSED under the apache license, version 2.0!\nand Released under the MIT License",
    }
    out = license_scan.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    got = {r["doc_id"]: r["licenses"] for r in out}
    assert got == {1: "MIT", 2: "GPL-3.0", 3: "MIT", 4: "BSD-3-Clause", 5: "BSD-2-Clause", 6: "", 7: "", 8: "Apache-2.0"}
    import re

    assert all(re.search(license_scan.ANCHOR, s) for s in license_scan.known_table())


def test_short_license_notices(spark):
    texts = {
        1: ("Own words first.\nLicensed under CC BY-NC 4.0.\nMore.", "CC-BY-NC-4.0"),
        2: ("This work is licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        3: ("Released under the CC BY-NC-ND 3.0 license", "CC-BY-NC-ND-3.0"),
        4: ("// SPDX-License-Identifier: MIT\nint main() { return 0; }", "MIT"),
        5: ("# SPDX-License-Identifier: GPL-3.0-or-later\n\nimport os\n", "GPL-3.0"),
        6: ("This work is licensed under CC0 1.0.", "CC0-1.0"),
        7: ("Er ging\nmit\nihr. The licence of a poet.", ""),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id bigint, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan_licenses(docs).collect()}
    assert got == {k: name for k, (_, name) in texts.items()}


def test_licenses_with_holders_and_bodies(spark):
    s = license_scan.SENTENCES
    bsd = [s["bsd-grant"], s["bsd-source"], s["bsd-binary"]]
    end = "may be used to endorse or promote products derived from this software without specific prior written permission."
    body = " ".join(f"Clause {k} of this text grants a {w} right and no other one." for k, w in enumerate("red green blue grey pink teal lime navy gold plum".split()))
    texts = {
        1: ("\n".join([*bsd, f"Neither the name of Example University nor the names of its contributors {end}", s["bsd-as-is"]]), "BSD-3-Clause"),
        2: ("\n".join([*bsd, f"Neither the name of Example Inc. nor the names of its contributors {end}"]), "BSD-3-Clause"),
        3: (s["mit-grant"] + "\n" + s["mit-condition"] + "\n" + s["as-is"] + " " + s["mit-liable"], "MIT"),
        4: ("Preamble\n" + s["gpl3-kind"], "GPL-3.0"),
        5: (s["agpl-free"], "AGPL-3.0"),
        6: (s["lgpl-free"] + " " + s["gpl-hope"], "LGPL-3.0"),
        7: ("Before. " + body + " After.", ""),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id bigint, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan_licenses(docs).collect()}
    assert got == {k: name for k, (_, name) in texts.items()}
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan_licenses(docs, {"Own-1.0": body}).collect()}
    assert got == {k: name or "Own-1.0" for k, (_, name) in texts.items()}


def test_every_license_line_of_the_tables_is_known(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("text")).filter("lower(text) like '%licen%'").distinct()
    out = license_scan.scan_licenses(lines.select(F.lit(1).alias("doc_id"), "text")).collect()
    assert len(out) >= 4 and all(r["licenses"] for r in out)


def test_sharding(spark, sf_dir, rows, odd):
    out = sharding.shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4).collect()
    texts = {k: t for k, t, _ in rows}
    shards, bytes_ = {}, [0] * 4
    for r in out:
        shards.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
        bytes_[r["shard"]] += len(texts[r["doc_id"]].encode()) + 1
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    assert all(len(s) == 1 for s in shards.values()) and len(out) == len(rows)
    assert max(bytes_) - min(bytes_) < 0.02 * sum(bytes_) / 4
    for s in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    hot = spark.createDataFrame([(i, "same" if i % 3 else f"text {i}") for i in range(3000)], "doc_id bigint, text string")
    sizes = [r["n"] for r in sharding.shard_documents(hot, 8).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.1 * sum(sizes) / 8


def test_sharding_against_group_by_group(spark):
    """The groups themselves, sorted by size, each into the tightest shard: the same bytes in every shard."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = sharding.shard_documents(docs, 8).collect()
    groups, held = {}, {}
    for r in docs.collect():
        groups[r["text"]] = groups.get(r["text"], 0) + len(r["text"].encode()) + 1
    sizes = sorted(groups.values(), reverse=True)
    capacity, _ = sharding.least_capacity([(n, 1) for n in sizes], 8)
    plain, left = [], []
    for n in sizes:
        fits = [(room, b) for b, room in enumerate(left) if room >= n]
        b = min(fits)[1] if fits else len(left)
        if not fits:
            left.append(capacity)
            plain.append(0)
        left[b] -= n
        plain[b] += n
    for r in out:
        held[r["shard"]] = held.get(r["shard"], 0) + r["size"]
    assert len(plain) <= 8 and sorted(held.values()) == sorted(plain)


def test_size_classes(spark):
    sizes = [1, sharding.EXACT_SIZE, sharding.EXACT_SIZE + 1, 12_345_678, 2**40 + 1, 2**41 - 1]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in sizes], "n bigint").select(sharding.size_class(F.col("n"))).collect()]
    assert got[:2] == sizes[:2] and all(n <= c <= n * (1 + 2.0**-10) for n, c in zip(sizes, got))
    assert all(c % 2 ** (c.bit_length() - sharding.SIZE_BITS - 1) == 0 for c in got[2:])


@pytest.mark.parametrize("seed", range(3))
def test_counts_fill_as_items_do(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.choice([1, 2, 3, 17, 40, 41, 90]) for _ in range(200)), reverse=True)
    units = [(n, sizes.count(n)) for n in sorted(set(sizes), reverse=True)]
    loose = [b for own in sharding.fill_counts(units, 120) for b, n in own for _ in range(n)]
    assert loose == sharding.best_fit_decreasing(sizes, 120)


def test_best_fit_decreasing():
    random.seed(2)
    sizes = sorted((random.randint(1, 60) for _ in range(300)), reverse=True)
    bins = sharding.best_fit_decreasing(sizes, 100)
    plain, out = [], []
    for s in sizes:
        fits = [(left, b) for b, left in enumerate(plain) if left >= s]
        b = min(fits)[1] if fits else len(plain)
        plain = [*plain, 100] if not fits else plain
        plain[b] -= s
        out.append(b)
    assert bins == out


def test_mixing(spark, sf_dir, rows):
    out = mixing.mix_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    size = {k: len(brute.words(t)) for k, t, _ in rows}
    total, block = sum(size.values()), max(1, sum(size.values()) // mixing.MAX_BLOCKS)
    goals, taken = {}, {}
    for r in out:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"]
        goals[r["source"]] = r["target"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert abs(sum(goals.values()) - total) < 1e-6 * total
    assert all(abs(goals[s] - taken[s]) <= 2 * block for s in goals)


@pytest.mark.parametrize("n_shards, block", [(1, 7), (5, 1), (5, 64), (16, 1024)])
def test_mixing_against_words_dealt_one_by_one(spark, n_shards, block):
    rng = random.Random(n_shards)
    size = lambda: rng.choice([0, 1, 3, 40, 300])
    docs = [(i, " w" * size(), rng.choice(["hot"] * 6 + ["a", "b", None])) for i in range(150)] + [(7, "again", "a")] * 2 + [(200, None, "empty")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(5)
    out = mixing.mix_documents(table, n_shards=n_shards, block_words=block).collect()
    again = mixing.mix_documents(table.repartition(3), n_shards=n_shards, block_words=block).collect()
    assert sorted(out, key=repr) == sorted(again, key=repr) and len(out) == len(docs)
    totals = sorted({(r["source"], r["source_size"]) for r in out}, key=lambda x: (x[0] is None, x[0] or ""))
    shard_sums = [sum(r["shard_taken"][j] for r in out) for j in range(n_shards)]
    assert max(shard_sums) - min(shard_sums) <= 1 and sum(shard_sums) == sum(n for _, n in totals)
    for name, n, goal, quota, shares in mixing.plan_mix(totals, (5, 2, 1), 3, n_shards).sources:
        rows = sorted((r for r in out if r["source"] == name and r["size"]), key=lambda r: r["start"])
        cycle = [k for k, r in enumerate(rows) for _ in range(r["size"])]
        assert len(cycle) == n and [r["start"] for r in rows] == [cycle.index(k) for k in range(len(rows))]
        served = (cycle * 4)[:quota]
        blocks = [served[i : i + block] for i in range(0, quota, block)]
        a, c = mixing.block_order(name, quota, block, 17)
        places = [(a * b + c) % len(blocks) for b in range(len(blocks))]
        assert sorted(places) == list(range(len(blocks)))
        line = [k for _, b in sorted(zip(places, range(len(blocks)))) for k in blocks[b]]
        want, at = [[0] * n_shards for _ in rows], 0
        for j, q in enumerate(shares):
            for k in line[at : at + q]:
                want[k][j] += 1
            at += q
        assert [r["shard_taken"] for r in rows] == want and [r["taken"] for r in rows] == list(map(sum, want))


def test_sainte_lague_against_plain_quotients():
    rng = random.Random(8)
    for _ in range(100):
        goals = [rng.random() * 50 for _ in range(rng.randint(1, 6))]
        most = [rng.randint(0, 40) for _ in goals]
        seats, won, plain = rng.randint(0, 60), [0] * len(goals), []
        for _ in range(seats):
            open_ = [i for i in range(len(goals)) if won[i] < most[i] and goals[i] > 0]
            if not open_:
                break
            i = max(open_, key=lambda i: (goals[i] / (2 * won[i] + 1), -i))
            won[i] += 1
            plain.append(i)
        assert mixing.sainte_lague(goals, seats, most) == plain


def test_apportionment():
    assert mixing.targets([10, 100, 100], [5, 2, 1], 210, 3) == [30, 120, 60]
    goals, most = [53.0, 24.0, 23.0], [99, 99, 99]
    awards = mixing.sainte_lague(goals, 7, most)
    assert [awards.count(i) for i in range(3)] == [3, 2, 2]
    plan = mixing.plan_mix([("a", 1000), ("b", 500), (None, 10)], (5, 2, 1), 3, 4)
    assert plan.sources[2][3] * plan.block <= 30 and all(sum(q) == n for *_, n, q in plan.sources)


def test_apportionment_serves_small_sources():
    """Sources far below total / MAX_BLOCKS beside a hot one, and more sources than MAX_BLOCKS."""
    small = [(f"s{i:04}", 1 + 7 * i) for i in range(300)]
    for totals in ([("hot", 10**10), *small], [(f"s{i:06}", 30) for i in range(mixing.MAX_BLOCKS + 5000)]):
        plan = mixing.plan_mix(totals, (5, 2, 1), 3, 16)
        assert sum(n for *_, n, _ in plan.sources) * plan.block == sum(s for _, s in totals)
        assert all(abs(n * plan.block - goal) <= 2 for _, _, goal, n, _ in plan.sources)
        assert all(sum(q) == n <= 3 * s for _, s, _, n, q in plan.sources)
        shards = [sum(q[j] for *_, q in plan.sources) for j in range(16)]
        assert max(shards) - min(shards) <= 1


def test_first_seats_are_those_of_the_highest_quotients():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.choice([1, 5, 60, 900]) for _ in range(rng.randrange(1, 9))]
        total, most = sum(sizes), [3 * s for s in sizes]
        goals = mixing.targets(sizes, [rng.random() + 0.1 for _ in sizes], total, 3)
        whole = mixing.sainte_lague(goals, total, most)
        first = mixing.first_seats(goals, total - rng.randrange(9), most)
        rest = mixing.sainte_lague(goals, total - sum(first), most, first)
        assert [n + rest.count(i) for i, n in enumerate(first)] == [whole.count(i) for i in range(len(sizes))]


def test_media(spark, sf_dir, rows, odd):
    for docs, own in ((spark.read.parquet(f"{sf_dir}/documents.parquet"), rows), (odd, ODD)):
        want = []
        for k, t, *_ in own:
            raw = (t or "").encode()
            payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
            want.append((k or -1, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])))
        out = media.media_columns(docs, media.Cuts(256, 8, 4096)).collect()
        assert sorted((r[0] or -1, *r[1:5]) for r in out) == sorted(want)
    gear, cuts = media.gear_table(), media.Cuts(64, 6, 512)
    raw = random.Random(1).randbytes(20_000)
    ends = media.chunk_ends(raw, cuts, gear)
    lengths = np.diff([0, *ends])
    assert ends[-1] == len(raw) and lengths.max() <= 512 and lengths[:-1].min() >= 64
    shifted = media.chunk_ends(b"prefix" + raw, cuts, gear)
    assert len({e - 6 for e in shifted} & set(ends)) > 0.9 * len(ends)
    mask, start, slow, h = 63, 0, [], 0
    for i, byte in enumerate(raw):
        h = (h << 1) + int(gear[byte]) & 0xFFFFFFFF
        if i + 1 - start == 512 or (i + 1 - start >= 64 and h & mask == 0):
            start = i + 1
            slow.append(start)
    assert ends == (slow if slow[-1] == len(raw) else [*slow, len(raw)])


def test_media_store_shares_chunks(spark):
    base = "".join(random.Random(4).choice("abcdefgh \n") for _ in range(30_000))
    docs = spark.createDataFrame([(1, base), (2, base), (3, base[:20_000] + "tail"), (4, "own")], "doc_id bigint, text string")
    store = media.store_media(docs.repartition(4), media.Cuts(512, 9, 4096))
    refs = store.lists.join(store.chunks, "digest", "left")
    assert refs.filter("frame is null").isEmpty()
    assert store.chunks.count() == store.chunks.select("digest").distinct().count() < store.lists.count()


def test_resampling_tells_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    out = resampling.resample_documents(docs, train)
    rows = out.join(held, "doc_id").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    right = sum(r["log_weight"] > b["log_weight"] for r in good for b in bad) / (len(good) * len(bad))
    assert right > 0.98
    kept = lambda rows: sum(r["kept"] for r in rows) / len(rows)
    assert kept(good) > 0.95 and kept(bad) < 0.1
    ranks = sorted(r["rank"] for r in out.collect())
    assert ranks == list(range(1, len(ranks) + 1))
    keys = [r["key"] for r in out.orderBy("rank").collect()]
    assert keys == sorted(keys, reverse=True)


def test_url_filter(spark):
    link = lambda *hosts: "".join(f'<p><a class=x href="https://{h}/p">l</a>' for h in hosts)
    pages = [
        (1, "http://a.bad.net/x", link("b.com")),
        (2, "https://WWW.Site.NET/en/1?q#f", ""),
        (3, "http://sub.example.net/en/2", link("friend.com")),
        (4, "http://www.example.com/de/3", ""),
        (5, "http://w.org/fr/", link("friend.com", "w.org")),
        (6, "http://friend.com/z", link("c.com")),
        (7, "http://linker.com/?x=http://y.net/", link("a.bad.net", "a.bad.net")),
        (8, "http://c.com", None),
        (9, None, "<a href='/de'>"),
        (10, "no scheme", ""),
        (11, "ftp://far.com#x", link("linker.com")),
        (11, "ftp://far.com#x", link("linker.com")),
    ]
    out = url_filter.filter_urls(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == {
        1: ("a.bad.net", "/x", "net/", "block"),
        2: ("www.site.net", "/en/1", "net/", "block"),
        3: ("sub.example.net", "/en/2", "example.net/en/", "allow"),
        4: ("www.example.com", "/de/3", "example.com/de/", "block"),
        5: ("w.org", "/fr/", "org/fr/", "allow"),
        6: ("friend.com", "/z", None, "allow"),
        7: ("linker.com", "/", None, "block"),
        8: ("c.com", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("", "", None, "allow"),
        11: ("far.com", "", None, "block"),
    }
    assert out.count() == len(pages)
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert url_filter.filter_urls(empty).collect() == []


def test_link_graph_against_a_matrix(spark):
    random.seed(9)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(a, b): random.randint(1, 3) for a in hosts for b in random.sample(hosts, 3) if a != b}
    w = np.zeros((12, 12))
    for (a, b), n in edges.items():
        w[hosts.index(a), hosts.index(b)] = n
    t0, d0 = np.eye(12)[0], np.eye(12)[5]
    t, d = t0, d0
    forward = w / np.maximum(w.sum(1, keepdims=True), 1)
    back = w / np.maximum(w.sum(0, keepdims=True), 1)
    for _ in range(8):
        t, d = 0.15 * t0 + 0.85 * t @ forward, 0.15 * d0 + 0.85 * back @ d
    rows = [(a, b, float(n)) for (a, b), n in edges.items()]
    seeds = spark.createDataFrame([("h0", 1.0, 0.0), ("h5", 0.0, 1.0)], "host string, trust double, distrust double")
    got = url_filter.propagate(spark.createDataFrame(rows, "src string, dst string, w double"), seeds, 0.85, 8, 0.0)
    for r in got.collect():
        i = hosts.index(r["host"])
        assert abs(r["trust"] - t[i]) < 1e-9 and abs(r["distrust"] - d[i]) < 1e-9


def test_small_shares_reach_distant_hosts(spark):
    """A seed of a millionth of all distrust, at the end of a chain of links."""
    edges = spark.createDataFrame([(f"h{k + 1}", f"h{k}", 1.0) for k in range(12)], "src string, dst string, w double")
    seeds = spark.createDataFrame([("h0", 0.0, 1e-6), ("big", 1.0, 1 - 1e-6)], "host string, trust double, distrust double")
    scores = {r["host"]: r["distrust"] for r in url_filter.propagate(edges, seeds, 0.85, 30, 1e-7).collect()}
    assert all(abs(scores[f"h{k}"] / (0.15e-6 * 0.85**k) - 1) < 1e-9 for k in range(12))


def test_links_behind_long_attributes():
    import re

    assert re.findall(url_filter.LINK, f'<a title="{"x" * 5000}" href="http://far.net/y">') == ["far.net"]


def test_queries_have_their_columns(spark, sf_dir):
    want = {
        "op1": "doc_id piece start length ids_crc32 sequence_id offset",
        "op2": "doc_id fingerprint component_id",
        "op5": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op7": "doc_id size text_crc32 law shard slot grown_shard",
        "op8": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
        "op9": "doc_id size source_size target taken",
        "op10": "page_id host path rule verdict",
    }
    for name, query in QUERIES.items():
        columns = query(spark, sf_dir).columns
        assert set(want.get(name.split("_")[0], "doc_id").split()) <= set(columns)


def test_walks_end_at_their_tolerance_or_raise(spark):
    edges = spark.createDataFrame([(f"h{k}", f"h{(k + 1) % 9}", 1.0) for k in range(9)], "src string, dst string, w double")
    seeds = spark.createDataFrame([("h0", 1.0, 0.0), ("h4", 0.0, 1.0)], "host string, trust double, distrust double")
    with pytest.raises(RuntimeError):
        url_filter.propagate(edges, seeds, 0.5, 5, 1e-6, strict=True)
    scores = {r["host"]: r["trust"] for r in url_filter.propagate(edges, seeds, 0.5, 1000, 1e-4, strict=True).collect()}
    assert all(abs(scores[f"h{k}"] / (0.5 * 0.5**k / (1 - 0.5**9)) - 1) < 1e-3 for k in range(9))


def test_mass_of_hosts_without_links_returns_to_the_seeds(spark):
    """a -> b, a -> c, b -> a; c ends the walk: the scores are those of a walk that jumps from c to the seed."""
    edges = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 1.0), ("b", "a", 1.0)], "src string, dst string, w double")
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "host string, trust double, distrust double")
    got = {r["host"]: r["trust"] for r in url_filter.whole(url_filter.propagate(edges, seeds, 0.5, 1000, 1e-4)).collect()}
    step, x = np.array([[0, 0.5, 0.5], [1, 0, 0], [1, 0, 0]]), np.array([1.0, 0, 0])
    for _ in range(300):
        x = 0.5 * np.array([1.0, 0, 0]) + 0.5 * x @ step
    assert all(abs(got[h] - x[i]) < 1e-3 for i, h in enumerate("abc"))


def test_url_filter_on_many_linked_hosts(spark):
    """100,000 hosts and some 300,000 links between them, against power iteration over arrays."""
    n, per = 100_000, 3
    to = lambda k: (F.col("id") * (2 * k + 3) * 7919 + F.col("id") * F.col("id") * (k + 1)) % n
    host = lambda i: F.concat(F.lit("h"), i.cast("string"), F.when(i % 50 == 0, ".org").when(i % 37 == 0, ".net").otherwise(".com"))
    links = F.concat(*[F.concat(F.lit('<a href="http://'), host(to(k)), F.lit('/">x</a>')) for k in range(per)])
    pages = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), host(F.col("id")), F.lit("/fr/")).alias("url"), links.alias("html"))
    got = sorted(url_filter.filter_urls(pages, damping=0.5, tolerance=1e-4).select("page_id", "verdict", "trust", "distrust").collect())
    i = np.arange(n, dtype=np.int64)
    pairs = np.unique(np.concatenate([np.stack([i, (i * (2 * k + 3) * 7919 + i * i * (k + 1)) % n]) for k in range(per)], axis=1), axis=1)
    src, dst = pairs[:, pairs[0] != pairs[1]]
    out, into = np.bincount(src, minlength=n), np.bincount(dst, minlength=n)
    good, bad = (i % 50 == 0).astype(float), ((i % 37 == 0) & (i % 50 != 0)).astype(float)
    t0, d0 = good / good.sum(), bad / bad.sum()
    t, d = t0, d0
    for _ in range(200):
        t = 0.5 * t0 + 0.5 * np.bincount(dst, (t / np.maximum(out, 1))[src], n)
        d = 0.5 * d0 + 0.5 * np.bincount(src, (d / np.maximum(into, 1))[dst], n)
    t, d = t / t.sum(), d / d.sum()
    trust, distrust = np.array([r["trust"] for r in got]), np.array([r["distrust"] for r in got])
    assert np.allclose(trust, t, rtol=2e-3, atol=1e-12) and np.allclose(distrust, d, rtol=2e-3, atol=1e-12)
    verdict = np.where(good > 0, "allow", np.where(bad > 0, "block", np.where(d > t, "block", "allow")))
    near = np.abs(d - t) < 2e-3 * (d + t)
    wrong = np.array([r["verdict"] for r in got]) != verdict
    assert not (wrong & ~near).any() and len(set(verdict[(good == 0) & (bad == 0)])) == 2


def test_line_dedup_tells_rows_of_one_doc_id_apart(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (2, "own1\nown2\nown3\nown4\nown5"), (3, "p\nq\nr"), (3, "p\nq\nr"), (None, "n\na\nb\nc"), (None, "u\nv\nw")]
    out = dedupe_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    got = sorted(((r["doc_id"] or 9, r["text"]) for r in out.collect()))
    assert got == [(1, rows[0][1]), (2, rows[2][1]), (2, "x\ny"), (3, ""), (3, "p\nq\nr"), (9, "n"), (9, "u\nv\nw")]


def test_long_texts_are_read_in_parts(rows, monkeypatch):
    """The same results however few words are objects at a time."""
    texts = [t for _, t, *_ in rows] + [t for _, t, *_ in ODD] + ["w" * 50, "a b " * 40 + "\n" + "x\t" * 30, "one\n two \n\n" * 9]
    rules = quality_rules.LineRules()

    def counts(t):
        out = Counter()
        for words, after in resampling.parts(t):
            out.update(resampling.buckets(words + after, resampling.WordHashes()).tolist())
            out.subtract(resampling.buckets(after, resampling.WordHashes()).tolist())
        return {k: n for k, n in out.items() if n}

    prints = lambda: [simhash.fingerprint(simhash.shingle_hashes(t or "")) for t in texts]
    want = [quality_rules.judge(t, rules) for t in texts], prints(), [counts(t) for t in texts[-30:]]
    for module in (quality_rules, simhash, resampling):
        assert module.word_parts is common.word_parts
    monkeypatch.setattr(common, "PART_CHARS", 7)
    monkeypatch.setattr(quality_rules, "LONG_TEXT", 1)
    monkeypatch.setattr(quality_rules, "LONG_LINE", 11)
    assert [w for t in texts for part in common.word_parts(t or "") for w in part] == [w.encode() for t in texts for w in brute.words(t)]
    got = [quality_rules.judge(t, rules) for t in texts], prints(), [counts(t) for t in texts[-30:]]
    assert got == want


def test_a_text_of_many_megabytes():
    """Memory beyond the text itself stays a small multiple of it."""
    import tracemalloc

    line = " ".join(f"word{i % 9973}x{i}" for i in range(4000)) + ".\n"
    text = line * 200
    tracemalloc.start()
    numbers, _ = quality_rules.judge(text, quality_rules.LineRules())
    judged = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    simhash.fingerprint(simhash.shingle_hashes(text))
    printed = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert numbers[0] == 800_000 and numbers[4] == 800_000 and numbers[3] == 199
    assert judged < 8 * len(text) and printed < 40e6 + 2 * len(text)


def test_line_rules_of_four_languages():
    fails = lambda line: quality_rules.judge(line, quality_rules.LineRules())[0][8:11]
    for line in ("Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.", "All rights reserved.", "Zur Datenschutzerklärung.", "LEER MÁS!"):
        assert fails(line) == [0, 0, 1], line
    assert fails("Startseite") == [0, 1, 0]
    assert fails("This sentence of some words just breaks off in the") == [1, 0, 0]
    assert fails("This sentence of some words comes to its end.") == [0, 0, 0]


def test_resampling_against_a_plain_version(spark):
    import math

    import xxhash

    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(vocabulary[:20] if i % 3 else vocabulary[10:], k=rng.randrange(12)))) for i in range(60)] + [(60, None), (5, "twice  twice"), (None, "w1 w2")]
    labels = [(i, int(i % 3 == 0), int(i % 12 == 0)) for i in range(0, 60, 2)]
    bits, seed = 6, 11
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    out = resampling.resample_documents(table, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), seed=seed, bits=bits).collect()

    def grams(text):
        one = [xxhash.xxh64_intdigest(w.encode(), resampling.SEED) for w in brute.words(text)]
        for a in one:
            yield a >> (64 - bits)
        for a, b in zip(one, one[1:]):
            x = (a * 0x9E3779B97F4A7C15 % 2**64) ^ b
            yield ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % 2**64) >> (64 - bits)

    target = {k for k, quality, toxic in labels if quality and not toxic}
    raw, fine = [1] * 2**bits, [1] * 2**bits
    for k, t in docs:
        for g in grams(t):
            raw[g] += 1
            fine[g] += k in target
    ratio = [math.log(f / sum(fine)) - math.log(r / sum(raw)) for f, r in zip(fine, raw)]
    want = []
    for k, t in docs:
        noise = int.from_bytes(hashlib.blake2b(f"{seed}:{k}".encode(), digest_size=8).digest(), "big")
        weight = sum(ratio[g] for g in grams(t))
        want.append((weight - math.log(-math.log((noise + 0.5) / 2**64)), k, weight, len(brute.words(t))))
    want.sort(key=lambda x: (-x[0], x[1] is not None, x[1]))
    kept = round(len(docs) * sum(q for _, q, _ in labels) / len(labels))
    out.sort(key=lambda r: r["rank"])
    assert [(r["doc_id"], r["n_words"], r["rank"], r["kept"]) for r in out] == [(k, n, i + 1, i < kept) for i, (_, k, _, n) in enumerate(want)]
    assert all(abs(r["key"] - x[0]) < 1e-9 and abs(r["log_weight"] - x[2]) < 1e-9 for r, x in zip(out, want))


def test_media_against_a_plain_version(spark):
    import math
    import struct

    import zstandard

    rng = random.Random(10)
    cuts, gear = media.Cuts(64, 6, 512), media.gear_table()
    long = "".join(rng.choice("abcdé \n") for _ in range(6000))
    docs = [(1, long), (2, long), (3, "short"), (4, None), (5, ""), (6, long[:3000] + "changed" + long[3000:]), (None, "short"), (7, "x" * 2000)]
    out = media.media_columns(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), cuts).collect()
    want = []
    for k, t in docs:
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        at, stored, chunks = 0, b"CDC1", 0
        for end in media.chunk_ends(payload, cuts, gear):
            frame = zstandard.ZstdCompressor(level=6, write_content_size=True).compress(payload[at:end])
            stored, at, chunks = stored + struct.pack("<I", len(frame)) + frame, end, chunks + 1
        shares = [payload.count(b) / len(payload) for b in set(payload)]
        feature = f"samples={len(payload)};chunks={chunks};mean_milli={sum(payload) * 1000 // len(payload)};peak={max(payload)};distinct={len(shares)};"
        feature += f"entropy={-sum(p * math.log2(p) for p in shares) + 0.0:.4f}"
        want.append((k or -1, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature))
    assert sorted((r[0] or -1, *r[1:]) for r in out) == sorted(want)


def test_stable_rows(spark, sf_dir):
    scan = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert common.stable_rows(scan, "t") is scan
    for other in (scan.repartition(2), scan.withColumn("r", F.rand()), scan.limit(3), spark.createDataFrame([(1,)], "a int")):
        assert common.stable_rows(other, "t") is not other
