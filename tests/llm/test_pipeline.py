"""The pipeline against its stages done plainly."""

import corpus_pipeline
from pyspark.sql import functions as F

from loamgrid.llm import mixing, packing, quality_rules
from loamgrid.llm.common import materialise
from tests.llm import brute


def plain_stages(rows):
    """Rows (doc_id, text, source) after each of the first three stages."""
    rules = quality_rules.LineRules()
    judged = [(k, *quality_rules.judge(t, rules), s) for k, t, s in rows]
    one = [(k, clean, s) for k, numbers, clean, s in judged if numbers[6]]
    assert all(not brute.base_rules(t)[-1] for k, t, _ in rows if k in {r[0] for r in one})
    texts = brute.dedupe_lines([r[:2] for r in one])
    two = [(k, texts[k], s) for k, t, s in one if 2 * (len(brute.words(t)) - len(brute.words(texts[k]))) <= len(brute.words(t))]
    groups = brute.near_duplicates([r[:2] for r in two], corpus_pipeline.NEAR_RADIUS)
    return one, two, [r for r in two if groups[r[0]][1] == r[0]]


ODD = [
    (5, "alpha " + " ".join(f"one{i}" for i in range(80)) + ".", "a", 1),
    (5, "beta " + " ".join(f"two{i}" for i in range(80)) + ".", "a", 1),
    (None, "gamma " + " ".join(f"three{i}" for i in range(80)) + ".", None, 1),
    (None, None, "a", None),
    (6, "", "b", 0),
    (7, "same " + " ".join(f"four{i}" for i in range(80)) + ".", "b", 1),
    (7, "same " + " ".join(f"four{i}" for i in range(80)) + ".", "b", 1),
    (8, "same " + " ".join(f"four{i}" for i in range(80)) + ".", "b", 1),
    (9, ". ".join(" ".join(f"v{j}x{i}" for i in range(20)) for j in range(3000)) + ".", "b", 1),
]


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls, repeated doc_ids with other texts, equal rows, a long text, names that stages might use, an empty table."""
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, source string, n_chars bigint")
    docs = docs.withColumns({name: F.lit("own") for name in ("_n", "_k", "row", "size", "pid", "taken", "lang", "component_id", "n", "o", "at")})
    stages = dict(corpus_pipeline.STAGES)
    heads = lambda df: sorted((r["doc_id"] or -1, (r["text"] or "")[:5]) for r in df.collect())
    worded = [(-1, "gamma"), (5, "alpha"), (5, "beta "), (7, "same "), (7, "same "), (8, "same "), (9, "v0x0 ")]
    want = {
        "quality rules": worded,
        "line dedup": sorted([*worded, (-1, ""), (6, "")]),
        "near dedup": [(-1, "gamma"), (5, "alpha"), (5, "beta "), (6, ""), (7, "same "), (9, "v0x0 ")],
    }
    for name, stage in stages.items():
        out = stage(spark, docs, sf_dir)
        if name in want:
            assert heads(out) == want[name], name
        if name == "mixing":
            own = heads(out)
            assert set(own) <= set(worded) and {(5, "alpha"), (-1, "gamma")} <= set(own) and max(map(own.count, own)) <= 6
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == {r[0] for r in ODD}
        else:
            assert out.dtypes == docs.dtypes
            assert all(r["_n"] == r["_k"] == r["row"] == "own" for r in out.collect())
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if name in ("quality rules", "line dedup") and r["text"])
        assert stage(spark, docs.limit(0), sf_dir).collect() == []


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain_stages(rows)):
        after = materialise(stage(spark, docs, sf_dir), "test-stage")
        assert after.columns == docs.columns, name
        assert sorted((r["doc_id"], r["text"], r["source"]) for r in after.collect()) == sorted(want), name
        docs = after
    mixed = corpus_pipeline.mixing(spark, docs, sf_dir).collect()
    taken = {r["doc_id"]: -(-r["taken"] // r["size"]) for r in mixing.mix_documents(docs).collect() if r["taken"]}
    assert len(mixed) == sum(taken.values()) and {r["doc_id"] for r in mixed} == set(taken)
    encode = packing.text_ids(packing.TOKENIZER).tokenizer.encode
    ids = lambda t: encode(t, add_special_tokens=False).ids
    want = sorted((r["doc_id"], *p) for r in mixed for p in brute.pieces(ids, r["text"]))
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(tuple(r[:5]) for r in out) == want
