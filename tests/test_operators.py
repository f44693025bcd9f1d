"""Operators whose refusals, ties and unknowns the queries do not show."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from loamgrid.operators import joins as J
from loamgrid.operators import shape as S
from loamgrid.sources import readers, writers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_join_refuses_ties_that_differ(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "2024-01-01", 5), (1, "2024-01-01", 5), (1, "2023-01-01", 9)], "k int, at string, v int")
    assert rows(J.latest_join(left, right, "k", "at", ["v"])) == [(1, "2024-01-01", 5), (2, None, None)]
    with pytest.raises(J.ConflictError):
        J.latest_join(left, right.union(spark.createDataFrame([(1, "2024-01-01", 6)], right.schema)), "k", "at", ["v"])


def test_preconditions_and_unique_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 3), (None, 4)], "key string, id int")
    assert rows(J.unique_keys(df, "key", "id")) == [("b", 3)]
    J.require_columns(df, key="string")
    with pytest.raises(J.ConflictError):
        J.require_columns(df, key="int")


def test_cascade_passes_over_ambiguous_keys(spark):
    left = spark.createDataFrame([(1, "l1", "p1"), (2, None, "p2"), (3, "lx", None), (4, "dup", "p2")], "id int, lic string, ph string")
    right = spark.createDataFrame([(10, "l1", "p9"), (11, "dup", "p2"), (12, "dup", "p3")], "co int, lic string, ph string")
    out = J.cascade_match(left, "id", right, "co", [("lic", "license", 1.0), ("ph", "phone", 0.95)])
    assert sorted(rows(out), key=lambda r: r[0]) == [(1, 10, "license", 1.0), (2, 11, "phone", 0.95), (3, None, None, None), (4, 11, "phone", 0.95)]


def test_fuzzy_is_for_review_only(spark):
    left = spark.createDataFrame([(1, "APEX ROOF"), (2, "ZEBRA"), (3, "ALPHA TEAM")], "id int, name string")
    right = spark.createDataFrame([(7, "APEX ROOFS"), (8, "ALPHA TEAMS"), (9, "ALPHA TEAMZ")], "co int, name string")
    out = {r["id"]: (r["candidate"], r["status"]) for r in J.fuzzy_candidates(left, right, "id", "co", "name", F.substring("name", 1, 1)).collect()}
    assert out == {1: (7, "review"), 3: (8, "ambiguous")}


def test_two_pass_and_references(spark):
    right = spark.createDataFrame([("p", "x", 1), ("p", "y", 2), ("q", "z", 3)], "a string, b string, id int")
    left = spark.createDataFrame([("p", "x"), ("q", "?"), ("p", "?")], "a string, b string")
    out = {(r["a"], r["b"]): r["id"] for r in J.two_pass_match(left, right, "a", "b", "id").collect()}
    assert out == {("p", "x"): 1, ("q", "?"): 3, ("p", "?"): None}


def test_dedupe_and_merge(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert rows(S.dedupe_or_raise(df, ["k"])) == [(1, "a"), (2, "b")]
    with pytest.raises(J.ConflictError):
        S.dedupe_or_raise(df.union(spark.createDataFrame([(2, "c")], df.schema)), ["k"])
    parts = spark.createDataFrame([("p", 5.0, 1, ["r1"]), ("p", 9.0, 2, ["r2", "r3"])], "k string, v double, o int, rings array<string>")
    assert rows(S.merge_duplicates(parts, "k", "v", "o", ["rings"])) == [("p", 9.0, 2, ["r1", "r2", "r3"], 2)]
    current = spark.createDataFrame([(1, "old", 7), (2, "keep", None)], "k int, name string, link int")
    new = spark.createDataFrame([(1, "new", 8), (2, None, 9), (3, "add", 1)], current.schema)
    once = S.merge_keep(current, new, ["k"], ["link"])
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(S.merge_keep(once, new, ["k"], ["link"]))))
    assert {r["k"]: (r["name"], r["link"]) for r in once.collect()} == {1: ("new", 7), 2: (None, 9), 3: ("add", 1)}


def test_rules_fail_closed(spark):
    entities = spark.createDataFrame([(1, 5), (2, 5), (3, -1), (4, 5)], "k int, a int")
    children = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 0, 1), (3, 1, 1)], "k int, x int, y int")
    rules = [S.Rule("own", "entity", "a > 0", ("a",)), S.Rule("x", "child", "x = 1", ("x",)), S.Rule("y", "child", "y = 1", ("y",))]
    out = {r["k"]: (r["passed"], r["failed"]) for r in S.evaluate_rules(entities, children, "k", rules).collect()}
    assert out == {1: (True, []), 2: (False, []), 3: (False, ["own"]), 4: (False, ["x", "y"])}
    with pytest.raises(J.ConflictError):
        S.compile_rules([S.Rule("bad", "entity", "x = 1", ("x",))], {"a"}, {"x"})
    with pytest.raises(J.ConflictError):
        S.compile_rules([S.Rule("bad", "phone", "x = 1", ("x",))], {"a"}, {"x"})


def test_guard(spark):
    df = spark.range(5)
    assert S.guarded_sql(spark, "WITH q AS (SELECT * FROM v) SELECT 'drop; table' AS s, id FROM q;", 2, v=df).count() == 2
    for bad in ("DROP TABLE v", "SELECT 1; SELECT 2", "INSERT INTO v SELECT 1", "WITH a AS (SELECT 1) INSERT INTO v SELECT 1"):
        with pytest.raises(ValueError):
            S.guarded_sql(spark, bad, v=df)


def test_mapping_missing_is_not_null(spark):
    df = spark.createDataFrame([('{"a":{"b":"x"},"c":null}',), ("{}",)], "j string")
    mapped = S.map_paths(F.col("j"), [("a.b", "o.p", "d"), ("c", "q", "d")])
    assert [json.loads(r[0]) for r in df.select(mapped).collect()] == [{"o": {"p": "x"}, "q": None}, {"o": {"p": "d"}, "q": "d"}]


def test_assignment():
    assert S.min_cost_assignment([[1, 5], [1, 2], [9, 9]], [1, 1], 6.0) == [0, 1, None]
    assert S.min_cost_assignment([[1, 2], [1, 9]], [1, 1], 50.0) == [1, 0]


def test_bonus_and_bands(spark):
    df = spark.createDataFrame([(23, 1320, 360), (2, 1320, 360), (12, 1320, 360)], "h int, s int, e int")
    got = [round(r[0], 3) for r in df.select(S.window_center_bonus(F.col("h"), F.col("s"), F.col("e"))).collect()]
    assert got == [0.375, 0.875, 0.0]
    bands = spark.createDataFrame([(0.95,), (0.7,), (0.1,)], "s double").select(S.confidence_band(F.col("s"))).collect()
    assert [r[0] for r in bands] == ["accept", "review", "reject"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'x,y\r\n"say ""hi""","two\nlines"\r\n\r\nshort\r\n')
    assert rows(readers.scan_csv(spark, f"{tmp_path}/a.csv", ["x", "y"])) == [('say "hi"', "two\nlines"), ("short", "")]
    with gzip.open(tmp_path / "b.jsonl.gz", "wt") as f:
        f.write('{"k":1}\n\n{"k":2}\n')
    assert rows(readers.scan_jsonl(spark, f"{tmp_path}/b.jsonl.gz", "k int")) == [(1,), (2,)]
    (tmp_path / "f.json").write_text('{"features":[{"id":1},{"id":2}]}\n{"id":3}\n')
    assert rows(readers.scan_features(spark, f"{tmp_path}/f.json", "struct<id:int>")) == [(1,), (2,), (3,)]
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("data/property.json", '{"a": 1}')
        z.writestr("data/relationship_x.json", "{}")
        z.writestr("other/y.json", "{}")
    assert [r["name"] for r in readers.scan_zip_json(spark, f"{tmp_path}/t.zip").collect()] == ["property.json"]
    df = spark.createDataFrame([(1, "p", None), (2, 'q "r"', "s")], "k int, a string, b string")
    assert writers.sink_parquet(df, f"{tmp_path}/out", ["k"]) == 2
    assert readers.scan_parquet_hive(spark, f"{tmp_path}/out", "k=2").select("k").collect()[0][0] == 2
    writers.sink_csv(df, f"{tmp_path}/csv")
    assert rows(readers.scan_csv(spark, f"{tmp_path}/csv", ["k", "a", "b"])) == [("1", "p", ""), ("2", 'q "r"', "s")]
    writers.sink_jsonl(df, f"{tmp_path}/jl", gzip=True)
    assert {r["k"]: r["b"] for r in readers.scan_jsonl(spark, f"{tmp_path}/jl", "k int, b string").collect()} == {1: None, 2: "s"}
    facts = writers.manifest(spark, f"{tmp_path}/jl")
    assert writers.verify_manifest(spark, f"{tmp_path}/jl", facts).collect() == []
    wrong = facts.withColumn("sha256", F.lit("0"))
    assert {r["fault"] for r in writers.verify_manifest(spark, f"{tmp_path}/jl", wrong).collect()} == {"changed"}


def test_html_parser(spark):
    html = "<html><title> A  b </title><script>var x='<a href=no>'</script><p id=name>Own <b>er</b></p><table><tr><th>k<td>v</tr></table><a href='/x'>l</a>"
    r = readers.scan_html(spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")).orderBy("page_id").collect()
    assert (r[0]["title"], r[0]["ids"], r[0]["links"], r[0]["table_rows"]) == ("A b", {"name": "Own er"}, ["/x"], [["k", "v"]])
    assert r[1]["title"] == "" and r[1]["links"] == []


def test_registry_officers(spark):
    line = list(" " * 1436)
    for at, value in ((1, "P0001"), (13, "ACME"), (669, "MGR"), (674, "JANE DOE"), (797, "VP"), (802, "JOHN ROE")):
        line[at - 1 : at - 1 + len(value)] = value
    out = readers.parse_fixed_width(spark.createDataFrame([("".join(line),), (" " * 20,)], "value string")).collect()
    assert len(out) == 1 and [o["name"] for o in out[0]["officers"]] == ["JANE DOE", "JOHN ROE"] and out[0]["zip"] is None


def test_street_and_deed_edges(spark):
    from loamgrid.operators import records as R

    cases = ["12 N Oak Street, Town, FL 12345", "5 Main", "", "7 ELM RUN, ga 12345-6789", "1 E", None]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cases], "v string").select(R.street_parts(F.col("v"))).collect()]
    assert tuple(got[0]) == ("12", "N", "OAK", "St", "TOWN", "FL", "12345", None)
    assert tuple(got[1])[:4] == ("5", None, "MAIN", None) and got[2]["number"] is None
    assert tuple(got[3]) == ("7", None, "ELM", "Run", None, "GA", "12345", "6789")
    assert got[4]["direction"] == "E" and got[4]["name"] is None
    raw = {"WD": "Warranty Deed", "qc: x": "Quitclaim Deed", "Special  Warranty": "Special Warranty Deed", "agreement deed": "Contract for Deed", "??": "Miscellaneous"}
    out = spark.createDataFrame([(k,) for k in raw], "v string").select("v", R.deed_type(F.col("v"))).collect()
    assert {r[0]: r[1] for r in out} == raw


def test_parent_clash_raises(spark):
    from loamgrid.operators import records as R

    children = spark.createDataFrame([("p",), ("q",), (None,)], "key string")
    parents = spark.createDataFrame([("p", 1), ("q", 2)], "key string, id int")
    assert {r["key"]: r["id"] for r in R.one_parent_each(children, parents, "key", "id").collect()} == {"p": 1, "q": 2, None: None}
    with pytest.raises(Exception, match="several id"):
        R.one_parent_each(children, parents.union(spark.createDataFrame([("q", 3)], parents.schema)), "key", "id").collect()
    with pytest.raises(J.ConflictError):
        R.refuse_columns(spark.createDataFrame([(1, 2)], "a int, SSN int"), {"ssn"})


def test_profiles(spark):
    from loamgrid.operators import records as R

    ld = '{"@graph":[{"@type":"LocalBusiness","name":"Apex","telephone":"1","x":[{"@type":"AggregateRating","ratingValue":"4.5","reviewCount":12}]}]}'
    html = f'<script type="application/ld+json">{ld}</script><p>This business is not accredited</p><a href="https://facebook.com/a"></a><a href="https://apex.example/">w</a>'
    out = R.profiles_from_pages(spark.createDataFrame([(1, html), (2, None), (3, '<script type="application/ld+json">{bad</script>')], "page_id bigint, html string"))
    assert [tuple(r) for r in out.collect()] == [(1, "LocalBusiness", "Apex", "1", 4.5, 12, False, "https://apex.example/")]


def test_paged_sources(spark, tmp_path):
    from loamgrid.sources import paged

    plan = paged.page_plan(spark, 23, 10)
    assert rows(plan) == [(0, 0, 10), (1, 10, 20), (2, 20, 23)]
    out = paged.fetch_pages(plan, lambda a, b: ((i, i * i) for i in range(a + 1, b + 1)), "id bigint, sq bigint")
    assert rows(out) == [(i, i * i) for i in range(1, 24)]
    spark.range(6).withColumn("year", F.col("id") % 2).write.partitionBy("year").parquet(f"{tmp_path}/p")
    assert paged.scan_partitioned(spark, f"{tmp_path}/p", ("year",), year=1).count() == 3
    with pytest.raises(ValueError):
        paged.scan_partitioned(spark, f"{tmp_path}/p", ("year",))


def test_fuzzy_keeps_the_block(spark):
    left = spark.createDataFrame([(1, "ACME ROOF", "A"), (2, "ACME ROOF", "B"), (3, "ZETA", "B")], "id long, name string, b string")
    right = spark.createDataFrame([(7, "ACME ROOFS", "A"), (5, "ACME ROOF", "B")], "co long, name string, b string")
    out = {r["id"]: (r["candidate"], r["status"]) for r in J.fuzzy_candidates(left, right, "id", "co", "name", F.col("b")).collect()}
    assert out == {1: (7, "review"), 2: (5, "review")}


def test_fuzzy_against_all_pairs(spark):
    from loamgrid.functions.text import jaro_winkler_of

    parts = spark.read.parquet("/root/testdata/sf0.01/part.parquet").select("p_partkey", "p_brand", F.upper("p_name").alias("name"))
    rows = [tuple(r) for r in parts.collect()]
    left, right = [r for r in rows if r[0] % 2 == 0], [r for r in rows if r[0] % 2]
    block = lambda r: r[1] + r[2][:3]
    want = set()
    for k, brand, name in left:
        found = [(-jaro_winkler_of(name, n), c) for c, b, n in right if block((c, b, n)) == block((k, brand, name))]
        found = sorted(x for x in found if -x[0] >= 0.9)
        if found:
            close = len(found) > 1 and found[1][0] - found[0][0] < 0.05
            want.add((k, found[0][1], round(-found[0][0], 9), "ambiguous" if close else "review"))
    out = J.fuzzy_candidates(
        parts.filter("p_partkey % 2 = 0"), parts.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "other"), "p_partkey", "other", "name",
        F.concat("p_brand", F.substring("name", 1, 3)),
    )
    got = {(r["p_partkey"], r["candidate"], round(r["score"], 9), r["status"]) for r in out.collect()}
    assert got == want and {s for *_, s in got} == {"ambiguous", "review"}


def test_jaro_winkler_bound_holds(spark):
    from loamgrid.functions.text import jaro_winkler_bound, jaro_winkler_of

    words = ["", "A", "AB", "ABCD", "ABCDE", "ABXDEFG", "MARTHA", "MARHTA", "ZZ", "ABCDEFGHIJKLMNOP"]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for r in df.select("a", "b", jaro_winkler_bound(F.col("a"), F.col("b")).alias("x")).collect():
        assert r["x"] >= jaro_winkler_of(r["a"], r["b"]) - 1e-9 or "" in (r["a"], r["b"])


def test_fill_null_link_refuses_several(spark):
    rows = spark.createDataFrame([(1, None), (2, 5)], "k long, c long")
    links = lambda *pairs: spark.createDataFrame(pairs, "k long, new long")
    got = sorted(tuple(r) for r in J.fill_null_link(rows, links((1, 7), (1, 7), (2, 9)), "k", "c").collect())
    assert got == [(1, 7), (2, 5)]
    with pytest.raises(Exception, match="several links"):
        J.fill_null_link(rows, links((1, 7), (1, 8)), "k", "c").collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, tmp_path):
    from types import SimpleNamespace

    from loamgrid.operators import numbering

    conf = lambda **kv: SimpleNamespace(get=lambda k, d: kv.get(k.replace(".", "_"), d))
    cluster = SimpleNamespace(conf=conf(), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        numbering.scratch_root(cluster)
    assert numbering.scratch_root(SimpleNamespace(conf=conf(spark_checkpoint_dir="s3://b/x/"), sparkContext=cluster.sparkContext)) == "s3://b/x"
    held = numbering.materialise(spark.range(3), "test-discard")
    where = spark._jvm.org.apache.hadoop.fs.Path(held._scratch_path)
    there = lambda: where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    assert there()
    numbering.discard(held)
    assert not there()


def test_nearest_rank(spark):
    rows = [("a", float(v)) for v in [5, 1, 1, 9, 3]] + [("b", 2.0), ("c", None)]
    out = S.nearest_rank(spark.createDataFrame(rows, "g string, v double"), "g", "v", {"p0": 0.0, "p50": 0.5, "p95": 0.95})
    assert {tuple(r) for r in out.collect()} == {("a", 1.0, 3.0, 9.0), ("b", 2.0, 2.0, 2.0)}


def test_hybrid_search_values(spark):
    df = spark.createDataFrame([("part 12",), ("Part 7",), ("x",), ("",)], "t string")
    got = {r["t"]: round(r["s"], 6) for r in df.select("t", S.hybrid_score(F.col("t"), "part 12").alias("s")).collect()}
    assert got == {"part 12": 1.0, "Part 7": round(0.4 * 0.5 + 0.2 * (1 - 2 / 7), 6), "x": 0.0, "": 0.0}


def test_predicates_name_their_columns():
    assert S.predicate_columns("a > 0 AND lower(`b c`) = 'x y' OR coalesce(d.e, 1) IN (1, 2) AND f IS NOT NULL") == {"a", "b c", "d", "f"}
    with pytest.raises(J.ConflictError):
        S.compile_rules([S.Rule("bad", "entity", "a > 0 and x = 1")], {"a"}, {"x"})


def test_empty_graph_is_a_fault(spark):
    empty = spark.createDataFrame([], "id string, label string")
    edges = spark.createDataFrame([], "label string, src string, dst string")
    assert [tuple(r) for r in S.graph_faults(empty, edges).collect()] == [(None, "empty_graph")]


def test_publish_tick(spark, tmp_path):
    import time

    from loamgrid.streaming import streams

    spark.range(5).write.parquet(f"{tmp_path}/in")
    stream = streams.event_stream(spark, f"{tmp_path}/in", "id bigint")
    running = streams.run_every(stream, streams.idempotent_parquet_sink(f"{tmp_path}/out"), f"{tmp_path}/c", "1 second")
    until = time.time() + 60
    while time.time() < until and not (tmp_path / "out" / "batch=0" / "_SUCCESS").exists():
        time.sleep(0.5)
    running.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
