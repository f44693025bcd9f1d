"""Queries against their SQL."""

import pytest

from loamgrid.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) == []


def test_link_scores_match_sql(spark, tmp_path):
    """The provided pages have no links between hosts; these have."""
    import random

    rng = random.Random(12)
    hosts = [f"h{i}.{rng.choice(['com', 'net', 'org', 'io'])}" for i in range(40)]
    pages = []
    for i in range(200):
        links = "".join(f'<a href="http://{rng.choice(hosts)}/x">l</a>' for _ in range(rng.randrange(4)))
        pages.append((i, f"https://{rng.choice(hosts)}{rng.choice(['/fr/', '/', '', '/de/x'])}", links))
    spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    name = "op10_link_graph_url_filter"
    got = QUERIES[name](spark, str(tmp_path))
    assert differences(got, connect(str(tmp_path)), ORACLE_SQL[name]) == []
    own = got.filter("rule is null").groupBy("verdict").count().collect()
    assert {r["verdict"] for r in own} == {"allow", "block"}
