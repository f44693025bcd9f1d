"""Properties over generated inputs."""

import uuid

from hypothesis import given, settings
from hypothesis import strategies as st

from loamgrid.functions.text import jaro_winkler_of
from loamgrid.operators.shape import min_cost_assignment


@given(st.text(max_size=12), st.text(max_size=12))
def test_jaro_winkler_is_a_similarity(a, b):
    score = jaro_winkler_of(a, b)
    assert 0 <= score <= 1 + 1e-9 and (score == 1 if a == b else True)
    assert jaro_winkler_of(a, a) == 1


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 9), min_size=2, max_size=2), max_size=6), st.lists(st.integers(0, 3), min_size=2, max_size=2), st.integers(0, 12))
def test_assignment_is_optimal(costs, capacity, overflow):
    def best(i, load):
        if i == len(costs):
            return 0
        options = [overflow + best(i + 1, load)]
        for s in range(2):
            if load[s] < capacity[s]:
                options.append(costs[i][s] + best(i + 1, tuple(n + (k == s) for k, n in enumerate(load))))
        return min(options)

    slots = min_cost_assignment([list(map(float, c)) for c in costs], capacity, float(overflow))
    assert all(slots.count(s) <= capacity[s] for s in range(2))
    total = sum(overflow if s is None else costs[i][s] for i, s in enumerate(slots))
    assert total == best(0, (0, 0))


@settings(deadline=None, max_examples=25)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=5))
def test_uuid5_equals_the_library(spark, names):
    from pyspark.sql import functions as F

    from loamgrid.functions import identity

    clean = [n.encode("utf-8", "ignore").decode() for n in names]
    space = uuid.UUID(identity.ADDRESS_NAMESPACE)
    rows = spark.createDataFrame([(n,) for n in clean], "v string").select("v", identity.uuid5(F.col("v"), str(space))).collect()
    assert all(r[1] == str(uuid.uuid5(space, r[0])) for r in rows)
