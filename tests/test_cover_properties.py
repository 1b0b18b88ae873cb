"""Property test: top-N + others against its plain-Python definition on
random small inputs with ties, NULL groups, NULL ids and an id spelt like the
label."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridtally.operators.cover import topn_with_others
from tests.test_cover import brute_topn

ids = st.one_of(st.none(), st.sampled_from(["others", "a", "b", "c", "d", "e", "f", "g", "h"]))
groups = st.one_of(st.none(), st.sampled_from(["x", "y", ""]))


@st.composite
def pair_tables(draw):
    rows = draw(st.lists(st.tuples(groups, ids, st.integers(1, 4)), min_size=1, max_size=40))
    seen, out = set(), []
    for g, i, c in rows:  # one row per (group, id), as the operator expects
        if (g, i) not in seen:
            seen.add((g, i))
            out.append((g, i, c))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=pair_tables(), n=st.integers(1, 4))
def test_topn_property(spark, pairs, n):
    df = spark.createDataFrame(pairs, "g string, id string, cnt bigint")
    got = {tuple(r) for r in topn_with_others(df, "g", "id", n=n).collect()}
    assert got == brute_topn(pairs, n=n)
