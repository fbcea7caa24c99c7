"""Generated-input properties of the integrity check and MERGE (hypothesis, small budgets)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketgraph.operators import graph as g

keys = st.integers(min_value=0, max_value=6)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(
    src_nodes=st.sets(keys, max_size=5),
    dst_nodes=st.sets(keys, max_size=5),
    edges=st.lists(st.tuples(keys, keys), max_size=15),
)
def test_integrity_partitions_the_edges(spark, src_nodes, dst_nodes, edges):
    e = spark.createDataFrame([(s, d, i) for i, (s, d) in enumerate(edges)], "src long, dst long, eid long")
    s = spark.createDataFrame([(k,) for k in src_nodes], "id long")
    d = spark.createDataFrame([(k,) for k in dst_nodes], "id long")
    valid = {r.eid for r in g.valid_edges(e, s, d).collect()}
    rejected = {r.eid: r.reason for r in g.rejected_edges(e, s, d).collect()}
    assert valid.isdisjoint(rejected) and valid | set(rejected) == set(range(len(edges)))
    for i, (a, b) in enumerate(edges):
        ok_s, ok_d = a in src_nodes, b in dst_nodes
        if ok_s and ok_d:
            assert i in valid
        else:
            assert rejected[i] == ("missing_both" if not ok_s and not ok_d else "missing_src" if not ok_s else "missing_dst")


@SETTINGS
@given(existing=st.sets(st.tuples(keys, keys), max_size=6), new=st.lists(st.tuples(keys, keys), max_size=10))
def test_merge_is_set_union_and_idempotent(spark, existing, new):
    ex = spark.createDataFrame(sorted(existing), "src long, dst long")
    nw = spark.createDataFrame(new, "src long, dst long")
    once = g.merge_edges(ex, nw)
    got = sorted(map(tuple, once.collect()))
    assert got == sorted(existing | set(new))
    assert sorted(map(tuple, g.merge_edges(once, nw).collect())) == got
