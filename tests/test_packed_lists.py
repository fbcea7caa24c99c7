"""All customers' order paths from packed lists: whole results in several rounds, and files that leave with their round."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basketgraph.operators import bounded
from basketgraph.operators import recommend as rec
from basketgraph.session import materialize_freed
from tests.conftest import rows


def _counts(spark, lines, owner):
    contains = spark.createDataFrame(lines, "order_key long, product_key long")
    buys = spark.createDataFrame(sorted(owner.items()), "order_key long, customer_key long").select("customer_key", "order_key")
    return rec.order_product_counts(contains, buys).checkpoint()


def _graph(seed, n_orders=80, n_products=30, n_customers=15):
    rng = random.Random(seed)
    lines = [(o, rng.randrange(n_products)) for o in range(n_orders) for _ in range(rng.randrange(1, 7))]
    lines += [(o, 7) for o in range(n_orders)] + [(0, p) for p in range(n_products)]
    return lines, {o: rng.randrange(n_customers) for o in range(n_orders)}


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getPath(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_exchanges_leave_no_files(spark):
    rng = np.random.default_rng(2)
    lines = [(int(o), int(p)) for o, p in zip(rng.integers(0, 4000, 16000), rng.integers(0, 900, 16000), strict=True)]
    mc = _counts(spark, lines, {o: o % 500 for o in range(4000)})
    before = _shuffle_files(spark)
    got = bounded.bounded_order_top_k(mc, block_entries=100_000)
    left = sum(n for f, n in _shuffle_files(spark).items() if f not in before)
    assert left < 20_000  # of more than a million bytes sent
    assert got.count() == 5000
    assert materialize_freed(mc.groupBy("product_key").count()).count() == 900
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


@pytest.mark.parametrize(("seed", "hot", "depths", "spread"), [(1, 1000, (256,), 1), (2, 10, (2, 5), 1), (3, 10, (3, 400), 10**17), (4, 1000, (400,), -(10**17))])
def test_rounds_equal_term_rows(spark, seed, hot, depths, spread):
    lines, owner = _graph(seed)
    mc = _counts(spark, [(o, p * spread) for o, p in lines], owner)
    want = rec.top_k_per_customer(rec.order_path_scores(mc, hot))
    got = bounded.bounded_order_top_k(mc, hot_order_products=hot, depths=depths, block_entries=300, round_entries=700)
    cols = ["customer_key", "product_key", "score"]
    assert rows(got, *cols) == rows(want, *cols)


def _paths(lines, owner):
    """Every path, enumerated."""
    edges = [(o, p) for o, p in lines if o in owner]
    out = Counter()
    for i, (o1, p1) in enumerate(edges):
        for j, (o2, p) in enumerate(edges):
            if j != i and p1 is not None and p == p1:
                out.update((owner[o1], p2) for n, (o3, p2) in enumerate(edges) if o3 == o2 and n not in (i, j))
    return out


@pytest.mark.parametrize(("hot", "customer_entries"), [(1000, 10**6), (4, 10**6), (4, 20)])
def test_lines_without_product_end_paths(spark, hot, customer_entries):
    rng = random.Random(9)
    lines = [(o, rng.choice([None, *range(8)])) for o in range(25) for _ in range(rng.randrange(1, 5))]
    lines += [(30, None), (31, None), (31, None), (31, 3)]
    owner = {o: o % 4 for o in range(25)} | {30: 5, 31: 6}
    got = bounded.bounded_order_top_k(_counts(spark, lines, owner), k=99, hot_order_products=hot, customer_entries=customer_entries)
    assert {(r["customer_key"], r["product_key"]): r["score"] for r in got.collect()} == dict(_paths(lines, owner))


def test_orders_are_whole_wherever_batches_end(monkeypatch):
    monkeypatch.setattr(bounded, "PAIR_ROWS", 40)
    monkeypatch.setattr(bounded, "PART_ENTRIES", 30)
    rng = random.Random(4)
    orders = [[(o, rng.randrange(12), rng.randrange(1, 4)) for _ in range(rng.choice([1, 2, 5, 9, 60]))] for o in range(40)]
    table = [(o, p, m, len(order), p % 3, o % 3) for order in orders for o, p, m in order]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*table[i : i + 7], strict=True)], names=["order_key", "product_key", "m", "n_rows", "part", "order_part"]) for i in range(0, len(table), 7)]
    found = pa.Table.from_batches(bounded._store_orders(10)(iter(batches)))
    want, degree = Counter(), Counter()
    for order in orders:
        for o, p, m in order:
            degree[p] += m
            for _, p2, m2 in order if len(order) <= 10 else []:
                want[bounded.TOGETHER, p, p2] += m * m2
            if len(order) > 10:
                want[bounded.LARGE_ORDER, o, p] += m
    got, degrees = {}, {}
    for part in range(3):
        one = bounded._sum_part(found.filter(pa.compute.equal(found["part"], part)))
        lists = bounded.Lists.unpack(one["lists"][0].as_buffer())
        of = np.repeat(np.arange(len(lists.size)), lists.size)
        got |= dict(zip(zip(lists.kind[of].tolist(), lists.key[of].tolist(), lists.products.tolist(), strict=True), lists.counts.tolist(), strict=True))
        degrees |= {key: n for kind, key, n in zip(lists.kind.tolist(), lists.key.tolist(), lists.degree.tolist(), strict=True) if kind == bounded.TOGETHER}
        for depth in (1, 3, 100):
            heads, at = lists.heads(depth), np.cumsum(lists.size) - lists.size
            for i, head in enumerate(np.split(heads.products, np.cumsum(heads.size)[:-1])):
                whole = sorted((-lists.counts[j], lists.products[j]) for j in range(at[i], at[i] + lists.size[i]))
                assert head.tolist() == sorted(p for _, p in whole[:depth])
                assert (-heads.rest[i], heads.rest_key[i]) == (whole[depth] if len(whole) > depth else (0, 0))
    assert got == dict(want) and degrees == dict(degree)
