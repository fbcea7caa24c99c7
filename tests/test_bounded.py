"""Bounded top lists of all customers against term rows and path enumeration."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketgraph.operators import bounded
from basketgraph.operators import recommend as rec
from tests.conftest import rows


def _counts(spark, lines, owner):
    contains = spark.createDataFrame(lines, "order_key long, product_key long")
    buys = spark.createDataFrame(sorted(owner.items()), "order_key long, customer_key long").select("customer_key", "order_key")
    return rec.order_product_counts(contains, buys).checkpoint()


def _graph(seed, n_orders=60, n_products=25, n_customers=12, hub=None):
    rng = random.Random(seed)
    lines = [(o, rng.randrange(n_products)) for o in range(n_orders) for _ in range(rng.randrange(1, 7))]
    if hub is not None:
        lines += [(o, hub) for o in range(n_orders)]
    lines += [(0, p) for p in range(n_products)]
    return lines, {o: rng.randrange(n_customers) for o in range(n_orders) if rng.random() < 0.95}


@pytest.mark.parametrize(("seed", "hot", "depths", "customer_entries"), [(1, 1000, (256,), 10**6), (2, 10, (2, 5), 10**6), (3, 10, (1, 3, 400), 10**6), (4, 1000, (3, 400), 60)])
def test_order_lists_equal_term_rows(spark, seed, hot, depths, customer_entries):
    mc = _counts(spark, *_graph(seed, hub=7))
    want = rec.top_k_per_customer(rec.order_path_scores(mc, hot))
    got = bounded.bounded_order_top_k(mc, hot_order_products=hot, depths=depths, block_entries=300, customer_entries=customer_entries)
    cols = ["customer_key", "product_key", "score"]
    assert rows(got, *cols) == rows(want, *cols)


def test_one_product_in_every_order_ends_early(spark, monkeypatch):
    """The shared product's list is never read beyond its head, so entries grow with the customers, not with customers times products."""
    def no_terms(*_):
        raise AssertionError("scored from term rows")

    monkeypatch.setattr(bounded, "scores_from_terms", no_terms)
    rng = np.random.default_rng(5)
    read = []
    for scale in (1, 3):
        n_products, n_customers = 400 * scale, 60 * scale
        popular = (n_products * rng.power(0.35, 900 * scale)).astype(int)
        lines = [(o, int(p)) for o, p in enumerate(popular)] + [(o, 10**6) for o in range(900 * scale)]
        mc = _counts(spark, lines, {o: o % n_customers for o in range(900 * scale)})
        got = bounded.bounded_order_top_k(mc, depths=(32, 64))
        assert rows(got) == rows(rec.top_k_per_customer(rec.order_path_scores(mc)).select(got.columns))
        entries, weights = bounded.path_lists(mc)
        heads = bounded.list_heads(entries, 32).select("kind", "key", F.size("products").alias("n"))
        every = entries.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
        read.append([weights.join(t, ["kind", "key"]).agg(F.sum("n")).first()[0] for t in (heads, every)])
    (few, all_), (few3, all3) = read
    assert few3 < 3.5 * few and all3 > 6 * all_ and few3 < all3 / 4


def test_merge_heads_keeps_ties_by_key():
    """An unseen product that may only tie, under a greater key, does not hold a customer back."""
    one = np.zeros(2, np.int64)
    args = [one, np.array([5, 6]), np.array([4, 4]), np.array([4, 4]), np.array([4])]
    owner, product, score, open_ = bounded.merge_heads(*args, np.array([7]), 2)
    assert (product.tolist(), score.tolist(), open_.tolist()) == ([5, 6], [4, 4], [])
    assert bounded.merge_heads(*args, np.array([6]), 2)[3].tolist() == [0]
    empty = np.zeros(0, np.int64)
    assert [x.tolist() for x in bounded.merge_heads(empty, empty, empty, empty, np.array([0]), np.array([0]), 3)] == [[]] * 4


def _rating_paths(edges, k):
    """Every path, enumerated."""
    best = {}
    for i, (c, p1, _) in enumerate(edges):
        for j, (c2, p, _) in enumerate(edges):
            if j != i and p == p1:
                for n, (c3, p2, r) in enumerate(edges):
                    if n not in (i, j) and c3 == c2:
                        best[c, p2] = max(best.get((c, p2), 0), r)
    out = []
    for c in {c for c, _ in best}:
        mine = sorted((-r, p) for (c1, p), r in best.items() if c1 == c)[:k]
        out += [(c, p, -r) for r, p in mine]
    return sorted(out)


@pytest.mark.parametrize(("seed", "k"), [(1, 1), (2, 2), (3, 3), (4, 2), (5, 10)])
def test_ratings_equal_path_enumeration(spark, seed, k):
    rng = random.Random(seed)
    edges = [(rng.randrange(9), rng.randrange(12), rng.randrange(1, 6)) for _ in range(55)]
    edges += [(20, 40, 5), (21, 41, 3), (21, 41, 4), (22, 42, 1), (22, 42, 2), (22, 42, 3), (23, 0, 5)]
    fb = spark.createDataFrame([(*e, "POSITIVE") for e in edges] + [(0, 50, 5, "NEGATIVE")], "customer_key long, product_key long, rating int, sentiment string")
    got = bounded.rating_top_k(fb.repartition(3), k)
    assert rows(got, "customer_key", "product_key", "score") == _rating_paths(edges, k)
    assert bounded.rating_top_k(fb.limit(0), k).count() == 0


def test_a_product_liked_by_all_grows_with_the_edges(spark, monkeypatch):
    """Rows passed on stay within (k + 1) per edge and lists within 2k + 1 per product."""
    sizes = []
    real = bounded.materialize

    def counted(df):
        out = real(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(bounded, "materialize", counted)
    edges = [(c, p, 1 + (c * 7 + p) % 5, "POSITIVE") for c in range(400) for p in (10**6, c % 37, c % 11)]
    fb = spark.createDataFrame(edges, "customer_key long, product_key long, rating int, sentiment string")
    got = bounded.rating_top_k(fb, 3)
    assert got.groupBy("customer_key").count().where("count > 3").count() == 0 and got.count() == 1200
    n_edges, n_customers, n_lists = sizes
    assert n_edges <= 1200 and n_customers == 400 and n_lists <= 49
