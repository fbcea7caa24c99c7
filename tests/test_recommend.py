"""Path-count recommenders against brute-force path enumeration on random multigraphs."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from basketgraph.operators import recommend as rec

from .conftest import rows

N_GRAPHS = 25


def _random_graphs(seed: int):
    """Disjoint small multigraphs: (order, customer) and (order, product) edge lists."""
    rnd = random.Random(seed)
    buys, contains = [], []
    for g in range(N_GRAPHS):
        base = g * 1000
        n_cust, n_ord, n_prod = rnd.randint(1, 4), rnd.randint(1, 7), rnd.randint(1, 5)
        for o in range(n_ord):
            buys.append((base + o, base + 100 + rnd.randrange(n_cust)))
            for _ in range(rnd.randint(0, 5)):  # repeated products give parallel edges
                contains.append((base + o, base + 500 + rnd.randrange(n_prod)))
    return buys, contains


def _brute_order_paths(buys, contains):
    cust_of = dict(buys)
    by_order, by_product = defaultdict(list), defaultdict(list)
    for i, (o, p) in enumerate(contains):
        by_order[o].append(i)
        by_product[p].append(i)
    score = defaultdict(int)
    for e1, (o1, p1) in enumerate(contains):
        c = cust_of[o1]
        for e2 in by_product[p1]:
            if e2 == e1:
                continue
            for e3 in by_order[contains[e2][0]]:
                if e3 != e2 and e3 != e1:
                    score[(c, contains[e3][1])] += 1
    return score


def _frames(spark, buys, contains):
    b = spark.createDataFrame(buys, "order_key long, customer_key long")
    c = spark.createDataFrame(contains, "order_key long, product_key long")
    return rec.order_product_counts(c, b)


@pytest.mark.parametrize("seed,hot", [(1, rec.HOT_ORDER_PRODUCTS), (2, 2), (3, 0)])
def test_order_paths_all_customers_match_brute_force(spark, seed, hot):
    buys, contains = _random_graphs(seed)
    expect = sorted((c, p, s) for (c, p), s in _brute_order_paths(buys, contains).items() if s > 0)
    got = rows(rec.order_path_scores(_frames(spark, buys, contains), hot), "customer_key", "product_key", "score")
    assert got == expect


def test_order_paths_one_customer_match_brute_force(spark):
    buys, contains = _random_graphs(4)
    brute = _brute_order_paths(buys, contains)
    mc = _frames(spark, buys, contains)
    for cust in sorted({c for _, c in buys})[:6]:
        expect = sorted((p, s) for (c, p), s in brute.items() if c == cust and s > 0)
        assert rows(rec.order_path_scores_for(mc, F.lit(cust)), "product_key", "score") == expect


def test_same_order_return_through_parallel_edge(spark):
    # one order, product 1 twice and product 2 once: paths go back into the same order
    buys = [(1, 10)]
    contains = [(1, 1), (1, 1), (1, 2)]
    got = dict(rows(rec.order_path_scores_for(_frames(spark, buys, contains), F.lit(10)), "product_key", "score"))
    brute = {p: s for (c, p), s in _brute_order_paths(buys, contains).items() if s > 0}
    assert got == brute and got  # p2 = p1 is allowed through the parallel edge


def test_top_k_ties_break_on_key(spark):
    scores = spark.createDataFrame([(i, 5 if i < 12 else 1) for i in range(20)], "product_key long, score long")
    top = rec.top_k(scores, 10)
    assert rows(top, "product_key") == [(i,) for i in range(10)]
    per = spark.createDataFrame(
        [(c, p, 1) for c in (1, 2) for p in range(15)], "customer_key long, product_key long, score long"
    )
    assert rows(rec.top_k_per_customer(per, 10).where("customer_key = 2"), "product_key") == [(p,) for p in range(10)]


def _random_feedback(seed):
    rnd = random.Random(seed)
    out = []
    for g in range(N_GRAPHS):
        base = g * 1000
        for _ in range(rnd.randint(0, 14)):
            out.append(
                (
                    base + rnd.randrange(4),
                    base + 500 + rnd.randrange(4),
                    rnd.randint(1, 5),
                    rnd.choice(["POSITIVE", "POSITIVE", "NEGATIVE", "NEUTRAL"]),
                )
            )
    return out


def _brute_rating(fb, seed_cust):
    best = {}
    for i1, (c1, p1, _, s1) in enumerate(fb):
        if c1 != seed_cust or s1 != "POSITIVE":
            continue
        for i2, (c2, pp, _, s2) in enumerate(fb):
            if i2 == i1 or pp != p1 or s2 != "POSITIVE":
                continue
            for i3, (c3, p3, r3, s3) in enumerate(fb):
                if i3 in (i1, i2) or c3 != c2 or s3 != "POSITIVE":
                    continue
                best[p3] = max(best.get(p3, 0), r3)
    return best


def test_rating_paths_match_brute_force(spark):
    fb = _random_feedback(5)
    df = spark.createDataFrame(fb, "customer_key long, product_key long, rating int, sentiment string")
    custs = sorted({c for c, *_ in fb})
    checked = 0
    for cust in custs[:12]:
        expect = sorted(_brute_rating(fb, cust).items())
        assert rows(rec.rating_scores_for(df, F.lit(cust)), "product_key", "score") == expect
        checked += bool(expect)
    assert checked > 0


def test_rating_literal_form_counts_path_rows(spark):
    # seed 1 likes product 10; customer 2 likes 10 and 20 (rating 5) and 30 (rating 4) twice
    fb = [(1, 10, 3, "POSITIVE"), (2, 10, 1, "POSITIVE"), (2, 20, 5, "POSITIVE"), (2, 30, 4, "POSITIVE"), (2, 30, 4, "POSITIVE")]
    df = spark.createDataFrame(fb, "customer_key long, product_key long, rating int, sentiment string")
    assert rows(rec.rating_top_paths_for(df, F.lit(1), k=2), "product_key", "score") == [(20, 5), (30, 4)]
    assert rows(rec.rating_top_paths_for(df, F.lit(1), k=1), "product_key") == [(20,)]


def test_non_positive_edge_in_each_position_blocks_path(spark):
    base = [(1, 10, 3, "POSITIVE"), (2, 10, 4, "POSITIVE"), (2, 20, 5, "POSITIVE")]
    for pos in range(3):
        fb = [(c, p, r, "NEGATIVE" if i == pos else s) for i, (c, p, r, s) in enumerate(base)]
        df = spark.createDataFrame(fb, "customer_key long, product_key long, rating int, sentiment string")
        got = dict(rows(rec.rating_scores_for(df, F.lit(1)), "product_key", "score"))
        assert 20 not in got


def test_combine_and_veto(spark):
    a = spark.createDataFrame([(1, 10), (1, 11)], "customer_key long, product_key long")
    b = spark.createDataFrame([(1, 11), (1, 12)], "customer_key long, product_key long")
    fb = spark.createDataFrame([(1, 12, "NEGATIVE"), (2, 10, "NEGATIVE")], "customer_key long, product_key long, sentiment string")
    out = rows(rec.veto_disliked(rec.combine_recommendations(a, b), fb))
    assert out == [(1, 10, True, False), (1, 11, True, True)]


def test_best_sellers_and_flag(spark):
    contains = spark.createDataFrame([(o, p) for o in range(5) for p in range(o + 1)], "order_key long, product_key long")
    top = rec.best_sellers(contains, 2)
    assert rows(top) == [(0, 5), (1, 4)]
    products = spark.createDataFrame([(p,) for p in range(6)], "product_key long")
    flags = dict(rows(rec.with_bestseller_flag(products, top)))
    assert flags == {0: True, 1: True, 2: False, 3: False, 4: False, 5: False}


def _brute_rating_paths(fb, seed_cust, k):
    path_rows = []
    for i1, (c1, p1, _, s1) in enumerate(fb):
        if c1 != seed_cust or s1 != "POSITIVE":
            continue
        for i2, (c2, pp, _, s2) in enumerate(fb):
            if i2 == i1 or pp != p1 or s2 != "POSITIVE":
                continue
            for i3, (c3, p3, r3, s3) in enumerate(fb):
                if i3 not in (i1, i2) and c3 == c2 and s3 == "POSITIVE":
                    path_rows.append((p3, r3))
    head = sorted(path_rows, key=lambda x: (-x[1], x[0]))[:k]
    best = {}
    for p, r in head:
        best[p] = max(best.get(p, 0), r)
    return sorted(best.items())


def test_rating_literal_form_matches_brute_force(spark):
    fb = _random_feedback(6)
    df = spark.createDataFrame(fb, "customer_key long, product_key long, rating int, sentiment string")
    for cust in sorted({c for c, *_ in fb})[:10]:
        for k in (1, 3):
            got = rows(rec.rating_top_paths_for(df, F.lit(cust), k=k), "product_key", "score")
            assert got == _brute_rating_paths(fb, cust, k)


def test_exclude_owned_option(spark):
    buys, contains = _random_graphs(7)
    brute = _brute_order_paths(buys, contains)
    mc = _frames(spark, buys, contains)
    owned = {(dict(buys)[o], p) for o, p in contains}
    expect = sorted((c, p, s) for (c, p), s in brute.items() if s > 0 and (c, p) not in owned)
    got = rows(rec.without_owned(rec.order_path_scores(mc), mc), "customer_key", "product_key", "score")
    assert got == expect
    cust = buys[0][1]
    mine = mc.where(F.col("customer_key") == cust)
    one = rows(rec.without_owned(rec.order_path_scores_for(mc, F.lit(cust)), mine), "product_key", "score")
    assert one == [(p, s) for c, p, s in expect if c == cust]


def test_skewed_graph_hot_customer_and_hot_product(spark):
    rnd = random.Random(21)
    buys, contains = [], []
    for o in range(60):
        cust = 1 if o < 20 else 2 + rnd.randrange(10)  # customer 1 owns a third of the orders
        buys.append((o, cust))
        contains.append((o, 999))  # product 999 is in every order
        for _ in range(rnd.randint(1, 3)):
            contains.append((o, rnd.randrange(12)))
    brute = _brute_order_paths(buys, contains)
    mc = _frames(spark, buys, contains)
    expect = sorted((c, p, s) for (c, p), s in brute.items() if s > 0)
    for hot in (rec.HOT_ORDER_PRODUCTS, 2):
        assert rows(rec.order_path_scores(mc, hot), "customer_key", "product_key", "score") == expect
    assert rows(rec.order_path_scores_for(mc, F.lit(1)), "product_key", "score") == [(p, s) for c, p, s in expect if c == 1]
