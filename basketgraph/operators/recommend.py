"""Best sellers and path-count recommenders.

Path semantics are those of a graph pattern match: inside one pattern an edge
is bound at most once, nodes may repeat. The pattern

    c -buys-> o1 -contains-> p1 <-contains- o2 -contains-> p2

scores ``p2`` for ``c`` by the number of matches whose three ``contains`` edges
are pairwise distinct. No path is ever materialised: with ``m(o,p)`` the number
of parallel ``contains`` edges, ``w(c,q) = sum over orders o of c of m(o,q)``,
``deg(p) = sum_o m(o,p)`` and ``size(o) = sum_p m(o,p)``,

    score(c,p) = sum_o2 m(o2,p) * sum_q w(c,q) m(o2,q)
               + sum_{o of c} m(o,p) * (2 - size(o) - m(o,p) - deg(p))

The first term counts all edge triples; the second removes, by inclusion and
exclusion, the triples that reuse an edge. It assumes one customer per order.
Every term is an equi-join plus a hash aggregation over pre-aggregated counts.
For one customer the work is linear in the edges of the orders that share a
product with that customer. For all customers the output itself grows with the
customers of a product times the products bought together with it, so a product
that everyone buys makes it quadratic in those edges.

Inputs use business keys: ``order_key``, ``product_key``, ``customer_key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketgraph.session import materialize

# List length of every recommender and best-seller list.
TOP_K = 10
# Orders with more distinct products than this are scored through the
# customer-order route instead of the product co-occurrence route (see
# ``order_path_scores``); both are exact.
HOT_ORDER_PRODUCTS = 1000

POSITIVE = "POSITIVE"
NEGATIVE = "NEGATIVE"

# Largest one-customer side (products of that customer) shipped to every task;
# a larger side is shuffle-joined instead.
SEED_BROADCAST_ROWS = 1_000_000


# ---------------------------------------------------------------------------
# Shared inputs
# ---------------------------------------------------------------------------


def exact_sum(col: Column | str) -> Column:
    """Sum of non-null longs that fails loudly on overflow.

    ``try_sum`` plus an explicit error: under ANSI mode a plain ``sum`` of longs
    ran about 4x slower on the path-count aggregations (measured on the 0.1
    tables), while ``try_sum`` keeps the hash aggregation fast. A null result
    from non-null inputs can only mean overflow, which is raised, not returned.
    """
    s = F.try_sum(col)
    return F.when(s.isNull() & (F.count(col) > 0), F.raise_error(F.lit("path count overflow"))).otherwise(s)


def broadcast_if_small(df: DataFrame, max_rows: int = SEED_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is at most ``max_rows``, else ``df`` (shuffle join).

    For sides derived from one customer: usually tiny, but not bounded by
    construction, so the count is checked before anything is broadcast.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def restrict(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``keys``; the keys are broadcast after a size check."""
    return df.join(broadcast_if_small(keys.select(key).distinct()), key, "left_semi")


def edges_near(contains: DataFrame, buys: DataFrame, customer: Column | int) -> tuple[DataFrame, DataFrame]:
    """(contains, buys) of the orders that share a product with the customer's orders.

    Every path of the order recommender for this customer, and every count in its
    edge-reuse terms, lies inside these orders, so scores over them are exact.
    """
    mine = restrict(contains, buys.where(F.col("customer_key") == customer), "order_key")
    reached = materialize(restrict(contains, mine, "product_key").select("order_key").distinct())
    return restrict(contains, reached, "order_key"), restrict(buys, reached, "order_key")


def order_product_counts(contains: DataFrame, buys: DataFrame) -> DataFrame:
    """order_key, customer_key, product_key, m: parallel ``contains`` edges counted.

    ``contains`` holds one row per edge (order_key, product_key); ``buys`` one row
    per (customer_key, order_key). Edges are counted per (order, product) first,
    with map-side combine and a shuffle spread over both keys, so an order holding
    a large share of all lines is reduced before it meets the join; the join then
    attaches the order's one customer and drops orders without one.
    """
    m = contains.groupBy("order_key", "product_key").agg(F.count(F.lit(1)).alias("m"))
    return m.join(buys.select("order_key", "customer_key"), "order_key", "inner").select(
        "order_key", "customer_key", "product_key", "m"
    )


def top_k(scores: DataFrame, k: int = TOP_K, score: str = "score", key: str = "product_key") -> DataFrame:
    """Top ``k`` by score, ties broken by the smaller key (TakeOrderedAndProject)."""
    return scores.orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)


def top_k_per_customer(
    scores: DataFrame, k: int = TOP_K, score: str = "score", key: str = "product_key"
) -> DataFrame:
    """Top ``k`` per customer_key. Spark plans a partial WindowGroupLimit before the shuffle,
    so at most ``k`` rows per customer and map task cross the network."""
    w = Window.partitionBy("customer_key").orderBy(F.col(score).desc(), F.col(key).asc())
    return scores.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


# ---------------------------------------------------------------------------
# Best sellers
# ---------------------------------------------------------------------------


def best_sellers(contains: DataFrame, k: int = TOP_K) -> DataFrame:
    """product_key, score: ``contains`` edges (invoice lines, not units) per product, top ``k``."""
    counts = contains.groupBy("product_key").agg(F.count(F.lit(1)).alias("score"))
    return top_k(counts, k)


def with_bestseller_flag(products: DataFrame, top: DataFrame) -> DataFrame:
    """All products with ``bestseller`` true for the top list and false otherwise.

    ``top`` is a ``limit(k)`` result, so its size is bounded by ``k`` and it is
    broadcast.
    """
    flags = F.broadcast(top.select("product_key", F.lit(True).alias("_top")))
    return products.join(flags, "product_key", "left").withColumn(
        "bestseller", F.coalesce(F.col("_top"), F.lit(False))
    ).drop("_top")


# ---------------------------------------------------------------------------
# Order-based recommender
# ---------------------------------------------------------------------------


def corrections(mc: DataFrame, deg: DataFrame, size: DataFrame) -> DataFrame:
    """customer_key, product_key, t: the edge-reuse terms, one row per (order, product) of a customer."""
    j = mc.join(size, "order_key").join(deg, "product_key")
    t = F.col("m") * (F.lit(2) - F.col("size") - F.col("m") - F.col("deg"))
    return j.select("customer_key", "product_key", t.alias("t"))


def without_owned(scores: DataFrame, mc: DataFrame) -> DataFrame:
    """Drop (customer, product) scores for products the customer already bought (optional, off by default)."""
    owned = mc.select("customer_key", "product_key").distinct()
    keys = ["customer_key", "product_key"] if "customer_key" in scores.columns else ["product_key"]
    return scores.join(owned.select(*keys), keys, "left_anti")


def order_path_scores_for(mc: DataFrame, customer: Column | int) -> DataFrame:
    """product_key, score for one customer: every term restricted to that customer first.

    ``mc`` is ``order_product_counts``. The customer's product weights are
    broadcast after a size check, so the full multiplicity table is never
    shuffled to meet them; the join on orders sharing a product moves one row
    per such order.
    """
    mine = mc.where(F.col("customer_key") == customer)
    w = broadcast_if_small(mine.groupBy("product_key").agg(exact_sum("m").alias("w")))
    m = mc.select("order_key", "product_key", "m")
    on_mine = m.join(w, "product_key")  # rows of m on the customer's products; m is not shuffled
    pairs = on_mine.groupBy("order_key").agg(exact_sum(F.col("w") * F.col("m")).alias("a"))
    triples = m.join(pairs, "order_key").select("product_key", (F.col("m") * F.col("a")).alias("t"))
    deg = on_mine.groupBy("product_key").agg(exact_sum("m").alias("deg"))
    size = restrict(m, mine, "order_key").groupBy("order_key").agg(exact_sum("m").alias("size"))
    corr = corrections(mine, deg, size).select("product_key", "t")
    scores = triples.unionByName(corr).groupBy("product_key").agg(exact_sum("t").alias("score"))
    return scores.where(F.col("score") > 0)


def order_path_scores(mc: DataFrame, hot_order_products: int = HOT_ORDER_PRODUCTS) -> DataFrame:
    """customer_key, product_key, score for every customer.

    The all-edge-triples term ``sum_q w(c,q) * C(q,p)`` uses the product
    co-occurrence ``C(q,p) = sum_o m(o,q) m(o,p)`` built inside each order, so a
    popular product never pairs its orders with each other. Orders with more
    than ``hot_order_products`` distinct products would make that in-order
    pairing quadratic; they go through ``A(c,o) = sum_q w(c,q) m(o,q)`` instead,
    which is linear in the customers that share a product with the order.
    """
    per_order = mc.groupBy("order_key").agg(
        exact_sum("m").alias("size"), F.count(F.lit(1)).alias("n_products")
    )
    m = mc.join(per_order, "order_key")
    w = mc.groupBy("customer_key", "product_key").agg(exact_sum("m").alias("w"))

    cold = m.where(F.col("n_products") <= hot_order_products)
    hot = m.where(F.col("n_products") > hot_order_products)

    left = cold.select("order_key", F.col("product_key").alias("q"), F.col("m").alias("mq"))
    right = cold.select("order_key", "product_key", F.col("m").alias("mp"))
    cooc = left.join(right, "order_key").groupBy("q", "product_key").agg(
        exact_sum(F.col("mq") * F.col("mp")).alias("c")
    )
    # Term rows are not summed here: all three terms meet in one aggregation below.
    t_cold = (
        w.withColumnRenamed("product_key", "q")
        .join(cooc, "q")
        .select("customer_key", "product_key", (F.col("w") * F.col("c")).alias("t"))
    )

    hot_m = hot.select("order_key", "product_key", "m")
    reach = w.join(hot_m, "product_key").groupBy("customer_key", "order_key").agg(
        exact_sum(F.col("w") * F.col("m")).alias("a")
    )
    t_hot = reach.join(hot_m, "order_key").select(
        "customer_key", "product_key", (F.col("a") * F.col("m")).alias("t")
    )

    deg = mc.groupBy("product_key").agg(exact_sum("m").alias("deg"))
    corr = corrections(mc, deg, per_order.select("order_key", "size"))

    scores = (
        t_cold.unionByName(t_hot)
        .unionByName(corr)
        .groupBy("customer_key", "product_key")
        .agg(exact_sum("t").alias("score"))
    )
    return scores.where(F.col("score") > 0)


# ---------------------------------------------------------------------------
# Rating-based recommender
# ---------------------------------------------------------------------------


def rating_path_candidates(feedback: DataFrame, customer: Column | int, sentiment: str = POSITIVE) -> DataFrame:
    """product_key, rating, paths for one customer over ``c -f1-> p1 <-f2- c2 -f3-> p2``.

    Every edge must carry ``sentiment`` and the three edges must be distinct.
    One row per candidate third edge ``f3`` with the number of valid ``(f1, f2)``
    pairs, counted from per-customer totals (inclusion and exclusion over
    ``f1=f2``, ``f2=f3``, ``f1=f3``) rather than by enumerating pairs.
    """
    pos = feedback.where(F.col("sentiment") == sentiment).select("customer_key", "product_key", "rating")
    me = F.col("customer_key") == customer
    w1 = broadcast_if_small(pos.where(me).groupBy("product_key").agg(F.count(F.lit(1)).alias("w1")))
    shared = pos.join(w1, "product_key").groupBy("customer_key").agg(
        exact_sum("w1").alias("u"),
        exact_sum(F.when(me, F.lit(1)).otherwise(F.lit(0))).alias("n_self"),
    )
    f3 = pos.join(shared, "customer_key").join(w1, "product_key", "left")
    w1p = F.coalesce(F.col("w1"), F.lit(0))
    self_ = F.when(me, F.lit(1)).otherwise(F.lit(0))
    paths = F.col("u") - F.col("n_self") - w1p - self_ * w1p + self_ * 2
    return f3.select("product_key", "rating", paths.alias("paths")).where(F.col("paths") > 0)


def rating_scores_for(feedback: DataFrame, customer: Column | int, sentiment: str = POSITIVE) -> DataFrame:
    """product_key, score: the best rating over valid paths, per product."""
    cands = rating_path_candidates(feedback, customer, sentiment)
    return cands.groupBy("product_key").agg(F.max("rating").alias("score"))


def rating_top_paths_for(
    feedback: DataFrame, customer: Column | int, k: int = TOP_K, sentiment: str = POSITIVE
) -> DataFrame:
    """product_key, score: the literal form, top ``k`` *path rows* by rating, then de-duplicated.

    Path rows are ordered by rating (desc) and product (asc); a product reached
    by several paths fills several of the ``k`` slots, so fewer than ``k``
    products can come back. The candidate list is cut with ``limit`` before the
    running count, so only ``k`` rows reach the single ordered window.
    """
    cands = rating_path_candidates(feedback, customer, sentiment)
    per = cands.groupBy("product_key", "rating").agg(exact_sum("paths").alias("paths"))
    head = per.orderBy(F.col("rating").desc(), F.col("product_key").asc()).limit(k)
    w = Window.orderBy(F.col("rating").desc(), F.col("product_key").asc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("paths").over(w), F.lit(0))
    kept = head.withColumn("_before", before).where(F.col("_before") < k)
    return kept.groupBy("product_key").agg(F.max("rating").alias("score"))


# ---------------------------------------------------------------------------
# Combining, MERGE, veto
# ---------------------------------------------------------------------------


def combine_recommendations(by_orders: DataFrame, by_ratings: DataFrame) -> DataFrame:
    """customer_key, product_key, from_orders, from_ratings: union de-duplicated on the pair."""
    a = by_orders.select(
        "customer_key", "product_key", F.lit(True).alias("from_orders"), F.lit(False).alias("from_ratings")
    )
    b = by_ratings.select(
        "customer_key", "product_key", F.lit(False).alias("from_orders"), F.lit(True).alias("from_ratings")
    )
    return a.unionByName(b).groupBy("customer_key", "product_key").agg(
        F.max("from_orders").alias("from_orders"), F.max("from_ratings").alias("from_ratings")
    )


def veto_disliked(recs: DataFrame, feedback: DataFrame, sentiment: str = NEGATIVE) -> DataFrame:
    """Drop recommendations of products the same customer gave ``sentiment`` feedback."""
    disliked = feedback.where(F.col("sentiment") == sentiment).select("customer_key", "product_key")
    return recs.join(disliked, ["customer_key", "product_key"], "left_anti")
