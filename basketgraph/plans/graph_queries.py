"""Graph integrity, best sellers and recommenders over the parquet tables.

Inventory ids: S9, J6 (integrity), A8, J10, T1, P6 (best sellers), J7, F6, A10,
T1, T3 (order paths), J8, F7, T2 (rating paths), U3, K4, J9, J11, F8, S11
(merge and veto).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph import jobs
from basketgraph.functions.ids import CUSTOMER_PREFIX, ORDER_PREFIX, PRODUCT_PREFIX, prefixed
from basketgraph.operators import bounded
from basketgraph.operators import graph as graph_ops
from basketgraph.operators import recommend as rec
from basketgraph.plans.registry import register
from basketgraph.session import materialize, shared_path
from basketgraph.sources import tables as tb
from basketgraph.sources.graph_files import write_graph_table
from basketgraph.sources.lookup import Clustered
from basketgraph.sources.merge_store import MergeStore

# The customer the single-customer recommenders run for (a parameter of the
# query, as the user id is in an interactive recommender call).
SEED_CUSTOMER = 7


def contains_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contains edge: order_key, product_key."""
    li = tb.table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("product_key"))


def buys_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_key, order_key for orders with a customer."""
    o = tb.table(spark, sf_dir, "orders")
    return o.where(F.col("o_custkey").isNotNull()).select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderkey").alias("order_key")
    )


def feedback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feedback_keys(tb.feedback(spark, sf_dir))


def _feedback_keys(fb: DataFrame) -> DataFrame:
    return fb.select(
        F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        "rating",
        "sentiment",
    )


def customer_multiplicities(spark: SparkSession, sf_dir: str, customer: int) -> DataFrame:
    """``order_product_counts`` of the orders that share a product with the customer, written once."""
    near = rec.edges_near(contains_keys(spark, sf_dir), buys_keys(spark, sf_dir), customer)
    return materialize(rec.order_product_counts(*near))


def liked_near(spark: SparkSession, sf_dir: str, customer: int) -> DataFrame:
    """Positive feedback of all customers who like a product that ``customer`` likes.

    The rating paths of this customer use no other edge.
    """
    flags = [flag for flag, label in tb.RETURNFLAG_SENTIMENT.items() if label == rec.POSITIVE]
    lines = tb.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin(flags))
    headers = tb.table(spark, sf_dir, "orders")
    own = headers.where(F.col("o_custkey") == customer).select(F.col("o_orderkey").alias("l_orderkey"))
    liked = rec.restrict(lines, own, "l_orderkey")
    orders = rec.restrict(lines, liked, "l_partkey").select(F.col("l_orderkey").alias("o_orderkey"))
    fans = materialize(rec.restrict(headers, orders, "o_orderkey").select("o_custkey").distinct())
    theirs = rec.restrict(headers, fans, "o_custkey").select("o_orderkey", "o_custkey", "o_orderdate")
    return _feedback_keys(tb.feedback(spark, sf_dir, lines, rec.broadcast_if_small(theirs)))


class CustomerFeedback:
    """The feedback of some customers, read from a store's tables."""

    def __init__(self, store: GraphStore):
        self.store = store

    def lookup(self, customers: Sequence[int]) -> DataFrame:
        """customer_key, product_key, rating, sentiment."""
        return self.store.feedback_of(self.store.buys.lookup(customers))


class GraphStore:
    """The graph of a table folder, clustered for one-customer lookups; built once per session and folder.

    Holds the edges themselves, so that it grows with the tables and not with the pairs of products: orders by customer,
    customers by order, lines by order and the orders of a product. A customer's paths are followed from table to table.
    """

    _built: dict[tuple[str, str], GraphStore] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.base = shared_path(spark, "graph_store")
        lines = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
        headers = buys_keys(spark, sf_dir)
        n, n_headers = lines.count(), headers.count()
        edges = lines.select(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("product_key"), tb.rating_of("l_quantity").alias("rating"), tb.sentiment_of_flag(F.col("l_returnflag")).alias("sentiment"))
        self.feedback = CustomerFeedback(self)
        self.buys = self._put("buys", headers, "customer_key", n_headers)
        self.buyers = self._put("buyers", headers, "order_key", n_headers)
        self.lines = self._put("lines", edges, "order_key", n)
        self.holders = self._put("holders", edges.select("product_key", "order_key", "sentiment"), "product_key", n)

    def _put(self, name: str, df: DataFrame, key: str, rows: int) -> Clustered:
        return Clustered.write(df, f"{self.base}/{name}", key, rows)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> GraphStore:
        at = (spark.sparkContext.applicationId, sf_dir)
        if at not in cls._built:
            cls._built[at] = cls(spark, sf_dir)
        return cls._built[at]

    @staticmethod
    def _rows(table: Clustered, keys: DataFrame) -> DataFrame:
        """Rows of ``table`` whose key is in its column of ``keys``."""
        return table.lookup_from(materialize(keys.select(table.key).distinct()), table.key)[0]

    @cached_property
    def _lists(self) -> tuple[Clustered, Clustered]:
        contains, buys = self.lines.read().select("order_key", "product_key"), self.buys.read()
        entries, weights = (materialize(t) for t in bounded.path_lists(materialize(rec.order_product_counts(contains, buys))))
        return self._put("entries", entries, "key", entries.count()), self._put("weights", weights, "customer_key", weights.count())

    @property
    def entries(self) -> Clustered:
        """All lists of ``bounded.path_lists`` by key, written when first asked for; one customer's scores do without them."""
        return self._lists[0]

    @property
    def weights(self) -> Clustered:
        """All weights of ``bounded.path_lists`` by customer; see ``entries``."""
        return self._lists[1]

    def feedback_of(self, buys: DataFrame) -> DataFrame:
        return self._rows(self.lines, buys).join(buys, "order_key").select("customer_key", "product_key", "rating", "sentiment")

    def order_scores(self, customer: int) -> DataFrame:
        """customer_key, product_key, score by order paths."""
        mine = self._rows(self.lines, self.buys.lookup([customer]))
        reached = materialize(self._rows(self.holders, mine).select("order_key").distinct())
        mc = materialize(rec.order_product_counts(self._rows(self.lines, reached), self._rows(self.buyers, reached)))
        return rec.order_path_scores_for(mc, customer).select(F.lit(customer).cast("long").alias("customer_key"), "product_key", "score")

    def rating_scores(self, customer: int) -> DataFrame:
        """customer_key, product_key, score by rating paths; the top ten are right."""
        liked = F.col("sentiment") == rec.POSITIVE
        products = materialize(self.feedback.lookup([customer]).where(liked).select("product_key").distinct())
        fans = self._rows(self.buyers, self._rows(self.holders, products).where(liked))
        edges = materialize(bounded.rating_edges(self.feedback_of(materialize(self._rows(self.buys, fans)))))
        best = materialize(bounded.own_best(edges))
        lists = bounded.product_lists(rec.restrict(edges, products, "product_key"), best)
        me = F.col("customer_key") == customer
        return bounded.read_product_lists(edges.where(me), best.where(me), lists)


def _recs_out(df: DataFrame, customer=None) -> DataFrame:
    cust = prefixed("customer_key", CUSTOMER_PREFIX) if customer is None else F.lit(f"{CUSTOMER_PREFIX}{customer}")
    return df.select(
        cust.alias("customer_id"), prefixed("product_key", PRODUCT_PREFIX).alias("product_id"), "score"
    )


# ---------------------------------------------------------------------------
# Referential integrity on the contains edges
# ---------------------------------------------------------------------------

# Graph snapshot used for the integrity queries: order nodes are orders not in
# status P, product nodes are parts of size above 10, so edges dangle at either end.
_EDGES_SQL = """
    SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS src, 'P' || CAST(l_partkey AS VARCHAR) AS dst,
           l_linenumber AS line_no,
           l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') AS src_ok,
           l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) AS dst_ok
    FROM lineitem
"""


def _integrity_inputs(spark: SparkSession, sf_dir: str):
    li = tb.table(spark, sf_dir, "lineitem")
    edges = li.select(
        F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_linenumber").alias("line_no")
    )
    orders = tb.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("id")
    )
    parts = tb.table(spark, sf_dir, "part").where(F.col("p_size") > 10).select(F.col("p_partkey").alias("id"))
    return edges, orders, parts


def _edge_ids(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        prefixed("src", ORDER_PREFIX).alias("src"), prefixed("dst", PRODUCT_PREFIX).alias("dst"), "line_no", *extra
    )


@register(
    "graph_edges_valid",
    f"SELECT src, dst, line_no FROM ({_EDGES_SQL}) e WHERE src_ok AND dst_ok",
    "J6",
)
def graph_edges_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, orders, parts = _integrity_inputs(spark, sf_dir)
    return _edge_ids(graph_ops.valid_edges(edges, orders, parts))


@register(
    "graph_edges_rejected",
    f"""
    SELECT src, dst, line_no,
           CASE WHEN NOT src_ok AND NOT dst_ok THEN 'missing_both'
                WHEN NOT src_ok THEN 'missing_src' ELSE 'missing_dst' END AS reason
    FROM ({_EDGES_SQL}) e WHERE NOT (src_ok AND dst_ok)
    """,
    "J6",
)
def graph_edges_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, orders, parts = _integrity_inputs(spark, sf_dir)
    return _edge_ids(graph_ops.rejected_edges(edges, orders, parts), "reason")


# Snapshot for the assembly report: besides the order and product node sets
# above, customer nodes are customers with a non-negative balance.
_REPORT_SQL = """
    WITH o AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'),
    p AS (SELECT p_partkey AS id FROM part WHERE p_size > 10),
    c AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal >= 0),
    e AS (
        SELECT 'contains' AS edge_type, l_orderkey AS src, l_partkey AS dst,
               l_orderkey IN (SELECT id FROM o) AS s_ok, l_partkey IN (SELECT id FROM p) AS d_ok FROM lineitem
        UNION ALL
        SELECT 'buys', o_custkey, o_orderkey, o_custkey IN (SELECT id FROM c), o_orderkey IN (SELECT id FROM o)
        FROM orders
        UNION ALL
        SELECT 'feedback', o.o_custkey, l.l_partkey, o.o_custkey IN (SELECT id FROM c), l.l_partkey IN (SELECT id FROM p)
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
    SELECT edge_type,
           CASE WHEN s_ok AND d_ok THEN 'kept' WHEN NOT s_ok AND NOT d_ok THEN 'missing_both'
                WHEN NOT s_ok THEN 'missing_src' ELSE 'missing_dst' END AS status,
           COUNT(*) AS n_edges
    FROM e GROUP BY 1, 2
"""


@register("graph_reject_report", _REPORT_SQL, "K7 J6")
def graph_reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assemble order, product and customer nodes with three edge types; count kept and rejected edges."""
    _, orders, parts = _integrity_inputs(spark, sf_dir)
    customers = tb.table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("id")
    )
    contains = contains_keys(spark, sf_dir).select(F.col("order_key").alias("src"), F.col("product_key").alias("dst"))
    buys = buys_keys(spark, sf_dir).select(F.col("customer_key").alias("src"), F.col("order_key").alias("dst"))
    fb = feedback_keys(spark, sf_dir).select(F.col("customer_key").alias("src"), F.col("product_key").alias("dst"))
    graph = graph_ops.assemble_graph(
        {"order": orders, "product": parts, "customer": customers},
        {
            "contains": graph_ops.EdgeSpec(contains, "order", "product"),
            "buys": graph_ops.EdgeSpec(buys, "customer", "order"),
            "feedback": graph_ops.EdgeSpec(fb, "customer", "product"),
        },
    )
    status = F.coalesce("reason", F.lit("kept")).alias("status")
    return graph.flagged.groupBy("edge_type", status).agg(F.count(F.lit(1)).alias("n_edges"))


@register("graph_from_files", _REPORT_SQL, "K7 J6 S9 K1 X17")
def graph_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from typed-header files: written from the whole tables, assembled and stored in one command, counted from the stored graph."""
    base = shared_path(spark, "graph-files")
    _, orders, parts = _integrity_inputs(spark, sf_dir)
    customers = tb.table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("id"))
    order, product, customer = ORDER_PREFIX, PRODUCT_PREFIX, CUSTOMER_PREFIX
    for name, ids, prefix in (("orderNode", orders, order), ("productNode", parts, product), ("customerNode", customers, customer)):
        write_graph_table(ids.select(prefixed("id", prefix).alias("id")), f"{base}/in/{name}")
    fb = feedback_keys(spark, sf_dir)
    for name, edges, (src, src_prefix), (dst, dst_prefix) in (
        ("containsEdge", contains_keys(spark, sf_dir), ("order_key", order), ("product_key", product)),
        ("buysEdge", tb.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_key"), F.col("o_orderkey").alias("order_key")), ("customer_key", customer), ("order_key", order)),
        ("feedbackEdge", fb, ("customer_key", customer), ("product_key", product)),
    ):
        write_graph_table(edges.select(prefixed(src, src_prefix).alias("src"), prefixed(dst, dst_prefix).alias("dst")), f"{base}/in/{name}")
    graph_ops.write_graph(jobs.graph_from_files(spark, f"{base}/in"), f"{base}/out")
    kept = [spark.read.parquet(f"{base}/out/edges/{name}").select(F.lit(name).alias("edge_type"), F.lit("kept").alias("status")) for name in ("contains", "buys", "feedback")]
    rejects = spark.read.parquet(f"{base}/out/rejects").select("edge_type", F.col("reason").alias("status"))
    return reduce(DataFrame.unionByName, [*kept, rejects]).groupBy("edge_type", "status").agg(F.count(F.lit(1)).alias("n_edges"))


# ---------------------------------------------------------------------------
# Best sellers
# ---------------------------------------------------------------------------

_CUST_LINES = "l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IS NOT NULL)"
_BEST_SQL = f"""
    SELECT l_partkey AS k, COUNT(*) AS score FROM lineitem WHERE {_CUST_LINES}
    GROUP BY l_partkey ORDER BY score DESC, l_partkey LIMIT 10
"""


def _customer_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contains_keys(spark, sf_dir).join(
        buys_keys(spark, sf_dir).select("order_key"), "order_key", "left_semi"
    )


@register(
    "best_sellers",
    f"SELECT 'P' || CAST(k AS VARCHAR) AS product_id, score FROM ({_BEST_SQL}) b",
    "A8 J10 T1",
)
def best_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = rec.best_sellers(_customer_contains(spark, sf_dir))
    return top.select(prefixed("product_key", PRODUCT_PREFIX).alias("product_id"), "score")


@register(
    "product_bestseller",
    f"""
    SELECT 'P' || CAST(p.p_partkey AS VARCHAR) AS product_id, p.p_name AS nameproduct,
           (b.k IS NOT NULL) AS bestseller
    FROM part p LEFT JOIN ({_BEST_SQL}) b ON b.k = p.p_partkey
    """,
    "P6 A8",
)
def product_bestseller(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = rec.best_sellers(_customer_contains(spark, sf_dir))
    parts = tb.products(spark, sf_dir).select(F.col("product_id").alias("product_key"), "product_name")
    flagged = rec.with_bestseller_flag(parts, top)
    return flagged.select(
        prefixed("product_key", PRODUCT_PREFIX).alias("product_id"),
        F.col("product_name").alias("nameproduct"),
        "bestseller",
    )


# ---------------------------------------------------------------------------
# Order-based recommender: brute-force path enumeration in the oracle
# ---------------------------------------------------------------------------

_ORDER_PATHS_SQL = f"""
    WITH li AS MATERIALIZED (
        SELECT row_number() OVER () AS eid, l_orderkey AS o, l_partkey AS p FROM lineitem WHERE {_CUST_LINES}),
    buys AS (SELECT DISTINCT o_custkey AS c, o_orderkey AS o FROM orders WHERE o_custkey IS NOT NULL),
    paths AS (
        SELECT b.c, e3.p AS p2 FROM buys b
        JOIN li e1 ON e1.o = b.o
        JOIN li e2 ON e2.p = e1.p AND e2.eid <> e1.eid
        JOIN li e3 ON e3.o = e2.o AND e3.eid <> e2.eid AND e3.eid <> e1.eid
        {{where}})
    SELECT c, p2, COUNT(*) AS score FROM paths GROUP BY c, p2
"""


@register(
    "recommend_from_orders",
    f"""
    SELECT 'C' || CAST(c AS VARCHAR) AS customer_id, 'P' || CAST(p2 AS VARCHAR) AS product_id, score
    FROM ({_ORDER_PATHS_SQL.format(where=f"WHERE b.c = {SEED_CUSTOMER}")}) s
    ORDER BY score DESC, p2 LIMIT 10
    """,
    "J7 F6 A10 T1",
)
def recommend_from_orders(spark: SparkSession, sf_dir: str, customer: int = SEED_CUSTOMER) -> DataFrame:
    return _recs_out(rec.top_k(GraphStore.of(spark, sf_dir).order_scores(customer)), customer)


@register(
    "recommend_from_orders_all",
    f"""
    SELECT 'C' || CAST(c AS VARCHAR) AS customer_id, 'P' || CAST(p2 AS VARCHAR) AS product_id, score
    FROM ({_ORDER_PATHS_SQL.format(where="")}) s
    QUALIFY row_number() OVER (PARTITION BY c ORDER BY score DESC, p2) <= 10
    """,
    "J7 A10 T3",
)
def recommend_from_orders_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recs_out(bounded.bounded_order_top_k(rec.order_product_counts(contains_keys(spark, sf_dir), buys_keys(spark, sf_dir))))


# ---------------------------------------------------------------------------
# Rating-based recommender
# ---------------------------------------------------------------------------

_FEEDBACK_SQL = """
    SELECT row_number() OVER () AS eid, o.o_custkey AS c, l.l_partkey AS p,
           1 + (CAST(l.l_quantity AS INTEGER) % 5) AS rating,
           CASE l.l_returnflag WHEN 'A' THEN 'POSITIVE' WHEN 'N' THEN 'NEUTRAL' WHEN 'R' THEN 'NEGATIVE' END AS sentiment
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
"""

_RATING_SQL = f"""
    WITH f AS MATERIALIZED (SELECT * FROM ({_FEEDBACK_SQL}) x WHERE sentiment = 'POSITIVE'),
    paths AS (
        SELECT f3.p AS p2, f3.rating FROM f f1
        JOIN f f2 ON f2.p = f1.p AND f2.eid <> f1.eid
        JOIN f f3 ON f3.c = f2.c AND f3.eid <> f2.eid AND f3.eid <> f1.eid
        WHERE f1.c = {SEED_CUSTOMER})
    SELECT p2, MAX(rating) AS score FROM paths GROUP BY p2 ORDER BY score DESC, p2 LIMIT 10
"""


@register(
    "recommend_from_ratings",
    f"""
    SELECT 'C{SEED_CUSTOMER}' AS customer_id, 'P' || CAST(p2 AS VARCHAR) AS product_id, score
    FROM ({_RATING_SQL}) r
    """,
    "J8 F7 T2",
)
def recommend_from_ratings(spark: SparkSession, sf_dir: str, customer: int = SEED_CUSTOMER) -> DataFrame:
    return _recs_out(rec.top_k(GraphStore.of(spark, sf_dir).rating_scores(customer)), customer)


_RATING_PATHS_SQL = _RATING_SQL.replace(
    "SELECT p2, MAX(rating) AS score FROM paths GROUP BY p2 ORDER BY score DESC, p2 LIMIT 10",
    "SELECT p2, MAX(rating) AS score FROM "
    "(SELECT p2, rating FROM paths ORDER BY rating DESC, p2 LIMIT 10) h GROUP BY p2",
)


@register(
    "recommend_from_ratings_paths",
    f"""
    SELECT 'C{SEED_CUSTOMER}' AS customer_id, 'P' || CAST(p2 AS VARCHAR) AS product_id, score
    FROM ({_RATING_PATHS_SQL}) r
    """,
    "J8 T2",
)
def recommend_from_ratings_paths(spark: SparkSession, sf_dir: str, customer: int = SEED_CUSTOMER) -> DataFrame:
    """The literal form: top 10 path rows by rating, then de-duplicated by product."""
    scores = rec.rating_top_paths_for(liked_near(spark, sf_dir, customer), F.lit(customer))
    return _recs_out(scores, customer)


@register(
    "recommend_from_ratings_all",
    f"""
    WITH f AS MATERIALIZED (SELECT * FROM ({_FEEDBACK_SQL}) x WHERE sentiment = 'POSITIVE'),
    paths AS (
        SELECT f1.c, f3.p AS p2, f3.rating FROM f f1
        JOIN f f2 ON f2.p = f1.p AND f2.eid <> f1.eid
        JOIN f f3 ON f3.c = f2.c AND f3.eid <> f2.eid AND f3.eid <> f1.eid)
    SELECT 'C' || CAST(c AS VARCHAR) AS customer_id, 'P' || CAST(p2 AS VARCHAR) AS product_id, MAX(rating) AS score
    FROM paths GROUP BY c, p2
    QUALIFY row_number() OVER (PARTITION BY c ORDER BY MAX(rating) DESC, p2) <= 10
    """,
    "J8 F7 T3",
)
def recommend_from_ratings_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's best-rated products by rating paths."""
    return _recs_out(bounded.rating_top_k(feedback_keys(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Merge of both recommenders, product lookup and negative-feedback veto
# ---------------------------------------------------------------------------


def _both_lists(spark: SparkSession, sf_dir: str, customer: int) -> tuple[DataFrame, DataFrame]:
    """Top lists of one customer by order paths and by ratings: customer_key, product_key, score."""
    store = GraphStore.of(spark, sf_dir)
    return rec.top_k(store.order_scores(customer)), rec.top_k(store.rating_scores(customer))


@register(
    "recommend_merge_veto",
    f"""
    WITH by_orders AS (
        SELECT p2 AS k FROM ({_ORDER_PATHS_SQL.format(where=f"WHERE b.c = {SEED_CUSTOMER}")}) s
        ORDER BY score DESC, p2 LIMIT 10),
    by_ratings AS (SELECT p2 AS k FROM ({_RATING_SQL}) r),
    merged AS (
        SELECT k, bool_or(o) AS from_orders, bool_or(r) AS from_ratings FROM (
            SELECT k, TRUE AS o, FALSE AS r FROM by_orders
            UNION ALL SELECT k, FALSE AS o, TRUE AS r FROM by_ratings) u
        GROUP BY k),
    disliked AS (
        SELECT DISTINCT p AS k FROM ({_FEEDBACK_SQL}) x WHERE c = {SEED_CUSTOMER} AND sentiment = 'NEGATIVE')
    SELECT 'C{SEED_CUSTOMER}' AS customer_id, 'P' || CAST(m.k AS VARCHAR) AS product_id,
           p.p_name AS product_name, m.from_orders, m.from_ratings
    FROM merged m JOIN part p ON p.p_partkey = m.k
    WHERE m.k NOT IN (SELECT k FROM disliked)
    """,
    "U3 J9 J11 F8 S11",
)
def recommend_merge_veto(spark: SparkSession, sf_dir: str, customer: int = SEED_CUSTOMER) -> DataFrame:
    by_orders, by_ratings = _both_lists(spark, sf_dir, customer)
    combined = rec.combine_recommendations(by_orders, by_ratings)
    mine = GraphStore.of(spark, sf_dir).feedback.lookup([customer])  # S11
    kept = rec.veto_disliked(combined, mine)
    named = kept.join(
        tb.products(spark, sf_dir).select(F.col("product_id").alias("product_key"), "product_name"),
        "product_key",
        "inner",
    )
    return named.select(
        prefixed("customer_key", CUSTOMER_PREFIX).alias("customer_id"),
        prefixed("product_key", PRODUCT_PREFIX).alias("product_id"),
        "product_name",
        "from_orders",
        "from_ratings",
    )


@register(
    "recommend_merge_existing",
    f"""
    WITH by_orders AS (
        SELECT p2 AS k FROM ({_ORDER_PATHS_SQL.format(where=f"WHERE b.c = {SEED_CUSTOMER}")}) s
        ORDER BY score DESC, p2 LIMIT 10),
    disliked AS (
        SELECT DISTINCT p AS k FROM ({_FEEDBACK_SQL}) x WHERE c = {SEED_CUSTOMER} AND sentiment = 'NEGATIVE'),
    offers AS (
        SELECT k, 1 AS rank, 'orders' AS source FROM by_orders
        UNION ALL SELECT p2, 2, 'ratings' FROM ({_RATING_SQL}) r
        UNION ALL SELECT k, 3, 'disliked' FROM disliked)
    SELECT 'C{SEED_CUSTOMER}' AS customer_id, 'P' || CAST(k AS VARCHAR) AS product_id, arg_min(source, rank) AS source
    FROM offers GROUP BY k
    """,
    "K4 U3",
)
def recommend_merge_existing(spark: SparkSession, sf_dir: str, customer: int = SEED_CUSTOMER) -> DataFrame:
    """The stored ``recommended_for`` edges after three merges, run twice: order list, rating list, disliked products.

    A merge adds only edges that are not stored, as one more delta; edges already present keep their first source.
    """
    by_orders, by_ratings = _both_lists(spark, sf_dir, customer)
    disliked = GraphStore.of(spark, sf_dir).feedback.lookup([customer]).where(F.col("sentiment") == rec.NEGATIVE)
    batches = [
        materialize(batch.select("customer_key", "product_key", F.lit(source).alias("source")))
        for source, batch in (("orders", by_orders), ("ratings", by_ratings), ("disliked", disliked))
    ]
    stored = MergeStore(spark, shared_path(spark, "recommended_for"), batches[0].schema, ["customer_key", "product_key"], buckets=16)
    for batch in batches + batches:
        stored.merge(batch)
    return stored.read().select(
        prefixed("customer_key", CUSTOMER_PREFIX).alias("customer_id"), prefixed("product_key", PRODUCT_PREFIX).alias("product_id"), "source"
    )
