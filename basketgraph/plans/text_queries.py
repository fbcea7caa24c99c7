"""Text, sentiment, feedback and JSON validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketgraph.functions import text as tx
from basketgraph.functions.lexicon import NEGATIVE_WORDS, POSITIVE_WORDS, STOP_WORDS
from basketgraph.operators import feedback as fb_ops
from basketgraph.operators import sentiment as sent
from basketgraph.plans.registry import register
from basketgraph.session import spread
from basketgraph.sources import tables as tb


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def clean_sql(col: str) -> str:
    """The cleaning chain in DuckDB SQL, from the same patterns as ``functions.text``."""
    letters = f"regexp_replace({col}, '{tx.NON_LETTER}', '', 'g')"
    chars = " || ".join(f"chr({ord(ch)})" for ch in tx.WHITESPACE_CHARS)
    trimmed = f"trim({letters}, {chars})"
    return f"regexp_replace(lower({trimmed}), '{tx.words_pattern(STOP_WORDS)}', '', 'g')"


def sentiment_sql(table: str, id_cols: str) -> str:
    return f"""
    WITH c AS (SELECT {id_cols}, {clean_sql('text')} AS clean_text FROM {table}),
    t AS (SELECT *, list_filter(string_split(clean_text, ' '), lambda x: x <> '') AS toks FROM c),
    n AS (SELECT {id_cols}, clean_text, CAST(len(toks) AS INTEGER) AS n_tokens,
                 CAST(len(list_filter(toks, lambda x: list_contains([{_sql_list(POSITIVE_WORDS)}], x))) AS INTEGER) AS pos_count,
                 CAST(len(list_filter(toks, lambda x: list_contains([{_sql_list(NEGATIVE_WORDS)}], x))) AS INTEGER) AS neg_count
          FROM t)
    SELECT *, CAST(pos_count AS DOUBLE) / NULLIF(n_tokens, 0) AS pos_score,
              CAST(neg_count AS DOUBLE) / NULLIF(n_tokens, 0) AS neg_score,
              CASE WHEN pos_count > neg_count THEN 'POSITIVE' WHEN pos_count < neg_count THEN 'NEGATIVE'
                   ELSE 'NEUTRAL' END AS sentiment
    FROM n
    """


@register(
    "clean_text",
    f"""
    SELECT doc_id, clean_text, CAST(len(list_filter(string_split(clean_text, ' '), lambda x: x <> '')) AS INTEGER) AS n_tokens
    FROM (SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents) d
    """,
    "X7 X8 X9 X10",
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(tb.table(spark, sf_dir, "documents").select("doc_id", "text"))
    cleaned = docs.select("doc_id", tx.clean_text("text", STOP_WORDS).alias("clean_text"))
    return cleaned.select("doc_id", "clean_text", F.size(tx.tokens("clean_text")).alias("n_tokens"))


def sentiment_of_documents(docs: DataFrame) -> DataFrame:
    return sent.score_text(docs, "text", STOP_WORDS, POSITIVE_WORDS, NEGATIVE_WORDS, keep=["doc_id"])


@register("sentiment_documents", sentiment_sql("documents", "doc_id"), "A11 C2 X6 J12 S8")
def sentiment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_of_documents(spread(tb.table(spark, sf_dir, "documents").select("doc_id", "text")))


@register(
    "sentiment_documents_lexicon",
    f"""SELECT doc_id, n_tokens, pos_count, neg_count, pos_score, neg_score, sentiment
    FROM ({sentiment_sql("documents", "doc_id")}) s""",
    "J12 S8 A11 C2",
)
def sentiment_documents_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores with the lexicon as a table, joined to exploded tokens."""
    lexicon = spark.createDataFrame(
        [(w, sent.POSITIVE) for w in POSITIVE_WORDS] + [(w, sent.NEGATIVE) for w in NEGATIVE_WORDS],
        "word string, polarity string",
    )
    docs = spread(tb.table(spark, sf_dir, "documents").select("doc_id", "text"))
    scored = sent.score_text_with_lexicon(docs, "doc_id", "text", STOP_WORDS, lexicon)
    return scored.select(
        "doc_id",
        F.col("n_tokens").cast("int").alias("n_tokens"),
        F.col("pos_count").cast("int").alias("pos_count"),
        F.col("neg_count").cast("int").alias("neg_count"),
        "pos_score",
        "neg_score",
        "sentiment",
    )


@register("sentiment_conversations", sentiment_sql("conversations", "conv_id, turn"), "A11 C2 X6 J12")
def sentiment_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = spread(tb.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return sent.score_text(conv, "text", STOP_WORDS, POSITIVE_WORDS, NEGATIVE_WORDS, keep=["conv_id", "turn"])


@register(
    "feedback_edges",
    """
    SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS customer_id, 'P' || CAST(l.l_partkey AS VARCHAR) AS product_id,
           1 + (CAST(l.l_quantity AS INTEGER) % 5) AS rating,
           CASE l.l_returnflag WHEN 'A' THEN 'POSITIVE' WHEN 'N' THEN 'NEUTRAL' WHEN 'R' THEN 'NEGATIVE' END
               AS sentimentalAnalysis,
           CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_key
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    """,
    "S6 X5 P2",
)
def feedback_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fb_ops.feedback_edges(tb.feedback(spark, sf_dir))


# events.props carries one JSON object per row; "k" is the required field.
PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType())])
_PROPS_SQL = """
    SELECT event_id, user_id, props,
           CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN TRY_CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
           CASE WHEN NOT json_valid(props) OR json_type(props) <> 'OBJECT' THEN 'not_json_object'
                WHEN json_extract(props, '$.k') IS NULL OR TRY_CAST(json_extract(props, '$.k') AS BIGINT) IS NULL
                    THEN 'missing_field' END AS reason
    FROM events
"""


def _parsed_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tb.table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    return fb_ops.parse_json_lines(ev, "props", PROPS_SCHEMA, ["k"], keep=["event_id", "user_id"])


@register("json_valid", f"SELECT event_id, user_id, k FROM ({_PROPS_SQL}) p WHERE reason IS NULL", "F4 X11")
def json_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = fb_ops.split_valid(_parsed_props(spark, sf_dir))
    return valid.select("event_id", "user_id", F.col("parsed.k").alias("k"))


@register(
    "json_rejected",
    f"SELECT event_id, user_id, props AS raw, reason FROM ({_PROPS_SQL}) p WHERE reason IS NOT NULL",
    "F4",
)
def json_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = fb_ops.split_valid(_parsed_props(spark, sf_dir))
    return rejected.select("event_id", "user_id", "raw", "reason")
