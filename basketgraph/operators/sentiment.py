"""Lexicon sentiment of feedback text.

Label rule: more positive than negative words -> POSITIVE, fewer -> NEGATIVE,
else NEUTRAL. The two scores share the token count as denominator, so the label
is the sign of (positive - negative) and an empty text is NEUTRAL. Scores use
``try_divide`` and are null for an empty text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketgraph.functions import text as tx

POSITIVE = "POSITIVE"
NEGATIVE = "NEGATIVE"
NEUTRAL = "NEUTRAL"


def label(pos: Column, neg: Column) -> Column:
    return F.when(pos > neg, POSITIVE).when(pos < neg, NEGATIVE).otherwise(NEUTRAL)


def score_text(
    df: DataFrame,
    text_col: str,
    stop_words: Iterable[str],
    positive: Iterable[str],
    negative: Iterable[str],
    keep: Iterable[str] = (),
    literal_stop_words: bool = True,
    normalize_lexicon: bool = True,
) -> DataFrame:
    """``keep`` columns plus clean_text, n_tokens, pos_count, neg_count, pos_score, neg_score, sentiment.

    Row-local: no shuffle, no Python; works unchanged on a streaming DataFrame.
    With ``normalize_lexicon`` the positive and negative words are cleaned by the
    same rule as the text (``all-around`` matches as ``allaround``); without it
    they are matched as given, so entries with non-letters never match.
    """
    if normalize_lexicon:
        positive, negative = tx.normalize_words(positive), tx.normalize_words(negative)
    cleaned = df.select(*keep, tx.clean_text(text_col, stop_words, literal_stop_words).alias("clean_text"))
    toks = tx.tokens("clean_text")
    scored = cleaned.select(
        *keep,
        "clean_text",
        F.size(toks).alias("n_tokens"),
        tx.count_in(toks, positive).alias("pos_count"),
        tx.count_in(toks, negative).alias("neg_count"),
    )
    return scored.select(
        "*",
        F.try_divide(F.col("pos_count").cast("double"), F.col("n_tokens")).alias("pos_score"),
        F.try_divide(F.col("neg_count").cast("double"), F.col("n_tokens")).alias("neg_score"),
        label(F.col("pos_count"), F.col("neg_count")).alias("sentiment"),
    )


def score_text_with_lexicon(
    df: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: Iterable[str],
    lexicon: DataFrame,
    lexicon_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Same counts with the lexicon as a table ``(word, polarity)``, polarity POSITIVE/NEGATIVE.

    Tokens are exploded and joined to the lexicon; the per-text aggregation is
    combined map-side, where all tokens of a text already are, so one row per
    text crosses the shuffle. The lexicon is broadcast only after its row count
    is checked against ``lexicon_broadcast_rows``; a larger one is shuffle-joined.
    """
    cleaned = df.select(id_col, tx.clean_text(text_col, stop_words).alias("clean_text"))
    exploded = cleaned.select(id_col, F.explode_outer(tx.tokens("clean_text")).alias("word"))
    # Words cleaned by the text rule; one row per word, so a word on both lists
    # does not duplicate its token.
    cleaned_words = lexicon.select(
        F.lower(tx.trim_whitespace(tx.keep_letters("word"))).alias("word"), "polarity"
    ).where(F.length("word") > 0)
    lex = cleaned_words.groupBy("word").agg(
        F.max(F.col("polarity") == POSITIVE).alias("is_pos"),
        F.max(F.col("polarity") == NEGATIVE).alias("is_neg"),
    )
    if lexicon.count() <= lexicon_broadcast_rows:
        lex = F.broadcast(lex)
    j = exploded.join(lex, "word", "left")
    counts = j.groupBy(id_col).agg(
        F.count("word").alias("n_tokens"),
        F.count(F.when(F.col("is_pos"), 1)).alias("pos_count"),
        F.count(F.when(F.col("is_neg"), 1)).alias("neg_count"),
    )
    return counts.select(
        "*",
        F.try_divide(F.col("pos_count").cast("double"), F.col("n_tokens")).alias("pos_score"),
        F.try_divide(F.col("neg_count").cast("double"), F.col("n_tokens")).alias("neg_score"),
        label(F.col("pos_count"), F.col("neg_count")).alias("sentiment"),
    )


def word_table(stop: DataFrame, positive: DataFrame, negative: DataFrame) -> DataFrame:
    """word, is_stop, is_positive, is_negative from three word lists (column ``word``) of any size, one row per word.

    Positive and negative words are cleaned by the text rule; stop words are matched as given, so only those of plain lower-case letters can match.
    """
    cleaned = F.lower(tx.trim_whitespace(tx.keep_letters("word"))).alias("word")

    def marked(df: DataFrame, word: Column, name: str) -> DataFrame:
        return df.select(word, *[F.lit(name == flag).alias(flag) for flag in ("is_stop", "is_positive", "is_negative")])

    words = marked(stop, F.col("word"), "is_stop").unionByName(marked(positive, cleaned, "is_positive")).unionByName(marked(negative, cleaned, "is_negative"))
    words = words.where(F.col("word").rlike("^[a-z]+$"))
    return words.groupBy("word").agg(*[F.max(flag).alias(flag) for flag in ("is_stop", "is_positive", "is_negative")])


def score_with_word_table(rows: DataFrame, row_id: str, text_col: str, words: DataFrame, broadcast_words: bool) -> DataFrame:
    """``row_id``, n_tokens, pos_count, neg_count, sentiment by a join with ``word_table``: the counts of ``score_text``.

    Tokens are joined to the words, which are broadcast on request (the caller knows their number) and shuffled
    otherwise. A token that holds a tab or line break keeps it when its words are deleted, so it counts and matches nothing. Static
    words join a micro-batch as they join a table.
    """
    text = F.lower(tx.trim_whitespace(tx.keep_letters(text_col)))
    toks = rows.select(row_id, F.explode_outer(tx.tokens(text)).alias("word"))
    j = toks.join(F.broadcast(words) if broadcast_words else words, "word", "left")
    kept = F.col("word").isNotNull() & ~F.coalesce(F.col("is_stop"), F.lit(False))
    counts = j.groupBy(row_id).agg(
        F.count(F.when(kept, 1)).alias("n_tokens"),
        F.count(F.when(kept & F.col("is_positive"), 1)).alias("pos_count"),
        F.count(F.when(kept & F.col("is_negative"), 1)).alias("neg_count"),
    )
    return counts.select("*", label(F.col("pos_count"), F.col("neg_count")).alias("sentiment"))
