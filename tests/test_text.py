"""Text cleaning and sentiment, including the traps of the cleaning chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketgraph.functions import text as tx
from basketgraph.operators import sentiment as sent

STOP = ("the", "a", "is", "co.", "inc.", "no-one")
POS = ("good", "great", "nice")
NEG = ("bad", "awful")


def _clean(spark, texts, literal=True):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(tx.clean_text("t", STOP, literal)).collect()]


def test_letters_trim_lower(spark):
    out = _clean(spark, ["\tThe Café is GREAT!!\n", "abc 123 déf", "...!!!"])
    assert out == [" caf  great", "abc  df", ""]


def test_stop_words_whole_words_and_quoting(spark):
    assert _clean(spark, ["the theme is a cop inch"]) == [" theme   cop inch"]
    # as raw patterns "co." and "inc." also delete "cop" and "inch"
    assert _clean(spark, ["the cop inch"], literal=False) == ["  "]


def test_tokens_skip_empties_and_keep_tabs(spark):
    df = spark.createDataFrame([("a  b\tc ",), ("",), ("   ",)], "t string")
    sizes = [r[0] for r in df.select(F.size(tx.tokens("t"))).collect()]
    assert sizes == [2, 0, 0]


def test_sentiment_labels(spark):
    docs = spark.createDataFrame(
        [(1, "Good, great day"), (2, "bad bad nice"), (3, "good and bad"), (4, "the a is"), (5, "?!")],
        "id long, text string",
    )
    out = {r.id: r for r in sent.score_text(docs, "text", STOP, POS, NEG, keep=["id"]).collect()}
    assert out[1].sentiment == "POSITIVE" and out[1].pos_count == 2 and out[1].n_tokens == 3
    assert out[2].sentiment == "NEGATIVE"
    assert out[3].sentiment == "NEUTRAL"  # equal counts
    assert out[4].sentiment == "NEUTRAL" and out[4].n_tokens == 0 and out[4].pos_score is None  # only stop words
    assert out[5].sentiment == "NEUTRAL" and out[5].n_tokens == 0  # only punctuation


def test_lexicon_table_path_matches_literal_path(spark):
    docs = spark.createDataFrame(
        [(1, "good good bad"), (2, "nothing here"), (3, ""), (4, "awful nice great")], "id long, text string"
    )
    lex = spark.createDataFrame(
        [(w, "POSITIVE") for w in POS] + [(w, "NEGATIVE") for w in NEG], "word string, polarity string"
    )
    a = sent.score_text(docs, "text", STOP, POS, NEG, keep=["id"]).select("id", "n_tokens", "pos_count", "neg_count", "sentiment")
    b = sent.score_text_with_lexicon(docs, "id", "text", STOP, lex).select("id", "n_tokens", "pos_count", "neg_count", "sentiment")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_membership_is_a_hash_set(spark):
    words = [f"w{i}" for i in range(50)]
    df = spark.createDataFrame([("w1 x",)], "t string")
    plan = df.select(tx.count_in(tx.tokens("t"), words).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan.upper()


def test_lexicon_normalised_like_the_text(spark):
    assert tx.normalize_words(["All-around", " good ", "***", "good"]) == ["allaround", "good"]
    docs = spark.createDataFrame([(1, "An all-around winner")], "id long, text string")
    on = sent.score_text(docs, "text", STOP, ["all-around"], NEG, keep=["id"]).first()
    off = sent.score_text(docs, "text", STOP, ["all-around"], NEG, keep=["id"], normalize_lexicon=False).first()
    assert (on.pos_count, on.sentiment) == (1, "POSITIVE")
    assert (off.pos_count, off.sentiment) == (0, "NEUTRAL")


def test_lexicon_table_is_normalised_too(spark):
    docs = spark.createDataFrame([(1, "An all-around winner")], "id long, text string")
    lex = spark.createDataFrame([("All-around", "POSITIVE")], "word string, polarity string")
    r = sent.score_text_with_lexicon(docs, "id", "text", STOP, lex).first()
    assert (r.pos_count, r.sentiment) == (1, "POSITIVE")


def test_stop_words_by_set_equal_the_regex(spark):
    """Deleting runs by set lookup equals deleting words by one alternation, white space included."""
    import random

    from pyspark.sql import functions as F

    from basketgraph.functions import text as tx

    rng = random.Random(8)
    words = ["a", "ab", "the", "of", "THE", "co.", "b-c", "", "é", "zz"]
    texts = ["".join(rng.choice(["a", "ab", "The", "of", "OF", " ", "  ", "\t", "\n", "\x0b", "é", "co.", "b-c", "1", "zzz", "zz"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", None, "  "])], "id long, text string")
    base = F.lower(tx.trim_whitespace(tx.keep_letters("text")))
    got = df.select("id", tx.clean_text("text", words).alias("set"), tx.remove_words(base, words).alias("regex")).where("NOT (set <=> regex)")
    assert got.collect() == []
    phrase = df.select(tx.clean_text("text", ["the of"]).alias("set"), tx.remove_words(base, ["the of"]).alias("regex")).where("NOT (set <=> regex)")
    assert phrase.collect() == []
    plan = df.select(tx.clean_text("text", [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(5000)]).alias("c"))
    assert plan.where("c IS NULL").count() == 1
