"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

The index is a written table of token postings (term, doc_id, pos) of the
training texts for the test items' terms. Each window of an item (``WINDOW``
consecutive words; the whole item if shorter) is searched from its rarest
terms: the postings of the rarest term give alignments (doc_id, item, delta),
and the offset-adjusted postings of the next rarest terms are intersected with
them. What is left is compared word by word, which also yields the spans.
``proximity_matches`` relaxes the offsets by a slop.

Defined results: null or empty texts have no words, match nothing and come back
with zero counts; an item without words has no window; repeated items match
each under its own id; rows of one item_id with different texts are items of
their own (no window mixes two texts) and are reported under the one id; an item with a null
item_id is searched too, counts as one item and adds no id to the list; several rows of one doc_id are judged each on its own
text and, if they have the same text, alike; rows with a null doc_id are judged
too. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

WINDOW = 13
#: Rarest words of a window whose postings are intersected.
PROBE_TERMS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands behind the last word of every text in the index, so its position is the text's length; no word can be a space.
END = " "
#: What stands between words before A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-@\[-`{-\x7F]+"


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def lowered(word: Column) -> Column:
    """A-Z in lower case; the character translation is slow, so only words with some capital go through it."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.transform(raw_words(text), lowered)


def row_key(key: str = "doc_id") -> Column:
    """Joins rows of a text with their postings; rows of one id and one text share it."""
    return F.struct(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("h"))


def numbered_items(items: DataFrame) -> DataFrame:
    """(item, item_id, ws): a written number for each distinct item_id and text; the index goes by it, as ids may be null or repeated."""
    rows = items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    ws = rows.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    return common.stored(ws.select(F.monotonically_increasing_id().alias("item"), "item_id", "ws"), "op2-items")


def item_terms(items: DataFrame) -> DataFrame:
    """(item, ws, n, off, term) per word of a numbered item; off counts from 0."""
    return items.select("item", "ws", F.size("ws").alias("n"), F.posexplode("ws").alias("off", "term"))


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, key, pos): where each term of the vocabulary stands in each text, and END behind each text's last word."""
    rows = docs.select(row_key().alias("key"), F.posexplode(F.array_append(raw_words(F.col("text")), F.lit(END))).alias("pos", "word"))
    rows = rows.select("key", "pos", lowered(F.col("word")).alias("term"))
    wanted = vocabulary.select("term").unionAll(vocabulary.sparkSession.range(1).select(F.lit(END).alias("term"))).distinct()
    return rows.join(common.broadcast_if_small(wanted), "term").select("term", "key", "pos")


def term_counts(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, freq) over all texts; 0 for a term that no text has."""
    return terms.select("term").distinct().join(index.groupBy("term").agg(F.count("*").alias("freq")), "term", "left").fillna(0, ["freq"])


def probes(terms: DataFrame, counts: DataFrame) -> DataFrame:
    """Per item the distinct triples of (offset, term) that its windows are searched by, rarest first."""
    per_item = terms.join(counts, "term").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("off", "freq", "term"))).alias("slots"))
    n_windows = F.greatest(F.size("slots") - (WINDOW - 1), F.lit(1))
    rarest = F.transform(
        F.sequence(F.lit(1), n_windows),
        lambda i: F.slice(F.sort_array(F.transform(F.slice("slots", i, F.lit(WINDOW)), lambda s: F.struct(s["freq"].alias("freq"), s["off"].alias("off"), s["term"].alias("term")))), 1, PROBE_TERMS),
    )
    return per_item.select("item", F.explode(F.array_distinct(rarest)).alias("slots"))


def alignments(index: DataFrame, probe: DataFrame) -> DataFrame:
    """(key, item, delta) where the terms of some probe stand at its offsets: item word i on text word delta + i."""
    numbered = probe.select("item", "slots", F.size("slots").alias("n"))
    found = index.join(
        common.broadcast_if_small(numbered.select("item", "slots", "n", F.col("slots")[0]["term"].alias("term"), F.col("slots")[0]["off"].alias("off"))), "term"
    ).select("key", "item", (F.col("pos") - F.col("off")).alias("delta"), "slots", "n")
    for k in range(1, PROBE_TERMS):
        # rows whose probe has no further term are done; the others need that term at its place
        expected = found.withColumn("term", F.when(F.col("n") > k, F.get("slots", F.lit(k))["term"])).withColumn("pos", F.when(F.col("n") > k, F.col("delta") + F.get("slots", F.lit(k))["off"]))
        long = expected.where(F.col("n") > k)
        kept = long.join(index, ["key", "pos", "term"], "left_semi").select(found.columns)
        found = expected.where(F.col("n") <= k).select(found.columns).unionAll(kept)
    return found.select("key", "item", "delta").distinct()


def phrase_spans(docs: DataFrame, items: DataFrame, aligned: DataFrame) -> DataFrame:
    """(key, hits, item_ids) of the texts in which some window occurs; hits: positions of hit words, from 1."""
    per_text = aligned.join(common.broadcast_if_small(items), "item").groupBy("key").agg(F.collect_set(F.struct("item_id", "delta", "ws")).alias("cands"))
    texts = docs.select(row_key().alias("key"), "text").join(common.broadcast_if_small(per_text.select("key"), 50_000), "key", "left_semi").dropDuplicates(["key"])
    joined = texts.select("key", words(F.col("text")).alias("words")).join(per_text, "key")

    def spans(c: Column) -> Column:
        """First word positions of the windows that match on this alignment."""
        length = F.least(F.size(c["ws"]), F.lit(WINDOW))
        starts = F.sequence(F.lit(1), F.size(c["ws"]) - length + 1)
        return F.filter(
            starts,
            lambda i: (c["delta"] + i >= 1)
            & (c["delta"] + i + length - 1 <= F.size("words"))
            & (F.slice("words", F.greatest(c["delta"] + i, F.lit(1)), length) == F.slice(c["ws"], i, length)),
        )

    per_cand = F.transform("cands", lambda c: F.struct(c["item_id"].alias("item_id"), c["delta"].alias("delta"), F.least(F.size(c["ws"]), F.lit(WINDOW)).alias("len"), spans(c).alias("at")))
    out = joined.select("key", F.filter(per_cand, lambda m: F.size(m["at"]) > 0).alias("m")).where(F.size("m") > 0)
    hits = F.array_distinct(F.flatten(F.flatten(F.transform("m", lambda m: F.transform(m["at"], lambda i: F.sequence(m["delta"] + i, m["delta"] + i + m["len"] - 1))))))
    return out.select("key", hits.alias("hits"), F.array_distinct(F.transform("m", lambda m: m["item_id"])).alias("item_ids"))


def proximity_matches(index: DataFrame, probe: DataFrame, slop: int) -> DataFrame:
    """(key, item, delta): probes whose terms stand near their offsets, each at most ``slop`` words off the rarest term's alignment."""
    slots = probe.select("item", "slots", F.monotonically_increasing_id().alias("probe"))
    rare = slots.select("item", "slots", "probe", F.col("slots")[0]["term"].alias("term"), F.col("slots")[0]["off"].alias("off"))
    found = index.join(rare, "term").select("key", "item", "probe", (F.col("pos") - F.col("off")).alias("delta"), "slots")
    others = found.select("key", "item", "probe", "delta", F.size("slots").alias("n"), F.explode_outer(F.slice("slots", F.lit(2), F.lit(PROBE_TERMS))).alias("s"))
    near = others.select("*", F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("shift")).select("*", (F.col("delta") + F.col("s.off") + F.col("shift")).alias("pos"), F.col("s.term").alias("term"))
    hit = near.join(index, ["key", "pos", "term"], "left_semi").groupBy("key", "item", "probe", "delta", "n").agg(F.countDistinct("s.off").alias("got"))
    alone = others.where(F.col("n") == 1).select("key", "item", "delta")
    return hit.where(F.col("got") == F.col("n") - 1).select("key", "item", "delta").unionAll(alone).distinct()


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash (with doc_id its row_key), n_words, hits (positions of hit words), item_ids (items with an occurring window)."""
    items = numbered_items(items)
    terms = common.stored(item_terms(items).select("item", "off", "term"), "op2-terms")
    index = common.stored(postings(docs, terms), "op2-postings")
    probe = common.stored(probes(terms, term_counts(index, terms)), "op2-probes")
    rare = index.join(common.broadcast_if_small(probe.select(F.explode("slots.term").alias("term")).distinct()), "term", "left_semi")
    aligned = common.stored(alignments(common.stored(rare, "op2-rare"), probe), "op2-alignments")
    found = common.stored(phrase_spans(docs, items, aligned), "op2-spans").withColumnRenamed("key", "own")
    rows = index.where(F.col("term") == END).join(found, F.col("key").eqNullSafe(F.col("own")), "left")
    return rows.select(F.col("key.id").alias("doc_id"), F.col("key.h").alias("text_hash"), F.col("pos").cast("long").alias("n_words"), F.coalesce(F.col("hits"), F.array().cast("array<int>")).alias("hits"), F.coalesce(F.col("item_ids"), F.array().cast(found.schema["item_ids"].dataType)).alias("item_ids"))


def verdict(found: DataFrame, *keep: str) -> DataFrame:
    """The digest columns of the contract, and the columns of ``found`` to keep."""
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    out = found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), *keep)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, unnest(list_transform(range(1, greatest(len(ws) - 11, 2)), lambda i: array_to_string(ws[i : i + 12], ' '))) AS win FROM b WHERE len(ws) > 0
), sizes AS (SELECT DISTINCT n FROM w
), dw AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i : i + n - 1], ' '))) AS win FROM d, sizes WHERE len(ws) >= n
), m AS (SELECT dw.doc_id, dw.i, dw.n, w.item_id FROM dw JOIN w ON dw.win = w.win AND dw.n = w.n
), h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY 1
), it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op2_decontamination", SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    items = common.read(spark, sf_dir, "benchmark").select("item_id", "text")
    return verdict(contamination(docs, items))
