"""Generations of the keyed table, the one-pass feedback stream, and word lists as tables."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketgraph.operators import sentiment as sent
from basketgraph.sources import shared_files as sf
from basketgraph.streaming import feedback_stream, journal
from basketgraph.streaming.feedback_stream import read_daily, read_dead_letters, read_lines, read_records, run_to_completion, start_feedback_stream
from basketgraph.streaming.generations import KeyedTable
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("at", T.LongType()), T.StructField("value", T.LongType())])


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "keyed"), SCHEMA, ["doc_id"], ["at", "value"])


def _batch(spark, found):
    return spark.createDataFrame(found, SCHEMA).withColumn("date", F.substring("doc_id", 1, 10))


def _brute(batches):
    best = {}
    for found in batches:
        for key, at, value in found:
            best[key] = max(best.get(key, (-1, -1)), (at, value))
    return sorted((k, *v) for k, v in best.items())


def test_generations_equal_all_batches(spark, table):
    rng = random.Random(4)
    batches = [[(f"2024-01-{rng.randrange(1, 6):02d}_{rng.randrange(4)}", rng.randrange(50), rng.randrange(9)) for _ in range(30)] for _ in range(7)]
    assert table.read().count() == 0 and table.compact().number == 0
    for i, found in enumerate(batches):
        table.write_batch(_batch(spark, found), i, "date")
        assert rows(table.read(), "doc_id", "at", "value") == _brute(batches[: i + 1])
        if i in (2, 5):
            table.compact()
            assert rows(table.read(), "doc_id", "at", "value") == _brute(batches[: i + 1])
        table.write_batch(_batch(spark, found), i, "date")  # replayed, before or after its compaction
        assert rows(table.read(), "doc_id", "at", "value") == _brute(batches[: i + 1])
    assert table.manifest().through == 5
    table.vacuum()
    assert rows(table.read(), "doc_id", "at", "value") == _brute(batches)


def test_compaction_rewrites_touched_days_only(spark, table):
    table.write_batch(_batch(spark, [("2024-01-01_1", 1, 1), ("2024-01-02_1", 1, 1)]), 0, "date")
    first = table.compact().days
    table.write_batch(_batch(spark, [("2024-01-02_1", 2, 5), ("2024-01-03_1", 1, 1)]), 1, "date")
    second = table.compact().days
    assert first["2024-01-01"] == second["2024-01-01"] and first["2024-01-02"] != second["2024-01-02"]
    assert set(second) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    # the same manifest name cannot be taken twice
    with pytest.raises(FileExistsError):
        sf.write_json(spark, f"{table.path}/manifests/{2:012d}.json", {"through": 0, "days": {}})


def test_a_batch_without_its_commit_is_not_read(spark, table):
    table.write_batch(_batch(spark, [("2024-01-01_1", 1, 1)]), 0, "date")
    latest = journal.latest_per_key(_batch(spark, [("2024-01-01_1", 9, 9)]).drop("date"), ["doc_id"], ["at", "value"])
    latest.withColumn(journal.BATCH_COL, F.lit(1).cast("long")).withColumn("day", F.lit("2024-01-01")).write.partitionBy("day").parquet(f"{table.path}/batches/{1:012d}")
    assert rows(table.read(), "doc_id", "at") == [("2024-01-01_1", 1)]


STOP, POS, NEG = ("is", "the"), ("good", "all-around"), ("bad",)


def _line(i, **more):
    return json.dumps({"customerid": str(i % 3), "productid": str(i), "rating": i % 5, "about": "x", "product": "p", **more})


LINES = [
    _line(1, about="the good, the allaround"), _line(2, about="is\tgood bad bad"), _line(3, about=""), _line(4, about="the\nthe good is"),
    _line(5, rating=2**40), _line(6)[:-1], "[6]", "", _line(7, about=None), _line(8, about="GOOD is Bad good\x0bgood good"),
]


@pytest.mark.parametrize("as_tables", [False, True])
def test_one_pass_commits_everything_and_replays_change_nothing(spark, tmp_path, as_tables):
    src, out = tmp_path / "lines", str(tmp_path / "out")
    src.mkdir()
    for i in range(0, len(LINES), 3):
        (src / f"{i}.txt").write_text("\n".join(LINES[i : i + 3]) + "\n")
    lists = [spark.createDataFrame([(w,) for w in words], "word string") for words in (STOP, POS, NEG)] if as_tables else (STOP, POS, NEG)
    for q in start_feedback_stream(read_lines(spark, "text", str(src), maxFilesPerTrigger=1), out, *lists, available_now=True):
        run_to_completion(q, 300)

    def state():
        return [rows(read_records(spark, out), "productid", "userid", "rating", "sentAnalysis"), rows(read_dead_letters(spark, out)), rows(read_daily(spark, out), "userid", "productid", "sentAnalysis")]

    before = state()
    assert [(r[0], r[3]) for r in before[0]] == [("1", "POSITIVE"), ("2", "NEGATIVE"), ("3", "NEUTRAL"), ("4", "POSITIVE"), ("8", "POSITIVE")]
    assert [r for _, r in sorted(before[1])] == [r for _, r in sorted([(LINES[4], "rating_out_of_range"), (LINES[5], "not_json_object"), ("[6]", "not_json_object"), ("", "not_json_object"), (LINES[8], "missing_field")])]
    commit = feedback_stream.FeedbackBatches(spark, out, *lists)
    for batch_id, i in enumerate(range(0, len(LINES), 3)):
        held = read_lines_of_batch(spark, src / f"{i}.txt")
        found = {r["productid"] for r in spark.read.schema(feedback_stream.RECORD).json(f"{out}/records/batch_id={batch_id}").collect()} if sf.exists(spark, f"{out}/records/batch_id={batch_id}") else set()
        mine = {r["customerid"] for r in held.collect()}
        if found and found <= mine:
            commit(spark.read.text(str(src / f"{i}.txt")), batch_id)
    assert state() == before
    commit(spark.createDataFrame([], "value string"), 99)
    assert state() == before


def read_lines_of_batch(spark, path):
    """Product ids of a file's lines, under the name customerid."""
    return feedback_stream.flag_feedback_lines(spark.read.text(str(path))).select(F.col("productid").alias("customerid"))


def test_two_hundred_thousand_words(spark):
    """Counts by the word table equal the literal sets, for lists far above what a plan should hold."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    positive, negative, stop = [word() for _ in range(120_000)], [word() + "-x" for _ in range(80_000)], ["aaa", "b", "the"]
    texts = [(i, " ".join(rng.choice(["the", "b", word(), word() + "x", word() + "\tb", "\tb\t", ""]) for _ in range(30))) for i in range(40)] + [(99, None), (100, "")]
    df = spark.createDataFrame(texts, "id long, text string")
    small = [set(positive), set(negative)]
    tables = [spark.createDataFrame([(w,) for w in words], "word string") for words in (stop, positive, negative)]
    words = sent.word_table(*tables).checkpoint()
    want = rows(sent.score_text(df, "text", stop, small[0], small[1], keep=["id"]).select("id", F.greatest("n_tokens", F.lit(0)).cast("long").alias("n"), F.col("pos_count").cast("long"), F.col("neg_count").cast("long"), "sentiment").where("id <> 99"))
    for broadcast in (True, False):
        got = sent.score_with_word_table(df, "id", "text", words, broadcast)
        assert rows(got.where("id <> 99"), "id", "n_tokens", "pos_count", "neg_count", "sentiment") == want
        assert rows(got.where("id = 99"), "n_tokens", "sentiment") == [(0, "NEUTRAL")]
    assert sum(r[2] for r in want) > 50 and sum(r[3] for r in want) > 20
