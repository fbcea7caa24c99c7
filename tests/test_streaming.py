"""Stream/batch parity, dead letters, the keyed journal, restart from a checkpoint."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from basketgraph.operators import feedback as fb_ops
from basketgraph.streaming import journal
from basketgraph.streaming.feedback_stream import parse_feedback_lines, run_to_completion, score_feedback, start_json_sink

STOP, POS, NEG = ("is", "the"), ("good",), ("bad",)

LINES = [
    json.dumps({"customerid": "17850", "productid": "85123", "rating": 5, "about": "Apple is good\tand GOOD", "product": "Apple"}),
    json.dumps({"customerid": "1", "productid": "2", "rating": 1, "about": "bad, bad 123 é", "product": "x"}),
    json.dumps({"customerid": "1", "productid": "3", "rating": 3, "about": "", "product": "x"}),
    "nope",
    "[1]",
    json.dumps({"customerid": "1", "productid": "2", "about": "no rating"}),
]


def _write_lines(dir_, name, lines):
    dir_.mkdir(exist_ok=True)
    (dir_ / name).write_text("\n".join(lines) + "\n")


def test_dead_letters_and_reasons(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    records, dead = parse_feedback_lines(df)
    assert records.count() == 3
    reasons = sorted(r.reason for r in dead.collect())
    assert reasons == ["missing_field", "not_json_object", "not_json_object"]
    assert records.count() + dead.count() == len(LINES)


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    _write_lines(src, "a.txt", LINES[:3])
    _write_lines(src, "b.txt", LINES[3:])
    stream = spark.readStream.format("text").load(str(src))
    records, _ = parse_feedback_lines(stream)
    scored = score_feedback(records, STOP, POS, NEG)
    q = start_json_sink(scored, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    run_to_completion(q, 300)
    got = spark.read.schema(scored.schema).json(str(tmp_path / "out"))
    batch_records, _ = parse_feedback_lines(spark.read.text(str(src)))
    batch = score_feedback(batch_records, STOP, POS, NEG)
    cols = ["userid", "productid", "rating", "sentAnalysis"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    labels = {r.productid: r.sentAnalysis for r in got.collect()}
    assert labels == {"85123": "POSITIVE", "2": "NEGATIVE", "3": "NEUTRAL"}


def _events(spark, rows):
    return spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp, value double")


def test_journal_last_write_wins_and_replay(spark, tmp_path):
    import datetime as dt

    day = dt.datetime(2024, 1, 1)
    path = str(tmp_path / "journal")
    # two records of user 1 on one day, the later one arriving first
    b0 = _events(spark, [(1, 2, day.replace(hour=9), 2.0), (2, 3, day.replace(hour=1), 5.0)])
    b1 = _events(spark, [(1, 1, day.replace(hour=8), 1.0)])
    keyed = lambda df: df.select(journal.daily_key("ts", "user_id").alias("doc_id"), "*")
    journal.write_batch(keyed(b0), 0, path)
    journal.write_batch(keyed(b1), 1, path)
    journal.write_batch(keyed(b1), 1, path)  # replayed batch
    table = journal.read_table(spark, path, ["doc_id"], ["ts", "event_id"])
    got = sorted((r.doc_id, r.event_id, r.value) for r in table.collect())
    assert got == [("2024-01-01_1", 2, 2.0), ("2024-01-01_2", 3, 5.0)]
    assert spark.read.parquet(path).count() == 3  # the replay replaced its own partition only


def test_journal_stream_restart_from_checkpoint(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "journal"), str(tmp_path / "ck")
    src.mkdir()
    schema = "user_id long, event_id long, ts timestamp, value double"
    import datetime as dt

    def add(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / name))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(src))
        recs = stream.select(journal.daily_key("ts", "user_id").alias("doc_id"), "*")
        run_to_completion(journal.start_journal_sink(recs, out, ck, available_now=True), 300)

    t = dt.datetime(2024, 1, 2, 10)
    add("p0", [(1, 1, t, 1.0)])
    run()
    add("p1", [(1, 2, t.replace(hour=11), 2.0), (3, 3, t, 3.0)])
    run()  # restart: only the new file is read
    assert spark.read.parquet(out).count() == 3
    table = journal.read_table(spark, out, ["doc_id"], ["ts", "event_id"])
    assert sorted((r.user_id, r.value) for r in table.collect()) == [(1, 2.0), (3, 3.0)]


def test_feedback_edges_from_json(spark, tmp_path):
    p = tmp_path / "fb.json"
    p.write_text(json.dumps({"date": "2020-06-01", "userid": "12", "productid": "85", "rating": 4, "sentAnalysis": "POSITIVE"}) + "\n")
    from basketgraph.sources.files import read_feedback_json

    edges = fb_ops.feedback_edges(fb_ops.feedback_records_from_json(read_feedback_json(spark, str(p))))
    assert [tuple(r) for r in edges.collect()] == [("C12", "P85", 4, "POSITIVE", 20200601)]
    assert dict(edges.dtypes)["date_key"] == "int"
    assert edges.where(F.col("rating") > 0).count() == 1


def test_feedback_stream_three_sinks(spark, tmp_path):
    from basketgraph.streaming.feedback_stream import read_daily, read_lines, start_feedback_stream

    src = tmp_path / "lines"
    _write_lines(src, "a.txt", LINES)
    out = str(tmp_path / "pipe")
    for q in start_feedback_stream(read_lines(spark, "text", str(src)), out, STOP, POS, NEG, available_now=True):
        run_to_completion(q, 300)
    assert spark.read.json(f"{out}/records").count() == 3
    assert spark.read.json(f"{out}/dead_letters").count() == 3
    daily = read_daily(spark, out)
    # user 1 sent two records today: one document per user per day
    assert sorted(r.userid for r in daily.collect()) == ["1", "17850"]
    assert daily.where("userid = '1'").first().productid == "3"


def test_journal_compaction_and_event_dates(spark, tmp_path):
    import datetime as dt

    path, out = str(tmp_path / "journal"), str(tmp_path / "compact")
    day = dt.datetime(2024, 3, 1, 12)
    rows = _events(spark, [(5, 1, day, 1.0), (5, 2, day.replace(hour=13), 2.0)])
    journal.write_batch(rows.select(journal.daily_key("ts", "user_id").alias("doc_id"), "*"), 0, path)
    journal.compact(spark, path, out, ["doc_id"], ["ts", "event_id"])
    assert [(r.doc_id, r.value) for r in spark.read.parquet(out).collect()] == [("2024-03-01_5", 2.0)]

    recs = spark.createDataFrame(
        [("7", "9", 4, "nice one", dt.datetime(2020, 6, 1, 23, 59))],
        "customerid string, productid string, rating int, about string, ts timestamp",
    )
    out_rec = score_feedback(recs, STOP, ("nice",), NEG, event_date="ts").first()
    assert (out_rec.date, out_rec.userid, out_rec.sentAnalysis) == ("2020-06-01", "7", "POSITIVE")


def test_processing_time_trigger(spark, tmp_path):
    src = tmp_path / "live"
    _write_lines(src, "a.txt", LINES[:2])
    records, _ = parse_feedback_lines(spark.readStream.format("text").load(str(src)))
    q = start_json_sink(score_feedback(records, STOP, POS, NEG), str(tmp_path / "o"), str(tmp_path / "c"), interval="1 second")
    try:
        q.processAllAvailable()
        _write_lines(src, "b.txt", LINES[2:3])  # arrives while the query runs
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.json(str(tmp_path / "o")).count() == 3
