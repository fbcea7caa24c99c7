"""Readers and streams on inputs that the plain tables never hold."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketgraph import session
from basketgraph.sources import files
from basketgraph.streaming import feedback_stream, journal


def test_invoice_csv_keeps_quoted_descriptions_and_small_amounts(spark, tmp_path):
    path = tmp_path / "invoices.csv"
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    path.write_text(header + '1,A,"SET OF 3 ""RED"", BLUE",3,12/1/10 8:26,0.001,17850,X\n')
    row = files.read_invoice_csv(spark, str(path)).first()
    assert row["description"] == 'SET OF 3 "RED", BLUE'
    assert row["customer_id"] == "17850"
    assert row["amount"] == Decimal("0.003")


def test_rating_beyond_int_goes_to_the_dead_letters(spark):
    line = '{"customerid": 1, "productid": 2, "rating": %d, "about": "fine", "product": "p"}'
    lines = spark.createDataFrame([(line % 5,), (line % (1 << 40),)], "value string")
    records, dead = feedback_stream.parse_feedback_lines(lines)
    assert [r["rating"] for r in records.collect()] == [5]
    assert [r["reason"] for r in dead.collect()] == ["rating_out_of_range"]


def test_daily_key_is_null_if_a_part_is_null(spark):
    rows = spark.createDataFrame([("2024-01-01", 7), ("2024-01-01", None), (None, 7)], "d string, u long")
    keys = {r[0] for r in rows.select(journal.daily_key("d", "u")).collect()}
    assert keys == {"2024-01-01_7", None}


def test_a_cluster_without_checkpoint_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_available_now_has_no_limit_of_its_own(spark, tmp_path):
    spark.range(5).select(F.col("id").cast("string").alias("value")).write.text(str(tmp_path / "in"))
    lines = feedback_stream.read_lines(spark, "text", str(tmp_path / "in"))
    q = feedback_stream.start_json_sink(lines, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    feedback_stream.run_to_completion(q)
    assert spark.read.json(str(tmp_path / "out")).count() == 5
