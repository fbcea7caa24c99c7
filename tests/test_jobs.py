"""The three batch jobs end to end through the CLI entry point."""

from __future__ import annotations

import json

import pytest

from basketgraph import jobs
from basketgraph.sources.graph_files import read_graph_table

from .test_orders import HEADER, LINES
from .test_prices_graph import PRICE_HEADER, _price_row


def _header(path):
    part = next(p for p in path.iterdir() if p.name.startswith("part-") and p.stat().st_size > 0)
    return part.read_text().splitlines()[0]


def test_orders_job_graph_csv(spark, tmp_path):
    inv = tmp_path / "retail.csv"
    inv.write_text(HEADER + "\n".join(LINES) + "\n")
    out = tmp_path / "out"
    argv = ["orders", "--invoices", str(inv), "--out", str(out), "--format", "graph-csv", "--single-file"]
    assert jobs.main(argv, spark=spark) == 0
    assert len([p for p in (out / "buysEdge").iterdir() if p.name.startswith("part-")]) == 1
    assert _header(out / "orderNode") == ":ID;total_price:double;total_cost:double;delivery:double"
    assert _header(out / "buysEdge") == ":START_ID;:END_ID"
    assert _header(out / "customerNode") == ":ID;name:string;age:int;gender:string"
    assert _header(out / "containsEdge") == ":START_ID;:END_ID;quantity:int;unitprice:double;costprice:double"
    assert _header(out / "classifiedasEdge") == ":START_ID;:END_ID"
    assert _header(out / "segmentNode") == ":ID;segmentName:string"
    buys = read_graph_table(spark, str(out / "buysEdge"))
    assert buys.count() == 3
    supplied = read_graph_table(spark, str(out / "suppliedbyEdge")).collect()
    assert len(supplied) == 3 and all(r.dst.startswith("F") for r in supplied)


def test_mkt_and_feedback_jobs(spark, tmp_path):
    prices = tmp_path / "prices-fruit.csv"
    prices.write_text(PRICE_HEADER + _price_row("Apple", "2020/04", "1.0") + "\n")
    products = tmp_path / "products.csv"
    products.write_text("ProductID,ProductName,Type\n22728,Apple,Fruit\n")
    cats = tmp_path / "categories.csv"
    cats.write_text(":ID;categoryname:string\nCAT3;Fruit\n")
    munis = tmp_path / "municipalities.txt"
    munis.write_text("Municipality,Comarca,Province\nAbrera,Baix Llobregat,Barcelona\nBadalona,Barcelones,Barcelona\n")
    inv = tmp_path / "retail.csv"
    inv.write_text(HEADER + "\n".join(LINES) + "\n")
    out = tmp_path / "mkt"
    csv_out = tmp_path / "mktcsv"
    argv = ["mkt", "--prices", str(prices), "--products", str(products), "--categories", str(cats),
            "--municipalities", str(munis), "--invoices", str(inv), "--out", str(out)]
    assert jobs.main(argv, spark=spark) == 0
    nodes = {r.product_id: r for r in spark.read.parquet(str(out / "productNode")).collect()}
    assert nodes["P22728"].nameproduct == "Apple" and nodes["P22728"].marketpriceEU == 1.0
    assert [tuple(r) for r in spark.read.parquet(str(out / "belongstoEdge")).collect()] == [("P22728", "CAT3")]
    assert jobs.main(argv[:-1] + [str(csv_out), "--format", "graph-csv"], spark=spark) == 0
    assert _header(csv_out / "productNode") == ":ID;nameproduct:string;marketpriceEU:double"
    assert _header(csv_out / "priceInDateEdge") == ":START_ID;:END_ID;marketpriceEU:double"
    assert _header(csv_out / "farmerNode") == ":ID;farmername:string;location:string;experience:int"
    farmers = spark.read.parquet(str(out / "farmerNode")).collect()
    assert len(farmers) == jobs.DEFAULT_FARMERS and {r.location for r in farmers} <= {"Abrera", "Badalona"}

    fb = tmp_path / "fb.json"
    fb.write_text(json.dumps({"date": "2020-06-01", "userid": "1", "productid": "2", "rating": 4, "sentAnalysis": "NEUTRAL"}) + "\n")
    assert jobs.main(["feedback", "--feedback", str(fb), "--out", str(tmp_path / "fbout")], spark=spark) == 0
    assert spark.read.parquet(str(tmp_path / "fbout" / "feedbackEdge")).count() == 1
    argv = ["feedback", "--feedback", str(fb), "--out", str(tmp_path / "fbcsv"), "--format", "graph-csv"]
    assert jobs.main(argv, spark=spark) == 0
    assert _header(tmp_path / "fbcsv" / "feedbackEdge") == ":START_ID;:END_ID;rating:int;sentimentalAnalysis:string;date:int"


def test_stream_and_compact_jobs(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    lines = [
        json.dumps({"customerid": "1", "productid": "2", "rating": 5, "about": "good good", "product": "x"}),
        json.dumps({"customerid": "1", "productid": "3", "rating": 1, "about": "bad", "product": "y"}),
        "not json",
    ]
    (src / "a.txt").write_text("\n".join(lines) + "\n")
    for name, words in (("stop.txt", "the\n"), ("pos.txt", "good\n"), ("neg.txt", "bad\n")):
        (tmp_path / name).write_text(words)
    out = tmp_path / "fb"
    argv = ["stream", "--lines", str(src), "--stop", str(tmp_path / "stop.txt"), "--positive", str(tmp_path / "pos.txt"),
            "--negative", str(tmp_path / "neg.txt"), "--out", str(out), "--available-now"]
    assert jobs.main(argv, spark=spark) == 0
    assert spark.read.json(str(out / "records")).count() == 2
    assert spark.read.json(str(out / "dead_letters")).count() == 1
    assert jobs.main(["compact", "--journal", str(out / "daily"), "--out", str(tmp_path / "daily_compact")], spark=spark) == 0
    assert spark.read.parquet(str(tmp_path / "daily_compact")).count() == 1  # one user, one day


def test_dates_job_covers_written_edges(spark, tmp_path):
    inv = tmp_path / "retail.csv"
    inv.write_text(HEADER + "\n".join(LINES) + "\n")
    fb = tmp_path / "fb.json"
    fb.write_text(json.dumps({"date": "2010-12-05", "userid": "1", "productid": "2", "rating": 4, "sentAnalysis": "NEUTRAL"}) + "\n")
    for fmt in ("parquet", "graph-csv"):
        out = tmp_path / f"graph-{fmt}"
        assert jobs.main(["orders", "--invoices", str(inv), "--out", str(out), "--format", fmt], spark=spark) == 0
        assert jobs.main(["feedback", "--feedback", str(fb), "--out", str(out), "--format", fmt], spark=spark) == 0
        assert jobs.main(["dates", "--out", str(out), "--format", fmt], spark=spark) == 0
        nodes = read_graph_table(spark, str(out / "dateNode")) if fmt == "graph-csv" else spark.read.parquet(str(out / "dateNode"))
        ids = sorted(r.id for r in nodes.collect())
        assert ids == ["20101201", "20101202", "20101203", "20101204", "20101205"]


def test_cli_runs_as_a_process(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    fb = tmp_path / "fb.json"
    fb.write_text(json.dumps({"date": "2020-06-01", "userid": "12", "productid": "85", "rating": 4, "sentAnalysis": "POSITIVE"}) + "\n")
    out = tmp_path / "out"
    repo = Path(__file__).resolve().parents[1]
    cmd = [sys.executable, "-m", "basketgraph.jobs", "feedback", "--feedback", str(fb), "--out", str(out),
           "--format", "graph-csv", "--single-file"]
    done = subprocess.run(cmd, cwd=repo, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    part = next(p for p in (out / "feedbackEdge").iterdir() if p.name.startswith("part-"))
    assert part.read_text().splitlines() == [
        ":START_ID;:END_ID;rating:int;sentimentalAnalysis:string;date:int",
        "C12;P85;4;POSITIVE;20200601",
    ]


def test_graph_job_assembles_written_files(spark, tmp_path):
    """One command builds the graph; each edge type's joins run once, and kept and rejected edges sum to the input."""
    inv = tmp_path / "retail.csv"
    inv.write_text(HEADER + "\n".join(LINES) + "\n")
    src = tmp_path / "files"
    assert jobs.main(["orders", "--invoices", str(inv), "--out", str(src), "--format", "graph-csv"], spark=spark) == 0
    assert jobs.main(["dates", "--out", str(src), "--format", "graph-csv"], spark=spark) == 0
    out = tmp_path / "graph"
    assert jobs.main(["graph", "--input", str(src), "--out", str(out), "--format", "graph-csv"], spark=spark) == 0
    rejects = spark.read.parquet(str(out / "rejects"))
    for name, table in (("buys", "buysEdge"), ("contains", "containsEdge"), ("in_date", "indateEdge"), ("classified_as", "classifiedasEdge")):
        given = read_graph_table(spark, str(src / table)).count()
        kept = spark.read.parquet(str(out / "edges" / name)).count()
        lost = rejects.where(f"edge_type = '{name}'").count()
        assert kept + lost == given > 0, name
        # no product table was written: every contains edge misses its end
        assert (kept == 0) == (name == "contains"), name
    assert {r.reason for r in rejects.collect()} == {"missing_dst"}
    with pytest.raises(ValueError, match="no edge tables"):
        jobs.main(["graph", "--input", str(tmp_path / "none"), "--out", str(tmp_path / "x")], spark=spark)
