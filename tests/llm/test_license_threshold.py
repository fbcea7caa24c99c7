"""The threshold of the licence scan comes from all unknown paragraphs, not from a sample of them."""

from basketgraph.llm import op4_licenses


def test_all_unknown_paragraphs_calibrate(spark, monkeypatch):
    monkeypatch.setattr(op4_licenses, "SAMPLE_PARAGRAPHS", 4)
    seen, least = [], op4_licenses.least_probability
    monkeypatch.setattr(op4_licenses, "least_probability", lambda likely, n: seen.append(n) or least(likely, n))
    rows = [(i, f"plain words number {i} here\n\nanother line {i} of them\n\n---") for i in range(150)] + [(900, "Released under the MIT License."), (901, None)]
    got = {r["doc_id"]: r["families"] for r in op4_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert seen == [300]
    assert got[900] == ["mit"] and got[901] == [] and got[5] == []


def test_the_share_is_of_all_unknown_paragraphs(spark):
    likely = spark.createDataFrame([(p / 100,) for p in range(55, 95)], "probability double")
    assert op4_licenses.least_probability(likely, 3000) == 0.91
    assert op4_licenses.least_probability(likely, 100_000) == 0.5
