"""Texts under a null or repeated doc_id are documents of their own in op5, op9 and the pipeline's stages."""

from __future__ import annotations

import pytest

import corpus_pipeline
from basketgraph.llm import common, op5_suffix_dedup, op9_neardup
from tests.conftest import spark  # noqa: F401

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def prose(tag, n=60):
    return " ".join(f"{tag}{i * 7919 % 997}" for i in range(n))


SHARED = prose("shared", 30)
HEAD, TAIL, OTHER = prose("head", 8)[:50], prose("tail"), prose("other")
#: The passage stands at byte 50 and at byte 200 of two texts without an id; a third pair has it at the same start.
EARLY, LATE = HEAD + SHARED + TAIL, prose("long", 40)[:200] + SHARED + OTHER
SAME = [HEAD.upper() + SHARED + prose("p"), HEAD.title() + SHARED + prose("q")]
ROWS = [(None, EARLY), (None, LATE), *[(None, t) for t in SAME], (7, prose("x") + prose("copy")), (7, prose("y") + prose("copy")), (8, prose("z"))]


def table(spark, rows):  # noqa: F811
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def windows(data):
    return [data[k : k + 100] for k in range(len(data) - 99)]


def test_repeated_text_goes_by_document(spark):  # noqa: F811
    cut = op5_suffix_dedup.deduplicated(table(spark, ROWS)).collect()
    assert len(cut) == len(ROWS)
    kept = [bytes(r["kept"]) for r in cut]
    # every window of the input is left exactly once or was cut through; own bytes of every document stay
    for own in (TAIL, OTHER, prose("p"), prose("q"), prose("x"), prose("y"), prose("z")):
        assert sum(own.encode()[1:-8] in k for k in kept) == 1  # the digits before a copied passage agree too
    for text in (SHARED, prose("copy")):
        assert sum(text.encode() in k for k in kept) == 1
    every = [w for k in kept for w in set(windows(k))]
    assert len(every) == len(set(every))
    twice = op5_suffix_dedup.deduplicated(table(spark, [(None, OTHER)] * 3 + [(5, TAIL)] * 2)).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in twice) == [(0, 0), (0, len(OTHER)), (0, len(OTHER)), (5, 0), (5, 0)]


def test_near_duplicates_go_by_document(spark):  # noqa: F811
    near = lambda t: t + " end"
    rows = [(None, TAIL), (None, TAIL), (None, near(TAIL)), (None, OTHER), (3, prose("n")), (None, near(prose("n"))), (4, prose("r")), (4, prose("s")), (9, near(prose("s"))), (5, prose("t")), (5, near(prose("t"))), (None, None), (None, "")]
    got = op9_neardup.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    count = {}
    for r in got:
        count[r["doc_id"], r["component_id"], r["kept"]] = count.get((r["doc_id"], r["component_id"], r["kept"]), 0) + 1
    # without an id: one of three TAIL texts, OTHER and both empty ones are kept
    assert count == {(None, None, True): 4, (None, None, False): 2, (3, 3, True): 1, (None, 3, False): 1, (4, 4, True): 2, (9, 4, False): 1, (5, 5, True): 1, (5, 5, False): 1}


def test_stages_go_by_document(spark, tmp_path):  # noqa: F811
    item = next(r["text"] for r in common.read(spark, SF, "benchmark").collect() if len(r["text"].split()) >= 13)
    clean = [(None, OTHER), (6, prose("six")), (None, prose("kept"))]
    docs = table(spark, [*clean, (None, item), (6, item + " it")])
    assert sorted(r["text"] for r in corpus_pipeline.decontamination(spark, docs, SF).collect()) == sorted(t for _, t in clean)
    docs = table(spark, [*clean, (None, OTHER), (None, OTHER + " end")])
    left = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert len(left) == 3 and {r["text"][:30] for r in left} == {t[:30] for _, t in clean}
    cut = [r["text"] for r in corpus_pipeline.repeated_text(spark, table(spark, ROWS), SF).collect()]
    want = [bytes(r["kept"]).decode() for r in op5_suffix_dedup.deduplicated(table(spark, ROWS)).collect()]
    assert len(cut) == len(ROWS) and sorted(map(len, cut)) == sorted(map(len, want)) and sum(SHARED in t for t in cut) == 1
