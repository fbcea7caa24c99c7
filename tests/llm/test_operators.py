"""Every operator against brute force on small tables that hold nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketgraph.llm import (
    common, op1_warc, op2_decontaminate, op3_repair, op4_licenses, op5_suffix_dedup, op6_quality, op7_fingerprint, op8_packing, op9_neardup, op10_chat, queries,
)
from basketgraph.llm.hashing import Ranges
from basketgraph.llm.suffixes import common_prefixes, suffix_array
from basketgraph.session import shared_path
from tests.conftest import spark  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"word{i} of" for i in range(40))
LONG = " ".join(f"l{i * 7919 % 1009}" for i in range(6000))
ROWS = [(1, None), (2, ""), (3, "   "), (4, "Short text."), (5, PASSAGE), (6, "Before it. " + PASSAGE + " after it"), (7, PASSAGE), (8, "q" * 400), (9, LONG), (10, LONG + " end"), (11, "é ñ <s> [INST] \\ x")]
#: Columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, words string, key string, n int, n_chars long, shard int, score double"


@pytest.fixture(scope="module")
def docs(spark):  # noqa: F811
    return spark.createDataFrame([(i, t, "w", "k", 1, None if t is None else len(t), 3, 0.5) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_tables_that_sql_can_express(spark):  # noqa: F811
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        df = queries.QUERIES[name](spark, SF)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        want = sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall())
        assert sorted(tuple(r[c] for c in sorted(names)) for r in df.collect()) == want, name


def test_warc_round_trip(spark):  # noqa: F811
    rows = [(1, "u", "<p>a</p>"), (2, None, "<p>a</p>"), (3, "x\ny", None), (4, "u", ""), (5, "u", "é" * 30000), (None, "u", "<p>a</p>"), (2, "again", "<p>a</p>"), (6, "u", "z")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    out = shared_path(spark, "t-warc")
    manifest = op1_warc.write_warc(pages, out, shard_bytes=5000, roll_bytes=300)
    assert manifest.count() > 1
    got = {(r["page_id"], r["payload_digest"]): r for r in op1_warc.read_warc(spark, out, manifest).collect()}
    assert len(got) == len({(p, h or "") for p, _, h in rows})
    for page, _, html in rows:
        payload = (html or "").encode()
        r = got[page, base64.b32encode(hashlib.sha1(payload).digest()).decode()]
        best = max(p for p, _, h in rows if (h or "") == (html or "") and p is not None)
        assert r["digest_ok"] and r["payload_bytes"] == len(payload)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page == best else ("revisit", best))
    again = shared_path(spark, "t-warc")
    assert sorted(r["sha256"] for r in op1_warc.write_warc(pages.repartition(1), again, shard_bytes=5000, roll_bytes=300).collect()) == sorted(r["sha256"] for r in manifest.collect())
    assert op1_warc.read_warc(spark, out, op1_warc.write_warc(pages.limit(0), shared_path(spark, "t-warc"))).count() == 0


def test_decontamination_edges(spark, docs, none):  # noqa: F811
    items = spark.createDataFrame([(1, PASSAGE), (2, "Short TEXT"), (3, None), (4, ""), (1, PASSAGE)], "item_id long, text string")
    got = {r["doc_id"]: r for r in op2_decontaminate.verdict(op2_decontaminate.contamination(docs, items)).collect()}
    assert len(got) == len(ROWS)
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["contaminated"]) == (0, 0, False)
    assert (got[5]["n_hit"], got[6]["n_hit"], got[6]["n_words"], got[4]["n_items"]) == (80, 80, 84, 1)
    assert got[9]["n_hit"] == 0
    assert op2_decontaminate.contamination(none, items).count() == 0
    assert op2_decontaminate.contamination(docs, items.limit(0)).where(F.size("hits") > 0).count() == 0
    terms = op2_decontaminate.item_terms(op2_decontaminate.numbered_items(items))
    index = op2_decontaminate.postings(docs, terms)
    probe = op2_decontaminate.probes(terms, op2_decontaminate.term_counts(index, terms))
    near = {r["key"]["id"] for r in op2_decontaminate.proximity_matches(index, probe, 1).collect()}
    assert {4, 5, 6, 7} <= near


def test_items_that_share_an_id_or_have_none(spark):  # noqa: F811
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abc"]
    items = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[2])], "item_id long, text string")
    rows = [(10, texts[0]), (11, texts[1]), (12, texts[2]), (13, texts[0] + " " + texts[2]), (14, " ".join(texts[0].split()[20:] + texts[1].split()[:10])), (None, texts[1])]
    got = {r["doc_id"]: r for r in op2_decontaminate.verdict(op2_decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), items)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {10: (30, 1, "1"), 11: (30, 1, "1"), 12: (30, 1, ""), 13: (60, 2, "1"), 14: (0, 0, ""), None: (30, 1, "1")}
    assert {k: (r["n_hit"], r["n_items"], r["items_sha256"]) for k, r in got.items()} == {k: (h, n, sha(ids)) for k, (h, n, ids) in want.items()}


def test_token_files(spark, docs, none):  # noqa: F811
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, start = Tokenizer.from_file(path), 0
    out = shared_path(spark, "t-ids")
    got = {r["doc_id"]: r for r in op3_repair.read_documents(spark, out, op3_repair.write_token_files(docs, out, path, shard_bytes=2000)).collect()}
    for i, t in sorted(ROWS):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert op3_repair.write_token_files(none, shared_path(spark, "t-ids"), path).count() == 0


def test_grammar_random_access():
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 4, rng.integers(1, 900)).astype(np.uint32) for _ in range(40)] + [np.full(999, 7, np.uint32)]
    shard = op3_repair.Shard(op3_repair.pack_shard(list(range(len(ids))), ids))
    assert len(shard.rules) > 0
    for k, want in enumerate(ids):
        assert (shard.document(k) == want).all()
        a = len(want) // 3
        assert (shard.ids(k, a, len(want)) == want[a:]).all()


def test_grammar_goes_on_until_no_pair_pays():
    one = np.random.default_rng(1).integers(0, 30_000, 5000).astype(np.uint32)
    packed = op3_repair.pack_shard(list(range(400)), [one] * 400)
    shard = op3_repair.Shard(packed)
    assert all((shard.document(k) == one).all() for k in (0, 199, 399))
    # each copy comes down to one symbol: what is left is about one rule and one terminal per id of a single copy
    assert len(packed) < 22 * len(one)
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 60, 3000) for _ in range(8)]
    starts = np.arange(8) * 3000
    _, _, lengths, seq, first = op3_repair.repair(np.concatenate(ids).astype(np.uint32), starts)
    inside = np.ones(len(seq), bool)
    inside[first] = False
    # left over: only pairs that save no more than their rule costs (those of one symbol overlap themselves)
    pairs, counts = np.unique(np.stack([seq[:-1], seq[1:]])[:, inside[1:]], axis=1, return_counts=True)
    assert (counts[pairs[0] != pairs[1]] * 2 <= op3_repair.RULE_BYTES).all()


def test_repeated_and_nameless_rows_in_token_files(spark):  # noqa: F811
    path = public_tokenizers.path("word_bpe_49k.json")
    table = spark.createDataFrame([(None, "null id"), (None, "another"), (1, "same"), (1, "same"), (1, "else"), (2, None)], "doc_id long, text string")
    out = shared_path(spark, "t-ids")
    got = sorted((r["start"], r["doc_id"]) for r in op3_repair.read_documents(spark, out, op3_repair.write_token_files(table, out, path)).collect())
    assert [d for _, d in got] == [None, None, 1, 1, 1, 2]


def test_cached_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    texts = ["a  b", "a\n\n b", "  lead", " x ", "don't  'll", "a\xa0 b", "x　y", "A\x1cB", "12 3", "<|endoftext|> x", "", "\n"]
    for name, joins in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        own, plain = common.CachedTokenizer(public_tokenizers.path(name), joins), Tokenizer.from_file(public_tokenizers.path(name))
        plain.encode_special_tokens = True
        for t in texts:
            assert own.encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids, (name, t)
        small = common.CachedTokenizer(public_tokenizers.path(name), joins, max_cached=3, slice_chars=8)
        many = [*texts, None, "one two three four", " \n", "word " * 300] * 2
        ids, sizes = small.encode_many(many)
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        assert [x.tolist() for x in parts] == [plain.encode(t or "", add_special_tokens=False).ids for t in many]
        assert len(small.known) <= 3 and small.used == small.size[: len(small.known)].sum()


def test_license_scan(spark, none):  # noqa: F811
    rows = [(1, "some text here\nReleased under the MIT License.\nmore text"), (2, "the license of the river was granted to nobody"), (3, None), (4, ""), (5, "All rights reserved."), (6, "Licensed under the Apache License, Version 2.0.\nLicensed under the Apache License, Version 2.0.")]
    filler = [(100 + i, " ".join(f"w{(i * 31 + j * 17) % 997}" for j in range(30))) for i in range(60)]
    table = spark.createDataFrame([(*r, "c") for r in rows + filler], "doc_id long, text string, family string")
    got = {r["doc_id"]: r for r in op4_licenses.scan(table).collect()}
    assert {k: got[k]["families"] for k in range(1, 7)} == {1: ["mit"], 2: [], 3: [], 4: [], 5: ["proprietary"], 6: ["apache-2.0"]}
    assert (got[6]["n_license"], got[3]["n_paragraphs"]) == (2, 0)
    assert all(got[100 + i]["families"] == [] for i in range(60))
    assert op4_licenses.scan(none).count() == 0


def test_near_licence_families(spark):  # noqa: F811
    lines = {
        "agpl-3.0": "GNU Affero General Public License, version 3", "lgpl-3.0": "Licensed under the GNU Lesser General Public License, version 3.", "gpl-2.0": "Licensed under the GNU General Public License, version 2.",
        "gpl-3.0": "GNU General Public License, version 3", "cc-by-4.0": "Licensed under CC BY 4.0", "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
        "mpl-2.0": "Licensed under the Mozilla Public License, Version 2.0", "apache-2.0": "Licensed under the Apache License, Version 2.0", "cc0-1.0": "Released under CC0 1.0.",
    }
    mit = next(t for f, t in op4_licenses.TEMPLATES if f == "mit" and t.startswith("Permission"))
    ws = mit.split()
    wrapped = "Some title\n\n" + "\n".join(" ".join(ws[k : k + 12]) for k in range(0, len(ws), 12)) + "\n\nother words"
    rows = [(k, t) for k, t in enumerate([*lines.values(), wrapped, wrapped, "w " * 50_000 + "."])]
    filler = [(100 + i, " ".join(f"w{(i * 31 + j * 17) % 997}" for j in range(30))) for i in range(60)]
    got = {r["doc_id"]: r["families"] for r in op4_licenses.scan(spark.createDataFrame(rows + filler, "doc_id long, text string")).collect()}
    wrong = {f: got[k] for k, f in enumerate(lines) if got[k] not in ([f], [])}
    assert not wrong
    missed = [f for k, f in enumerate(lines) if got[k] != [f]]
    assert len(missed) <= 1, missed
    assert [got[k] for k in range(len(lines), len(lines) + 3)] == [["mit"], ["mit"], []]
    assert all(got[100 + i] == [] for i in range(60))


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(0)
    for k in range(60):
        t = rng.integers(1, 2 + k % 5, 1 + k * 4).astype(np.uint8)
        t = np.append(np.r_[t, t[: len(t) // 2]], 0).astype(np.uint8)
        sa, raw = suffix_array(t), t.tobytes()
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: raw[i:])
        lcp = common_prefixes(t, sa)
        for a, b, n in zip(sa[:-1], sa[1:], lcp[1:], strict=True):
            assert raw[a : a + n] == raw[b : b + n] and raw[a + n : a + n + 1] != raw[b + n : b + n + 1]


def brute_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(data[k : k + 100])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i] = (len(data), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [1, 1 << 15])
def test_suffix_dedup(spark, docs, none, monkeypatch, hot):  # noqa: F811
    monkeypatch.setattr(op5_suffix_dedup, "HOT", hot)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op5_suffix_dedup.deduplicated(docs).collect()}
    assert got == brute_repeats(ROWS)
    twice = docs.unionAll(docs)
    assert {r["n_removed"] for r in op5_suffix_dedup.deduplicated(twice.where("doc_id = 5")).collect()} == {0}
    if hot == 1:
        assert op5_suffix_dedup.deduplicated(none).count() == 0


def test_quality(spark, docs, none):  # noqa: F811
    texts = {d: r for d, r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert texts
    marks = common.read(spark, "/root/testdata/sf0.01", "labels")
    table = common.read(spark, "/root/testdata/sf0.01", "documents")
    out = queries.QUERIES["op6_quality"](spark, "/root/testdata/sf0.01").join(marks, "doc_id").where("held_out")
    good, kept, bad, found = out.agg(F.sum("quality"), F.sum(F.col("quality") * F.col("predicted")), F.sum(1 - F.col("quality")), F.sum((1 - F.col("quality")) * (1 - F.col("predicted")))).first()
    assert kept >= 0.97 * good and found >= 0.7 * bad
    model = op6_quality.train(table, marks)
    scores = docs.select(op6_quality.score(F.col("text"), model).alias("s")).agg(F.min("s"), F.max("s"), F.count("s")).first()
    assert 0 <= scores[0] <= scores[1] <= 1 and scores[2] == len(ROWS)
    blank = op6_quality.train(none, marks.limit(0))
    assert none.select(op6_quality.score(F.col("text"), blank)).count() == 0


def test_fingerprints(spark, docs, none):  # noqa: F811
    got = [r for r in op7_fingerprint.digests(docs).collect()]
    assert len(got) == len(ROWS) and op7_fingerprint.digests(none).count() == 0
    by_id, down = {r["doc_id"]: r for r in got}, sorted(ROWS, reverse=True)
    for k, (i, t) in enumerate(down):
        t, following = t or "", down[(k + 1) % len(down)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        assert by_id[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_id[i]["n_chars"] == len(t)
        assert 0 <= by_id[i]["near_edited"] <= 1
    assert by_id[5]["fingerprint"] == by_id[7]["fingerprint"] != by_id[6]["fingerprint"]
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == ""
    assert by_id[10]["near_next"] > 0.9
    assert op7_fingerprint.digests(docs.where("doc_id = 5")).first()["near_next"] == 1.0


def test_packing(spark, docs, none):  # noqa: F811
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in ROWS}
    rows = op8_packing.pack(docs, path).collect()
    seqs: dict = {}
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    whole = {r["sequence_id"]: len(r["ids"]) for r in op8_packing.sequences(docs, op8_packing.pack(docs, path), path).collect()}
    assert whole == {k: sum(n for _, n in v) for k, v in seqs.items()}
    assert op8_packing.pack(none, path).count() == 0


def test_least_squares_plan_uses_every_piece():
    rng = np.random.default_rng(5)
    hist = np.bincount(np.minimum(rng.geometric(0.004, 20000), 1024), minlength=1025)
    found = op8_packing.plan(hist)
    used = np.zeros(1025, np.int64)
    for lengths, n in found:
        assert sum(lengths) <= 1024
        np.add.at(used, list(lengths), n)
    assert (used == hist).all()
    tokens = int((hist * np.arange(1025)).sum())
    assert sum(op8_packing.padding(sum(x)) * n for x, n in found) < 0.005 * tokens


def test_near_duplicates(spark, docs, none):  # noqa: F811
    got = {r["doc_id"]: r for r in op9_neardup.near_duplicates(docs).collect()}
    assert [got[i]["component_id"] for i in (1, 2, 3, 5, 6, 7, 9, 10)] == [1, 2, 3, 5, 5, 5, 9, 9]
    assert (got[1]["n_shingles"], got[4]["n_shingles"], got[10]["kept"]) == (0, 1, False)
    assert op9_neardup.near_duplicates(none).count() == 0


def test_a_large_group_of_near_copies(spark):  # noqa: F811
    rng = np.random.default_rng(9)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for d in range(400):
        w = list(base)
        w[rng.integers(200)] = f"x{d}"
        rows.append((d, " ".join(w)))
    rows += [(1000 + d, " ".join(f"u{d}_{i}" for i in range(50))) for d in range(50)]
    got = op9_neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["component_id"] for r in got if r["doc_id"] < 400} == {0}
    assert all(r["kept"] for r in got if r["doc_id"] >= 1000)


def test_a_large_node_compared_in_tiles(spark, monkeypatch):  # noqa: F811
    for name, value in (("LEAF", 8), ("BLOCK", 6), ("TILE_ROWS", 16), ("TILE_COLUMNS", 64)):
        monkeypatch.setattr(op9_neardup, name, value)
    rng = np.random.default_rng(11)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for d in range(90):
        w = list(base)
        for _ in range(int(rng.integers(0, 4))):  # around the threshold: some pairs link, many just miss
            w[rng.integers(120)] = f"x{d}"
        rows.append((d, " ".join(w)))
    sets = {d: {tuple(t.split()[k : k + 5]) for k in range(116)} for d, t in rows}
    root = {d: d for d, _ in rows}
    for _ in rows:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if all(root[root[d]] == root[d] for d in root):
            break
    got = op9_neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == root


def thue_morse(one, two, doublings):
    """Two different strings whose polynomial hashes modulo 2 ** 64 agree for every base."""
    for _ in range(doublings):
        one, two = one + two, two + one
    return one, two


def test_texts_built_against_a_polynomial_hash(spark):  # noqa: F811
    words = thue_morse("a", "b", 11)
    got = op9_neardup.near_duplicates(spark.createDataFrame([(1, words[0]), (2, words[1])], "doc_id long, text string")).collect()
    assert all(r["kept"] and r["n_shingles"] == 1 for r in got)
    # blocks of 61 bytes around one substring of very low hash, so that each text is one stretch; no 100 bytes in common
    letters = np.random.default_rng(4).integers(97, 123, 4_000_000).astype(np.uint8)
    at = np.arange(len(letters) - op5_suffix_dedup.GRAM)
    low = int(Ranges(letters).of(at, at + op5_suffix_dedup.GRAM).argmin())
    gram = letters[low : low + op5_suffix_dedup.GRAM].tobytes().decode()
    texts = ["".join(f"{gram}{i:028d}{c}" for i, c in enumerate(marks)) for marks in thue_morse("a", "b", 10)]
    first, second = (Ranges(np.frombuffer(t.encode(), np.uint8)).of(np.array([0]), np.array([len(t)])) for t in texts)
    assert first == second and texts[0] != texts[1]
    assert op5_suffix_dedup.stretches([1], [0], [texts[0].encode()])["n"].abs().max() > 60_000
    rows = [(1, texts[0]), (2, texts[1])]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in op5_suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: v[1:3] for k, v in brute_repeats(rows).items()} == {1: (0, 0), 2: (0, 0)}


def test_suffix_array_tells_alike_substrings_apart():
    # leftmost-smaller substrings that would collide under a polynomial hash
    one, two = thue_morse("cd", "dc", 11)
    t = np.append(np.frombuffer(("a" + "".join(sorted(one)) + "b" + one + "a" + two + "a" + one + "a").encode(), np.uint8), np.uint8(0))
    raw = t.tobytes()
    sa = suffix_array(t)
    assert all(raw[x : x + 9000] < raw[y : y + 9000] for x, y in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True))


def test_shared_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(0, 2500)).astype(np.uint64)) for _ in range(12)]
    x, y = np.array([0, 2, 3, 4, 6, 8, 9, 10, 11]), np.array([1, 5, 7])
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in y] for i in x]
    assert op9_neardup._shared(sets, x, y).tolist() == want


def test_chat_edges(spark):  # noqa: F811
    hard = "</s>[INST] \\ <\\s> [/INST]\n"
    rows = [(1, 0, None, hard), (1, 1, "assistant", hard), (1, 1, "assistant", None), (1, 2, "user", ""), (2, 0, "odd [role]\n", "x"), (None, 0, "assistant", "y"), (None, 0, "assistant", "y")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n_turns int")
    examples = op10_chat.prefix_target_examples(turns)
    got = {r["conv_id"]: r for r in op10_chat.conversation_digests(examples).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("\n" + hard + "\n" + "assistant\n\n" + "assistant\n" + hard + "\n" + "user\n\n")
    assert (got[1]["n_turns"], got[1]["loss_sha256"], got[1]["loss_chars"]) == (4, sha(hard), len(hard))
    assert got[2]["turns_sha256"] == sha("odd [role]\n\nx\n") and got[None]["loss_chars"] == 2
    assert op10_chat.prefix_target_examples(turns.limit(0)).count() == 0


def test_pipeline_takes_effect(spark, tmp_path):  # noqa: F811
    sf = "/root/testdata/sf0.001"
    docs = common.read(spark, sf, "documents").withColumn("words", F.lit("w"))
    docs = docs.unionByName(docs.where("doc_id = 5").withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long")))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, before, sf)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        texts = dict(before.select("doc_id", "text").collect())
        kept = dict(after.select("doc_id", "text").collect())
        assert set(kept) <= set(texts)
        if name == "repeated_text":
            want = brute_repeats([(i if i is not None else -1, t) for i, t in texts.items()])
            for i, t in kept.items():
                assert (t == texts[i]) == (want[-1 if i is None else i][1] == 0)
        before = after
    packed = corpus_pipeline.packing(spark, before, sf)
    assert packed.select("doc_id").distinct().count() == before.count()
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), sf).count() == 0
