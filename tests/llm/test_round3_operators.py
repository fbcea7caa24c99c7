"""Conversation repair, token counts and embedding whitening against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest

from basketgraph.llm import op11_repair, op12_token_counts, op13_whitening
from basketgraph.session import shared_path
from tests.conftest import spark  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")

# ---------------------------------------------------------------------------
# Conversation repair
# ---------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """Rows of one conversation after the damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def legal(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def brute_repair(rows):
    """Every sequence of edits over a frontier of (roles so far, cost, audit, lines)."""
    seen, faults, frontier = set(), [], {"": (0, "", ())}

    def inserted(front):
        out = dict(front)
        for _ in range(2):
            for roles, (cost, audit, lines) in list(out.items()):
                for name in ("user", "assistant"):
                    new = (cost + 5, audit + "I", lines + (name + ":",))
                    if roles + name[0] not in out or new < out[roles + name[0]]:
                        out[roles + name[0]] = new
        # only roles that can still become legal matter
        return {r: v for r, v in out.items() if legal(r) or legal(r + "a") or r == "s"}

    frontier = inserted(frontier)
    for _, role, text in rows:
        fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        late = 5 if fault == "truncated" else 0
        new = {}
        for roles, (cost, audit, lines) in frontier.items():
            moves = [(roles, cost + 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                moves.append((roles + (role[:1] or "?"), cost + late, "K", (f"{role}:{text}",)))
                moves += [(roles + name[0], cost + 1 + late, "R", (f"{name}:{text}",)) for name in ("user", "assistant")]
            for r, c, letter, line in moves:
                value = (c, audit + letter, lines + line)
                if r not in new or value < new[r]:
                    new[r] = value
        frontier = inserted({r: v for r, v in new.items() if r == "" or legal(r) or legal(r + "a") or r == "s"})
    cost, audit, lines = min(v for r, v in frontier.items() if legal(r))
    known = {t for t, _, _ in rows if t is not None}
    pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), pairs, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "cut off", "", "  \t", None, "Ends. \n", "é?", "why"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = [(c, None if rng.random() < 0.05 else rng.randrange(12), rng.choice(roles), rng.choice(texts)) for c in range(150) for _ in range(rng.randrange(1, 9))]
    rows += [(200, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(30)]
    rows += [(None, t, "system" if t == 0 else "user" if t % 2 else "assistant", "a" * 3000 + ".") for t in range(5)]
    return rows + rows[:20]


SCHEMA = "conv_id long, turn long, role string, text string, code int, part int, audit string"


def _turns(spark, rows):  # noqa: F811
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(5)


def _expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return {c: brute_repair(damage(rs)) for c, rs in by.items()}


def _got(df):
    return {r["conv_id"]: tuple(r[c] for c in op11_repair._NAMES) for r in df.collect()}


def test_repair_against_brute_force(spark, turns):  # noqa: F811
    hurt = op11_repair.damaged(_turns(spark, turns))
    want = _expected(turns)
    assert _got(op11_repair.repair(hurt)) == want
    assert {v[6] == "" and v[7] == hashlib.sha256(b"").hexdigest() for v in want.values()} == {True, False}


def test_long_conversations_in_blocks(spark, turns, monkeypatch):  # noqa: F811
    """Every conversation of more than three rows goes through blocks of two."""
    want = _expected(turns)
    monkeypatch.setattr(op11_repair, "LONG_ROWS", 2)
    hurt = op11_repair.damaged(_turns(spark, turns))
    assert _got(op11_repair.repair(hurt, long_rows=3)) == want
    assert _got(op11_repair.repair(hurt.limit(0), long_rows=3)) == {}
    rows = [(1, t, "user", None) for t in range(40)]
    assert _got(op11_repair.repair(op11_repair.damaged(_turns(spark, rows)), long_rows=3)) == _expected(rows)


def test_repair_sql(spark, turns):  # noqa: F811
    import pandas as pd

    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(turns, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    cur = con.execute(op11_repair.SQL)
    names = [d[0] for d in cur.description]
    got = {r[0]: tuple(r[names.index(c)] for c in op11_repair._NAMES) for r in cur.fetchall()}
    assert got == _expected(turns)


def test_least_path_of_equal_costs():
    """Ranks choose the ASCII-least of all cheapest audits: checked against listing every path."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(0, 6))
        codes = rng.choice([0, 1, 2, 3, 5, 6, 9], n)
        padded = op11_repair._with_ends(codes.tolist(), [n])
        cost, [(letters, _, _, _)] = op11_repair.least_repairs(padded, np.array([n]), op11_repair.AT_END[None, :], np.array([True]), [0])
        roles = {0: "system", 1: "user", 2: "assistant", 3: "tool"}
        rows = [(i, roles[c & 3], "" if c & 8 else f"t{i}" if c & 4 else f"t{i}.") for i, c in enumerate(codes.tolist())]
        want = brute_repair(rows)
        assert (int(cost[0, 0]), op11_repair._audit(letters)) == (want[5], want[6])


# ---------------------------------------------------------------------------
# Token counts
# ---------------------------------------------------------------------------

TEXTS = [
    (1, None), (2, ""), (3, "plain words here"), (4, "plain words here"), (None, "nameless"), (None, "nameless"), (4, "an <|endoftext|> inside"),
    (5, "Ünïcödé   spaces  and\ttabs\n\n"), (6, " ".join(f"w{i * 7919 % 1009}" for i in range(3000))), (7, "x" * 9000), (8, "plain  words HERE"),
]


def _documents(spark, rows=TEXTS):  # noqa: F811
    return spark.createDataFrame([(i, t, 9, "k") for i, t in rows], "doc_id long, text string, n_tokens int, content string").repartition(3)


def _library_count(name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        return lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda t: len(model.encode(t))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_and_cache(spark, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(op12_token_counts, "SLICE", 2000)
    path, count, cache = public_tokenizers.path(name), _library_count(name), shared_path(spark, "t-cache")
    want = sorted(((i if i is not None else -1), len((t or "").encode()), count(t or ""), count(t or "") > 1024) for i, t in TEXTS)

    def got(df):
        return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect())

    assert got(op12_token_counts.token_counts(_documents(spark), path, cache)) == want
    digest = op12_token_counts.tokenizer_digest(path)
    entries = {bytes(r["content"]): r["n_tokens"] for r in op12_token_counts.read_cache(spark, cache, digest).collect()}
    distinct = len({t or "" for _, t in TEXTS})
    assert len(entries) in (distinct, distinct - 1)  # "words  HERE" and "words here" are one normal form for the lower-casing tokenizer
    runs = spark.read.option("recursiveFileLookup", True).parquet(cache).count()

    # stored counts are used, only the new text is encoded, and it is added
    encoded = []
    plain = op12_token_counts.encode_counts
    monkeypatch.setattr(op12_token_counts, "encode_counts", lambda texts, p: encoded.append([r["text"] for r in texts.collect()]) or plain(texts, p))
    more = [*TEXTS, (9, "brand new"), (10, "brand new")]
    assert len(got(op12_token_counts.token_counts(_documents(spark, more), path, cache))) == len(more)
    assert encoded == [["brand new"]]
    assert got(op12_token_counts.token_counts(_documents(spark), path, cache)) == want and len(encoded) == 1
    assert spark.read.option("recursiveFileLookup", True).parquet(cache).count() == runs + 1
    assert op12_token_counts.token_counts(_documents(spark).limit(0), path, cache).count() == 0


def test_slices_keep_counts():
    count = op12_token_counts.counter(public_tokenizers.path("byte_bpe_50k.json"))
    plain = _library_count("byte_bpe_50k.json")
    rng, old = random.Random(2), op12_token_counts.SLICE
    try:
        for _ in range(60):
            text = "".join(rng.choice(["word", " ", "  ", "\n", "é", ",", "'s", "1", "<|endoftext|>", " "]) for _ in range(200))
            op12_token_counts.SLICE = rng.randrange(1, 60)
            assert count([text]) == [plain(text)]
    finally:
        op12_token_counts.SLICE = old


SPACES = [" ", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u200b", "\u2028", "\u202f", "\u205f", "\u3000", "\ufeff"]
CHUNK_PARTS = ["word", "Word,", "né", "à", "\u0420\u0420", "\u4e00\u3042", "\U0001f600", "\u2019", "'s", "n't", "42", "...", "<|endoftext|>", "<|end", "of", "text|>", "\x00", "\x7f"]


def test_chunks_keep_counts():
    """Texts of which most chunks repeat count as whole texts do, whatever white space and special strings lie at the cuts."""
    count = op12_token_counts._json_counter(public_tokenizers.path("byte_bpe_50k.json"))
    plain = _library_count("byte_bpe_50k.json")
    rng = random.Random(12)
    for _ in range(40):
        parts = ["".join(rng.choice(rng.choice([SPACES, CHUNK_PARTS])) for _ in range(rng.randrange(12))) for _ in range(10)]
        texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(30)]
        assert count(texts) == [plain(t) for t in texts]
    assert count(["", " ", "é", " é"]) == [plain(t) for t in ["", " ", "é", " é"]]


def test_each_chunk_is_encoded_once(monkeypatch):
    import tokenizers

    given = []

    class Spied:
        def __init__(self, tok):
            self.tok = tok

        def __getattr__(self, name):
            return getattr(self.tok, name)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.tok.encode_batch_fast(texts, **options)

        @classmethod
        def from_file(cls, path, made=tokenizers.Tokenizer.from_file):
            return cls(made(path))

    plain = _library_count("byte_bpe_50k.json")
    monkeypatch.setattr(tokenizers, "Tokenizer", Spied)
    count = op12_token_counts._json_counter(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(50)]
    first, second = ([" " + " ".join(rng.choices(words, k=200)) for _ in range(20)] for _ in range(2))
    assert count(first) == [plain(t) for t in first]
    assert sorted(given) == sorted({" " + w for w in words})
    assert count(second) == [plain(t) for t in second] and len(given) == len(words)
    # few chunks repeat: the texts are encoded as they are, and nothing is kept of them
    alone = [" ".join("".join(rng.choices("ijklmnop", k=9)) for _ in range(40)) for _ in range(5)]
    assert count(alone) == [plain(t) for t in alone] and given[len(words) :] == alone
    # beyond what is kept, the counts hold
    monkeypatch.setattr(op12_token_counts, "KEPT", 20)
    count = op12_token_counts._json_counter(public_tokenizers.path("byte_bpe_50k.json"))
    assert [count(first), count(second), count(first)] == [[plain(t) for t in x] for x in (first, second, first)]


# ---------------------------------------------------------------------------
# Embedding whitening
# ---------------------------------------------------------------------------


def _vectors(spark, rows):  # noqa: F811
    return spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id long, embedding array<float>, n int, x string").repartition(4)


def test_whitening_against_numpy(spark):  # noqa: F811
    rng = np.random.default_rng(7)
    base = (rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6)) + [3, -2, 0, 100, 0.5, 0]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(3, base[0].tolist())] * 40 + [(None, base[1].tolist())]
    bad = [(900, None), (901, [None] + [1.0] * 5), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []), (905, [1.0, 2.0])]
    got = op13_whitening.whiten(_vectors(spark, rows + bad)).collect()
    assert len(got) == 4 * len(rows)
    x = np.floor(256 * np.array([v for _, v in rows], np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    cov = np.cov(fit.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:4]
    white = (x - total / n) @ vectors[:, order] / np.sqrt(values[order])
    deviation = ((n * x - total) ** 2).sum(1)
    want = sorted((-1 if i is None else i, c + 1, n, int(d), w[c]) for (i, _), d, w in zip(rows, deviation, white, strict=True) for c in range(4))
    mine = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"]) for r in got)
    for c in range(1, 5):
        a, b = np.array([r[4] for r in mine if r[1] == c]), np.array([r[4] for r in want if r[1] == c])
        assert min(np.abs(np.sort(a) - np.sort(b)).max(), np.abs(np.sort(-a) - np.sort(b)).max()) < 1e-8
    assert sorted(r[:4] for r in mine) == sorted(r[:4] for r in want)
    for r in got:
        assert abs(r["explained"] - values[order][r["component"] - 1] / np.trace(cov)) < 1e-9 and r["identity_error"] < 1e-9


def test_polarised_covariance_is_exact(spark):  # noqa: F811
    """A large common offset does not cost digits."""
    rows = [(0, [2.0**38, 1.0]), (1, [2.0**38 + 2**16, 2.0]), (2, [2.0**38, 5.0])]
    fit = op13_whitening.whole_vectors(_vectors(spark, rows)).select("x").distinct()
    sums = op13_whitening.dimension_sums(fit, 2)
    centre = [(2 * s + 3) // 6 for s in sums]
    got = op13_whitening.polarised_covariance(3, [s - 3 * c for s, c in zip(sums, centre, strict=True)], op13_whitening.squared_sums(fit, 2, centre))
    want = np.cov(np.array([[0, 256.0], [2.0**24, 512.0], [0, 1280.0]]).T, bias=True)
    assert np.allclose(got, want, rtol=1e-12)


def test_whitening_without_variance(spark):  # noqa: F811
    none = _vectors(spark, [(1, [1.0, 2.0])] * 3)
    assert op13_whitening.whiten(none).count() == 0
    assert op13_whitening.whiten(none.limit(0)).count() == 0
    flat = op13_whitening.whiten(_vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 9.0])])).collect()
    assert {r["component"] for r in flat} == {1} and len(flat) == 3
    with pytest.raises(Exception, match="range of a long"):
        op13_whitening.whiten(_vectors(spark, [(1, [1e18, 2.0]), (2, [-1e18, 3.0]), (3, [1e17, 9.0])])).collect()
