"""Packing by non-negative least squares over length combinations.

Texts are encoded and an end id is appended. A document is cut into pieces of a
full window and one rest. All combinations of up to ``DEPTH`` lengths that fill
a window exactly are enumerated; repeat counts that reproduce the histogram of
piece lengths are solved by projected gradient steps, rounded, and limited to the
pieces there are. What is left is packed greedily, longest piece first, each
gap with the longest length that fits. The driver holds the histogram and the
plan, whose sizes depend on the window only. Pieces find their place from their
rank among pieces of their length, so no piece is compared with another.

Defined results: a null or empty text is only the end id; rows with one doc_id
are packed each on its own; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

WINDOW = 1024
END_ID = 0
DEPTH = 3
STEPS = 400

PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, part int, rank long"


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in the same part (task)."""

    @common.lean
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, part, seen = common.CachedTokenizer.shared(tokenizer, space_joins_next=True), TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            flat, sizes = tok.encode_many(list(batch["text"]))
            rows = []
            for doc_id, stop, n in zip(batch["doc_id"], np.cumsum(sizes), sizes, strict=True):
                ids = np.append(flat[stop - n : stop], end).astype("<u4")
                for start in range(0, len(ids), window):
                    one = ids[start : start + window]
                    rows.append((doc_id, start, len(one), zlib.crc32(one.tobytes()), len(ids), part, seen[len(one)]))
                    seen[len(one)] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(cut, PIECES)


def combinations(window: int = WINDOW) -> np.ndarray:
    """Non-increasing length triples that sum to the window; shorter combinations end in zeros."""
    a = np.arange(1, window + 1)
    first, second = np.meshgrid(a, np.r_[0, a], indexing="ij")
    first, second = first.ravel(), second.ravel()
    third = window - first - second
    ok = (third >= 0) & (first >= second) & (second >= third)
    return np.stack([first[ok], second[ok], third[ok]], 1)


def solve_counts(hist: np.ndarray, combos: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared difference between their lengths and ``hist`` (index: length)."""
    used = combos > 0
    m = len(hist)

    def lengths(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(combos[:, k], weights=x * used[:, k], minlength=m) for k in range(combos.shape[1]))

    def back(r: np.ndarray) -> np.ndarray:
        return (r[combos] * used).sum(1)

    v = np.ones(len(combos))
    for _ in range(20):
        v = back(lengths(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(back(lengths(v))))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(lengths(y) - hist))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(hist: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of all sequences: the rounded solution, then the greedy rest."""
    left = hist.astype(np.int64).copy()
    out = []

    def take(lengths: tuple[int, ...], n: int) -> None:
        size, need = np.unique(lengths, return_counts=True)
        n = int(min(n, (left[size] // need).min()))
        if n > 0:
            left[size] -= n * need
            out.append((lengths, n))

    combos = combinations(window)
    present = ((left[combos] > 0) | (combos == 0)).all(1)
    combos = combos[present]
    if len(combos):
        x = solve_counts(left.astype(float), combos)
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 0.5:
                break
            take(tuple(int(c) for c in combos[k] if c), int(x[k] + 0.5))
    while left.any():
        room, lengths, spare = window, [], left.copy()
        while room and (fits := np.flatnonzero(spare[: room + 1])).size:
            best = int(fits[-1])
            lengths.append(best)
            spare[best] -= 1
            room -= best
        take(tuple(lengths), int(left.max()))
    return out


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Pieces with their sequence_id and offset."""
    cut = common.stored(pieces(docs, tokenizer, window), "op8-pieces")
    counts = common.stored(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "op8-counts")
    hist = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``window`` rows
        hist[r["length"]] = r["n"]
    found = plan(hist, window)
    # slots, ordered by (length, first rank): the pieces of a length fill them in the order of their rank
    slots, next_rank, base = [], np.zeros(window + 1, np.int64), 0
    for lengths, n in found:
        offset = 0
        for size in lengths:
            slots.append((size, next_rank[size], base, offset))
            next_rank[size] += n
            offset += size
        base += n
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    key = table[:, 0] * (1 << 48) + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rank = rank.to_numpy(np.int64)
        at = np.searchsorted(key, length.to_numpy(np.int64) * (1 << 48) + rank, side="right") - 1
        return pd.DataFrame({"sequence_id": table[at, 2] + rank - table[at, 1], "offset": table[at, 3]})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cut.join(firsts, ["length", "part"]).withColumn("at", place("length", F.col("rank") + F.col("first")))
    return ranked.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset")


def padding(used: int, window: int = WINDOW) -> int:
    """Pad ids of a sequence with ``used`` ids: none at a power of two, else up to the window."""
    return 0 if used & (used - 1) == 0 else window - used


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, without padding; doc_id must be unique here."""
    per_doc = packed.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("ps"))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = common.CachedTokenizer.shared(tokenizer, space_joins_next=True)
        for batch in batches:
            rows = []
            for text, ps in zip(batch["text"], batch["ps"], strict=True):
                ids = np.append(tok.encode(text), END_ID)
                rows += [(p["sequence_id"], p["offset"], ids[p["start"] : p["start"] + p["length"]].tolist()) for p in ps]
            yield pd.DataFrame(rows, columns=["sequence_id", "offset", "ids"])

    cut = docs.select("doc_id", "text").join(per_doc, "doc_id").select("text", "ps").mapInPandas(fill, "sequence_id long, offset long, ids array<int>")
    return cut.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(common.read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
