"""Improbable-feature digests of whole texts.

The entropy of every 64-byte window is binned; how often each bin occurs over all texts
ranks it, rare bins first. In each run of 64 neighbouring windows the rarest
one (the leftmost of equals) scores a point, and windows with enough points are
the text's features. Features are hashed into chained Bloom filters, and two
digests are compared by their filters' shared bits between the overlap that
chance gives and the most there can be.

Entropies follow from integer tables, so equal bytes give equal bins in any
buffer; a digest depends on the text and the rank table only.

Defined results: a null or empty text has the empty fingerprint; a non-empty text without a
feature by points (short or plain) has one feature, its whole text;
equal fingerprints are alike 1, an empty and another one 0. Rows are taken in order of
(doc_id, text), so ties and repeated rows follow each other; a null doc_id is the smallest; a
single row is its own next document; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

SPAN = 64
BINS = 1000
LEAST_BIN = 100
POINTS = 16
FILTER_BITS, FILTER_FEATURES, HASHES = 2048, 160, 5
SHARD_BYTES = 16 << 20
#: Bytes handled in one numpy buffer; a longer text is a buffer of its own.
BUFFER = 1 << 20
#: c * log2(c) in units of 2**-16, for counts of a byte in a window.
G = np.round(np.arange(SPAN + 1) * np.log2(np.maximum(np.arange(SPAN + 1), 1)) * (1 << 16)).astype(np.int64)
G_MAX = int(G[SPAN])


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """Bin of the 64-byte window at each place of ``data`` (uint8); 0..BINS."""
    n = len(data)
    if n < SPAN:
        return np.zeros(0, np.int32)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # equal bytes among the 63 places before and after
    for d in range(1, SPAN):
        same = data[d:] == data[:-d]
        after[: n - d] += same
        before[d:] += same
    # the window moves from p to p + 1: data[p] leaves while ``after`` others stay, data[p + 64] joins ``before`` others
    gone, come = after[: n - SPAN].astype(np.int64), before[SPAN:].astype(np.int64)
    change = G[gone] - G[gone + 1] + G[come + 1] - G[come]
    start = int(G[np.bincount(data[:SPAN], minlength=256)].sum())
    total = np.concatenate([[start], start + np.cumsum(change)])
    return ((G_MAX - total) * BINS // G_MAX).astype(np.int32)


def _buffers(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > BUFFER:
            yield at, texts[at:k]
            at, held = k, 0
        held += len(t)
    if texts:
        yield at, texts[at:]


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: bytes, bins, whether a window lies in one text, where texts begin."""
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(texts), np.uint8)
    bins = entropy_bins(data)
    valid = np.ones(len(bins), bool)
    # windows that begin in the last 63 places of a text reach over its end
    for e in ends:
        valid[max(0, e - SPAN + 1) : e] = False
    return data, bins, valid, ends - size


def bin_counts(texts: list[bytes]) -> np.ndarray:
    out = np.zeros(BINS + 1, np.int64)
    for _, part in _buffers(texts):
        _, bins, valid, _ = _windows(part)
        out += np.bincount(bins[valid], minlength=BINS + 1)
    return out


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each bin, 0 the rarest; bins below LEAST_BIN (plain repetition) are never chosen."""
    rank = np.empty(BINS + 1, np.int64)
    rank[np.lexsort((np.arange(BINS + 1), counts))] = np.arange(BINS + 1)
    rank[:LEAST_BIN] = BINS + 1
    return rank


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[str]:
    out = [""] * len(texts)
    for at, part in _buffers(texts):
        data, bins, valid, starts = _windows(part)
        n = len(bins)
        owner, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if n:
            score = np.where(valid, rank[bins], BINS + 1)
            key = (score << 40) | np.arange(n)
            low, width = key, 1  # rarest of the next 64 windows, by doubling
            while width < SPAN:
                low = np.concatenate([np.minimum(low[:-width], low[width:]), low[-width:]]) if len(low) > width else low
                width *= 2
            best = low[valid & ((low >> 40) <= BINS)] & ((1 << 40) - 1)
            points = np.bincount(best, minlength=n)
            chosen = np.flatnonzero(points >= POINTS)
            words = np.lib.stride_tricks.sliding_window_view(data, SPAN)[chosen].copy().view(np.uint64)
            hashes = np.zeros(len(chosen), np.uint64)
            for k in range(SPAN // 8):
                hashes = _mix(hashes ^ words[:, k])
            owner = np.searchsorted(starts, chosen, side="right") - 1
        count = np.bincount(owner, minlength=len(part))
        for k in np.flatnonzero(count == 0):
            if part[k]:
                owner = np.append(owner, k)
                hashes = np.append(hashes, np.frombuffer(hashlib.sha256(part[k]).digest()[:8], np.uint64))
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
        count = np.bincount(owner, minlength=len(part))
        index = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
        n_filters = -(-count // FILTER_FEATURES)
        first = np.cumsum(n_filters) - n_filters
        bits = np.zeros((int(n_filters.sum()), FILTER_BITS), bool)
        for k in range(HASHES):
            bits[first[owner] + index // FILTER_FEATURES, (hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)] = True
        packed = np.packbits(bits, axis=1)
        for k in range(len(part)):
            if count[k]:
                out[at + k] = f"{count[k]}:" + base64.b64encode(packed[first[k] : first[k] + n_filters[k]].tobytes()).decode()
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _filters(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.split(":", 1)[1]), np.uint64).reshape(-1, FILTER_BITS // 64)


def likeness(a: str, b: str) -> float:
    """0 to 1: for each filter of the shorter chain its best overlap with the other's, averaged by bits set."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    fa, fb = _filters(a), _filters(b)
    if len(fa) > len(fb):
        fa, fb = fb, fa
    na, nb = np.bitwise_count(fa).sum(1).astype(float), np.bitwise_count(fb).sum(1).astype(float)
    best = np.zeros(len(fa))
    for k in range(len(fa)):
        common_bits = np.bitwise_count(fa[k] & fb).sum(1)
        most = np.minimum(na[k], nb)
        chance = na[k] * nb / FILTER_BITS
        floor = chance + 0.25 * (most - chance)
        share = np.where(most > floor, (common_bits - floor) / np.where(most > floor, most - floor, 1), 0.0)
        # a chain's last filter may hold few bits; against a much fuller one only its own size counts
        best[k] = np.clip(share, 0, 1).max()
    return float((best * na).sum() / na.sum())


def corpus_ranks(docs: DataFrame) -> np.ndarray:
    """The rank table from the windows of all texts; each task sends BINS + 1 counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BINS + 1, np.int64)
        for batch in batches:
            total += bin_counts([(t or "").encode() for t in batch["text"]])
        yield pd.DataFrame({"bin": np.arange(BINS + 1), "n": total})

    counts = np.zeros(BINS + 1, np.int64)
    for r in docs.select("text").mapInPandas(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[r["bin"]] = r["n"]
    return rank_table(counts)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_previous(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """Documents in shards of ascending (doc_id, text); each shard begins with a guest row, the last row of the shard before
    (for the first shard: of the last). Guests have ``own`` false."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bounds = common.key_bounds(docs, "doc_id", F.octet_length("text") + 64, shard_bytes)
    placed = docs.withColumn("shard", common.shard_of("doc_id", bounds)).withColumn("own", F.lit(True))
    lasts = sorted((r["shard"], r["last"]) for r in placed.groupBy("shard").agg(F.max(F.col("doc_id")).alias("last")).collect())  # a row per shard
    if not lasts:
        return placed, 1
    to = {last: lasts[(k + 1) % len(lasts)][0] for k, (_, last) in enumerate(lasts)}
    pairs = docs.sparkSession.createDataFrame(list(to.items()), "last long, shard int")
    ends = docs.join(F.broadcast(pairs), F.col("doc_id").eqNullSafe(F.col("last"))).groupBy("shard", "doc_id").agg(F.max("text").alias("text"))
    guests = ends.select("doc_id", "text", "shard", F.lit(False).alias("own"))
    return placed.unionByName(guests), len(bounds) + 1


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; next: the next smaller doc_id."""
    spark = docs.sparkSession
    rank = spark.sparkContext.broadcast(corpus_ranks(docs))
    rows, n = with_previous(docs)
    rows = rows.repartitionById(n, F.col("shard")).sortWithinPartitions("own", F.asc_nulls_first("doc_id"), "text")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text_before = print_before = None
        for batch in batches:
            texts = list(batch["text"])
            prints = fingerprints([t.encode() for t in texts], rank.value)
            prev_text, prev_print = [text_before, *texts[:-1]], [print_before, *prints[:-1]]
            text_before, print_before = texts[-1], prints[-1]
            own = batch["own"].to_numpy()
            new = [edited(t, p) if o else "" for t, p, o in zip(texts, prev_text, own, strict=True)]
            new_prints = fingerprints([t.encode() for t in new], rank.value)
            out = pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in new],
                "fingerprint": prints, "edited_fingerprint": new_prints,
                "near_edited": [likeness(a, b) for a, b in zip(prints, new_prints, strict=True)], "near_next": [likeness(a, b) if b is not None else 0.0 for a, b in zip(prints, prev_print, strict=True)],
            })
            yield out[own]

    return rows.mapInPandas(digest, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


@query("op7_fingerprint")
def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
