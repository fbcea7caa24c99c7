"""Exact removal of repeated byte strings with sharded suffix arrays.

A ``LENGTH``-byte string starts at every place of a text. Each such window is
keyed by the least hash of its ``GRAM``-byte substrings, which equal windows
share; neighbouring windows of one key form a stretch. Stretches are brought
together by key. Keys of a single stretch cannot repeat elsewhere and fall out; equal
stretches (by length and a keyed hash of their bytes, ``hashing.keyed_strings``) are counted once, the earliest standing for all, and the others
are repeats as a whole. The different stretches of a key go with all others of their key into one
shard: its suffix array is built by induced sorting, and permuted common prefixes of
``LENGTH`` or more mark equal windows, of which the earliest stays. A key with more than ``HOT`` different stretches
(the edge of a passage that very many texts share) would fill a shard alone; its
windows are matched by a 128-bit digest with map-side combining instead, linear in their number.

Defined results: a null or empty text has no bytes; texts below LENGTH bytes lose
nothing; positions are ordered by (doc_id, start) with a null doc_id first; rows
that agree in doc_id and text are one document, so a repeated row does not remove itself; different texts of one
doc_id are different documents, and so is every row with a null doc_id (``common.keyed``); an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.hashing import Ranges, keyed_strings
from basketgraph.llm.registry import query
from basketgraph.llm.suffixes import common_prefixes, suffix_array

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1
#: Different stretches of one key that one shard takes at most (a few megabytes of text).
HOT = 1 << 15
#: Window starts per buffer; a longer text is taken in overlapping pieces.
BUFFER = 1 << 19
SHARD_BYTES = 1 << 20
NO_ID = -(2**63)


def _pieces(ids: list[int], texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Buffers of (doc, offset, bytes); the pieces of a long text overlap so that every window lies in one piece."""
    docs, offsets, parts, held = [], [], [], 0
    for doc, data in zip(ids, texts, strict=True):
        for at in range(0, max(1, len(data) - LENGTH + 1), BUFFER):
            part = data[at : at + BUFFER + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if held and held + len(part) > 2 * BUFFER:
                yield docs, offsets, parts
                docs, offsets, parts, held = [], [], [], 0
            docs.append(doc)
            offsets.append(at)
            parts.append(part)
            held += len(part)
    if parts:
        yield docs, offsets, parts


def stretches(ids: list[int], variants: list[int], texts: list[bytes]) -> pd.DataFrame:
    """key, seg (keyed hash of the stretch's bytes), doc, v, start, n (windows; negative if the least substring repeats inside)."""
    out = []
    ids, variants = np.array(ids, np.int64), np.array(variants, np.int64)
    for places, offsets, parts in _pieces(list(range(len(texts))), texts):
        data = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts], np.int64)
        begin = np.cumsum(size) - size
        r = Ranges(data)
        at = np.arange(len(data) - GRAM + 1)
        gram = r.of(at, at + GRAM)
        low, width = gram, 1
        while width * 2 <= SPAN:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (SPAN - width)], low[SPAN - width :])  # least of SPAN substrings from each place on
        m = len(low)
        valid = np.ones(m, bool)
        for e in begin + size:
            valid[max(0, e - LENGTH + 1) : e] = False
        edge = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (valid[1:] != valid[:-1])])
        last = np.append(edge[1:], m) - 1
        keep = valid[edge]
        first, last = edge[keep], last[keep]
        key = low[first]
        several = np.zeros(len(first), bool)
        span = np.arange(SPAN)
        for k in range(0, len(first), 8192):
            s = slice(k, k + 8192)
            a = gram[first[s, None] + span] == key[s, None]
            b = gram[last[s, None] + span] == key[s, None]
            several[s] = (a.sum(1) > 1) | (b.sum(1) > 1) | (first[s] + a.argmax(1) != last[s] + b.argmax(1))
        raw = data.tobytes()
        cuts = np.empty(len(first), object)
        cuts[:] = [raw[a:b] for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)]
        seg = keyed_strings(cuts)
        owner = np.searchsorted(begin, first, side="right") - 1
        n = last - first + 1
        out.append(pd.DataFrame({"key": key.view(np.int64), "seg": seg.view(np.int64), "doc": ids[places][owner], "v": variants[places][owner], "start": np.array(offsets, np.int64)[owner] + first - begin[owner], "n": np.where(several, -n, n)}))
    return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("key", "seg", "doc", "v", "start", "n")})


STRETCH = "key long, seg long, doc long, v long, start long, n int"


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, v, z): texts as compressed UTF-8, so that shuffles carry few bytes."""

    @F.pandas_udf("binary")
    def squeeze(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        for text in texts:
            yield pd.Series([z.compress((t or "").encode()) for t in text])
        common.give_back()

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("_v").alias("v"), squeeze("text").alias("z"))


def _unpack(z: pd.Series) -> list[bytes]:
    import zstandard

    d = zstandard.ZstdDecompressor()
    return [d.decompress(x) for x in z]


def found_stretches(docs: DataFrame) -> DataFrame:
    @common.lean
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in common.slices(batch, batch["text"].map(lambda t: len(t or ""))):
                df = stretches([NO_ID if pd.isna(d) else int(d) for d in part["doc_id"]], list(part["_v"]), [(t or "").encode() for t in part["text"]])
                if len(df):
                    yield df

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "_v", "text").mapInPandas(scan, STRETCH)


def _whole_keys(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches sorted by key, joined to blocks of about ``rows`` rows that never split a key."""
    held: list[pd.DataFrame] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < rows or not len(batch):
            continue
        block = pd.concat(held)
        k = block["key"].to_numpy()
        cut = int(np.searchsorted(k, k[-1])) if k[0] != k[-1] else 0
        if cut:
            yield block.iloc[:cut]
        held, count = [block.iloc[cut:]], len(block) - cut
    if held and sum(map(len, held)):
        yield pd.concat(held)


def matched_stretches(found: DataFrame) -> DataFrame:
    """From stretches: kind 0 (doc, v, start, n): all n windows repeat an earlier stretch; kind 1: a stretch to be
    compared with the other ones of its key; kind 2: the same for a hot key."""

    @common.lean
    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _whole_keys(batches, 100_000):
            c = {k: block[k].to_numpy(np.int64) for k in ("key", "seg", "doc", "v", "start", "n")}
            new = np.r_[True, c["key"][1:] != c["key"][:-1]]
            group = np.cumsum(new) - 1
            alone = np.bincount(group)[group] == 1
            sel = np.flatnonzero(~alone | (c["n"] < 0))
            if not len(sel):
                continue
            order = sel[np.lexsort((c["start"][sel], c["v"][sel], c["doc"][sel], c["n"][sel], c["seg"][sel], group[sel]))]
            g, seg, doc, v, start, n = group[order], c["seg"][order], c["doc"][order], c["v"][order], c["start"][order], c["n"][order]
            head = np.r_[True, (g[1:] != g[:-1]) | (seg[1:] != seg[:-1]) | (n[1:] != n[:-1])]
            owner = np.flatnonzero(head)[np.cumsum(head) - 1]
            again = ~head & ((doc != doc[owner]) | (v != v[owner]) | (start != start[owner]))
            kinds = np.bincount(g[head], minlength=int(g[-1]) + 1)[g]
            rep = head & ((kinds > 1) | (n < 0))
            kind = np.where(kinds > HOT, 2, 1)
            yield pd.DataFrame({
                "kind": np.r_[np.zeros(again.sum(), np.int64), kind[rep]], "key": np.r_[np.zeros(again.sum(), np.int64), c["key"][order][rep]],
                "doc": np.r_[doc[again], doc[rep]], "v": np.r_[v[again], v[rep]], "start": np.r_[start[again], start[rep]], "n": np.abs(np.r_[n[again], n[rep]]),
            })

    rows = found.repartition("key").sortWithinPartitions("key")
    return rows.mapInPandas(match, "kind int, key long, doc long, v long, start long, n int")


CUT = ["kind", "key", "key2", "doc", "v", "start", "n", "data"]


def cut_out(reps: DataFrame, packed: DataFrame) -> DataFrame:
    """The bytes of stretches (kind 1), or digests of their windows (kind 2): kind, key, key2, doc, v, start, n, data."""
    per_doc = reps.groupBy("doc", "v").agg(F.collect_list(F.struct("kind", "key", "start", "n")).alias("reps"))

    @common.lean
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0  # rows of many documents make one batch; a batch per document costs more than its rows
        for batch in (part for whole in batches for part in common.slices(whole, whole["z"].map(len) * 4)):
            for doc, v, data, reps in zip(batch["doc"], batch["v"], _unpack(batch["z"]), batch["reps"], strict=True):
                for r in reps:
                    begin, n = r["start"], r["n"]
                    if r["kind"] == 1:
                        held.append((1, r["key"], 0, doc, v, begin, n, data[begin : begin + n + LENGTH - 1]))
                        size += n + LENGTH
                        continue
                    for at in range(begin, begin + n):
                        held.append((2, *_digest(data[at : at + LENGTH]), doc, v, at, 1, None))
                        size += LENGTH
                    if size >= common.SLICE_BYTES:
                        yield pd.DataFrame(held, columns=CUT)
                        held, size = [], 0
                if size >= common.SLICE_BYTES:
                    yield pd.DataFrame(held, columns=CUT)
                    held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=CUT)

    return packed.join(per_doc, ["doc", "v"]).mapInPandas(cut, "kind int, key long, key2 long, doc long, v long, start long, n int, data binary")


def _digest(window: bytes) -> tuple[int, int]:
    raw = hashlib.blake2b(window, digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _intervals(doc: np.ndarray, v: np.ndarray, pos: np.ndarray) -> pd.DataFrame:
    """Neighbouring window starts of a document as one stretch of windows."""
    if not len(doc):
        return pd.DataFrame({"doc": doc, "v": v, "start": pos, "n": pos})
    order = np.lexsort((pos, v, doc))
    doc, v, pos = doc[order], v[order], pos[order]
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (v[1:] != v[:-1]) | (pos[1:] > pos[:-1] + 1)])
    tail = np.append(head[1:], len(doc)) - 1
    return pd.DataFrame({"doc": doc[head], "v": v[head], "start": pos[head], "n": pos[tail] - pos[head] + 1})


def repeated_windows(block: pd.DataFrame) -> pd.DataFrame:
    """By one suffix array over stretches of whole keys: the windows that an earlier one equals."""
    parts, doc, v, start, n = list(block["data"]), block["doc"].to_numpy(np.int64), block["v"].to_numpy(np.int64), block["start"].to_numpy(np.int64), block["n"].to_numpy(np.int64)
    # bytes of UTF-8 stay below 0xF5, so after adding 1 the value 255 can part the stretches and 0 end the text
    gap = b"\xfe"
    t = np.append(np.frombuffer(gap.join(parts), np.uint8) + np.uint8(1), np.uint8(0))
    begin = np.cumsum(n + LENGTH) - (n + LENGTH)
    sa = suffix_array(t)
    lcp = common_prefixes(t, sa)
    equal = lcp >= LENGTH
    several = np.flatnonzero(equal | np.append(equal[1:], False))  # a string that stands once is no repeat
    group, sa = np.cumsum(~equal, dtype=np.int32)[several], sa[several].astype(np.int64)
    del lcp, equal, several
    owner = np.searchsorted(begin, sa, side="right") - 1
    offset = sa - begin[owner]
    is_window = offset < n[owner]
    g, d, w, p = group[is_window], doc[owner[is_window]], v[owner[is_window]], start[owner[is_window]] + offset[is_window]
    order = np.lexsort((p, w, d, g))
    g, d, w, p = g[order], d[order], w[order], p[order]
    head = np.r_[True, g[1:] != g[:-1]][: len(g)]
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    again = ~head & ((d != d[first]) | (w != w[first]) | (p != p[first]))
    return _intervals(d[again], w[again], p[again])


WINDOWS = "doc long, v long, start long, n long"


def sorted_shards(cut: DataFrame) -> DataFrame:
    @common.lean
    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = max(1, SHARD_BYTES // (LENGTH + SPAN // 2))
        for block in _whole_keys(batches, rows):
            df = repeated_windows(block)
            if len(df):
                yield df

    plain = cut.where("kind = 1").select("key", "doc", "v", "start", "n", "data")
    return plain.repartition("key").sortWithinPartitions("key").mapInPandas(sort, WINDOWS)


def hot_windows(cut: DataFrame) -> DataFrame:
    rows = cut.where("kind = 2").select("key", "key2", "doc", "v", "start")
    first = rows.groupBy("key", "key2").agg(F.min(F.struct("doc", "v", "start")).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    return rows.join(first, ["key", "key2"]).where(F.struct("doc", "v", "start") != F.col("first")).select("doc", "v", "start", F.lit(1).cast("long").alias("n"))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, v, start, n): stretches of n window starts whose windows occur earlier; doc is NO_ID for a null doc_id."""
    matched = common.stored(matched_stretches(found_stretches(docs)), "op5-matched")
    cut = common.stored(cut_out(matched.where("kind > 0"), _packed(docs)), "op5-cut")
    whole = matched.where("kind = 0").select("doc", "v", "start", F.col("n").cast("long").alias("n"))
    return common.stored(whole.unionAll(sorted_shards(cut)).unionAll(hot_windows(cut)), "op5-repeats")


def removed_ranges(starts: np.ndarray, ns: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered byte ranges [a, b)."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.minimum(starts[order] + ns[order] + LENGTH - 1, size)
    ok = a < b
    a, b = a[ok], b[ok]
    if not len(a):
        return a, b
    reach = np.maximum.accumulate(b)
    head = np.flatnonzero(np.r_[True, a[1:] > reach[:-1]])
    return a[head], reach[np.append(head[1:], len(a)) - 1]


RESULT = "doc_id long, _v long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def deduplicated(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (null unless asked for)."""
    return cut_documents(common.keyed(docs.select("doc_id", "text"), "op5-nameless"), keep_bytes).drop("_v")


def cut_documents(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """The same per row of a table that ``common.keyed`` returned, with its ``_v``."""
    gone = repeats(docs).groupBy("doc", "v").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))

    @common.lean
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (part for whole in batches for part in common.slices(whole, whole["z"].map(len) * 4)):
            out = []
            for doc, v, data, starts, ns in zip(batch["doc"], batch["v"], _unpack(batch["z"]), batch["starts"], batch["ns"], strict=True):
                a, b = removed_ranges(np.array(starts, np.int64), np.array(ns, np.int64), len(data)) if starts is not None else ((), ())
                if len(a):
                    kept = b"".join(data[x:y] for x, y in zip([0, *b], [*a, len(data)], strict=True))
                else:
                    kept = data
                out.append((None if doc == NO_ID else doc, v, len(data), len(data) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            df = pd.DataFrame(out, columns=["doc_id", "_v", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            yield df.astype({"doc_id": "Int64"})

    return _packed(docs).join(gone, ["doc", "v"], "left").select("doc", "v", "z", "starts", "ns").mapInPandas(cut, RESULT)


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(common.read(spark, sf_dir, "documents").select("doc_id", "text"), keep_bytes=False).drop("kept")
