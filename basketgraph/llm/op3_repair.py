"""Token-id files compressed by Re-Pair grammars.

Texts are encoded, an end id is appended to each, and runs of documents in
ascending doc_id order form shards of about equal text bytes. Within a shard the
most frequent pairs of neighbouring ids are replaced by nonterminals, round by
round, until pairs stop paying for their rule; pairs never cross a document.
The file keeps the rules with their expansion lengths, so one document, or a
range of ids inside it, is decoded without the rest of the shard.

File (little-endian): magic, counts (terminals, rules, symbols, documents) as
uint32, then the terminals' ids, the rules' left and right symbols, the expansion
length of every symbol, per document doc_id, first symbol and first id, and the symbols;
symbols are uint16 while terminals and rules fit, else uint32.

Defined results: a null or empty text is only the end id; rows of one doc_id
follow each other ordered by text; null doc ids come first; an empty table
gives no file and no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query
from basketgraph.session import shared_path

MAGIC = b"RPG1"
END_ID = 2
SHARD_BYTES = 6 << 20
#: Each round replaces at most this many pairs, the most frequent first; rounds go on until no pair pays for its rule.
PAIRS_PER_ROUND = 8192
#: Bytes of a rule and its expansion length in the file.
RULE_BYTES = 12
SLOT_BITS = 20
FIRST, NEW, STAY = np.uint8(1), np.uint8(2), np.uint8(4)


def repair(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over ``ids`` with documents at ``starts``: (terminals, rules, lengths, symbols, first symbol of each document)."""
    present = np.bincount(ids) > 0
    terminals = np.flatnonzero(present)
    seq = (np.cumsum(present, dtype=np.int32) - 1).astype(np.uint32)[ids]
    n_sym = len(terminals)
    mark = np.zeros(len(seq), np.uint8)  # of each symbol: FIRST of its document, NEW, pair with the next one STAYs frequent
    mark[starts] = FIRST
    rules, lengths = [], [np.ones(n_sym, np.int64)]
    live = mark[1:] == 0  # pairs that may be frequent: a pair can only become frequent anew if one of its symbols is new
    while True:
        at = np.flatnonzero(live)
        if not len(at):
            break
        # keys fit 32 bits as long as symbols fit 16; small keys sort fast
        kind = np.uint32 if n_sym <= 1 << 16 else np.uint64
        key = seq[:-1].astype(kind, copy=False) * kind(n_sym)
        key += seq[1:]
        key = key[at]
        run = np.sort(key)
        edge = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        counts = np.diff(np.r_[edge, len(run)])
        width = 2 if n_sym < 1 << 16 else 4
        good = np.flatnonzero(counts * width > RULE_BYTES)
        good = good[np.argsort(-counts[good], kind="stable")]
        n_chosen = min(len(good), PAIRS_PER_ROUND)
        room = (1 << 16) - n_sym
        if 0 <= room < n_chosen and counts[good[:n_chosen]].sum() < len(seq):
            n_chosen = room  # wider symbols would cost more than this round saves
        if not n_chosen:
            break
        frequent = run[edge[good]]
        rank_at = np.full(1 << SLOT_BITS, -1, np.int32)
        rank_at[_slot(frequent[::-1])] = np.arange(len(frequent), dtype=np.int32)[::-1]  # of pairs that share a slot the most frequent stays
        r = rank_at[_slot(key)]
        mark &= FIRST
        mark[at[r >= 0]] |= STAY
        hit = np.flatnonzero(r.view(np.uint32) < n_chosen)  # -1 is the largest
        hit = hit[frequent[r[hit]] == key[hit]]
        pos, r = at[hit], r[hit]
        # overlapping occurrences: the better ranked pair wins; losers wait for a later round
        left = np.full(len(pos), 1 << 30, np.int32)
        right = left.copy()
        near = np.flatnonzero(np.diff(pos) == 1)
        left[near + 1], right[near] = r[near], r[near + 1]
        win = (r < left) & (r < right)
        tie = (r == left) | (r == right)
        if tie.any():  # a run of one repeated symbol: every other place, counted from the run's left end
            tie = np.flatnonzero(tie)
            p, s, lo, hi = pos[tie], r[tie], left[tie], right[tie]
            begin = np.flatnonzero(np.r_[True, (np.diff(p) != 1) | (s[1:] != s[:-1])])
            in_run = np.arange(len(p)) - np.repeat(begin, np.diff(np.r_[begin, len(p)]))
            win[tie] = (in_run % 2 == 0) & (s <= lo) & (s <= hi)
        pos, r = pos[win], r[win]
        # a pair whose occurrences went to better ones has no rule yet unless what is left pays
        paid = np.bincount(r, minlength=n_chosen) * width > RULE_BYTES
        pos, r = pos[paid[r]], r[paid[r]]
        if not len(pos):
            break
        pairs = frequent[:n_chosen][paid].astype(np.int64)
        size = np.concatenate(lengths)
        rules.append(np.stack([pairs // n_sym, pairs % n_sym], 1))
        lengths.append(size[pairs // n_sym] + size[pairs % n_sym])
        seq[pos] = (n_sym + np.cumsum(paid) - 1)[r]
        mark[pos] |= NEW
        keep = np.ones(len(seq), bool)
        keep[pos + 1] = False
        seq, mark = seq[keep], mark[keep]
        live = (mark[:-1] >= NEW) | ((mark[1:] & NEW) > 0)
        live &= (mark[1:] & FIRST) == 0
        n_sym += len(pairs)
    all_rules = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return terminals, all_rules, np.concatenate(lengths), seq, np.flatnonzero(mark & FIRST)


def _slot(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)


def pack_shard(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    size = np.array([len(x) for x in ids], np.int64)
    starts = np.cumsum(size) - size
    terminals, rules, lengths, seq, first = repair(np.concatenate(ids), starts)
    n_sym = len(terminals) + len(rules)
    kind = "<u2" if n_sym <= 1 << 16 else "<u4"
    null = -(2**63)
    parts = [MAGIC, struct.pack("<4I", len(terminals), len(rules), len(seq), len(ids)), terminals.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes()]
    parts += [np.array([null if d is None else d for d in doc_ids], "<i8").tobytes(), first.astype("<u4").tobytes(), starts.astype("<u8").tobytes(), seq.astype(kind).tobytes()]
    return b"".join(parts)


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1 and so on for size[0] places, then the same for the next."""
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if total + int(begin.max(initial=0)) < 1 << 31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((begin - (end - size)).astype(kind), size)


class Shard:
    """A file read back; documents and id ranges are expanded on demand."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a grammar file")
        n_term, n_rule, n_seq, n_doc = struct.unpack_from("<4I", raw, 4)
        at = 20

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.table = None
        self.terminals, self.rules, self.lengths = take("<u4", n_term), take("<u4", 2 * n_rule).reshape(-1, 2), take("<u4", n_term + n_rule).astype(np.int64)
        self.doc_ids, self.first, self.starts = take("<i8", n_doc), take("<u4", n_doc).astype(np.int64), take("<u8", n_doc).astype(np.int64)
        self.seq = take("<u2" if n_term + n_rule <= 1 << 16 else "<u4", n_seq).astype(np.int64)

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Expansions of all symbols in one array, and where each begins; rules only use symbols before them."""
        if self.table is None:
            n_term, ends = len(self.terminals), np.cumsum(self.lengths)
            begin = ends - self.lengths
            flat = np.zeros(ends[-1], np.int64)
            flat[:n_term] = self.terminals
            level = np.zeros(len(self.lengths), np.int64)
            for k, (a, b) in enumerate(self.rules.tolist()):
                level[n_term + k] = 1 + max(level[a], level[b])
            for depth in range(1, int(level.max(initial=0)) + 1):
                sym = np.flatnonzero(level == depth)
                for side in (0, 1):
                    part = self.rules[sym - n_term, side].astype(np.int64)
                    to = begin[sym] + (self.lengths[self.rules[sym - n_term, 0]] if side else 0)
                    flat[_spread(to, self.lengths[part])] = flat[_spread(begin[part], self.lengths[part])]
            self.table = (flat, begin)
        return self.table

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a symbol sequence."""
        flat, begin = self._table()
        return flat[_spread(begin[symbols], self.lengths[symbols])]

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.seq[self.first[k] : self.first[k + 1] if k + 1 < len(self.first) else len(self.seq)])

    def ids(self, k: int, begin: int, end: int) -> np.ndarray:
        """Ids begin to end of document ``k``: expansion lengths find the symbols that cover them."""
        symbols = self.seq[self.first[k] : self.first[k + 1] if k + 1 < len(self.first) else len(self.seq)]
        upto = np.cumsum(self.lengths[symbols])
        a, b = np.searchsorted(upto, begin, side="right"), np.searchsorted(upto, end, side="left")
        skip = begin - (upto[a - 1] if a else 0)
        return self.expand(symbols[a : b + 1])[skip : skip + end - begin]

    def total(self) -> int:
        return int(self.lengths[self.seq].sum())


def write_token_files(docs: DataFrame, out: str, tokenizer: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode (doc_id, text) into grammar files under ``out``; returns the manifest (shard, name, documents, ids, bytes)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bounds = common.key_bounds(docs, "doc_id", F.octet_length("text") + 16, shard_bytes)
    rows = docs.withColumn("shard", common.shard_of("doc_id", bounds)).repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    temp = f"{out}/_temporary"
    common.make_dirs(spark, temp)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = common.task_fs(temp)
        tok, attempt, done, seq = common.CachedTokenizer.shared(tokenizer, space_joins_next=False, slice_chars=SHARD_BYTES), uuid.uuid4().hex, [], 0
        doc_ids, ids, held, shard = [], [], 0, 0
        end = np.array([END_ID], np.uint32)

        def flush():
            nonlocal doc_ids, ids, held, seq
            raw = pack_shard(doc_ids, ids)
            name = f"{attempt}-{seq:05d}"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(raw)
            done.append((shard, seq, f"ids-{shard:06d}-{seq:05d}.rpg", name, len(ids), held, len(raw)))
            doc_ids, ids, held, seq = [], [], 0, seq + 1

        for batch in batches:
            flat, sizes = tok.encode_many(list(batch["text"]))
            stops = np.cumsum(sizes)
            for doc_id, shard_no, stop, n in zip(batch["doc_id"], batch["shard"], stops, sizes, strict=True):
                shard = int(shard_no)
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                ids.append(np.append(flat[stop - n : stop], end))
                held += int(n) + 1
                if held >= shard_bytes:  # a range of keys that is heavier than planned still gives files of bounded size
                    flush()
        if ids:
            flush()
        yield pd.DataFrame(done, columns=["shard", "seq", "name", "temp", "documents", "ids", "bytes"])

    manifest = common.stored(rows.mapInPandas(write, "shard int, seq int, name string, temp string, documents long, ids long, bytes long"), "op3-manifest").orderBy("shard", "seq")
    files = manifest.collect()  # one row per file
    common.rename_all(spark, [(f"{temp}/{f['temp']}", f"{out}/{f['name']}") for f in files])
    return manifest


def read_documents(spark: SparkSession, out: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; start counts the ids of all files before."""
    base, rows = 0, []
    for f in manifest.collect():  # one row per file
        rows.append((f["name"], base))
        base += f["ids"]
    files = spark.createDataFrame(rows, "name string, base long")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = common.task_fs(out)
        for batch in batches:
            for name, before in zip(batch["name"], batch["base"], strict=True):
                with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                    shard = Shard(f.read())
                flat = shard.expand(shard.seq).astype("<u4")
                ends = np.append(shard.starts[1:], len(flat))
                crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(shard.starts, ends, strict=True)]
                ids = pd.array(shard.doc_ids, dtype="Int64")
                ids[shard.doc_ids == -(2**63)] = pd.NA
                yield pd.DataFrame({"doc_id": ids, "start": shard.starts + before, "n_tokens": ends - shard.starts, "ids_crc32": np.array(crc, np.int64)})

    return files.repartition(min(max(1, len(rows)), 4096)).mapInPandas(parse, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op3_token_grammar")
def op3_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = shared_path(spark, "op3-ids")
    manifest = write_token_files(common.read(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, out, manifest)
