"""Shared helpers: scratch tables, byte-balanced shards, file system access from tasks, cached tokenising."""

from __future__ import annotations

import ctypes
import functools
import json
import math
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from basketgraph.session import shared_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and return the reread table."""
    path = shared_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``_v``, which tells documents of one doc_id apart; (doc_id, _v) is the key of a document.

    An id with one text has 0, so that the column costs shuffles nothing; an id with several texts has the hash of each,
    and rows that agree in both are one document. Each row without a doc_id is a document of its own: it has a written
    row number from 1 on, so the key is the same whenever the table is read again.
    """
    nameless = stored(docs.where(F.col("doc_id").isNull()).withColumn("_v", F.monotonically_increasing_id() + 1), name)
    named = docs.where(F.col("doc_id").isNotNull())
    text = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    several = stored(named.groupBy("doc_id").agg(F.min(text).alias("l"), F.max(text).alias("m")).where("l < m").select(F.col("doc_id").alias("_several")), f"{name}-several")
    named = named.join(broadcast_if_small(several), named["doc_id"] == several["_several"], "left")
    named = named.withColumn("_v", F.when(F.col("_several").isNotNull(), text).otherwise(F.lit(0).cast("long"))).drop("_several")
    return named.unionByName(nameless)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows; else unchanged, for a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def key_bounds(df: DataFrame, key: str, weight: Column, target: int, bins_per_shard: int = 16) -> list[int]:
    """Ascending keys that cut ``df`` into shards of about ``target`` weight each.

    A histogram of weights over equal-width key bins, refined where one bin
    alone exceeds the target, so clustered keys are cut as well. The driver
    receives a constant number of bins per shard, never rows; the cuts depend
    on the data only, so the same table gives the same shards everywhere.
    """
    narrow = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), weight.cast("long").alias("w"))
    total, lo, hi = narrow.agg(F.sum("w"), F.min("k"), F.max("k")).first()
    if not total or total <= target:
        return []
    spans, cuts, carried = [(lo, hi + 1, total)], [], 0
    level = 0
    while spans:
        n_bins = max(64, bins_per_shard * math.ceil(total / target))
        step = {s: max(1, -(-(e - s) // n_bins)) for s, e, _ in spans}
        pick = F.lit(None).cast("long")
        for s, e, _ in spans:
            inside = (F.col("k") >= s) & (F.col("k") < e)
            pick = F.when(inside, F.lit(s) + F.expr(f"(k - {s}L) div {step[s]}L") * F.lit(step[s])).otherwise(pick)
        found = narrow.select(pick.alias("b"), "w").where("b is not null").groupBy("b").agg(F.sum("w").alias("w")).collect()
        width = sorted((r["b"], r["w"]) for r in found)
        of = sorted(step)
        fine = [(b, w, step[max(s for s in of if s <= b)]) for b, w in width]
        cuts.append(fine)
        level += 1
        spans = [(b, b + st, w) for b, w, st in fine if w > target and st > 1][:64] if level < 4 else []
    bins = {}
    for fine in cuts:
        for b, w, st in fine:
            bins[b] = (w, st)
    # a refined bin is replaced by its parts, which begin at the same key
    order = sorted(bins.items())
    bounds = []
    for b, (w, _) in order:
        if carried and carried + w > target:
            bounds.append(b)
            carried = 0
        carried += w
    return bounds


def shard_of(key: str, bounds: list[int]) -> Column:
    """The shard number of a key: how many of ``bounds`` are at or below it; null keys go to shard 0."""
    cuts = np.asarray(bounds, dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    return place(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)).cast("long")))


#: About how many bytes of text a Python step takes at once.
SLICE_BYTES = 2 << 20


def slices(batch: pd.DataFrame, size: pd.Series) -> Iterator[pd.DataFrame]:
    """A batch in parts of about SLICE_BYTES, so that a task's memory follows bytes and not rows."""
    part = (size.cumsum() // SLICE_BYTES).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(batch)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.iloc[a:b]


def give_back() -> None:
    """Return the memory that this process has freed to the system; allocators keep it otherwise."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim is not None:
        trim(0)


def lean(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's step over batches that gives its memory back at the end: a worker stays for a minute after its task, next to an executor that needs the room."""

    @functools.wraps(step)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from step(batches)
        finally:
            give_back()

    return run


def task_fs(uri: str):
    """(file system, path) of a shared folder, usable inside a task: local, HDFS or object store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def rename_all(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    """Rename files through Hadoop's file system; a name that exists already with no source left counts as done."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for src, dst in pairs:
        fs = path(src).getFileSystem(conf)
        if not fs.rename(path(src), path(dst)) and not (fs.exists(path(dst)) and not fs.exists(path(src))):
            raise OSError(f"cannot commit {src}")


def put_text(spark: SparkSession, uri: str, text: str) -> None:
    """Write a small text file through Hadoop's file system: under a temporary name, then renamed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(uri).getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(path(uri + ".tmp"), True)
    out.write(bytearray(text.encode()))
    out.close()
    rename_all(spark, [(uri + ".tmp", uri)])


def make_dirs(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    path(uri).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path(uri))


def _runs(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``size[i]`` values from ``start[i]`` on, for all i in a row, and where each run ends."""
    end = np.cumsum(size, dtype=np.int64)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 30 else np.int64
    return values[np.arange(total, dtype=kind) + np.repeat((start - (end - size)).astype(kind), size)], end


_TOKENIZERS: dict = {}


class CachedTokenizer:
    """Ids of whole texts by the tokenizers library, encoding each distinct word chunk once.

    Texts are cut only where no token can cross: at ASCII white space after a
    visible character. With ``space_joins_next`` the white space stays at the
    head of the following chunk (byte-level BPE); without, it is dropped (a
    tokenizer that discards white space). A text with any other Unicode space
    or control separator is encoded in one piece. Special-token strings in a
    text are ordinary text.

    A tokenizer with the rules ``WORD_RULES`` lower-cases and parts letters from
    punctuation; there a chunk of letters and a tail of punctuation is looked
    up as two words, the letters in lower case, so that far fewer are met anew.
    """

    OTHER_SPACE = r"[\x00\x01\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
    #: Normalizers and pre-tokenizers under which a ``WORD`` can be parted.
    WORD_RULES = (
        [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
        [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    )
    #: Letters that NFC leaves alone and whose lower case is one letter.
    LETTERS = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]+"
    #: All ASCII punctuation but the apostrophe, which can begin a token of letters.
    TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str, space_joins_next: bool, max_cached: int = 600_000, slice_chars: int = 3_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.joins, self.max_cached, self.slice_chars = space_joins_next, max_cached, slice_chars
        self.word_ends = None if space_joins_next else self._word_ends()
        self._reset()

    def _word_ends(self) -> np.ndarray | None:
        """For a tokenizer with ``WORD_RULES`` and a mark at word ends: whether each id ends a word."""
        rules = json.loads(self.tok.to_str())
        parts = tuple((rules[k] or {}).get(f"{k}s".replace("_", "")) for k in ("normalizer", "pre_tokenizer"))
        mark, vocabulary = rules["model"].get("end_of_word_suffix"), rules["model"].get("vocab")
        if parts != self.WORD_RULES or rules["model"].get("type") != "BPE" or not mark or rules["post_processor"] or rules["truncation"] or rules["padding"]:
            return None
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        # the same model with what the rules come to for words of LETTERS between spaces
        self.for_words = Tokenizer(self.tok.model)
        self.for_words.normalizer = normalizers.Lowercase()
        self.for_words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        return ends

    def _reset(self) -> None:
        import pyarrow as pa

        self.known = pa.array([], pa.large_string())  # chunk of each row of ``size`` and ``start``; packed, a dict would take ten times the memory
        self.size = np.zeros(1024, np.int32)
        self.start = np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.uint32)
        self.used = 0

    @classmethod
    def shared(cls, path: str, space_joins_next: bool, **options: int) -> CachedTokenizer:
        """One instance per worker process, so that a reused worker keeps what earlier tasks have encoded."""
        key = (path, space_joins_next, *sorted(options.items()))
        if key not in _TOKENIZERS:
            _TOKENIZERS[key] = cls(path, space_joins_next, **options)
        return _TOKENIZERS[key]

    def _learn(self, new) -> np.ndarray:
        """Encode the chunks of an Arrow array, and return the rows they got."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.word_ends is not None:
            letters = pc.match_substring_regex(new, f"^{self.LETTERS}$")
            rows = np.empty(len(new), np.int64)
            for some, learn in ((letters, self._learn_words), (pc.invert(letters), self._learn_chunks)):
                rows[np.flatnonzero(some.to_numpy(zero_copy_only=False))] = learn(new.filter(some))
            return rows
        return self._learn_chunks(new)

    def _learn_words(self, words) -> np.ndarray:
        """The same for words of letters: each ends with an id that ends a word, so offsets are not needed."""
        import pyarrow as pa

        base, texts = len(self.known), words.to_pylist()
        for k in range(0, len(texts), 4096):
            lines = [" ".join(texts[i : i + 64]) for i in range(k, min(k + 4096, len(texts)), 64)]
            ids = np.concatenate([np.asarray(e.ids, np.uint32) for e in self.for_words.encode_batch_fast(lines, add_special_tokens=False)])
            sizes = np.diff(np.flatnonzero(self.word_ends[ids]), prepend=-1)
            if len(sizes) != len(texts[k : k + 4096]):
                raise ValueError("a word of letters has no end or several")
            self._add(ids, sizes, base + k)
        self.known = pa.concat_arrays([self.known, words])
        return base + np.arange(len(texts))

    def _learn_chunks(self, new) -> np.ndarray:
        import pyarrow as pa
        import pyarrow.compute as pc

        # a chunk with white space at its head can follow another one directly, one without is set apart by a space that gives no token
        follows = pc.match_substring_regex(new, pattern=r"^[ \t\n\r]+[^ \t\n\r]" if self.joins else r"[^ \t\n\r]").to_numpy(zero_copy_only=False)
        alone, together = new.filter(pa.array(~follows)), new.filter(pa.array(follows))
        base = len(self.known)
        for k in range(0, len(alone), 4096):
            found = [e.ids for e in self.tok.encode_batch_fast(alone[k : k + 4096].to_pylist(), add_special_tokens=False)]
            self._add(np.concatenate([np.asarray(x, np.uint32) for x in found]), np.array([len(x) for x in found]), base + k)
        gap = "" if self.joins else " "
        chars = pc.utf8_length(together).to_numpy(zero_copy_only=False) + len(gap)
        for k in range(0, len(together), 256):
            enc = self.tok.encode(gap.join(together[k : k + 256].to_pylist()), add_special_tokens=False)
            begin = np.fromiter((o[0] for o in enc.offsets), np.int64, len(enc.ids))
            of = np.searchsorted(np.cumsum(chars[k : k + 256]), begin, side="right")
            self._add(np.asarray(enc.ids, np.uint32), np.bincount(of, minlength=min(256, len(together) - k)), base + len(alone) + k)
        self.known = pa.concat_arrays([self.known, alone, together])
        rows = np.empty(len(new), np.int64)
        rows[np.flatnonzero(~follows)] = base + np.arange(len(alone))
        rows[np.flatnonzero(follows)] = base + len(alone) + np.arange(len(together))
        return rows

    def _add(self, ids: np.ndarray, sizes: np.ndarray, row: int) -> None:
        n = len(sizes)
        while row + n > len(self.size):
            self.size, self.start = np.resize(self.size, 2 * len(self.size)), np.resize(self.start, 2 * len(self.start))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.size[row : row + n] = sizes
        self.start[row : row + n] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)

    def _forget(self) -> None:
        """Drop what lies beyond the cache's size: the chunks met first, the frequent ones among them, stay."""
        import pyarrow as pa

        if len(self.known) > self.max_cached:
            self.known = pa.concat_arrays([self.known[: self.max_cached], self.known[:0]])  # a copy, so that the rest is freed
            self.used = int(self.start[self.max_cached])

    def encode_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has; worked off in slices of about ``slice_chars``."""
        found, begin, chars = [], 0, 0
        for k, text in enumerate(texts):
            chars += len(text or "")
            if chars >= self.slice_chars or k == len(texts) - 1:
                found.append(self._encode_slice(texts[begin : k + 1]))
                self._forget()
                begin, chars = k + 1, 0
        if not found:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([ids for ids, _ in found]), np.concatenate([n for _, n in found])

    @staticmethod
    def _cut_before_space(texts) -> tuple:
        """Chunks of all texts in a row, cut at each white space behind a visible character, and each text's first chunk (and the end)."""
        import pyarrow as pa

        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[: bounds[-1]] if data is not None else np.zeros(0, np.uint8)
        space = (raw == 32) | (raw == 9) | (raw == 10) | (raw == 13)
        cut = np.zeros(len(raw), bool)
        cut[1:] = space[1:] & ~space[:-1]
        cut[bounds[:-1][bounds[:-1] < len(raw)]] = True
        begin = np.append(np.flatnonzero(cut), len(raw)).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(begin) - 1, pa.py_buffer(begin), pa.py_buffer(raw)), np.searchsorted(begin, bounds)

    def _found(self, chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different chunks: an array, and where each chunk's ids start in it and how many they are."""
        import pyarrow as pa
        import pyarrow.compute as pc

        row = np.full(len(chunks), -1, np.int64)
        if len(self.known) > len(chunks):  # the hash table is made of the smaller side
            at = pc.fill_null(pc.index_in(self.known, value_set=chunks), -1).to_numpy()
            met = np.flatnonzero(at >= 0)
            row[at[met]] = met
        else:
            row[:] = pc.fill_null(pc.index_in(chunks, value_set=self.known), -1).to_numpy()
        new = np.flatnonzero((row < 0) & (pc.binary_length(chunks).to_numpy() > 0))
        if len(new):
            row[new] = self._learn(chunks.take(pa.array(new)))
        return self.flat, self.start[row], np.where(row < 0, 0, self.size[row])

    def _found_parts(self, chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same by the words of the chunks: letters in lower case and their tail of punctuation, or a whole chunk and no tail."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(chunks):
            return self._found(chunks)
        word = pc.match_substring_regex(chunks, f"^{self.LETTERS}[{re.escape(self.TAIL)}]*$")
        head = pc.binary_length(pc.ascii_rtrim(chunks, self.TAIL)).to_numpy()
        size = pc.binary_length(chunks).to_numpy()
        bounds = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
        is_word = word.to_numpy(zero_copy_only=False)
        cuts = np.append(np.stack([bounds[:-1], bounds[:-1] + np.where(is_word, head, size)], 1).ravel(), bounds[-1])
        parts = pa.LargeStringArray.from_buffers(2 * len(chunks), pa.py_buffer(cuts), chunks.buffers()[2])
        parts = pc.if_else(pa.array(np.repeat(is_word, 2)), pc.ascii_lower(parts), parts).dictionary_encode()
        code = parts.indices.to_numpy(zero_copy_only=False)
        ids_of, start_of, size_of = self._found(parts.dictionary)
        flat, end = _runs(ids_of, start_of[code], size_of[code])
        stop = end[1::2]
        start = np.r_[0, stop[:-1]]
        return flat, start, stop - start

    def _encode_slice(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = [t or "" for t in texts]
        odd = np.flatnonzero(pc.match_substring_regex(pa.array(texts, pa.large_string()), pattern=self.OTHER_SPACE).to_numpy(zero_copy_only=False)).tolist()
        whole = {k: np.asarray(self.tok.encode(texts[k], add_special_tokens=False).ids, np.uint32) for k in odd}
        plain = pa.array(["" if k in whole else t for k, t in enumerate(texts)], pa.large_string())
        if self.joins:
            values, first = self._cut_before_space(plain)
        else:
            lists = pc.ascii_split_whitespace(plain)
            values, first = lists.values, lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = values.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        ids_of, start_of, size_of = self._found(coded.dictionary) if self.word_ends is None else self._found_parts(coded.dictionary)
        flat, end = _runs(ids_of, start_of[code], size_of[code])
        upto = np.r_[0, end][first]
        if not whole:
            return flat, np.diff(upto)
        parts = [whole.get(k, flat[upto[k] : upto[k + 1]]) for k in range(len(texts))]
        return np.concatenate(parts) if parts else flat, np.array([len(x) for x in parts], np.int64)

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text])[0]
