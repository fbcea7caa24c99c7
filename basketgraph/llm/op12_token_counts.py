"""Token counts by a digest cache.

The cache is a folder of Parquet entries (content digest -> tokens), one subfolder per digest of the tokenizer: its
library, the library's version and the bytes of its file. Texts are reduced to digests of their normalised
content first; only digests are joined with the cache, and of those that it lacks one text each is encoded. The new
counts are written as a run of their own under the tokenizer's folder. A run that fails leaves nothing that a reader sees, runs
of several jobs do not touch each other, and an entry that two of them wrote counts once.

Normalised content is what the tokenizer's own normaliser makes of a text, where that cannot change the count: the normalised text is
its own normal form and neither it nor the text holds a special string. Else, and where a tokenizer has no
normaliser of its own, it is the text. Digests are SHA-256.

Counts are those of the library: ``tokenizers`` for a ``.json`` file, ``sentencepiece`` for a ``.model`` file, with special strings inside
texts handled as the library's default and no special token, truncation or padding added.

Defined results: a null text counts as the empty text; every row has its count, rows with a null or repeated doc_id
too; an empty table gives no rows and writes no run; other columns are ignored. A text of any length is encoded whole; with a byte-level
tokenizer that adds no space in front, in slices cut before a space between two visible ASCII characters, which no token crosses.
With such a tokenizer the texts are cut further into chunks, at white space behind a character that is none; each different chunk is
encoded once and the counts of its occurrences are added up. Where chunks hardly repeat, texts are encoded as they are.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query
from basketgraph.session import shared_path

#: Tokens above which a document is over the limit (fixed value of the contract).
LIMIT = 1024
#: Characters encoded at a time, and of a slice of a long text.
SLICE = 500_000
#: Characters whose chunks are told apart at a time.
GROUP = 3_000_000
#: Chunks that a worker keeps the counts of, and the characters of the longest of them.
KEPT, KEPT_CHARS = 300_000, 64
ENTRY = "content binary, n_tokens long"

_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")
_LOADED: dict[str, Callable] = {}


def tokenizer_digest(path: str) -> str:
    """Names everything that counts depend on: file, library and its version."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    with open(path, "rb") as f:
        held = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{library.__name__} {library.__version__} {held}".encode()).hexdigest()


def _slices(text: str) -> list[str]:
    parts, at = [], 0
    while len(text) - at > SLICE:
        cut = _CUT.search(text, at + SLICE)
        if cut is None:
            break
        parts.append(text[at : cut.start()])
        at = cut.start()
    return [*parts, text[at:]]


def _groups(texts: Iterable[str], size: int) -> Iterator[list[str]]:
    """Lists of texts of about ``size`` characters."""
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text)
        if chars >= size:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _chunks(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Chunks of all texts in a row, and each text's first chunk (and the end).

    A cut is before ASCII white space behind a character that is no white space: a visible ASCII character, or one of two
    bytes or more that does not begin as U+0085, U+00A0 and the white space of three bytes do.
    """
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[: bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    space = (raw == 32) | (raw == 9) | (raw == 10) | (raw == 13)
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    last, two, three = raw[at - 1], raw[at - 2], raw[at - 3]
    wide = (last > 127) & (two != 0xC2) & (three != 0xE1) & (three != 0xE2) & (three != 0xE3) & (three != 0xEF)
    cut = np.zeros(len(raw), bool)
    cut[at[(last > 32) & (last < 127) | wide]] = True
    cut[bounds[:-1][bounds[:-1] < len(raw)]] = True
    begin = np.append(np.flatnonzero(cut), len(raw)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(begin) - 1, pa.py_buffer(begin), pa.py_buffer(raw)), np.searchsorted(begin, bounds)


def _by_chunks(encoded: Callable[[list[str]], list[int]]) -> Callable[[list[str]], list[int]]:
    """``encoded``, which counts texts, once for each different chunk of them."""
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        chunks, first = _chunks(pa.array(texts, pa.large_string()))
        coded = chunks.dictionary_encode()
        if 2 * (pc.sum(pc.binary_length(coded.dictionary)).as_py() or 0) > (pc.sum(pc.binary_length(chunks)).as_py() or 0):
            return encoded(texts)
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        sizes = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(sizes < 0)
        sizes[new] = encoded(words[new].tolist())
        kept = [(words[k], int(sizes[k])) for k in new if len(words[k]) <= KEPT_CHARS]
        known.update(kept[: KEPT - len(known)])
        upto = np.append(0, np.cumsum(sizes[coded.indices.to_numpy()]))
        return np.diff(upto[first]).tolist()

    return count


def _json_counter(path: str) -> Callable[[list[str]], list[int]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    first = said.get("pre_tokenizer") or {}
    cuts = not said.get("normalizer") and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
    cuts = cuts and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in said.get("added_tokens", []))

    def encoded(texts: list[str]) -> list[int]:
        return [len(e) for group in _groups(texts, SLICE) for e in tok.encode_batch_fast(group, add_special_tokens=False)]

    if not cuts:
        return encoded
    chunked = not any(c.isspace() for t in said.get("added_tokens", []) for c in t["content"])
    counted = _by_chunks(encoded) if chunked else encoded

    def count(texts: list[str]) -> list[int]:
        parts = [_slices(t) for t in texts]
        sizes = iter([n for group in _groups((s for p in parts for s in p), GROUP) for n in counted(group)])
        return [sum(next(sizes) for _ in p) for p in parts]

    return count


def _piece_counter(path: str) -> Callable[[list[str]], list[int]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for group in _groups(texts, SLICE) for ids in model.encode(group, num_threads=1)]


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of a list of texts; one instance per worker process."""
    if path not in _LOADED:
        _LOADED[path] = _json_counter(path) if path.endswith(".json") else _piece_counter(path)
    return _LOADED[path]


def normalised(text: Column, path: str) -> Column:
    """What a text is known by; equal values have equal counts."""
    text = F.coalesce(text, F.lit(""))
    if not path.endswith(".json"):
        return text
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    if not said.get("normalizer"):
        return text
    special = [t["content"] for t in said.get("added_tokens", [])]

    @F.pandas_udf("string")
    def normal(texts: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        change = Tokenizer.from_file(path).normalizer.normalize_str

        def of(t: str) -> str:
            n = change(t)
            return "T" + t if any(s in t or s in n for s in special) or change(n) != n else "N" + n

        return texts.map(of)

    return normal(text)


def _exists(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of all finished runs of a tokenizer, one row per content."""
    folder = f"{cache}/tokenizer={tokenizer}"
    if not _exists(spark, folder):
        return spark.createDataFrame([], ENTRY)
    entries = spark.read.schema(ENTRY).option("recursiveFileLookup", True).parquet(folder)
    return entries.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """(content, text) -> (content, n_tokens)."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            found = [n for group in _groups((v.as_py() or "" for v in batch.column("text")), GROUP) for n in count(group)]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(found, pa.int64())], names=["content", "n_tokens"])

    return texts.select("content", "text").mapInArrow(counts, ENTRY)


def _missing_texts(texts: DataFrame, misses: DataFrame, n_misses: int, all_missing: bool) -> DataFrame:
    """One text of each missing content. Copies meet in the map tasks, so a copied text crosses the shuffle once per task."""
    if not all_missing:
        small = n_misses <= 200_000
        if small:
            texts = texts.join(F.broadcast(misses), "content", "left_semi")
        one = texts.dropDuplicates(["content"])
        return one if small else one.join(misses, "content", "left_semi")
    return texts.dropDuplicates(["content"])


def token_counts(docs: DataFrame, path: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_tokens, over_limit for every row; adds to ``cache`` what it lacked."""
    spark, tokenizer = docs.sparkSession, tokenizer_digest(path)
    content = F.unhex(F.sha2(normalised(F.col("text"), path).cast("binary"), 256)).alias("content")
    n_bytes = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_bytes")
    rows = common.stored(docs.select("doc_id", content, n_bytes), "op12-rows")

    known = read_cache(spark, cache, tokenizer)
    found = common.stored(rows.select("content").distinct().join(known, "content", "left"), "op12-contents")
    misses = found.where("n_tokens IS NULL").select("content")
    n_misses, n_contents = misses.count(), found.count()
    run = shared_path(spark, "run").rsplit("/", 1)[1]
    run = f"{cache}/tokenizer={tokenizer}/{run}"
    if n_misses:
        texts = _missing_texts(docs.select(content, "text"), misses, n_misses, n_misses == n_contents)
        encode_counts(texts, path).write.parquet(run)
        new = spark.read.schema(ENTRY).parquet(run)
        counts = found.where("n_tokens IS NOT NULL").unionByName(new)
    else:
        counts = found
    counts = F.broadcast(counts) if n_contents <= 200_000 else counts
    return rows.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cold cache, so that the work is that of the whole table; jobs pass the folder they keep."""
    import public_tokenizers

    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), shared_path(spark, "op12-cache"))
