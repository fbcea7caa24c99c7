"""Quality classifier by compression with zstandard dictionaries.

One dictionary is built from good and one from bad labelled texts. A text is cut
into blocks, each block is compressed under both dictionaries, and the
difference of the two sizes over their sum is mapped to a probability by a logistic curve
fitted on labelled texts that the dictionaries have not seen. Blocks keep the
weight of a dictionary the same in long and short texts; all blocks of a text count.

Training reads at most ``SAMPLE_DOCS`` labelled texts per class, of at most
``SAMPLE_BYTES`` bytes each, in the order of a hash of doc_id; rows whose crc32(doc_id as text) mod 5
is 0 are held out and never read. Everything else covers all texts.

Defined results: a null or empty text has difference 0 and gets the curve's value there; rows
with a null doc_id are scored like others (held_out false); repeated rows are scored each and count once in training (least
text of a doc_id); a doc_id with contradicting labels is not trained on; an
empty table gives no rows; if a class has no labelled text, the score is the
share of label 1 for every text (0.5 without labels). Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

SAMPLE_DOCS, SAMPLE_BYTES = 1500, 32768
DICT_BYTES = 64 << 10
BLOCK = 2048
LEVEL = 3
THRESHOLD = 0.3
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def differences(self, texts: list[str | None]) -> np.ndarray:
        """(size under bad - size under good) / (sum of both) per text, over all its blocks; 0 for an empty text."""
        import zstandard

        packers = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in (self.good, self.bad)]
        out = np.zeros(len(texts))
        for k, text in enumerate(texts):
            data = (text or "").encode()
            good = bad = 0
            for at in range(0, len(data), BLOCK):
                block = data[at : at + BLOCK]
                good += len(packers[0].compress(block))
                bad += len(packers[1].compress(block))
            if good + bad:
                out[k] = (bad - good) / (good + bad)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = self.differences(texts) if self.good and self.bad else np.zeros(len(texts))
        return 1 / (1 + np.exp(-(self.slope * x + self.offset)))


def chosen_ids(usable: DataFrame, marks: DataFrame, label: int, docs_per_class: int) -> DataFrame:
    """doc_id of at most ``docs_per_class`` usable documents of a label, first by a hash of doc_id.

    Only ids move. A threshold on the hash, from the count, leaves about twice as many before they are sorted, so what one task
    or the driver gets does not grow with the table.
    """
    ids = common.stored(marks.where(F.col("quality") == label).select("doc_id").join(usable.select("doc_id"), "doc_id", "left_semi"), "op6-ids")
    n, hashed = ids.count(), F.xxhash64("doc_id")
    share = 2 * docs_per_class / n if n else 1.0
    few = ids if share >= 0.9 else ids.where(hashed < int(-(2**63) + share * 2**64))
    return few.orderBy(hashed, "doc_id").limit(docs_per_class)


def sample(docs: DataFrame, labels: DataFrame, docs_per_class: int = SAMPLE_DOCS) -> tuple[list[str], list[str]]:
    """(good, bad) labelled texts for training; bounded by docs_per_class x SAMPLE_BYTES."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.octet_length("text").between(1, SAMPLE_BYTES))
    known = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marks = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_other")).where("quality = _other")
    out = []
    for label in (1, 0):
        ids = chosen_ids(usable, marks, label, docs_per_class)
        # at most docs_per_class ids are broadcast, and as many texts of bounded size fetched
        texts = usable.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
        rows = texts.select(F.xxhash64("doc_id").alias("h"), "doc_id", "text").collect()
        out.append([r["text"] for r in sorted(rows, key=lambda r: (r["h"], r["doc_id"]))])
    return out[0], out[1]


def dictionary(texts: list[str]) -> bytes:
    import zstandard

    blocks = [t.encode()[at : at + BLOCK] for t in texts for at in range(0, len(t.encode()), BLOCK)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their plain content is a valid dictionary
        return b"".join(blocks)[-DICT_BYTES:]


def fit(good: list[str], bad: list[str], share: float | None = None) -> Model:
    """Dictionaries from every other text, the curve from the rest."""
    if not good or not bad:
        p = min(max(0.5 if not good and not bad else float(bool(good)), 0.01), 0.99)
        return Model(b"", b"", 0.0, float(np.log(p / (1 - p))))
    model = Model(dictionary(good[::2]), dictionary(bad[::2]), 0.0, 0.0)
    held_good, held_bad = good[1::2] or good, bad[1::2] or bad
    x = model.differences(held_good + held_bad)
    y = np.r_[np.ones(len(held_good)), np.zeros(len(held_bad))]
    share = len(good) / (len(good) + len(bad)) if share is None else share
    weight = np.where(y == 1, share / len(held_good), (1 - share) / len(held_bad))
    slope, offset = _logistic(x, y, weight / weight.sum())
    return Model(model.good, model.bad, slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-5) -> tuple[float, float]:
    """Weighted logistic regression on one variable by damped Newton steps; the ridge keeps separable data finite."""
    scale = x.std() or 1.0
    a = np.stack([x / scale, np.ones_like(x)], 1)
    beta = np.zeros(2)
    penalty = np.diag([ridge, 0.0])

    def loss(b: np.ndarray) -> float:
        z = a @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * b @ penalty @ b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-a @ beta))
        grad = a.T @ (weight * (p - y)) + penalty @ beta
        step = np.linalg.solve((a.T * (weight * p * (1 - p))) @ a + penalty + 1e-12 * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    good, bad = sample(docs, labels)
    counts = {r["quality"]: r["n"] for r in labels.where(~held_out(F.col("doc_id"))).groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = counts.get(0, 0) + counts.get(1, 0)
    return fit(good, bad, counts.get(1, 0) / total if total and counts.get(0) and counts.get(1) else None)


def score(text: Column, model: Model) -> Column:
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(t: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(list(t)))

    return scored(text)


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.read(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
