"""Training-data pipeline over ``documents``: one operator per stage.

quality -> near_duplicates -> repeated_text -> decontamination -> packing. Every
stage works on all rows its predecessor kept and takes effect: rejected,
duplicate and contaminated documents go, repeated bytes are cut out, and the
rest is packed. All stages but the last return the columns they were given.

Defined results: an empty table passes through every stage; a null text counts as empty
(the quality stage scores it like any text, the cutting stage leaves it null);
decisions and cut texts go by document, not by doc_id: rows that agree in doc_id and text are one document, different
texts of one doc_id are different ones, and so is every row with a null doc_id (in the near-duplicate stage it goes if
its group has a document with a doc_id or an earlier one without); other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common, op2_decontaminate, op5_suffix_dedup, op6_quality, op8_packing, op9_neardup
from basketgraph.session import shared_path


def _without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` without the documents (doc_id, key) of ``gone``; null ids match each other, so ``key`` tells them apart."""
    own = gone.select(F.col("doc_id").alias("_gone_id"), F.col(key).alias("_gone_key")).distinct()
    return docs.join(own, docs["doc_id"].eqNullSafe(F.col("_gone_id")) & (docs[key] == F.col("_gone_key")), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below the threshold. Labels are learned on the given documents."""
    model = op6_quality.train(docs, common.read(spark, sf_dir, "labels"))
    return docs.where(op6_quality.score(F.col("text"), model) >= op6_quality.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group: least doc_id, null last."""
    rows = common.keyed(docs, "pipeline-nameless")
    found = op9_neardup.grouped_documents(rows.select("doc_id", "text", "_v"))
    return _without(rows, found.where(~F.col("kept")), "_v").drop("_v")


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out every byte of a 100-byte string that occurs earlier; parts of a character left at a cut go too."""
    rows = common.keyed(docs, "pipeline-nameless")
    cut = op5_suffix_dedup.cut_documents(rows.select("doc_id", "text", "_v")).where("n_removed > 0")

    @F.pandas_udf("string")
    def text_of(kept):
        return kept.map(lambda b: bytes(b).decode(errors="ignore"))

    changed = cut.dropDuplicates(["doc_id", "_v"]).select(F.col("doc_id").alias("_cut_id"), F.col("_v").alias("_cut_v"), text_of("kept").alias("_cut_text"))
    joined = rows.join(changed, rows["doc_id"].eqNullSafe(F.col("_cut_id")) & (rows["_v"] == F.col("_cut_v")), "left")
    text = F.coalesce(F.col("_cut_text"), rows["text"])
    new = {"text": text, "n_chars": F.when(F.col("_cut_text").isNotNull(), F.length("_cut_text").cast("long")).otherwise(rows["n_chars"]) if "n_chars" in docs.columns else None}
    return joined.select(*[new[c].alias(c) if new.get(c) is not None else rows[c] for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more are words of benchmark windows."""
    items = common.read(spark, sf_dir, "benchmark").select("item_id", "text")
    found = op2_decontaminate.verdict(op2_decontaminate.contamination(docs.select("doc_id", "text"), items), "text_hash")
    rows = docs.withColumn("_text_hash", op2_decontaminate.row_key()["h"])
    return _without(rows, found.where("contaminated").withColumnRenamed("text_hash", "_text_hash"), "_text_hash").drop("_text_hash")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all kept documents with their place in a sequence."""
    import public_tokenizers

    return op8_packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_text", repeated_text),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No stage list with a trained model and tokenised output can be said in SQL; tests check the effect of each stage, the cutting stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread as the next one's input."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
