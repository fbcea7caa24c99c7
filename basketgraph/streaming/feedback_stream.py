"""The feedback stream: JSON lines -> validated records -> cleaned and scored -> sinks.

The same column functions serve batch and stream; only the source and the
sink differ. Sinks never run side effects inside a transformation: one
``foreachBatch`` reads each micro-batch of raw lines once and commits records,
dead letters and the daily table by batch id (``FeedbackBatches``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketgraph import schemas
from basketgraph.operators import feedback as fb_ops
from basketgraph.operators import sentiment as sent
from basketgraph.session import materialize
from basketgraph.streaming import journal
from basketgraph.streaming.generations import KeyedTable

REQUIRED_FIELDS = ("customerid", "productid", "rating", "about")


def flag_feedback_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Every raw line with its fields and ``reason`` (null when valid): raw, reason, customerid, productid, rating, about, product."""
    parsed = fb_ops.parse_json_lines(lines, value_col, schemas.FEEDBACK_LINE, REQUIRED_FIELDS)
    rating = F.expr("try_cast(parsed.rating AS INT)")
    reason = F.when(F.col("reason").isNull() & rating.isNull(), F.lit("rating_out_of_range")).otherwise(F.col("reason"))
    fields = [F.col(f"parsed.{name}").alias(name) for name in ("customerid", "productid")]
    return parsed.select("raw", reason.alias("reason"), *fields, rating.alias("rating"), F.col("parsed.about").alias("about"), F.col("parsed.product").alias("product"))


def parse_feedback_lines(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records, dead letters) from raw lines; dead letters keep the raw text and a reason."""
    valid, rejected = fb_ops.split_valid(flag_feedback_lines(lines, value_col))
    return valid.drop("raw", "reason"), rejected.select("raw", "reason")


def score_feedback(
    records: DataFrame,
    stop_words: Iterable[str],
    positive: Iterable[str],
    negative: Iterable[str],
    event_date: str | None = None,
) -> DataFrame:
    """Feedback records as written by the stream: date, userid, productid, rating, sentAnalysis.

    ``date`` is the event date column when given, else the processing date
    (constant within a micro-batch).
    """
    keep = ["customerid", "productid", "rating"] + ([event_date] if event_date else [])
    scored = sent.score_text(records, "about", stop_words, positive, negative, keep=keep)
    day = F.col(event_date).cast("date") if event_date else F.current_date()
    return scored.select(
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.col("customerid").alias("userid"),
        F.col("productid").alias("productid"),
        F.col("rating"),
        F.col("sentiment").alias("sentAnalysis"),
    )


def start_json_sink(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "1 second"
) -> StreamingQuery:
    """Append every record of every micro-batch as JSON lines (K3). Empty batches write nothing."""
    writer = df.writeStream.format("json").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def run_to_completion(query: StreamingQuery, timeout_sec: int | None = None) -> None:
    """Wait for an ``availableNow`` query to finish its backlog, however long; a caller's limit stops it and fails."""
    finished = query.awaitTermination(timeout_sec) if timeout_sec else query.awaitTermination() or True
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_sec}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def read_lines(spark, fmt: str = "text", path: str | None = None, **options) -> DataFrame:
    """A streaming DataFrame of raw lines in ``value``.

    ``text`` over a directory by default; ``socket`` or ``kafka`` when the caller
    chooses them (the Kafka connector must be on the classpath).
    """
    reader = spark.readStream.format(fmt).options(**options)
    df = reader.load(path) if path is not None else reader.load()
    if fmt == "kafka":
        df = df.selectExpr("CAST(value AS STRING) AS value")
    return df.select("value")


WordList = Iterable[str] | DataFrame

# Columns of a stored feedback record; the daily table adds its key.
RECORD = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("userid", T.StringType()), T.StructField("productid", T.StringType()),
    T.StructField("rating", T.IntegerType()), T.StructField("sentAnalysis", T.StringType()),
])
# Word tables of at most this many rows are broadcast to a batch; larger ones are shuffled.
BROADCAST_WORDS = 1_000_000


class FeedbackBatches:
    """Commits each micro-batch of raw lines, read once, to three places under ``out_dir``.

    * ``records/batch_id=N``: every scored record as JSON lines (K3);
    * ``dead_letters/batch_id=N``: rejected lines with their reason;
    * ``daily``: one row per user and day, last write wins (K2, ``generations``). Within a batch, records of one user and
      day are ordered by product, rating and label, so the winner does not depend on arrival order.

    Each place is replaced by batch id, and the daily table's commit is written last, so a replayed batch changes nothing.
    Word lists are plain words, or tables of any size that are joined inside the batch.
    """

    def __init__(self, spark, out_dir: str, stop_words: WordList, positive: WordList, negative: WordList):
        self.out_dir = out_dir.rstrip("/")
        self.daily = daily_table(spark, self.out_dir)
        self.lists = (stop_words, positive, negative)
        self.words = None
        if any(isinstance(x, DataFrame) for x in self.lists):
            tables = [x if isinstance(x, DataFrame) else spark.createDataFrame([(w,) for w in x], "word string") for x in self.lists]
            self.words = materialize(sent.word_table(*tables))
            self.broadcast = self.words.count() <= BROADCAST_WORDS

    def scored(self, flagged: DataFrame) -> DataFrame:
        """Valid lines of a batch as records."""
        records = flagged.where(F.col("reason").isNull())
        if self.words is None:
            return score_feedback(records, *self.lists)
        labels = sent.score_with_word_table(records, "_row", "about", self.words, self.broadcast).select("_row", "sentiment")
        day = F.date_format(F.current_date(), "yyyy-MM-dd").alias("date")
        return records.join(labels, "_row").select(day, F.col("customerid").alias("userid"), "productid", "rating", F.col("sentiment").alias("sentAnalysis"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        flagged = flag_feedback_lines(batch).withColumn("_row", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if flagged.isEmpty():
                return
            scored = self.scored(flagged).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                scored.write.mode("overwrite").json(f"{self.out_dir}/records/batch_id={batch_id}")
                dead = flagged.where(F.col("reason").isNotNull()).select("raw", "reason")
                dead.write.mode("overwrite").json(f"{self.out_dir}/dead_letters/batch_id={batch_id}")
                keyed = scored.select(journal.daily_key("date", "userid").alias("doc_id"), "*").where(F.col("doc_id").isNotNull())
                self.daily.write_batch(keyed, batch_id, "date")
            finally:
                scored.unpersist()
        finally:
            flagged.unpersist()


def keyed_feedback(spark, path: str) -> KeyedTable:
    """One row per user and day at ``path``."""
    schema = T.StructType([T.StructField("doc_id", T.StringType()), *RECORD.fields])
    return KeyedTable(spark, path, schema, ["doc_id"], [journal.BATCH_COL, "productid", "rating", "sentAnalysis"])


def daily_table(spark, out_dir: str) -> KeyedTable:
    return keyed_feedback(spark, f"{out_dir.rstrip('/')}/daily")


def start_feedback_stream(
    lines: DataFrame,
    out_dir: str,
    stop_words: WordList,
    positive: WordList,
    negative: WordList,
    available_now: bool = False,
    interval: str = "1 second",
) -> list[StreamingQuery]:
    """Validate, clean, score and label feedback lines: one query that reads the source once (``FeedbackBatches``)."""
    commit = FeedbackBatches(lines.sparkSession, out_dir, stop_words, positive, negative)
    writer = lines.writeStream.foreachBatch(commit).option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoints/lines")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return [writer.start()]


def read_records(spark, out_dir: str) -> DataFrame:
    """All records written so far."""
    return spark.read.schema(RECORD).json(f"{out_dir.rstrip('/')}/records").select(*RECORD.names)


def read_dead_letters(spark, out_dir: str) -> DataFrame:
    return spark.read.schema("raw string, reason string").json(f"{out_dir.rstrip('/')}/dead_letters").select("raw", "reason")


def read_daily(spark, out_dir: str) -> DataFrame:
    """The keyed feedback table written by ``start_feedback_stream``."""
    return daily_table(spark, out_dir).read()
