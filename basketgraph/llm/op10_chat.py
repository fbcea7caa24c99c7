"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes its own example: all turns before it are the
context, and only that reply lies under the loss mask. A conversation that does
not end with a reply also gives one example without a target, so that the output
holds every turn.

Template: ``[INST] role\\ntext [/INST]`` for a turn of any other role and
``<s>text</s>`` for a reply. Inside texts a backslash is doubled, and a control
string gets a backslash after its first character, so no control string is left
in them; dropping each backslash and keeping the character behind it restores
the text.

Defined results: a null or empty text is the empty text and a null role the empty role; turns
are ordered by turn, then role, then text (nulls first), so ties and repeated rows
are kept in a fixed order; null conversation ids form one conversation; an empty
table gives no rows; other columns are ignored. An example's text holds its whole prefix, so the
output of one conversation is quadratic in its turns, by definition of the method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

#: Control strings of the template (fixed values).
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
OPEN, CLOSE = "[INST] ", " [/INST]"
REPLY_OPEN, REPLY_CLOSE = "<s>", "</s>"
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def prefix_target_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per example.

    conv_id, example_no (position of the target turn), n_turns, formatted,
    loss_start and loss_end (code points of ``formatted``; equal: no target),
    is_full (the example that holds the whole conversation).
    """
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    reply = role == "assistant"
    segment = F.when(reply, F.concat(F.lit(REPLY_OPEN), escape(text), F.lit(REPLY_CLOSE))).otherwise(
        F.concat(F.lit(OPEN), F.url_encode(role), F.lit("\n"), escape(text), F.lit(CLOSE))
    )
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text"), segment.alias("seg"), reply.alias("reply")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    conv = conv.select("conv_id", F.transform("ts", lambda t: t["seg"]).alias("segs"), F.transform("ts", lambda t: t["reply"]).alias("replies"))
    wanted = F.filter(F.sequence(F.lit(1), F.size("segs")), lambda i: (i == F.size("segs")) | F.element_at("replies", i.cast("int")))
    ex = conv.select("conv_id", "segs", "replies", F.explode(wanted).alias("i"))
    context = F.array_join(F.slice("segs", F.lit(1), F.col("i") - 1), "")
    own, is_reply = F.element_at("segs", F.col("i")), F.element_at("replies", F.col("i"))
    ex = ex.select("conv_id", (F.col("i") - 1).alias("example_no"), F.col("i").alias("n_turns"), context.alias("context"), own.alias("own"), is_reply.alias("is_reply"), (F.col("i") == F.size("segs")).alias("is_full"))
    start = F.length("context") + len(REPLY_OPEN)
    end = F.length("context") + F.length("own") - len(REPLY_CLOSE)
    return ex.select(
        "conv_id", "example_no", "n_turns", F.concat("context", "own").alias("formatted"),
        F.when(F.col("is_reply"), start).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("is_reply"), end).otherwise(0).cast("long").alias("loss_end"), "is_full",
    )


def parse_formatted(formatted: Column) -> Column:
    """Array of (role, text) restored from a formatted example."""
    segs = F.regexp_extract_all(formatted, F.lit(r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>"), F.lit(0))

    def turn(seg: Column) -> Column:
        body = F.substring(seg, F.lit(len(OPEN) + 1), F.length(seg) - len(OPEN) - len(CLOSE))
        role = F.substring_index(body, "\n", 1)
        reply = F.substring(seg, F.lit(len(REPLY_OPEN) + 1), F.length(seg) - len(REPLY_OPEN) - len(REPLY_CLOSE))
        is_reply = seg.startswith(REPLY_OPEN)
        return F.struct(
            F.when(is_reply, F.lit("assistant")).otherwise(F.url_decode(role)).alias("role"),
            unescape(F.when(is_reply, reply).otherwise(F.substring(body, F.length(role) + 2, F.length(body)))).alias("text"),
        )

    return F.transform(segs, turn)


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, what the examples hold: turns, trainable text and size."""
    target = unescape(F.substring("formatted", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")))
    rows = examples.select(
        "conv_id", F.struct("example_no", target.alias("t")).alias("target"), F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("is_full"), parse_formatted(F.col("formatted"))).alias("turns"),
    )
    per = rows.select(
        "conv_id", "target", "chars", F.size("turns").cast("long").alias("n"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("sha"),
    )
    got = per.groupBy("conv_id").agg(F.max("n").alias("n_turns"), F.max("sha").alias("turns_sha256"), F.sort_array(F.collect_list("target")).alias("ts"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("ts", lambda t: t["t"]), "")
    return got.select("conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


SQL = """
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    length(replace(replace(replace(replace(replace(text, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]'))
      + CASE WHEN role = 'assistant' THEN 7 ELSE 16 + length(role) END AS len
  FROM src
), c AS (SELECT *, sum(len) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


@query("op10_chat_formatting", SQL)
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = common.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)").select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.lit(PROBE_TEXT).alias("text")
    )
    examples = common.stored(prefix_target_examples(turns.unionByName(probe)), "op10")
    return conversation_digests(examples)
