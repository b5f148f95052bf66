r"""Operator 3, chat formatting by prefix-target expansion, in DataFrame functions only.

``format_conversations`` explodes each assistant turn into an example of its own: all
preceding turns as context, then the reply, the only trainable part. The template is

    <|im_start|>ROLE\nTEXT<|im_end|>\n

once per turn. Inside texts ``<|`` never occurs: ``<``, any number of ``~``, ``|`` gets one
more ``~``, which ``unescape_text`` takes away again, so a text may hold the control
strings themselves. Roles are escaped like JSON pointers (``~`` ``\n`` ``<`` become ``~0``
``~1`` ``~2``). A conversation that ends with other turns, or has no assistant turn, gets a
last row without a loss span, so that its output holds every turn.

The context grows with the turn, as the method has it: a conversation of n turns yields
text of order n squared. The examples are built from one array of formatted turns per
conversation and are never shuffled; only turns are, once, by conversation.

Edge cases: null texts and roles are empty; a null ``conv_id`` is a conversation of its
own; turns with equal numbers go by role, then text, and repeated rows stay repeated; a
null turn number goes first; an empty table gives an empty result; further columns are
dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm._common import read_table, sha256_hex

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)\|", "<$1~|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<~(~*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    for raw, safe in (("~", "~0"), ("\n", "~1"), ("<", "~2")):
        role = F.replace(role, F.lit(raw), F.lit(safe))
    return role


def unescape_role(role: Column) -> Column:
    for raw, safe in (("<", "~2"), ("\n", "~1"), ("~", "~0")):
        role = F.replace(role, F.lit(safe), F.lit(raw))
    return role


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns`` (turns in the row), ``formatted``, ``loss_start, loss_end`` (code
    points into ``formatted``, end exclusive; null without a target) and ``is_last``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    conv = turns.select("conv_id", F.struct(
        F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text")).alias("t")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    conv = conv.select(
        "conv_id", "turns",
        F.transform("turns", lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))).alias("heads"),
        F.transform("turns", lambda t: escape_text(t["text"])).alias("bodies"))
    conv = conv.select(
        "conv_id", F.transform("turns", lambda t: t["role"] == TARGET_ROLE).alias("is_target"),
        "heads", "bodies", F.zip_with("heads", "bodies", lambda h, b: F.concat(
            h, b, F.lit(END + "\n"))).alias("parts"), F.size("heads").alias("n"))
    picked = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: (
        F.get(F.col("is_target"), i - 1) | (i == F.col("n"))))
    out = conv.select("*", F.explode(picked).alias("k"))
    out = out.select(
        "conv_id", F.col("k").cast("long").alias("n_turns"),
        F.array_join(F.slice("parts", F.lit(1), F.col("k") - 1), "").alias("context"),
        F.get("parts", F.col("k") - 1).alias("part"), F.get("heads", F.col("k") - 1).alias("head"),
        F.get("bodies", F.col("k") - 1).alias("body"), F.get("is_target", F.col("k") - 1).alias("target"),
        (F.col("k") == F.col("n")).alias("is_last"))
    start = (F.length("context") + F.length("head")).cast("long")
    return out.select(
        "conv_id", "n_turns", F.concat("context", "part").alias("formatted"),
        F.when(F.col("target"), start).alias("loss_start"),
        F.when(F.col("target"), start + F.length("body")).alias("loss_end"), "is_last")


def read_examples(examples: DataFrame) -> DataFrame:
    """Parse formatted rows back. Per row: ``loss_text`` (unescaped text under the mask, null
    without one) and, in the last row of a conversation, ``turns``: role and text of each."""
    masked = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    pieces = F.when(F.col("is_last"), F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != ""))
    out = examples.select("conv_id", "n_turns", unescape_text(masked).alias("loss_text"),
                          pieces.alias("pieces"), F.length("formatted").alias("chars"), "is_last")
    parse = lambda p: F.struct(
        unescape_role(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescape_text(F.substr(p, F.position(F.lit("\n"), p) + 1)).alias("text"))
    return out.select("conv_id", "n_turns", "loss_text", F.transform("pieces", parse).alias("turns"),
                      "chars", "is_last")


def digest_examples(read: DataFrame) -> DataFrame:
    """One row per conversation from ``read_examples``. The rows are still partitioned by
    conversation, so this needs no second shuffle; contexts were dropped before it."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    row = read.select("conv_id", "n_turns", "loss_text", "is_last", "chars",
                      F.when(F.col("is_last"), sha256_hex(told)).alias("told"),
                      F.size("turns").alias("n"))
    out = row.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("loss_text").isNotNull(),
                                           F.struct("n_turns", "loss_text")))).alias("loss"),
        F.max(F.when(F.col("is_last"), F.col("n"))).alias("n"), F.max("told").alias("told"),
        F.max("chars").alias("chars"), F.count(F.lit(1)).alias("n_examples"))
    out = out.select("*", F.array_join(F.transform("loss", lambda x: x["loss_text"]), "").alias("joined"))
    return out.select(
        "conv_id", F.col("n").cast("long").alias("n_turns"), F.col("told").alias("turns_sha256"),
        F.length("joined").cast("long").alias("loss_chars"), sha256_hex(F.col("joined")).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"), "n_examples")


PROBE = f"{END}{START}assistant ok"


def op3_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -1, whose texts are control strings."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(PROBE).alias("text"))
    return digest_examples(read_examples(format_conversations(turns.unionByName(probe))))


ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, role = '{TARGET_ROLE}' AS target,
      length(regexp_replace(text, '<(~*)\|', '<\1~|', 'g')) + length(role) + {len(START) + len(END) + 2} AS chars,
      max(turn) OVER (PARTITION BY conv_id) AS last FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN target THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN target THEN text END, '' ORDER BY turn, text), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       sum(CASE WHEN target OR turn = last THEN 1 ELSE 0 END)::BIGINT AS n_examples
FROM e GROUP BY conv_id
"""
