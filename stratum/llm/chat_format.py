"""Chat formatting from an event log (operator 9), in DataFrame functions alone.

An event is a row (``conv_id``, ``seq``, ``msg``, ``kind``, ``role``, ``text``).
Kinds: ``message`` starts a message, ``delta`` appends to it, ``edit`` and
``regenerate`` replace what it said so far.  Events of a conversation are
ordered by ``seq``; each message keeps its place, its last role, and the text
from its last starting or replacing event on.

Template of a turn: ``<|turn|>role\\ntext<|end|>\\n``.  In roles and texts ``&``,
``<`` and ``[`` become ``&amp;``, ``&lt;`` and ``&#91;`` (in roles also the line feed
``&#10;``), so no control string, the template's or another's, can stand there;
``read_back`` undoes it.  ``loss_spans`` marks the assistant's texts: ``turn``,
``start`` (place in the formatted string), ``offset`` (place in the turn), ``length``.

Hot conversations: a conversation is one string, so its turns meet in one
task; events are folded before, by message, and streamed deltas of one
message are split over tasks only if messages are.  Nothing is gathered over
conversations.

Rows: a null text is empty; a null role is empty; a null ``conv_id`` is a
conversation of its own; equal ``seq`` are ordered by message, kind, role and
text; repeated rows are repeated events; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the template.
TURN, END, TRAINED = "<|turn|>", "<|end|>\n", "assistant"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))
EXTRA_ID, EXTRA_TEXT = -7, "</s>[INST] ok [/INST]"


def escape(c: Column, table=ESCAPES) -> Column:
    for plain, safe in table:
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def unescape(c: Column, table=ESCAPES) -> Column:
    for plain, safe in reversed(table):
        c = F.replace(c, F.lit(safe), F.lit(plain))
    return c


def messages(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id, msg, first_seq, role, text``."""
    resets = F.col("kind").isin("message", "edit", "regenerate")
    order = Window.partitionBy("conv_id", "msg").orderBy("seq", "kind", "role", "text")
    # a reset starts a new version; the last version's events make the text
    versions = events.withColumn("version", F.sum(F.when(resets, 1).otherwise(0)).over(order)).withColumn("n", F.row_number().over(order))
    last = Window.partitionBy("conv_id", "msg")
    now = versions.withColumn("last", F.max("version").over(last)).withColumn("first_seq", F.min("seq").over(last))
    parts = F.array_sort(F.collect_list(F.when(F.col("version") == F.col("last"), F.struct("n", F.coalesce("text", F.lit("")).alias("text")))))
    return now.groupBy("conv_id", "msg").agg(
        F.min("first_seq").alias("first_seq"), F.max_by("role", F.when(F.col("role").isNotNull(), F.col("n"))).alias("role"),
        F.concat_ws("", F.transform(parts, lambda p: p["text"])).alias("text"))


def formatted(events: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans``."""
    turns = messages(events).select("conv_id", "first_seq", "msg", escape(F.coalesce("role", F.lit("")), ROLE_ESCAPES).alias("role"), escape(F.col("text")).alias("text"))
    turns = turns.withColumn("piece", F.concat(F.lit(TURN), "role", F.lit("\n"), "text", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("first_seq", "msg")
    placed = turns.withColumn("turn", F.row_number().over(order) - 1).withColumn(
        "before", F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offset = F.lit(len(TURN)) + F.length("role") + 1
    span = F.when(F.col("role") == TRAINED, F.struct("turn", (F.col("before") + offset).alias("start"), offset.alias("offset"), F.length("text").alias("length")))
    return placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "piece"))).alias("pieces"), F.array_sort(F.collect_list(span)).alias("loss_spans")).select(
        "conv_id", F.concat_ws("", "pieces.piece").alias("formatted"), "loss_spans")


def read_back(chats: DataFrame) -> DataFrame:
    """``conv_id, turns`` (role and text of each turn) and ``loss`` (the unescaped texts under the mask) from the output."""
    ends = F.split("formatted", F.lit("<\\|end\\|>\\n"))
    cut = chats.select("conv_id", "formatted", "loss_spans", ends.alias("raw"))
    cut = cut.withColumn("turns", F.transform(F.slice("raw", 1, F.size("raw") - 1), lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), "\n", 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text"))))
    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.get("raw", s["turn"]), s["offset"] + 1, s["length"])))
    return cut.select("conv_id", "formatted", "turns", F.concat_ws("", masked).alias("loss"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Each row as the event that starts its message; ``msg`` numbers the rows of a conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.withColumn("msg", F.row_number().over(order).cast("long")).select(
        "conv_id", F.col("msg").alias("seq"), "msg", F.lit("message").alias("kind"), "role", "text")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and one more whose texts look like control strings."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(F.lit(EXTRA_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(TRAINED).alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).union(probe)


def digests(chats: DataFrame) -> DataFrame:
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read_back(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS safe,
         replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;') AS safe_role
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(safe) + length(safe_role) + length('<|turn|>') + 1 + length('<|end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
