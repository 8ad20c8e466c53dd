"""Multi-party chat rendered from every participant's perspective.

For each participant of a conversation the whole dialogue is rendered with that
participant as ``assistant`` and everybody else as a named ``user``; ``system``
messages stay as they are.  The result has one row per (conversation,
participant, message): its segment of the rendering, where the segment starts,
and the span that counts for the loss (text and end mark of the participant's
own messages).  Segments in ``position`` order, put end to end, are the
rendering; rows instead of one long string keep a conversation of any length
distributed.  Offsets are sums within stretches of ``CHUNK`` turns plus the sums
of the stretches before, so no task holds a whole long conversation either.

Defined results: messages are ordered by turn (null first), then speaker, then
text; repeated rows are repeated messages; a null or blank role is the
participant ``unknown``; null text is empty; a null ``conv_id`` is a
conversation of its own; a conversation with system messages only has no
participant and no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 64
START, END = "<|im_start|>", "<|im_end|>"


def render(conversations: DataFrame) -> DataFrame:
    speaker = F.lower(F.trim(F.col("role").cast("string")))
    messages = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(speaker.isNull() | (speaker == ""), "unknown").otherwise(speaker).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    participants = (
        messages.filter("speaker != 'system'")
        .select(F.col("conv_id").alias("of"), F.col("speaker").alias("participant"))
        .distinct()
    )
    own = F.col("speaker") == F.col("participant")
    role = F.when(own, "assistant").when(F.col("speaker") == "system", "system").otherwise("user")
    name = F.when(F.col("role") == "user", F.col("speaker"))
    head = F.concat(
        F.lit(START), "role", F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n")
    )
    rendered = (
        messages.join(participants, F.col("conv_id").eqNullSafe(F.col("of")))
        .withColumn("role", role)
        .withColumn("name", name)
        .withColumn("head", F.length(head))
        .withColumn("segment", F.concat(head, "text", F.lit(END + "\n")))
        .withColumn("size", F.length("segment").cast("long"))
        .drop("of")
    )
    keys = ["conv_id", "participant"]
    inside = Window.partitionBy(*keys, "chunk").orderBy("turn", "speaker", "text")
    before = (
        Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    chunks = (
        rendered.groupBy(*keys, "chunk")
        .agg(F.count("*").alias("messages"), F.sum("size").alias("chars"))
        .select(
            F.col("conv_id").alias("c"),
            F.col("participant").alias("p"),
            F.col("chunk").alias("k"),
            F.coalesce(F.sum("messages").over(before), F.lit(0)).alias("messages_before"),
            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
        )
    )
    placed = rendered.withColumn("nth", F.row_number().over(inside)).withColumn(
        "reach", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    joined = placed.join(
        chunks,
        F.col("conv_id").eqNullSafe(F.col("c"))
        & (F.col("participant") == F.col("p"))
        & F.col("chunk").eqNullSafe(F.col("k")),
    )
    start = F.col("chars_before") + F.col("reach") - F.col("size")
    mine = F.col("role") == "assistant"
    return joined.select(
        "conv_id",
        "participant",
        (F.col("messages_before") + F.col("nth") - 1).alias("position"),
        "turn",
        "role",
        "name",
        "segment",
        start.alias("segment_start"),
        F.when(mine, start + F.col("head")).alias("mask_start"),
        F.when(mine, start + F.col("size") - 1).alias("mask_end"),
    )


ORACLE = """
WITH messages AS (
  SELECT conv_id, turn,
         CASE WHEN role IS NULL OR trim(role) = '' THEN 'unknown' ELSE lower(trim(role)) END AS speaker,
         coalesce(text, '') AS text
  FROM conversations),
participants AS (SELECT DISTINCT conv_id, speaker AS participant FROM messages WHERE speaker <> 'system'),
rendered AS (
  SELECT m.*, p.participant,
         CASE WHEN m.speaker = p.participant THEN 'assistant'
              WHEN m.speaker = 'system' THEN 'system' ELSE 'user' END AS role
  FROM messages m JOIN participants p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (
  SELECT *, CASE WHEN role = 'user' THEN speaker END AS name,
         '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head
  FROM rendered),
placed AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS segment,
         row_number() OVER w - 1 AS position,
         sum(length(head || text || '<|im_end|>' || chr(10))) OVER (w ROWS UNBOUNDED PRECEDING) AS reach
  FROM headed
  WINDOW w AS (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, text))
SELECT conv_id, participant, position, turn, role, name, segment,
       CAST(reach - length(segment) AS BIGINT) AS segment_start,
       CAST(CASE WHEN role = 'assistant' THEN reach - length(segment) + length(head) END AS BIGINT) AS mask_start,
       CAST(CASE WHEN role = 'assistant' THEN reach - 1 END AS BIGINT) AS mask_end
FROM placed
"""
