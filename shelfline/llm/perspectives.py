"""Multi-party perspective rotation of conversations.

For every participant of a conversation (each speaker but ``system``), the whole
dialogue is rendered with that speaker as ``assistant``, all others as ``user``
with their name, and system turns as ``system``. A loss mask covers what the
assistant says, with its end mark.

The result has one row a message of a rendering: its text, its place in the
whole rendering and the masked span in it. So a dialogue is whole (ordered by
``start``, its rows are the rendering) and never has to meet in one task: the
place is a sum over ranges of turns first, then inside a range.

Defined results: null text is empty; a null speaker is named ``unknown``; rows
equal in conversation, turn, speaker and text are one message; messages of one
turn follow speaker and text; a null turn comes first; end marks in a text are
broken up with a zero-width space, so that no text can pose as markup; an empty
table gives an empty one; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import col

SYSTEM = "system"
TURNS = 1024    # turns of a range


def _rendered(speaker: Column, view: Column, text: Column) -> tuple[Column, Column, Column]:
    """(role, head, body) of a message in a perspective."""
    role = F.when(speaker == SYSTEM, SYSTEM).when(speaker == view, "assistant").otherwise("user")
    name = F.when(role == "user", F.concat(F.lit(" name="), F.regexp_replace(speaker, r"\s+", "_"))).otherwise("")
    safe = F.replace(text, F.lit("<|im_"), F.lit("<|​im_"))
    return role, F.concat(F.lit("<|im_start|>"), role, name, F.lit("\n")), F.concat(safe, F.lit("<|im_end|>\n"))


def rotate(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, perspective, turn, speaker, role, rendered, start (characters of
    the rendering before the message), mask_start and mask_length (of the
    message; 0 and 0 where nothing is learned)."""
    said = rows.select(col(conv_col).alias("conv_id"), col(turn_col).cast("long").alias("turn"),
                       F.coalesce(col(speaker_col), F.lit("unknown")).alias("speaker"),
                       F.coalesce(col(text_col), F.lit("")).alias("text")).distinct()
    views = said.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    v, s = views.alias("v"), said.alias("s")
    both = s.join(v, F.col("s.conv_id").eqNullSafe(F.col("v.conv_id"))).select("s.*", "perspective")
    role, head, body = _rendered(F.col("speaker"), F.col("perspective"), F.col("text"))
    both = both.select("conv_id", "perspective", "turn", "speaker", "text", role.alias("role"), F.concat(head, body).alias("rendered"),
                       F.length(head).cast("long").alias("head"))
    both = both.withColumns({"size": F.length("rendered").cast("long"), "part": F.floor(F.col("turn") / TURNS)})
    keys = ["conv_id", "perspective"]
    past = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = both.groupBy(*keys, "part").agg(F.sum("size").alias("size"))
    sums = sums.select(*keys, "part", past(Window.partitionBy(*keys).orderBy(F.col("part").asc_nulls_first())).alias("base"))
    inside = both.withColumn("run", past(Window.partitionBy(*keys, "part").orderBy(
        F.col("turn").asc_nulls_first(), "speaker", "text")))
    i, b = inside.alias("i"), sums.alias("b")
    on = F.lit(True)
    for k in [*keys, "part"]:
        on = on & F.col(f"i.{k}").eqNullSafe(F.col(f"b.{k}"))
    learned = F.col("role") == "assistant"
    return i.join(b, on).select(
        "i.conv_id", "i.perspective", "turn", "speaker", "role", "rendered", (F.col("base") + F.col("run")).alias("start"),
        F.when(learned, F.col("head")).otherwise(F.lit(0).cast("long")).alias("mask_start"),
        F.when(learned, F.col("i.size") - F.col("head") - 1).otherwise(F.lit(0).cast("long")).alias("mask_length"))


PERSPECTIVES_SQL = """
WITH s AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
v AS (SELECT DISTINCT conv_id, speaker AS perspective FROM s WHERE speaker <> 'system'),
b AS (SELECT s.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
             ELSE 'user' END AS role FROM s JOIN v ON s.conv_id IS NOT DISTINCT FROM v.conv_id),
h AS (SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || regexp_replace(speaker, '\\s+', '_', 'g')
             ELSE '' END || chr(10) AS head,
             replace(text, '<|im_', '<|' || chr(8203) || 'im_') || '<|im_end|>' || chr(10) AS body FROM b)
SELECT conv_id, perspective, turn, speaker, role, head || body AS rendered,
       coalesce(sum(length(head || body)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
       CASE WHEN role = 'assistant' THEN length(head) ELSE 0 END::BIGINT AS mask_start,
       CASE WHEN role = 'assistant' THEN length(body) - 1 ELSE 0 END::BIGINT AS mask_length
FROM h
""".replace("\\\\s", "\\s")
