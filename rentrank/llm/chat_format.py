"""Dialogues of several parties, rendered once from every participant's side.

For each participant, that speaker's turns become the assistant's, the others' become a named
user's, and only the assistant's words count in training. A rendered dialogue is kept as its
segments, one row per turn, with the place of each in the whole: a dialogue may be of any length,
and none is ever gathered. Places come from running sums within stretches of turns, and running
sums over the stretches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentrank.llm.store import saved, table

#: Turn numbers that one stretch spans: what a task holds of a dialogue at once.
STRETCH = 256
#: The markup, and the role whose turns are nobody's.
OPEN, NAMED, CLOSE, END = "<|", " name=", "|>\n", "<|end|>\n"
SYSTEM, ASSISTANT, USER = "system", "assistant", "user"


def _stretched(turns: DataFrame, speaker: str) -> DataFrame:
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col(speaker), F.lit("")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / STRETCH).cast("long"), F.lit(-1)).alias("_stretch"),
    ).filter("conv_id IS NOT NULL")


def perspectives(turns: DataFrame, speaker: str = "role") -> DataFrame:
    """conv_id, perspective, position, start, role, name, segment, mask_start, mask_end.

    ``turns``: conv_id, turn, ``speaker``, text. Every speaker of a conversation but the system
    is a participant (a NULL speaker is the one named ''). Per participant (perspective) and
    turn: role is assistant, user or system; name is the speaker of a user's turn, else NULL;
    segment is the rendered turn; ``start`` its place (in characters) in the rendered dialogue,
    of which the segments by ``position`` (from 0) are the parts; mask_start and mask_end the
    place of what is learned: the assistant's words and the end mark after them, else NULL.
    Turns are ordered by turn (NULL first), speaker, text; repeated rows stay. NULL text counts
    as empty; turns without conv_id belong to no dialogue and are left out. A conversation of
    the system alone has no perspective.
    """
    rows = _stretched(turns, speaker)
    members = rows.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    # Dealt out by stretch as well, so that no task gets all of one conversation.
    sides = rows.select("conv_id", "_stretch").distinct().join(members, "conv_id")
    seen = rows.join(saved(sides, "sides"), ["conv_id", "_stretch"])
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, ASSISTANT).when(F.col("speaker") == SYSTEM, SYSTEM).otherwise(USER)
    name = F.when(~own & (F.col("speaker") != SYSTEM), F.col("speaker"))
    head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(NAMED), name), F.lit("")), F.lit(CLOSE))
    tail = F.concat(F.lit("\n"), F.lit(END))
    segments = seen.select(
        "conv_id", "perspective", "_stretch", "turn", "speaker", "text", role.alias("role"), name.alias("name"),
        F.concat(head, F.col("text"), tail).alias("segment"), F.length(head).alias("_head"), own.alias("_own"),
    )
    side = ["conv_id", "perspective"]
    order = ["turn", "speaker", "text"]
    within = Window.partitionBy(*side, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*side).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.groupBy(*side, "_stretch").agg(
        F.sum(F.length("segment")).alias("_chars"), F.count(F.lit(1)).alias("_turns")
    )
    offsets = sizes.select(
        *side, "_stretch", F.coalesce(F.sum("_chars").over(before), F.lit(0)).alias("_from"),
        F.coalesce(F.sum("_turns").over(before), F.lit(0)).alias("_first"),
    )
    placed = segments.select(
        "*", F.coalesce(F.sum(F.length("segment")).over(within), F.lit(0)).alias("_at"),
        F.count(F.lit(1)).over(within).alias("_nth"),
    ).join(saved(offsets, "offsets"), [*side, "_stretch"])
    start = F.col("_from") + F.col("_at")
    body = start + F.col("_head")
    return placed.select(
        "conv_id", "perspective", (F.col("_first") + F.col("_nth")).alias("position"), start.alias("start"),
        "role", "name", "segment", F.when(F.col("_own"), body).alias("mask_start"),
        F.when(F.col("_own"), start + F.length("segment")).alias("mask_end"),
    )


def op5_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the side of each of its participants."""
    return perspectives(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS speaker, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
members AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
seen AS (
  SELECT *, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
    ELSE 'user' END AS role,
    CASE WHEN speaker <> perspective AND speaker <> 'system' THEN speaker END AS name
  FROM turns JOIN members USING (conv_id)),
rendered AS (
  SELECT *, '<|' || role || coalesce(' name=' || name, '') || '|>' || chr(10) AS head,
    head || text || chr(10) || '<|end|>' || chr(10) AS segment FROM seen),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    CAST(coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM rendered WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text))
SELECT conv_id, perspective, position, start, role, name, segment,
  CASE WHEN speaker = perspective THEN start + length(head) END AS mask_start,
  CASE WHEN speaker = perspective THEN start + length(segment) END AS mask_end
FROM placed
"""
