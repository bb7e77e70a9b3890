"""Chat formatting with rotating perspective: a dialogue is rendered once for every participant, that speaker as the
assistant and all others as named users, with the training mask to match.

A rendered dialogue is its segments, one row per turn, in the order of ``turn`` and ``place``: concatenated they are the
whole text. A dialogue of any length thus never has to fit one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.tables import table, whole_text

# The markup of chat turns, the role that sets the scene without taking part, and the name of the nameless.
OPEN, CLOSE, SYSTEM, UNKNOWN = "<|im_start|>", "<|im_end|>", "system", "unknown"


def participants(turns: DataFrame) -> DataFrame:
    """``conv_id, perspective``: who speaks in each dialogue, system turns aside."""
    return turns.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()


def broken_up(text: Column) -> Column:
    """Text in which nothing opens or closes a turn."""
    return F.replace(F.replace(text, F.lit(OPEN), F.lit("<| im_start|>")), F.lit(CLOSE), F.lit("<| im_end|>"))


def rotated(conversations: DataFrame) -> DataFrame:
    """``conv_id, perspective, turn, place, chat_role, name, segment, mask_start, mask_end`` for every turn and
    every participant of its dialogue.

    ``chat_role`` is assistant for the perspective's own turns, system for system turns, else user; ``name`` is the
    speaker of a user turn. The mask is the part of the segment (code points, end exclusive) that the model learns: what
    the assistant says with the closing mark, nothing of other turns (0, 0). Markup inside a text is broken up by a space,
    and inside a name by an underscore, so that it can't open or close a turn.

    A null role, an empty one or one of spaces is the speaker ``unknown``; names lose spaces around them and other
    white space becomes an underscore. Null text is empty. Turns with the same number follow by speaker and text
    (``place`` counts nothing: it is the key that orders them). Repeated rows are rendered each. A dialogue without
    participants gives no rows, as does empty input; dialogues with a null conv_id are one dialogue. Columns beside
    conv_id, turn, role and text play no part.
    """
    name = F.regexp_replace(F.trim(broken_up(F.coalesce("role", F.lit("")))), r"\s+", "_")
    text = broken_up(whole_text("text"))
    turns = conversations.select("conv_id", "turn", F.when(name == "", UNKNOWN).otherwise(name).alias("speaker"), text.alias("said"))
    who = participants(turns).withColumnRenamed("conv_id", "_conv")
    met = turns.join(who, turns["conv_id"].eqNullSafe(who["_conv"])).drop("_conv")
    role = (F.when(F.col("speaker") == SYSTEM, SYSTEM).when(F.col("speaker") == F.col("perspective"), "assistant")
            .otherwise("user"))
    named = met.withColumn("chat_role", role).withColumn("name", F.when(F.col("chat_role") == "user", F.col("speaker")))
    head = F.concat(F.lit(OPEN), F.col("chat_role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("\n"))
    learnt = F.col("chat_role") == "assistant"
    return (named.withColumn("head", head).withColumn("segment", F.concat("head", "said", F.lit(f"{CLOSE}\n")))
            .select("conv_id", "perspective", "turn", F.concat_ws(" ", "speaker", F.sha2("said", 256)).alias("place"), "chat_role",
                    "name", "segment", F.when(learnt, F.length("head")).otherwise(0).alias("mask_start"),
                    F.when(learnt, F.length("segment") - 1).otherwise(0).alias("mask_end")))


def op2_chat_rotation(spark: SparkSession, folder: str) -> DataFrame:
    return rotated(table(spark, folder, "conversations"))


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn,
         CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE regexp_replace(
           trim(replace(replace(role, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')), '\s+', '_', 'g') END AS speaker,
         replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') AS said
  FROM conversations),
who AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM turns WHERE speaker <> 'system'),
met AS (
  SELECT *, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role
  FROM turns JOIN who ON conv_id IS NOT DISTINCT FROM c),
headed AS (
  SELECT *, CASE WHEN chat_role = 'user' THEN speaker END AS name,
         '<|im_start|>' || chat_role || CASE WHEN chat_role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head
  FROM met)
SELECT conv_id, perspective, turn, speaker || ' ' || sha256(said) AS place, chat_role, name,
       head || said || '<|im_end|>' || chr(10) AS segment,
       CAST(CASE WHEN chat_role = 'assistant' THEN length(head) ELSE 0 END AS INTEGER) AS mask_start,
       CAST(CASE WHEN chat_role = 'assistant' THEN length(head || said) + 10 ELSE 0 END AS INTEGER) AS mask_end
FROM headed
"""
