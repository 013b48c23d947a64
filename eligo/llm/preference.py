"""Preference formatting: the shared start of two conversations once as prompt, the rest as masked completions.

Two conversations make a pair, by default ids 2k (chosen) and 2k + 1 (rejected). Their turns are compared at
equal turn numbers; the prompt is the longest run of turns, from the first, that are equal in role and text in
both. It is rendered once, from the chosen side; what follows on either side is that side's completion. The
loss mask of a segment is the character span that is trained on: the body and end mark of an assistant turn of a
completion, nothing of a prompt or of another role.

The output has one row per rendered turn, in order by (pair_id, part, turn, copy), and not one string per pair:
so a conversation of any length is never gathered in one place. ``assemble`` joins the segments where
conversations are known to be short. All steps are DataFrame functions; equality is tested by grouping on
(pair, turn), so the pairs' texts meet without a gathering of conversations, and a pair with very many turns is
split like any skewed join.

Defined cases: a conversation without a partner has an empty prompt and comes whole, with ``paired`` false;
null ids form one conversation without a partner; a null turn number sorts after all others; rows that repeat
a turn number are told apart by ``copy`` (1, 2, ... by role and text); a null role or text equals another null
and renders as the empty string; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eligo.llm.common import materialize

LAST = (1 << 63) - 1


def opening(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(opening(role), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def paired_turns(conversations: DataFrame) -> DataFrame:
    """(pair_id, side, conv_id, turn, copy, role, text): side 0 is chosen, 1 rejected."""
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    return conversations.select(
        F.shiftright("conv_id", 1).alias("pair_id"),
        F.coalesce(F.col("conv_id").bitwiseAND(F.lit(1)), F.lit(0)).cast("int").alias("side"),
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        copy.cast("long").alias("copy"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def common_prefix(turns: DataFrame) -> DataFrame:
    """(pair_id, paired, end_turn, end_copy): the first place where the sides of a pair differ (null: nowhere)."""
    said = F.struct("role", "text")
    places = turns.groupBy("pair_id", "turn", "copy").agg(
        F.min("side").alias("low"), F.max("side").alias("high"), (F.min(said) == F.max(said)).alias("same"))
    differs = (F.col("low") == F.col("high")) | ~F.col("same")
    return places.groupBy("pair_id").agg(
        ((F.min("low") == 0) & (F.max("high") == 1)).alias("paired"),
        F.min(F.when(differs, F.struct("turn", "copy"))).alias("end")).select(
        "pair_id", "paired", F.col("end.turn").alias("end_turn"), F.col("end.copy").alias("end_copy"))


def preference_segments(conversations: DataFrame) -> DataFrame:
    """One row per rendered turn: pair_id, paired, part, conv_id, turn, copy, role, rendered, trained_from, trained_to."""
    turns = paired_turns(conversations)
    ends = materialize(common_prefix(turns), "preference-prefix").withColumnRenamed("pair_id", "_pair")
    joined = turns.join(ends, turns["pair_id"].eqNullSafe(ends["_pair"]))
    shared = F.col("end_turn").isNull() | (F.col("turn") < F.col("end_turn")) | (
        (F.col("turn") == F.col("end_turn")) & (F.col("copy") < F.col("end_copy")))
    part = F.when(F.col("paired") & shared, "prompt").when(F.col("side") == 0, "chosen").otherwise("rejected")
    text = rendered(F.col("role"), F.col("text"))
    trained = (F.col("part") != "prompt") & (F.coalesce(F.col("role"), F.lit("")) == "assistant")
    return (joined.withColumn("part", part).filter((F.col("part") != "prompt") | (F.col("side") == 0))
            .select("pair_id", "paired", "part", "conv_id", F.nullif("turn", F.lit(LAST)).alias("turn"), "copy", "role",
                    text.alias("rendered"),
                    F.when(trained, F.length(opening(F.col("role")))).otherwise(0).cast("long").alias("trained_from"),
                    F.when(trained, F.length(text)).otherwise(0).cast("long").alias("trained_to")))


def assemble(segments: DataFrame) -> DataFrame:
    """One row per pair with the prompt and both completions as strings, for conversations of bounded length."""
    def joined(part: str) -> Column:
        of = F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct(
            F.coalesce("turn", F.lit(LAST)).alias("turn"), "copy", "rendered"))))
        return F.array_join(F.transform(of, lambda x: x["rendered"]), "").alias(part)
    return segments.groupBy("pair_id", "paired").agg(joined("prompt"), joined("chosen"), joined("rejected"))


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_segments(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = """
WITH t AS (
  SELECT conv_id, conv_id >> 1 AS pair_id, conv_id & 1 AS side, turn, role, text,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) AS copy
  FROM conversations
), sides AS (
  SELECT pair_id, count(DISTINCT side) = 2 AS paired FROM t GROUP BY pair_id
), odd AS (
  SELECT pair_id, min([turn, copy]) AS first_odd FROM (
    SELECT pair_id, turn, copy FROM t GROUP BY pair_id, turn, copy
    HAVING count(*) < 2 OR min(role) <> max(role) OR min(text) <> max(text)) GROUP BY pair_id
), p AS (
  SELECT t.*, paired,
         CASE WHEN paired AND (first_odd IS NULL OR [turn, copy] < first_odd) THEN 'prompt'
              WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part
  FROM t JOIN sides USING (pair_id) LEFT JOIN odd USING (pair_id)
)
SELECT pair_id, paired, part, conv_id, turn, copy, role,
       '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 ELSE 0 END AS trained_from,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 + length(text) + 8 ELSE 0 END AS trained_to
FROM p WHERE part <> 'prompt' OR side = 0
"""
