"""Preference formatting: the common turns of a chosen and a rejected conversation as one
prompt, and what follows as a pair of completions with masks.

Turns are rendered as ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline. A mask
is the runs ``length:train`` of a completion, in order; only assistant texts and their end
markers are trained on. Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.llm.order import deal_by_order
from graniteflow.session import partitions_for

START, END = "<|im_start|>", "<|im_end|>"


def turn_list(turn: Column, role: Column, text: Column) -> Column:
    """Aggregate: array of (role, text) in the order of the turns (null first, then by role and text).

    Null roles and texts are empty. ``<|im_`` within them gets a space, so no text can
    open or close a turn.
    """
    safe = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    parts = F.sort_array(F.collect_list(F.struct(turn.alias("turn"), safe(role).alias("role"), safe(text).alias("text"))))
    return F.transform(parts, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that are equal."""
    same = F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(chosen)).cast("int")


def _pieces(turns: Column) -> Column:
    """(text, train) pieces of the rendered turns."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit(START), t["role"], F.lit("\n")).alias("text"), F.lit(0).alias("train")),
        F.struct(F.concat(t["text"], F.lit(END)).alias("text"), (t["role"] == "assistant").cast("int").alias("train")),
        F.struct(F.lit("\n").alias("text"), F.lit(0).alias("train")),
    )))


def rendered(turns: Column) -> Column:
    """Text of the turns."""
    return F.array_join(F.transform(_pieces(turns), lambda p: p["text"]), "")


def mask(turns: Column) -> Column:
    """Runs ``length:train`` of the rendered turns."""
    return F.array_join(F.transform(_pieces(turns), lambda p: F.concat_ws(":", F.length(p["text"]), p["train"])), ",")


def format_pairs(df: DataFrame, id_col: str, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """One row per pair: id, prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask.

    ``chosen`` and ``rejected`` are arrays of (role, text); a null array has no turns. Equal
    conversations have the whole as prompt and two empty completions; without a common
    turn the prompt is empty.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    sides = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(chosen), none).alias("_c"), F.coalesce(F.col(rejected), none).alias("_r"))
    sides = sides.withColumn("_n", common_turns(F.col("_c"), F.col("_r")))
    rest = lambda c: F.slice(c, F.col("_n") + 1, F.greatest(F.size(c) - F.col("_n"), F.lit(0)))
    return sides.select(
        F.col("_id").alias(id_col), F.col("_n").alias("prompt_turns"), rendered(F.slice("_c", F.lit(1), F.col("_n"))).alias("prompt"),
        rendered(rest("_c")).alias("chosen"), mask(rest("_c")).alias("chosen_mask"),
        rendered(rest("_r")).alias("rejected"), mask(rest("_r")).alias("rejected_mask"),
    )


def with_rejected(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: id, chosen, rejected.

    Chosen are its turns. Rejected are the same turns up to the last assistant turn, whose
    text comes from the last assistant turn of the next conversation (ascending id, null
    first; after the last the first; empty if that has none). Without an assistant turn
    both are equal. Texts are shuffled once, by ranges of the id.
    """
    payload = [F.col(id_col).alias("_id"), F.col(turn_col).alias("_turn"), F.col(role_col).alias("_role"), F.col(text_col).alias("_text")]
    dealt = deal_by_order(df, F.col(id_col), payload).repartition(partitions_for(df), "_range")
    whole = dealt.groupBy("_range", "_guest", "_key", "_id").agg(turn_list(F.col("_turn"), F.col("_role"), F.col("_text")).alias("_turns"))
    spot = lambda turns: F.array_max(F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", i + 1)))
    whole = whole.withColumn("_at", spot(F.col("_turns")))
    whole = whole.withColumn("_answer", F.when(F.col("_at") > 0, F.element_at("_turns", F.col("_at"))["text"]).otherwise(F.lit("")))
    order = Window.partitionBy("_range").orderBy("_guest", "_key")
    pairs = whole.withColumn("_other", F.lead("_answer").over(order)).where(~F.col("_guest"))
    other = F.array(F.struct(F.lit("assistant").alias("role"), F.coalesce("_other", F.lit("")).alias("text")))
    swapped = F.concat(F.slice("_turns", F.lit(1), F.col("_at") - 1), other)
    return pairs.select(F.col("_id").alias(id_col), F.col("_turns").alias("chosen"), F.when(F.col("_at") > 0, swapped).otherwise(F.col("_turns")).alias("rejected"))


FORMAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, replace(coalesce(role, ''), '<|im_', '<| im_') AS role, replace(coalesce(text, ''), '<|im_', '<| im_') AS text FROM conversations),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id),
a AS (
  SELECT *, list_max(list_transform(range(1, len(turns) + 1), lambda i: CASE WHEN turns[i].role = 'assistant' THEN i END)) AS spot FROM c),
n AS (
  SELECT *, coalesce(lead(coalesce(turns[spot].text, '')) OVER o, first_value(coalesce(turns[spot].text, '')) OVER o) AS other
  FROM a WINDOW o AS (ORDER BY conv_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
p AS (
  SELECT conv_id, turns AS ch, CASE WHEN spot IS NULL THEN turns ELSE list_concat(turns[1:spot - 1], [{'role': 'assistant', 'text': other}]) END AS re FROM n),
q AS (
  SELECT *, coalesce(list_min(list_transform(range(1, greatest(len(ch), len(re)) + 1), lambda i: CASE WHEN ch[i] IS DISTINCT FROM re[i] THEN i END)) - 1, len(ch)) AS k FROM p),
d AS (SELECT conv_id, k, ch[1:k] AS pre, ch[k + 1:] AS cr, re[k + 1:] AS rr FROM q)
SELECT conv_id, k::INTEGER AS prompt_turns,
  coalesce(array_to_string(list_transform(pre, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(cr, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), ''), '') AS chosen,
  coalesce(array_to_string(list_transform(cr, lambda x: (length(x.role) + 13) || ':0,' || (length(x.text) + 10) || ':' || (x.role = 'assistant')::INTEGER || ',1:0'), ','), '') AS chosen_mask,
  coalesce(array_to_string(list_transform(rr, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), ''), '') AS rejected,
  coalesce(array_to_string(list_transform(rr, lambda x: (length(x.role) + 13) || ':0,' || (length(x.text) + 10) || ':' || (x.role = 'assistant')::INTEGER || ',1:0'), ','), '') AS rejected_mask
FROM d
"""
