"""Preference formatting of paired conversations, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def turns(conversations: DataFrame) -> DataFrame:
    """One row a conversation: conv_id and its turns (role, text) in order. Rows without conv_id belong to none and go."""
    t = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    return t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).select("conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("ts"))


def render(t):
    """A turn as text. '<|' in a role or text gets a backslash, so that no text can open a turn."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("<\\|"))
    return F.concat(F.lit("<|"), safe(t["role"]), F.lit("|>\n"), safe(t["text"]), F.lit("<|end|>\n"))


def preference(pairs: DataFrame) -> DataFrame:
    """Paired prompts and completions.

    pairs: pair_id, chosen_id, rejected_id, chosen, rejected (arrays of turns role, text; null: no such conversation).
    The longest common prefix of turns (equal role and text) is the prompt, rendered once. What follows it on either
    side is that side's completion; its mask lists (start, end, train): character ranges of the turns in the
    completion, train being true where the role is assistant. Equal conversations: both completions are empty. A
    missing side: nothing is common, its completion and mask are null. Empty table: no rows. Turns that repeat count
    each; turns of one number are ordered by role and text. Texts may be of any length; turns of a conversation are one
    array, so its size is a row's. Other columns are not read.
    """
    first = F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.size("chosen"), F.size("rejected")), F.lit(1))), lambda i: ~F.get(F.col("chosen"), i - 1).eqNullSafe(F.get(F.col("rejected"), i - 1)))
    both = F.least(F.size("chosen"), F.size("rejected"))
    n = F.when(F.col("chosen").isNull() | F.col("rejected").isNull(), 0).when(F.size(first) > 0, F.get(first, F.lit(0)) - 1).otherwise(both)
    out = pairs.withColumn("common_turns", n.cast("int"))
    join = lambda ts: F.array_join(F.transform(ts, render), "")
    out = out.withColumn("prompt", F.coalesce(join(F.slice("chosen", 1, F.col("common_turns"))), F.lit("")))
    for side in ("chosen", "rejected"):
        rest = F.slice(side, F.col("common_turns") + 1, F.greatest(F.size(side) - F.col("common_turns"), F.lit(0)))
        none = F.struct(F.array().cast("array<struct<start:int,end:int,train:boolean>>").alias("mask"), F.lit(0).alias("end"))
        # a turn is rendered where it is appended, and its start is carried on: each is looked at once
        further = lambda a, t, size: F.struct(F.array_append(a["mask"], F.struct(a["end"].alias("start"), (a["end"] + size).alias("end"), (t["role"] == "assistant").alias("train"))).alias("mask"), (a["end"] + size).alias("end"))
        ends = F.aggregate(rest, none, lambda a, t: further(a, t, F.length(render(t))), lambda a: a["mask"])
        out = out.withColumn(f"{side}_completion", join(rest)).withColumn(f"{side}_mask", ends)
    return out.select("pair_id", "chosen_id", "rejected_id", "common_turns", "prompt", "chosen_completion", "chosen_mask", "rejected_completion", "rejected_mask")


def neighbours(conversations: DataFrame) -> DataFrame:
    """Pairs of the table `conversations`: ids 2i (chosen) and 2i+1 (rejected). An equi-join on i; no key has more than
    two conversations, however often a first turn or a whole conversation repeats."""
    t = turns(conversations).withColumn("pair_id", F.floor(F.col("conv_id") / 2)).withColumn("even", F.col("conv_id") == 2 * F.col("pair_id"))
    side = lambda even, name: F.max(F.when(F.col("even") == F.lit(even), F.struct("conv_id", "ts"))).alias(name)
    p = t.groupBy("pair_id").agg(side(True, "c"), side(False, "r"))
    return p.select("pair_id", F.col("c.conv_id").alias("chosen_id"), F.col("r.conv_id").alias("rejected_id"), F.col("c.ts").alias("chosen"), F.col("r.ts").alias("rejected"))


SQL = r"""
WITH t AS (
  SELECT conv_id, conv_id // 2 AS pair_id, conv_id % 2 AS odd, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(turn, -1), coalesce(role, 'unknown'), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT *, '<|' || replace(role, '<|', '<\|') || '|>' || chr(10) || replace(text, '<|', '<\|') || '<|end|>' || chr(10) AS s FROM t),
p AS (SELECT pair_id, max(CASE WHEN odd = 0 THEN conv_id END) AS chosen_id, max(CASE WHEN odd = 1 THEN conv_id END) AS rejected_id,
             count(*) FILTER (odd = 0) AS nc, count(*) FILTER (odd = 1) AS nr FROM t GROUP BY pair_id),
m AS (SELECT a.pair_id, min(a.k) - 1 AS n FROM t a LEFT JOIN t b ON a.pair_id = b.pair_id AND b.odd = 1 AND a.k = b.k AND a.role = b.role AND a.text = b.text
      WHERE a.odd = 0 AND b.k IS NULL GROUP BY a.pair_id),
c AS (SELECT p.*, CASE WHEN nc = 0 OR nr = 0 THEN 0 ELSE coalesce(m.n, nc) END AS n FROM p LEFT JOIN m USING (pair_id)),
e AS (SELECT r.*, sum(length(s)) OVER (PARTITION BY pair_id, odd ORDER BY k) - sum(CASE WHEN k <= n THEN length(s) ELSE 0 END) OVER (PARTITION BY pair_id, odd) AS stop FROM c JOIN r USING (pair_id))
SELECT c.pair_id, c.chosen_id, c.rejected_id, c.n::INT AS common_turns,
       coalesce(string_agg(s, '' ORDER BY k) FILTER (odd = 0 AND k <= n), '') AS prompt,
       CASE WHEN nc > 0 THEN coalesce(string_agg(s, '' ORDER BY k) FILTER (odd = 0 AND k > n), '') END AS chosen_completion,
       CASE WHEN nr > 0 THEN coalesce(string_agg(s, '' ORDER BY k) FILTER (odd = 1 AND k > n), '') END AS rejected_completion,
       CASE WHEN nc > 0 THEN coalesce(string_agg((stop - length(s)) || '-' || stop || ':' || (role = 'assistant'), ',' ORDER BY k) FILTER (odd = 0 AND k > n), '') END AS chosen_mask,
       CASE WHEN nr > 0 THEN coalesce(string_agg((stop - length(s)) || '-' || stop || ':' || (role = 'assistant'), ',' ORDER BY k) FILTER (odd = 1 AND k > n), '') END AS rejected_mask,
       CASE WHEN nc > 0 THEN coalesce(sum(length(s)) FILTER (odd = 0 AND k > n AND role = 'assistant'), 0)::BIGINT END AS chosen_trained,
       CASE WHEN nr > 0 THEN coalesce(sum(length(s)) FILTER (odd = 1 AND k > n AND role = 'assistant'), 0)::BIGINT END AS rejected_trained
FROM c JOIN e USING (pair_id) GROUP BY c.pair_id, c.chosen_id, c.rejected_id, c.n, nc, nr
"""
