"""Chat formatting: cumulative-snapshot collapse, then rendering (DataFrame functions).

Logs often hold a conversation many times, once after each turn. Every conversation's
turns get a rolling prefix digest: the running XOR of two 64-bit hashes of (position,
role, text), 128 bits in all. A conversation is a snapshot if its whole digest is a
proper prefix digest of another one; equal conversations keep the smallest id. Anti-joins
leave the maximal conversations, which are rendered by a chat template.

Prefix digests are made distinct before the join, so a first turn that a third of all
conversations share is one row there. A window spans one conversation only.

Defined cases: turns are ordered by (turn, role, text), nulls first; rows that repeat
exactly count once; a null role renders as "unknown", a null text as empty, and both are
values of their own in digests; rows with a null conversation id are dropped, since no
conversation is known for them; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The chat template: one turn, then the marker that ends it.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def numbered_turns(logs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, pos (from 1), role, text of each distinct turn, with running digests p1, p2."""
    turns = logs.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text")).distinct()
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    turns = turns.withColumn("pos", F.row_number().over(order))
    for name, seed in (("h1", 11), ("h2", 23)):
        turns = turns.withColumn(name, F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), "role", F.col("text").isNull(), "text"))
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return turns.select("conv", "pos", "role", "text", F.expr("bit_xor(h1)").over(run).alias("p1"),
                        F.expr("bit_xor(h2)").over(run).alias("p2"),
                        F.count("*").over(Window.partitionBy("conv")).alias("n_turns"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv, n_turns, n_copies of the conversations that no longer one begins with."""
    whole = turns.where(F.col("pos") == F.col("n_turns")).groupBy("n_turns", "p1", "p2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    inner = turns.where(F.col("pos") < F.col("n_turns")).select(F.col("pos").alias("n_turns"), "p1", "p2").distinct()
    return whole.join(inner, ["n_turns", "p1", "p2"], "left_anti").select("conv", "n_turns", "n_copies")


def render(turns: DataFrame) -> DataFrame:
    """conv, text: turns of each conversation in order, by the template."""
    line = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    return turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines")).select(
        "conv", F.concat_ws("\n", "lines.line").alias("text"))


def format_chats(logs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, n_turns, n_copies, text of every maximal conversation."""
    turns = numbered_turns(logs, conv_col, turn_col, role_col, text_col)
    kept = maximal(turns)
    shown = render(turns.join(kept.select("conv"), "conv", "left_semi"))
    return kept.join(shown, "conv")


ORACLE_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n_turns
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
c AS (SELECT conv_id, count(*) AS n_turns,
             list({'role': role, 'text': text} ORDER BY pos) AS turns,
             string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>',
                        chr(10) ORDER BY pos) AS text
      FROM p GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, n_turns, turns, text, count(*) AS n_copies FROM c GROUP BY n_turns, turns, text),
prefixes AS (SELECT DISTINCT k AS n_turns, list_slice(turns, 1, k) AS turns
             FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM u))
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, CAST(n_copies AS BIGINT) AS n_copies, text
FROM u WHERE NOT EXISTS (SELECT 1 FROM prefixes q WHERE q.n_turns = u.n_turns AND q.turns = u.turns)
"""
