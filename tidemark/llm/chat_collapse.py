"""Chat logs: keep only maximal conversations, found by rolling turn-prefix hashes, then render them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import pick, table

#: Fixed marks of the rendered format: turn start, turn end.
START, END = "<|im_start|>", "<|im_end|>"
LANES = [f"h{i}" for i in range(4)]


def _part(value: Column) -> Column:
    """A field with its length, so that neighbouring fields cannot run into each other; null differs from empty."""
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.char_length(value).cast("string"), F.lit(":"), value))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, n_turns, h0..h3), one row per turn: the hash of the conversation up to that turn.

    Each turn's digest covers its place, role and text; a prefix's hash is the running sum of the digests' four 32-bit
    pieces, so one ordered pass per conversation rolls it forward, and no pass holds a conversation's texts.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    digest = F.md5(F.concat(F.col("place").cast("string"), F.lit("/"), _part(F.col("role")), F.lit("/"), _part(F.col("text"))))
    # texts are ordered by only where a turn number repeats; their digest stands for them in the shuffle
    tied = turns.select("conv_id", "turn", "role", F.md5(_part(F.col("text"))).alias("text"))
    placed = tied.withColumn("place", F.row_number().over(order)).withColumn("digest", digest)
    for i, lane in enumerate(LANES):
        piece = F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long")
        placed = placed.withColumn(lane, F.sum(piece).over(order.rowsBetween(W.unboundedPreceding, 0)))
    every = W.partitionBy("conv_id")
    return placed.withColumn("n_turns", F.count("*").over(every)).select("conv_id", "place", "n_turns", *LANES)


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no proper prefix of another, one (smallest id) per equal group.

    Whole-conversation hashes and proper-prefix hashes are each reduced to distinct rows before they meet, so a first
    turn or a conversation that very many logs share is one row on either side of the anti-join.
    """
    rolled = prefixes(turns)
    whole = rolled.where("place = n_turns").groupBy("n_turns", *LANES).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = rolled.where("place < n_turns").select(F.col("place").cast("long").alias("n_turns"), *LANES).distinct()
    return whole.join(proper, ["n_turns", *LANES], "left_anti").select("conv_id", "n_turns", "n_copies")


def collapse(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered), one row per maximal conversation.

    ``conversations`` needs conv_id, turn, role, text. Turns are ordered by turn, then role, then the text's digest
    (nulls first); repeated rows are turns of their own. A null id is a conversation like others; null role or text
    differ from empty ones in the hash and render as empty. An empty table gives an empty result.
    """
    turns = pick(conversations, "conv_id", "turn", "role", "text")
    kept = maximal(turns).alias("m")
    met = turns.alias("t").join(kept, F.col("t.conv_id").eqNullSafe(F.col("m.conv_id"))).select("t.*", "m.n_turns", "m.n_copies")
    line = F.struct("turn", "role", F.md5(_part(F.col("text"))).alias("tie"), "text")
    listed = met.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    empty = F.lit("")
    rendered = F.transform(
        "lines", lambda x: F.concat(F.lit(START), F.coalesce(x["role"], empty), F.lit("\n"), F.coalesce(x["text"], empty), F.lit(END + "\n"))
    )
    return listed.select("conv_id", "n_turns", "n_copies", F.array_join(rendered, "").alias("rendered"))


def op10_chat_collapse(spark, sf_dir: str) -> DataFrame:
    return collapse(table(spark, sf_dir, "conversations"))


#: Compares whole prefixes, spelled out, instead of hashes.
SQL = f"""
WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(coalesce(length(text) || ':' || text, '-'))) AS place,
         count(*) OVER (PARTITION BY conv_id) AS n_turns FROM conversations),
spelled AS (
  SELECT conv_id, place, n_turns,
         string_agg(coalesce(length(role) || ':' || role, '-') || '/' || coalesce(length(text) || ':' || text, '-'), '|')
           OVER (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix FROM placed),
whole AS (SELECT n_turns, prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM spelled WHERE place = n_turns GROUP BY ALL),
kept AS (SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM spelled s WHERE s.place < s.n_turns AND s.place = w.n_turns AND s.prefix = w.prefix))
SELECT k.conv_id, k.n_turns, k.n_copies,
       string_agg('{START}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{END}' || chr(10), '' ORDER BY place) AS rendered
FROM kept k JOIN placed p ON p.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY ALL
"""
