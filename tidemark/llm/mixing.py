"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, by_place, checkpointed, pick, table

#: Offsets lie on a grid, so that whole rates add up without rounding.
GRID = 4096
#: Seeded offsets tried per source; the one whose words come nearest the target is used.
DRAWS = 16
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): weights repeat over the sources in code-point order, null last, and
    share all of ``source_size``; no target exceeds ``most`` times its source, the excess is reshared by weight.

    Resharing until none is above ends where target = min(level x weight, most x size). Sorted by size over weight,
    the sources at their limit are a prefix; running sums give the level behind each prefix, and the first one that
    its source can take is the level. These windows order one row per source, nothing else.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    turn = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    limits = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)).withColumn(
        "limit", F.col("source_size") * F.lit(float(most))
    )
    full_first = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = full_first.rowsBetween(W.unboundedPreceding, -1)
    whole = full_first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = limits.withColumn("level", left / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("limit", "weight", "level"))
    levels = levels.withColumn("level", F.first(fits, ignorenulls=True).over(whole)["level"])
    return levels.select("source", "source_size", F.least(F.col("level") * F.col("weight"), F.col("limit")).alias("target"))


def _offset(draw: Column) -> Column:
    """A multiple of 1 / GRID below 1, from the seed, the source and the draw."""
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    digits = F.substring(F.md5(F.concat_ws("/", F.lit(SEED), draw.cast("string"), name)), 1, 3)
    return F.conv(digits, 16, 10).cast("double") / GRID


def _copies(offset: Column) -> Column:
    """Integer boundaries that the running sum of expected copies crosses at this document."""
    upto = F.floor(F.col("rate") * F.col("place") + offset)
    behind = F.floor(F.col("rate") * (F.col("place") - 1) + offset)
    return upto - behind


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3, draws: int = DRAWS) -> DataFrame:
    """How often each document enters the mix.

    ``docs`` needs doc_id, text and source. Returns (doc_id, source, size, n_rows, source_size, target, copies), one
    row per distinct (doc_id, source, size) with the number of rows that share it: repeated rows are drawn together
    and get the same copies. Expected copies of a document are target / source_size. Documents stand by size within
    their source, so a systematic sample of places is also even over sizes. Null texts have size 0, null ids and null
    sources are values like others; a source without words has target 0. An empty table gives an empty result.

    Places come from a range partitioning over (source, size, doc_id): running numbers inside each part plus the
    rows of the source's earlier parts. No source is ordered in one task.
    """
    given = pick(docs, "doc_id", "text", "source").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    units = checkpointed(given.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n_rows")))
    sources = targets(
        units.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size")), weights, most
    ).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(
        units.repartitionByRange(parts, F.col("source").isNull(), "source", "size", "doc_id").withColumn("part", F.spark_partition_id())
    )
    runs = ranged.groupBy("source", "part").agg(F.count("*").alias("run"))
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = runs.select("source", "part", F.coalesce(F.sum("run").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy("source", "part").orderBy("size", "doc_id"))
    numbered = ranged.withColumn("inside", inside).alias("n")
    placed = (
        numbered.join(starts.alias("s"), (F.col("n.part") == F.col("s.part")) & F.col("n.source").eqNullSafe(F.col("s.source")))
        .select("n.doc_id", "n.source", "n.size", "n.n_rows", (F.col("s.start") + F.col("n.inside")).alias("place"))
        .alias("p")
        .join(sources.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
        .select("p.*", "s.source_size", "s.target", "s.rate")
    )
    tried = placed.groupBy("source", "target").agg(
        *[F.sum(F.col("size") * F.col("n_rows") * _copies(_offset(F.lit(k)))).alias(f"took_{k}") for k in range(draws)]
    )
    misses = F.array(*[F.struct(F.abs(F.col(f"took_{k}") - F.col("target")).alias("miss"), F.lit(k).alias("draw")) for k in range(draws)])
    chosen = tried.select("source", F.array_min(misses)["draw"].alias("draw"))
    return (
        placed.alias("q")
        .join(chosen.alias("c"), F.col("q.source").eqNullSafe(F.col("c.source")))
        .select("q.*", "c.draw")
        .withColumn("copies", F.least(_copies(_offset(F.col("draw"))), F.lit(int(most))).cast("long"))
        .select("doc_id", "source", "size", "n_rows", "source_size", "target", "copies")
    )


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """``docs`` itself, each row as often as the mix takes it."""
    taken = mix(docs, **how).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies")
    plain, at, columns = by_place(docs)
    sized = plain.withColumn("_words", word_count(F.col(at["text"])))
    same = F.col(at["doc_id"]).eqNullSafe(F.col("_id")) & F.col(at["source"]).eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size"))
    met = sized.join(taken.where("copies > 0"), same)
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*columns)


def op1_systematic_mix(spark, sf_dir: str) -> DataFrame:
    units = mix(table(spark, sf_dir, "documents"))
    rows = units.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
units AS (SELECT doc_id, source, size, count(*) AS n_rows FROM docs GROUP BY ALL),
sizes AS (SELECT source, CAST(sum(size * n_rows) AS DOUBLE) AS source_size FROM units GROUP BY source),
named AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS most FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM named WINDOW b AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(level, (most / weight, source IS NULL, coalesce(source, ''))) AS level FROM levels WHERE level * weight <= most),
goals AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, least(level.level * weight, most) AS target FROM named, level),
placed AS (
  SELECT u.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY u.source ORDER BY u.size, u.doc_id NULLS FIRST) AS place
  FROM units u JOIN goals g ON u.source IS NOT DISTINCT FROM g.source),
draws AS (
  SELECT g.source, k, ('0x' || substr(md5('mix/' || k || '/' || coalesce('s' || source, 'n')), 1, 3))::INT / 4096.0::DOUBLE AS u
  FROM goals g, range(16) AS r(k)),
tried AS (
  SELECT d.source, d.k, d.u, abs(sum(p.size * p.n_rows * (floor(p.rate * p.place + d.u) - floor(p.rate * (p.place - 1) + d.u))) - any_value(p.target)) AS miss
  FROM placed p JOIN draws d ON p.source IS NOT DISTINCT FROM d.source GROUP BY ALL),
chosen AS (SELECT source, arg_min(u, (miss, k)) AS u FROM tried GROUP BY source)
SELECT p.doc_id, p.size, p.source_size, p.target, p.source,
       CAST(least(floor(rate * place + u) - floor(rate * (place - 1) + u), 3) AS BIGINT) AS copies,
       CAST(least(floor(rate * place + u) - floor(rate * (place - 1) + u), 3) AS BIGINT) * p.size AS taken
FROM placed p JOIN chosen c ON p.source IS NOT DISTINCT FROM c.source, range(p.n_rows)
"""
