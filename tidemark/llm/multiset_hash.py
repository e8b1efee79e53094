"""Document fingerprints by a homomorphic multiset hash over paragraphs, and their likeness."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import pick, table

#: A packed word holds three 20-bit lanes; its 20 shifts of a 60-bit hash give 60 one-bit lanes, two hashes 120.
FIELD = 20
ONES = 1 | 1 << FIELD | 1 << 2 * FIELD
MASK = (1 << FIELD) - 1
#: Lanes are first added up in 4-bit fields, which hold as many pieces as fit a field, and then widened.
NARROW, CHUNK = 4, 15
NARROW_ONES = sum(1 << NARROW * i for i in range(60 // NARROW))
WORDS = 2 * FIELD
#: Places in the fingerprint array: paragraphs, four 32-bit sums, pieces, then the packed words.
SUMS, PIECES, PACKED = 4, 5, 6


def fingerprint(text: Column) -> Column:
    """array<long>: what the paragraphs (lines) of a text add up to. Null is the empty text, one empty paragraph.

    Every paragraph contributes a wide vector: 1; its md5 as four numbers modulo 2 ** 32, which decide equality; the
    number of its sentence pieces; and for each piece 120 bits of its md5, which carry likeness. Vectors are added
    component by component, so order does not matter, and adding or subtracting a paragraph's own vector inserts or
    deletes it (``combine``). The packed lanes hold 2 ** 20 pieces; beyond, likeness blurs, equality does not.
    """
    whole = F.coalesce(text, F.lit(""))
    paragraphs = F.transform(F.split(whole, "\n"), lambda p: F.md5(p))
    pieces = F.transform(F.filter(F.split(whole, "[.!?\n]"), lambda p: p != ""), lambda p: F.md5(p))

    def number(start: int, digits: int):
        return lambda d: F.conv(F.substring(d, start, digits), 16, 10).cast("long")

    zero = F.lit(0).cast("long")

    def sums(hashes: Column) -> Column:
        each = [F.aggregate(F.transform(hashes, number(8 * i + 1, 8)), zero, lambda a, x: a + x) % (1 << 32) for i in range(SUMS)]
        return F.array(F.size(hashes).cast("long"), *each)

    def lanes(hashes: Column) -> Column:
        halves = [_once(F.transform(hashes, number(start, 15)), _packed) for start in (1, 16)]
        return F.concat(F.array(F.size(hashes).cast("long")), *halves)

    return F.concat(_once(paragraphs, sums), _once(pieces, lanes))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used: aggregates do not share their inputs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _packed(half: Column) -> Column:
    """The FIELD packed words of 60-bit numbers: word i holds how often the bits i, i + 20 and i + 40 are set."""
    zero = F.lit(0).cast("long")
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size(half) / CHUNK).cast("int")), lambda i: F.slice(half, i * CHUNK + 1, CHUNK))

    def narrow(shift: int):
        return lambda chunk: F.aggregate(chunk, zero, lambda a, h: a + F.shiftright(h, shift).bitwiseAND(F.lit(NARROW_ONES)))

    def widened(shift: int):
        wide = F.lit(ONES * ((1 << NARROW) - 1))
        return lambda a, n: a + F.shiftright(n, shift).bitwiseAND(wide)

    def words(sums: Column) -> Column:
        each = [F.aggregate(F.get(sums, F.lit(i % NARROW)), zero, widened(i - i % NARROW)) for i in range(FIELD)]
        return F.array(*each)

    return _once(chunks, lambda c: _once(F.array(*[F.transform(c, narrow(s)) for s in range(NARROW)]), words))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets of paragraphs together (sign 1), or of ``a`` without those of ``b`` (-1)."""
    added = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"] + sign * x["b"])
    return F.transform(added, lambda x, i: F.when((i >= 1) & (i <= SUMS), F.pmod(x, F.lit(1 << 32))).otherwise(x))


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.hex(x))), "-")


def _signed(fp: Column) -> Column:
    """Lanes as sums of +1 and -1 over the pieces; independent texts have nearly orthogonal lanes."""
    n = F.get(fp, F.lit(PIECES))
    words = F.slice(fp, PACKED + 1, WORDS)
    fields = F.flatten(
        F.transform(words, lambda w: F.array(w.bitwiseAND(F.lit(MASK)), F.shiftright(w, FIELD).bitwiseAND(F.lit(MASK)), F.shiftright(w, 2 * FIELD)))
    )
    return F.transform(fields, lambda x: 2 * x - n)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def likeness(a: Column, b: Column, lanes_a: Column, lanes_b: Column) -> Column:
    """1 for equal fingerprints, else the shared part of the two multisets of pieces, 2 a.b / (a.a + b.b), from 0 to 1."""
    both = _dot(lanes_a, lanes_a) + _dot(lanes_b, lanes_b)
    shared = F.when(both > 0, 2.0 * _dot(lanes_a, lanes_b) / both).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(shared, F.lit(0.0)))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many descending bounds are at or above the key, less one; found in two steps of about sqrt(bounds)."""
    step = isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    coarse = F.array(*[F.lit(g[0]) for g in groups])
    fine = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
    group = F.size(F.filter(coarse, lambda b: b >= key)) - 1
    return group * step + F.size(F.filter(F.get(fine, group), lambda b: b >= key)) - 1


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next``, a struct of the columns of the row behind in descending doc_id; the first row follows the last.

    Bounds that are ids of the table (approximate percentiles) cut it into buckets, each ordered by itself; the rows
    at a bucket's upper bound also go to the bucket before as its last neighbour, and the first rows to the last
    bucket. Equal ids stand by text, null ids last.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("_key", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long")))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = keyed.agg(
        F.max("_key").alias("top"), F.percentile_approx("_key", [i / n for i in range(1, n)], F.lit(10 * n)).alias("cuts")
    ).first()
    bounds = sorted({found.top, *(found.cuts or [])} - {None}, reverse=True) or [0]
    at = F.array(*[F.lit(b) for b in bounds])
    own = _bucket(F.col("_key"), bounds)
    ahead = (own + len(bounds) - 1) % len(bounds)
    is_bound = F.get(at, own) == F.col("_key")
    here = F.struct(own.alias("bucket"), F.lit(0).alias("extra"))
    there = F.struct(ahead.alias("bucket"), F.lit(1).alias("extra"))
    dealt = keyed.withColumn("_to", F.explode(F.when(is_bound, F.array(here, there)).otherwise(F.array(here))))
    order = W.partitionBy("_to.bucket").orderBy("_to.extra", F.desc("_key"), F.col("doc_id").isNull(), "text")
    followed = dealt.withColumn("next", F.lead(F.struct(*columns)).over(order))
    return followed.where("_to.extra = 0").drop("_to", "_key")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how alike they are.

    ``docs`` needs doc_id and text; null texts are empty, repeats and further columns are allowed. The edited text
    has the last floor(n / 2) code points replaced by the first as many of the next document (all, if it has fewer).
    Texts are shuffled once, into buckets of neighbouring ids. An empty table gives an empty result.
    """
    base = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("fp", fingerprint(F.col("text")))
    paired = with_next(base, ["text", "fp"]).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr(F.col("next.text"), F.lit(1), half))
    paired = paired.select("doc_id", "n_chars", "fp", F.col("next.fp").alias("next_fp"), edited.alias("edited"))
    paired = paired.withColumn("edited_fp", fingerprint(F.col("edited")))
    paired = paired.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    for name in ("fp", "edited_fp", "next_fp"):
        paired = paired.withColumn(f"{name}_lanes", _signed(F.col(name)))
    near = lambda other: likeness(F.col("fp"), F.col(other), F.col("fp_lanes"), F.col(f"{other}_lanes"))
    return paired.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        near("edited_fp").alias("near_edited"), near("next_fp").alias("near_next"),
    )


def op3_multiset_hash(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    def fp(text):
        sums = ", ".join(
            f"coalesce(list_sum(list_transform(string_split({text}, chr(10)), lambda p: ('0x' || md5(p)[{8 * i + 1}:{8 * i + 8}])::BIGINT)), 0)::BIGINT % 4294967296"
            for i in range(SUMS)
        )
        pieces = f"list_filter(string_split_regex({text}, '[.!?\\n]'), lambda p: p <> '')"
        halves = [f"list_transform({pieces}, lambda p: ('0x' || md5(p)[{s}:{s + 14}])::BIGINT)" for s in (1, 16)]
        packed = " || ".join(
            f"list_transform(range({FIELD}), lambda i: coalesce(list_sum(list_transform({h}, lambda x: (x >> i) & {ONES})), 0)::BIGINT)" for h in halves
        )
        return f"[len(string_split({text}, chr(10))), {sums}, len({pieces})] || {packed}"

    def lanes(fp):
        return (
            f"list_transform(flatten(list_transform({fp}[{PACKED + 1}:], lambda w: [w & {MASK}, (w >> {FIELD}) & {MASK}, w >> {2 * FIELD}])),"
            f" lambda x: 2 * x - {fp}[{PIECES + 1}])"
        )

    def dot(a, b):
        return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]))"

    def near(a, b):
        both = f"({dot(a + '_l', a + '_l')} + {dot(b + '_l', b + '_l')})"
        return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {both} = 0 THEN 0.0::DOUBLE ELSE greatest(2.0::DOUBLE * {dot(a + '_l', b + '_l')} / {both}, 0.0::DOUBLE) END"

    def hexes(fp):
        return f"array_to_string(list_transform({fp}, lambda x: lower(to_hex(x))), '-')"

    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
followed AS (
  SELECT *, length(text) AS n, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text
  FROM texts WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, text)),
edits AS (SELECT doc_id, text, next_text, n, text[: n - n // 2] || next_text[: n // 2] AS edited FROM followed),
prints AS (SELECT *, {fp('text')} AS fp, {fp('edited')} AS efp, {fp('next_text')} AS nfp FROM edits),
signed AS (SELECT *, {lanes('fp')} AS fp_l, {lanes('efp')} AS efp_l, {lanes('nfp')} AS nfp_l FROM prints)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, {hexes('fp')} AS fingerprint, {hexes('efp')} AS edited_fingerprint,
       {near('fp', 'efp')} AS near_edited, {near('fp', 'nfp')} AS near_next
FROM signed
"""


SQL = _oracle()
