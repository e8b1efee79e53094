"""Near-duplicates by SimHash, with deletion-variant signatures as the candidate index."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import by_place, pick, saved, table
from tidemark.llm.components import components

SEED, SHINGLE, BITS = 42, 3, 64
#: Fingerprints link at up to this many differing bits: two segments, one of which differs by at most one.
MOST_BITS, SEGMENT = 3, 32
#: Members of one signature that a task compares at a time; larger signatures are cut into pairs of blocks.
BLOCK = 2048


def text_fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half the XXH64 values of a UTF-8 text's word shingles; on bytes, lower and split are ASCII only."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] | list[bytes] = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    count = max(1, len(words) - shingle + 1)
    seen = np.zeros(BITS, dtype=np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=">u8", count=count)
    for start in range(0, count, 65_536):
        seen += np.unpackbits(hashes[start : start + 65_536].view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * seen > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_fingerprint(t.as_py(), shingle) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())], names=["doc_id", "fp"]
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def signatures(nodes: DataFrame) -> DataFrame:
    """(sig, fp): for each segment of a fingerprint, one signature per bit, in which that bit is a wildcard."""
    sides = []
    for side in range(BITS // SEGMENT):
        part = F.shiftrightunsigned("fp", SEGMENT).cast("long") if side else F.col("fp").bitwiseAND(F.lit((1 << SEGMENT) - 1))
        wild = F.expr(f"explode(transform(sequence(0, {SEGMENT - 1}), i -> struct(i, shiftleft(1L, i) as bit)))")
        cut = nodes.select("fp", part.alias("part"), wild.alias("wild"))
        tag = (F.col("wild.i") + F.lit(side * SEGMENT)).cast("long")
        sides.append(cut.select((F.shiftleft(tag, SEGMENT) + (F.col("part") - F.col("part").bitwiseAND(F.col("wild.bit")))).alias("sig"), "fp"))
    return sides[0].union(sides[1])


def _forest(fps: np.ndarray, other: np.ndarray | None, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is within ``most`` bits in one block or between two: each member to the smallest
    member it is tied to, so a block yields fewer links than members however many pairs it holds."""
    members = fps if other is None else np.concatenate([fps, other])
    root = np.arange(len(members))
    values = members.view(np.uint64)
    for i in range(len(members) - 1):
        near = np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= most) + i + 1
        if len(near):
            roots = np.unique(root[np.append(near, i)])
            if len(roots) > 1:
                root[np.isin(root, roots[1:])] = roots[0]
    tied = np.flatnonzero(root != np.arange(len(members)))
    if len(tied):
        yield members[tied], members[root[tied]]


def _links(most: int):
    """Reads (sig, one, two, fp) sorted by signature and blocks; a signature's run may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] | None = None

        def work(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(fps))
            sizes = ends - starts
            out_a, out_b = [], []
            first = starts[sizes == 2]
            if len(first):
                x, y = fps[first], fps[first + 1]
                ok = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= most
                out_a.append(x[ok])
                out_b.append(y[ok])
            for s, e in zip(starts[sizes > 2], ends[sizes > 2]):
                for a, b in _forest(np.unique(fps[s:e]), None, most):
                    out_a.append(a)
                    out_b.append(b)
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "one", "two")], axis=1)
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            if not len(fps):
                continue
            if held is not None:
                keys, fps = np.concatenate([held[0], keys]), np.concatenate([held[1], fps])
            open_run = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            cut = open_run[-1] + 1 if len(open_run) else 0
            if cut:
                yield from work(keys[:cut], fps[:cut])
            held = keys[cut:], fps[cut:]
        if held is not None and len(held[1]):
            yield from work(*held)

    return run


def link(nodes: DataFrame, most: int = MOST_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) links whose components are those of all pairs of distinct ``fp`` within ``most`` <= 3 differing bits.

    With at most three differing bits, one of two segments differs in at most one, so the pair shares the signature
    that wildcards that bit. Signatures met once are dropped after a pre-aggregated count. The others are compared
    inside their group and verified on all 64 bits. A group above ``block`` members is cut into blocks, and every
    pair of blocks is a group of its own: each pair still meets, no task gets more than two blocks, and a group yields
    a spanning forest, not its pairs.

    Spark sizes the signatures like the nodes they are exploded from, far too low, and would send them through the
    driver: the hint keeps both sides of their join in shuffles.
    """
    if most > MOST_BITS:
        raise ValueError("two segments find at most three differing bits")
    keys = signatures(nodes)
    shared = keys.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
    met = keys.join(shared.hint("merge"), "sig")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = met.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("sig", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("two"), "fp")
    sorted_groups = dealt.repartition("sig", "one", "two").sortWithinPartitions("sig", "one", "two", "fp")
    return sorted_groups.mapInArrow(_links(most), "a long, b long")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """(doc_id, fp, component_id), one row per document; component_id is the smallest doc_id reachable over links.

    ``docs`` needs doc_id and text; further columns, repeated rows and nulls are allowed. Equal fingerprints are one
    node from the start, so exact copies cost nothing. A text without words (null, empty) has fingerprint 0 and links
    like any other. A null id counts only where its whole component has no other. An empty table gives none.
    """
    prints = saved(fingerprints(docs, shingle), "simhash")
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    return classes(prints, nodes, link(nodes, most))


def classes(prints: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of the prints, by the components of the links between nodes (fp, low)."""
    roots = components(links)
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = placed.join(lows, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """``docs`` with one row left of each group of near duplicates: that of the smallest doc_id, and of repeated rows one."""
    return keep_one(docs, near_groups(docs, shingle, most), lambda text: text_fingerprint(text, shingle))


def keep_one(docs: DataFrame, groups: DataFrame, fingerprint: Callable[[bytes | None], int]) -> DataFrame:
    """One row of ``docs`` for each component of ``groups`` (doc_id, fp, component_id).

    Rows meet the kept ids by doc_id. Only where an id comes more than once is the fingerprint worked out again, to
    tell its rows apart; among rows with the same id and fingerprint the first by the text's digest stays.
    """
    last = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "fp")
    winners = groups.groupBy("component_id").agg(F.min(last).alias("w")).select(F.col("w.doc_id").alias("_id"), F.col("w.fp").alias("_fp"))
    often = groups.groupBy("doc_id").agg((F.count("*") > 1).alias("_often")).withColumnRenamed("doc_id", "_again")
    known = winners.join(often, F.col("_id").eqNullSafe(F.col("_again"))).select("_id", "_fp", "_often")
    plain, at, columns = by_place(docs)
    met = plain.join(known, F.col(at["doc_id"]).eqNullSafe(F.col("_id")))

    @F.pandas_udf("long")
    def again(texts: pd.Series) -> pd.Series:
        found = [fingerprint(None if t is None else t.encode()) for t in texts]
        return pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    text = F.col(at["text"])
    order = W.partitionBy("_id", "_fp").orderBy(F.md5(F.coalesce(text, F.lit(""))), text.isNull())
    repeated = met.where("_often").withColumn("_own", again(text)).where("_own = _fp")
    first = repeated.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    return met.where("not _often").select(*columns).union(first.select(*columns))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: XXH64 and bit counts over shingles have no DuckDB counterpart; tests compare with brute force.
SQL = None
