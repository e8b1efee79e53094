"""Exact removal of repeated byte strings: q-gram buckets of suffixes, refined by the identifiers of later offsets."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, saved, table
from tidemark.session import work_path

#: Bytes of a string that is removed where it started before.
LENGTH = 100
#: Neighbouring window starts that the second level keeps together.
BLOCK = 8
#: Window starts that are worked on at a time, so that very long texts need bounded memory.
PIECE = 1 << 20
#: One text in so many is looked at for hot buckets; so many buckets at most are spread, from so many rows there.
SAMPLE, HOT_BUCKETS, HOT_ROWS = 16, 4096, 64
_LOW = np.uint64((1 << 24) - 1)
_FIRST = np.random.default_rng(42).integers(1 << 63, size=256, dtype=np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SHIFTS = np.uint64(29), np.uint64(32)


def _join(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The identifier of a string from those of a front and a back that cover it."""
    x = one * _A
    x ^= x >> _SHIFTS[0]
    x += two
    x *= _B
    x ^= x >> _SHIFTS[1]
    return x


def identifiers(raw: bytes | memoryview, size: int) -> np.ndarray:
    """Bucket identifiers of all substrings of ``size`` (a power of two) bytes: those of half the size, refined by the
    identifier half a size later."""
    at = _FIRST[np.frombuffer(raw, dtype=np.uint8)]
    have = 1
    while have < size:
        at = _join(at[:-have], at[have:])
        have *= 2
    return at


def gram(length: int) -> int:
    """Bytes of the first buckets' q-grams: the largest power of two within a third of the length."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def families(raw: bytes, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, lo, n, back): the windows of ``length`` bytes that start at lo, ..., lo + n - 1 share their least q-gram,
    ``back`` bytes behind lo; key is its identifier. Which q-gram is a window's least depends on the window alone."""
    q = gram(length)
    width = length - q + 1
    for begin in range(0, len(raw) - length + 1, PIECE):
        own = identifiers(memoryview(raw)[begin : begin + PIECE + length - 1], q)
        n = len(own)
        ordered = (own & ~_LOW) | np.arange(n, dtype=np.uint64)
        rows = np.concatenate([ordered, np.full(-n % width, ~np.uint64(0))]).reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & _LOW).astype(np.int64)
        cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
        lo, hi = np.append(0, cuts), np.append(cuts, len(least))
        yield own[least[lo]], lo + begin, hi - lo, least[lo] - lo


def _longer(raw: bytes, starts: np.ndarray, size: int) -> np.ndarray:
    """Identifiers of the strings of ``size`` bytes at ``starts``, in pieces."""
    half = 1 << (size.bit_length() - 1)
    out = np.zeros(len(starts), dtype=np.uint64)
    for begin in range(0, len(raw), PIECE):
        here = np.flatnonzero((starts >= begin) & (starts < begin + PIECE))
        if len(here):
            own = identifiers(memoryview(raw)[begin : begin + PIECE + size], half)
            at = starts[here] - begin
            out[here] = _join(own[at], own[at + size - half])
    return out


def blocks(raw: bytes, length: int, lo: np.ndarray, n: np.ndarray, back: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Families cut into blocks of BLOCK starts, by distance from their q-gram; key is what a block's windows share."""
    near, far = (back - n + 1) // BLOCK, back // BLOCK
    count = far - near + 1
    owner = np.repeat(np.arange(len(lo)), count)
    which = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + near[owner]
    anchor = (lo + back)[owner]
    first = np.maximum(lo[owner], anchor - BLOCK * which - BLOCK + 1)
    last = np.minimum((lo + n - 1)[owner], anchor - BLOCK * which)
    yield _longer(raw, anchor - BLOCK * which, length - BLOCK + 1), first, last - first + 1, anchor - first


def windows(raw: bytes, length: int, lo: np.ndarray, n: np.ndarray, back: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks cut into single windows; key is the window's identifier."""
    starts = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    yield _longer(raw, starts, length), starts, np.ones(len(starts), dtype=np.int64), np.zeros(len(starts), dtype=np.int64)


ROWS = "key long, salt int, span long, ord long, lo long, n long, back long"
RUNS = "ord long, lo long, n long, back long"


def _frame(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    parts = [p.split() for p in names.split(", ")]
    arrays = [pa.array(c.astype(np.int32) if kind == "int" else c.view(np.int64)) for c, (_, kind) in zip(columns, parts)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in parts])


def _merged(ord_: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring starts in the same text as one; there is at least one."""
    order = np.lexsort((lo, ord_))
    ord_, lo, n = ord_[order], lo[order], n[order]
    new = np.append(True, (ord_[1:] != ord_[:-1]) | (lo[1:] != lo[:-1] + n[:-1]))
    at = np.flatnonzero(new)
    return ord_[at], lo[at], np.add.reduceat(n, at)


def _rows(texts: DataFrame, length: int, cut: Callable, hot: list[int], salts: int) -> DataFrame:
    """One row for each bucket member that a task cannot settle by itself: key (the bucket), span (a hash of all bytes
    its windows cover), ord (its text), lo, n, back. Of members with equal spans the first stays; the others are
    repeats, and go on as runs with ``back`` -1. ``texts`` is (ord, text) and, after the first level, runs."""
    heated = texts.sparkSession.sparkContext.broadcast(np.sort(np.array(hot, dtype=np.int64)).view(np.uint64))
    later = "runs" in texts.columns

    def settle(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, span, ord_, lo, n, back = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((lo, ord_, span, key))
        repeat = np.zeros(len(order), dtype=bool)
        repeat[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (span[order[1:]] == span[order[:-1]])
        salt = np.where(np.isin(key, heated.value), 1 + span % np.uint64(salts), 0)
        kept = [c[~repeat] for c in (key, salt, span, ord_, lo, n, back)]
        yield _frame(ROWS, *kept)
        if repeat.any():
            ord_, lo, n = _merged(ord_[repeat], lo[repeat], n[repeat])
            zero = np.zeros(len(ord_), dtype=np.int64)
            yield _frame(ROWS, ord_, zero, zero, ord_, lo, n, zero - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            ords, texts_ = batch.column("ord").to_pylist(), batch.column("text").cast(pa.binary())
            for i, at in enumerate(ords):
                raw = texts_[i].as_py()
                given = []
                if later:
                    runs = batch.column("runs")[i].values
                    given = [runs.field(c).to_numpy() for c in ("lo", "n", "back")]
                for key, lo, n, back in cut(raw, length, *given):
                    ends = (lo + n + (length - 1)).tolist()
                    digest = xxhash.xxh3_64_intdigest
                    span = np.fromiter((digest(raw[a:b]) for a, b in zip(lo.tolist(), ends)), dtype=np.uint64, count=len(lo))
                    held.append((key, span, np.full(len(lo), at, dtype=np.int64), lo, n, back))
                    size += len(lo)
                    if size > 1_000_000:
                        yield from settle(held)
                        held, size = [], 0
        if held:
            yield from settle(held)

    return texts.mapInArrow(run, ROWS)


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads rows sorted by bucket and span; gives repeats (back -1), and the members that go on: the first of each
    span in buckets with several. The first of a bucket is held until a second span appears."""
    last: tuple[int, int] | None = None
    pending: np.ndarray | None = None
    for batch in batches:
        key, salt, span, ord_, lo, n, back = (c.to_numpy() for c in batch.columns)
        known = back < 0
        out = [np.stack([ord_[known], lo[known], n[known], back[known]])]
        if known.any():
            key, salt, span, ord_, lo, n, back = (c[~known] for c in (key, salt, span, ord_, lo, n, back))
        if len(key):
            bucket = np.append(last is None or last[0] != key[0], key[1:] != key[:-1])
            first = bucket | np.append(last is None or last[1] != span[0], span[1:] != span[:-1])
            rows = np.stack([ord_, lo, n, np.where(first, back, -1)])
            out.append(rows[:, ~first])
            at = np.flatnonzero(first)
            if len(at):
                opens = bucket[at]
                if pending is not None and not opens[0]:
                    out.append(pending)
                stays = ~opens | np.append(~opens[1:], False) | (salt[at] > 0)
                out.append(rows[:, at[stays]])
                pending = rows[:, at[-1:]] if opens[-1] and not stays[-1] else None
            last = (key[-1], span[-1])
        yield _frame(RUNS, *np.concatenate(out, axis=1))


class _Texts:
    """Distinct texts of at least ``length`` bytes, each with its place in the order of documents.

    The texts lie in a bucketed table below the shared folder, so that later passes bring their lists to the texts and
    move no text again.
    """

    def __init__(self, docs: DataFrame, length: int):
        self.spark, self.length = docs.sparkSession, length
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        text = F.coalesce("text", F.lit(""))
        full = pick(docs, "doc_id", "text").select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
        full = full.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
        self.prints = saved(full.drop("text"), "dedup-prints")
        long = full.where(F.col("n_bytes") >= length)
        self.name = f"dedup_texts_{uuid.uuid4().hex}"
        once = long.groupBy("digest").agg(F.first("text").alias("text"))
        once.write.bucketBy(self.parts, "digest").option("path", work_path(self.spark, "dedup-texts")).option("compression", "zstd").saveAsTable(self.name)
        firsts = self.prints.where(F.col("n_bytes") >= length).groupBy("digest").agg(F.min(F.struct("doc_id")).alias("first"))
        order = [F.asc_nulls_first("doc_id"), F.asc("digest")]
        ranged = firsts.select("digest", "first.doc_id").repartitionByRange(*order).sortWithinPartitions(*order)
        self.order = saved(ranged.withColumn("ord", F.monotonically_increasing_id()), "dedup-order")

    def all(self) -> DataFrame:
        """(ord, text)."""
        return self.spark.table(self.name).join(self.order.select("digest", "ord"), "digest").select("ord", "text")

    def with_runs(self, runs: DataFrame, how: str = "inner") -> DataFrame:
        """(digest, doc_id, ord, text, runs) of the texts with any of the runs, or of all."""
        lists = runs.groupBy("ord").agg(F.collect_list(F.struct("lo", "n", "back")).alias("runs"))
        listed = self.order.join(lists, "ord", how)
        return self.spark.table(self.name).join(listed, "digest")

    def close(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")


def _level(texts: DataFrame, length: int, cut: Callable, parts: int) -> DataFrame:
    """One refinement: rows to their buckets, repeats and unsettled members back, written to the shared folder.

    Buckets that hold much of a sample of the texts are spread by span; their members all go on, which settles them
    on the next level. The sample only decides where rows meet.
    """
    some = texts.where(F.pmod(F.xxhash64("ord"), F.lit(SAMPLE)) == 0)
    counts = _rows(some, length, cut, [], 1).where("back >= 0").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_ROWS)
    hot = [r.key for r in counts.orderBy(F.desc("n"), "key").limit(HOT_BUCKETS).collect()]
    rows = _rows(texts, length, cut, hot, parts)
    grouped = rows.repartition("key", "salt").sortWithinPartitions("key", "span", "ord", "lo")
    return saved(grouped.mapInArrow(_refine, RUNS), "dedup-level")


def _kept(length: int):
    """Reads (digest, doc_id, text, runs of repeats); gives the removed spans and the bytes that are left."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def spans_of(runs: pa.Array | None) -> list[tuple[int, int]]:
        if runs is None:
            return []
        lo, n = (runs.field(c).to_numpy() for c in ("lo", "n"))
        order = np.argsort(lo, kind="stable")
        start, stop = lo[order], (lo + n)[order] + (length - 1)
        reach = np.maximum.accumulate(stop)
        at = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
        return list(zip(start[at].tolist(), np.maximum.reduceat(stop, at).tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                texts, lists = batch.column("text").cast(pa.binary()), batch.column("runs")
                spans, kept = [], []
                for i in range(batch.num_rows):
                    raw = texts[i].as_py()
                    found = spans_of(lists[i].values)
                    edges = [0, *(x for s in found for x in s), len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) if found else raw)
                    spans.append([{"start": a, "stop": b} for a, b in found])
                hashes = [hashlib.sha256(k).hexdigest() for k in kept]
                columns = [batch.column("digest"), batch.column("doc_id"), pa.array(spans, span_type), pa.array(kept, pa.binary()), pa.array(hashes)]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "doc_id", "spans", "kept", "kept_sha256"])

    return run


KEPT = "digest string, doc_id long, spans array<struct<start:long,stop:long>>, kept binary, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = LENGTH, texts: bool = True) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, kept_sha256), one row per document: its UTF-8 bytes without those covered by a
    string of ``length`` bytes that also starts earlier; without ``texts``, kept (the bytes left) is omitted.

    Earlier is a smaller doc_id (null first) or, in the same document, an earlier start; among documents with the same
    id, equal texts follow each other and different ones go by the text's digest. ``docs`` needs doc_id and text;
    further columns are allowed, a null text is empty, shorter texts lose nothing, an empty table gives none.

    Of equal texts only the first is searched: the others are removed whole. Suffixes are bucketed by the least q-gram
    of the window they start (equal windows choose the same), which samples one start in some 35; a bucket's members
    that no other string shares leave at once. The others are refined by identifiers of later offsets: blocks of
    neighbouring windows by the bytes they share, then single windows by their whole ``length`` bytes. On every level
    members whose windows are all equal are settled against the first of them, in the task, then across tasks.
    """
    found = _Texts(docs, length)
    one = _level(found.all(), length, families, found.parts)
    two = _level(found.with_runs(one.where("back >= 0")).select("ord", "text", "runs"), length, blocks, found.parts)
    three = _level(found.with_runs(two.where("back >= 0")).select("ord", "text", "runs"), length, windows, found.parts)
    repeats = one.union(two).union(three).where("back < 0")
    done = found.with_runs(repeats, "left").select("digest", "doc_id", "text", "runs").mapInArrow(_kept(length), KEPT)
    done = saved(done if texts else done.drop("kept"), "dedup-kept")
    found.close()

    rows = found.prints.groupBy("doc_id", "digest", "n_bytes").agg(F.count("*").cast("int").alias("times"))
    firsts = done.select(F.col("digest").alias("_digest"), F.col("doc_id").alias("_id"), *done.columns[2:])
    met = rows.join(firsts, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    each = met.withColumn("time", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))

    def pick_by_kind(first: Column, copy: Column, short: Column) -> Column:
        return F.when(F.col("n_bytes") < length, short).when(F.col("_digest").isNotNull() & (F.col("time") == 0), first).otherwise(copy)

    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = [F.col("doc_id"), F.col("n_bytes"), pick_by_kind(F.col("spans"), whole, none).alias("spans")]
    if not texts:
        return each.select(*out, pick_by_kind(F.col("kept_sha256"), nothing, F.col("digest")).alias("kept_sha256"))
    short = pick(docs, "text").where(F.octet_length("text") < length).select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text")
    each = each.join(short.groupBy("digest").agg(F.first("text").cast("binary").alias("short")), "digest", "left")
    kept = pick_by_kind(F.col("kept"), F.lit(b""), F.coalesce("short", F.lit(b"")))
    return each.select(*out, kept.alias("kept"), pick_by_kind(F.col("kept_sha256"), nothing, F.col("digest")).alias("kept_sha256"))


def op13_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"), texts=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


#: A window of bytes for every start has no DuckDB form that whole tables allow; tests compare with brute force.
SQL = None
