"""Language-model scores by a probabilistic suffix tree over words."""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, saved, table
from tidemark.session import work_path

FOLDS, HELD_OUT = 10, 0
#: Weight of the shorter context's distribution in that of a context of one and of two words.
WEIGHT = (4.0, 2.0)
#: A context is kept if it was seen so often, and if its next-word distribution, left one out, beats its suffix's by so many nats.
SEEN, GAIN = 2, 2.0
#: Tokens of a chunk of documents, the unit of work; tokens behind one bucket of the exchange.
CHUNK, BUCKET = 800_000, 1_000_000
#: The end token: white space, so no word.
END = b" "
ODD = np.uint64(1)


def squeeze(values: np.ndarray) -> bytes:
    """Bytes of an array, most alike first: all first bytes, all second bytes, and so on."""
    columns = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(columns.tobytes())


def expand(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).reshape(-1)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, order kept; odd, while words' own keys are even."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) | ODD


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as chunks: ids, fold, lengths, sorted word keys, and each token's place among them."""
    lookup: dict[bytes, int] = {}
    docs: list[tuple] = []
    tokens: list[np.ndarray] = []
    held, made, part = 0, 0, TaskContext.get().partitionId()

    def out() -> pa.RecordBatch:
        keys = np.array([xxhash.xxh64_intdigest(w) for w in lookup], dtype=np.uint64) & ~ODD
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(keys), dtype=np.uint32)
        place[order] = np.arange(len(keys), dtype=np.uint32)
        ids, folds, sizes = zip(*docs)
        return pa.RecordBatch.from_pydict({
            "chunk": [f"{part}-{made}"], "doc_id": pa.array([list(ids)], pa.list_(pa.int64())), "held": pa.array([list(folds)], pa.list_(pa.bool_())),
            "size": pa.array([list(sizes)], pa.list_(pa.int64())), "words": [squeeze(np.diff(keys[order], prepend=np.uint64(0)))],
            "tokens": [squeeze(place[np.concatenate(tokens)])],
        })

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
            words = (text.as_py() or b"").lower().split()
            words.append(END)
            tokens.append(np.array([lookup.setdefault(w, len(lookup)) for w in words], dtype=np.uint32))
            fold = zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % FOLDS
            docs.append((doc_id, fold == HELD_OUT, len(words)))
            held += len(words)
            if held >= CHUNK:
                yield out()
                made, held = made + 1, 0
                lookup.clear()
                docs.clear()
                tokens.clear()
    if docs:
        yield out()


CHUNKS = "chunk string, doc_id array<long>, held array<boolean>, size array<long>, words binary, tokens binary"
SENT = "chunk string, bucket int, keys binary, vals binary"
BACK = "chunk string, bucket int, vals binary, total long, known long, once long, twice long"


class Chunk:
    """A chunk's tokens and the n-grams that end at them; contexts do not reach over a document's start."""

    def __init__(self, row):
        words = np.cumsum(expand(row.words, "<u8"), dtype=np.uint64)
        self.row = row
        self.word = words[expand(row.tokens, "<u4")]
        size = np.asarray(row["size"], dtype=np.int64)
        self.doc = np.repeat(np.arange(len(size)), size)
        self.train = ~np.asarray(row.held, dtype=bool)[self.doc]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        depth = np.arange(len(self.word)) - first[self.doc]
        self.has1, self.has2 = depth >= 1, depth >= 2
        before = np.roll(self.word, 1)
        self.pair = mix(before, self.word)  # (previous, this)
        self.triple = mix(np.roll(self.pair, 1), self.word ^ np.uint64(0x5851F42D4C957F2C))
        self.keys, at = np.unique(np.concatenate([self.word, self.pair[self.has1]]), return_inverse=True)
        self.at1, self.at2 = at[: len(self.word)], np.zeros(len(self.word), dtype=np.int64)
        self.at2[self.has1] = at[len(self.word) :]

    def counts(self) -> np.ndarray:
        """Training occurrences of ``keys`` in this chunk."""
        n = np.bincount(self.at1, self.train, len(self.keys))
        return n + np.bincount(self.at2[self.has1], self.train[self.has1], len(self.keys))

    def learn(self, totals: np.ndarray) -> None:
        """Counts over the whole corpus: of the word, its pair, the context of one word and of two."""
        self.totals = totals
        self.c1 = totals[self.at1]
        self.c2 = np.where(self.has1, totals[self.at2], 0)
        self.s1 = np.where(self.has1, np.roll(self.c1, 1), 0)
        self.s2 = np.where(self.has2, np.roll(self.c2, 1), 0)
        self.deep = self.has2 & (self.s2 >= SEEN)  # only these can have a kept context of two words
        self.keys3, self.at3 = np.unique(self.triple[self.deep], return_inverse=True)

    def counts3(self) -> np.ndarray:
        return np.bincount(self.at3, self.train[self.deep], len(self.keys3))

    def learn3(self, totals: np.ndarray) -> None:
        self.c3 = np.zeros(len(self.word))
        self.c3[self.deep] = totals[self.at3]

    def root(self, stats: dict) -> np.ndarray:
        """Discounted word frequencies; what the discount frees is the chance of the one unknown word."""
        n, v = stats["total"], stats["known"]
        if not n:
            return np.ones(len(self.word))
        d = min(max(stats["once"] / max(1, stats["once"] + 2 * stats["twice"]), 0.05), 0.95)
        return np.where(self.c1 > 0, (self.c1 - d) / n, d * v / n)

    def gains(self, stats: dict) -> tuple[np.ndarray, np.ndarray]:
        """(context keys, nats): what each context of one or two words gains over its suffix at training tokens, each
        token left out of its own counts: the sample form of count x divergence between the two distributions."""
        p1 = self.root(stats)
        one = self.train & self.has1 & (self.s1 >= SEEN)
        two = self.train & self.deep
        p2 = p1.copy()
        p2[one] = (self.c2[one] - 1 + WEIGHT[0] * p1[one]) / (self.s1[one] - 1 + WEIGHT[0])
        p3 = (self.c3[two] - 1 + WEIGHT[1] * p2[two]) / (self.s2[two] - 1 + WEIGHT[1])
        keys = np.concatenate([np.roll(self.word, 1)[one], np.roll(self.pair, 1)[two]])
        nats = np.concatenate([np.log(p2[one] / p1[one]), np.log(p3 / p2[two])])
        found, at = np.unique(keys, return_inverse=True)
        return found, np.bincount(at, nats, len(found))

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All contexts that a token here may use, and the tokens' places among them."""
        one, two = self.has1 & (self.s1 >= SEEN), self.deep
        keys, at = np.unique(np.concatenate([np.roll(self.word, 1)[one], np.roll(self.pair, 1)[two]]), return_inverse=True)
        return keys, at[: one.sum()], at[one.sum() :]

    def score(self, stats: dict, kept: np.ndarray) -> pd.DataFrame:
        """One row per document. Each token takes its longest kept context; a context's own suffix smooths it."""
        _, at1, at2 = self.contexts()
        one, two = self.has1 & (self.s1 >= SEEN), self.deep.copy()
        p = self.root(stats)
        use = np.flatnonzero(one)[kept[at1]]
        p[use] = (self.c2[use] + WEIGHT[0] * p[use]) / (self.s1[use] + WEIGHT[0])
        use = np.flatnonzero(two)[kept[at2]]
        p[use] = (self.c3[use] + WEIGHT[1] * p[use]) / (self.s2[use] + WEIGHT[1])
        base = np.log10((self.c1 + 0.1) / (stats["total"] + 0.1 * (stats["known"] + 1)))
        n = len(self.row["size"])
        return pd.DataFrame({
            "doc_id": pd.array([None if x is None or x != x else int(x) for x in self.row.doc_id], dtype="Int64"), "held_out": np.asarray(self.row.held, dtype=bool),
            "n_tokens": np.asarray(self.row["size"], dtype=np.int64), "n_known": np.bincount(self.doc, self.c1 > 0, n).astype(np.int64),
            "train_tokens": np.full(n, stats["total"], dtype=np.int64), "base_score": np.bincount(self.doc, base, n),
            "score": np.bincount(self.doc, np.log10(p), n),
        })


def _send(chunk: str, keys: np.ndarray, vals: np.ndarray, buckets: int) -> pd.DataFrame:
    """Sorted keys cut into buckets of equal hash ranges; the answers, put together in bucket order, fit the keys."""
    bucket = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = [
        (chunk, b, squeeze(np.diff(keys[s:e], prepend=np.uint64(0))), squeeze(vals[s:e])) for b, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s
    ]
    return pd.DataFrame(rows, columns=["chunk", "bucket", "keys", "vals"])


def _exchange(sent: DataFrame, dtype: str, label: str, least: float | None = None) -> DataFrame:
    """Adds up each key's values over all chunks and answers every chunk in its own order. A bucket is a fixed share
    of the hash range, and a key comes at most once per chunk, so neither hot words nor hot contexts weigh on one. With
    ``least``, the answer is one byte, whether the sum reaches it."""

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(expand(k, "<u8"), dtype=np.uint64) for k in rows["keys"]]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(at, np.concatenate([expand(v, dtype) for v in rows["vals"]]), len(found))
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        answers = totals[at].astype(dtype) if least is None else (totals >= least)[at].astype(np.uint8)
        back = [squeeze(part) for part in np.split(answers, cuts)]
        words = totals[(found & ODD) == 0]
        out = pd.DataFrame({"chunk": rows["chunk"].to_numpy(), "bucket": rows["bucket"].to_numpy(), "vals": back})
        for name, n in (("total", words.sum()), ("known", (words > 0).sum()), ("once", (words == 1).sum()), ("twice", (words == 2).sum())):
            out[name] = np.array([int(n)] + [0] * (len(out) - 1), dtype=np.int64)
        return out

    return saved(sent.groupBy("bucket").applyInPandas(add_up, BACK), label)


def _answers(back: pd.DataFrame, stage: int, dtype: str) -> np.ndarray:
    own = back[back["stage"] == stage].sort_values("bucket")
    return np.concatenate([np.zeros(0, dtype=dtype), *[expand(v, dtype) for v in own["vals"]]])


def _stage(chunks: DataFrame, answers: list[DataFrame], work, shape: str) -> DataFrame:
    """``work`` over each chunk and the answers so far; chunks stay where their buckets lie, only answers move."""
    back, deep = None, len(answers) > 1
    for i, answer in enumerate(answers):
        one = answer.select("chunk", F.lit(i).alias("stage"), "bucket", "vals")
        back = one if back is None else back.union(one)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, row in left.iterrows():
            chunk = Chunk(row)
            chunk.learn(_answers(right, 0, "<f8"))
            if deep:
                chunk.learn3(_answers(right, 1, "<f8"))
            parts.append(work(row.chunk, chunk, right))
        return pd.concat(parts)

    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(run, shape)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document.

    ``docs`` needs doc_id and text; null texts are empty (their end token alone), repeats and further columns are
    allowed, an empty table gives an empty result. Words are lowered in A-Z only. Documents whose id has crc32 0
    modulo 10 are held out of all counts. Counts, tree and smoothing cover every other document, whatever its size.

    Documents become chunks, written once. Three exchanges add up, over all chunks, the counts of words and pairs, of
    triples behind repeated pairs, and the gains of contexts; each sends a chunk's distinct keys once and brings back
    as many numbers. Contexts that gain enough are the tree's states.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_tree_{uuid.uuid4().hex}"
    made = pick(docs, "doc_id", "text").mapInArrow(_chunks, CHUNKS)
    made.write.bucketBy(parts, "chunk").option("path", work_path(spark, "suffix-chunks")).option("compression", "zstd").saveAsTable(name)
    chunks = spark.table(name)
    tokens = chunks.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(1, math.ceil(tokens / BUCKET))

    def send_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                chunk = Chunk(row)
                yield _send(row.chunk, chunk.keys, chunk.counts(), buckets)

    first = _exchange(chunks.mapInPandas(send_counts, SENT), "<f8", "suffix-counts")
    found = first.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "known", "once", "twice")]).first()
    stats = found.asDict()

    def send_triples(key: str, chunk: Chunk, _: pd.DataFrame) -> pd.DataFrame:
        return _send(key, chunk.keys3, chunk.counts3(), buckets)

    second = _exchange(_stage(chunks, [first], send_triples, SENT), "<f8", "suffix-triples")

    def send_gains(key: str, chunk: Chunk, _: pd.DataFrame) -> pd.DataFrame:
        every, _, _ = chunk.contexts()
        keys, nats = chunk.gains(stats)
        vals = np.zeros(len(every))
        vals[np.searchsorted(every, keys)] = nats
        return _send(key, every, vals.astype("<f4"), buckets)

    third = _exchange(_stage(chunks, [first, second], send_gains, SENT), "<f4", "suffix-gains", GAIN)

    def finish(_: str, chunk: Chunk, back: pd.DataFrame) -> pd.DataFrame:
        return chunk.score(stats, _answers(back, 2, "u1") > 0)

    shape = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _stage(chunks, [first, second, third], finish, shape)


def op2_suffix_tree(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


#: A trained tree has no SQL counterpart; tests compare with a brute-force tree.
SQL = None
