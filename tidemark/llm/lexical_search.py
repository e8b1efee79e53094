"""Ranked lexical search: documents grouped by the mask of an item's terms they hold, masks tried best first."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import pick, saved, table

#: Documents returned for an item.
TOP = 10
#: Items searched in one pass, and the distinct terms that close a pass: both bound what is broadcast.
ITEMS, TERMS = 512, 16_384
#: Documents whose masks are grouped at a time, and counts (documents x terms) held for them.
DOCS, CELLS = 4096, 32_000_000
#: Documents of the first masks that are evaluated at once; each further step takes twice as many.
STEP = 64
#: Constants of the score: a document's m is BASE + (SLOPE * n * N) div L, a term counts SCALE * tf div (tf * 1000 + SPREAD * m).
BASE, SLOPE, SCALE, SPREAD = 25, 75, 1_000_000_000, 8
#: Separators are the ASCII characters that are neither digits nor letters; letters A-Z become a-z, all other bytes stay.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, with repeats; none for null."""
    return (text or b"").translate(FOLDED).split()


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items (item_id, counts of terms) in blocks that stay below ITEMS items or TERMS distinct terms."""
    block: list[tuple] = []
    seen: set[bytes] = set()
    for row in pick(items, "item_id", "text").where("text is not null").toLocalIterator():
        counts = Counter(terms_of(row.text.encode()))
        if not counts:
            continue
        if block and (len(block) == ITEMS or len(seen | set(counts)) > TERMS):
            yield block
            block, seen = [], set()
        block.append((row.item_id, counts))
        seen |= set(counts)
    if block:
        yield block


POSTINGS = "doc_id long, n long, terms binary, counts binary"


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of documents with a term: number of all terms, and which of the vocabulary's terms
    (32-bit numbers) come how often (64-bit numbers)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                ids, sizes, terms, counts = [], [], [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                    found = terms_of(text.as_py())
                    if found:
                        seen = Counter(map(known, found))
                        seen.pop(None, None)
                        ids.append(doc_id)
                        sizes.append(len(found))
                        terms.append(np.fromiter(seen.keys(), dtype="<i4", count=len(seen)).tobytes())
                        counts.append(np.fromiter(seen.values(), dtype="<i8", count=len(seen)).tobytes())
                columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return pick(docs, "doc_id", "text").mapInArrow(run, POSTINGS)


def _holders(postings: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is; tasks send one number for each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for terms in batch.column("terms"):
                df[np.frombuffer(terms.as_buffer(), dtype="<i4")] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    counted = postings.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counted.collect():  # one row for each term of the block
        out[row.term] = row.df
    return out


class Best:
    """The best documents of one item so far: higher scores first, equal ones by ascending id, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.rows: list[tuple] = []

    def floor(self) -> int:
        """A document below this score cannot enter."""
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def offer(self, scores: np.ndarray, ids: list) -> None:
        low = self.floor()
        fresh = [(-int(scores[i]), ids[i] is None, ids[i] or 0) for i in np.flatnonzero(scores >= low)]
        self.rows = sorted(self.rows + fresh)[: self.top]


def masked_best(best: Best, counts: np.ndarray, weights: np.ndarray, m: np.ndarray, ids: list) -> int:
    """Offer the documents of one block to an item, and return how many of them were evaluated.

    ``counts`` holds the item's terms of each document, ``weights`` their weight times their repeats in the item. Bits
    of presence make a document's mask; equal masks form a group with one largest possible score, that of its terms at
    the block's highest counts and smallest m. Groups are evaluated by that bound, highest first, until it falls below
    the last of the best.
    """
    held = counts > 0
    most = SCALE * counts.max(axis=0)
    ceiling = weights * (most // np.maximum(1000 * counts.max(axis=0) + SPREAD * m.min(), 1))
    packed = np.ascontiguousarray(np.packbits(held, axis=1))
    masks, group = np.unique(packed.view(f"S{packed.shape[1]}").ravel(), return_inverse=True)
    first = np.zeros(len(masks), dtype=np.int64)
    first[group] = np.arange(len(group))
    bounds = held[first] @ ceiling
    order = np.argsort(-bounds[group], kind="stable")
    reach = bounds[group][order]
    done, step = 0, STEP
    while done < len(order) and reach[done] >= best.floor():
        some = order[done : done + step]
        tf = counts[some]
        scores = (weights * ((SCALE * tf) // (1000 * tf + SPREAD * m[some][:, None]))).sum(axis=1)
        best.offer(scores, [ids[i] for i in some])
        done += len(some)
        step *= 2
    return done


def _search_block(docs: DataFrame, block: list[tuple], top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, counts in block for t in counts}))}
    postings = saved(_postings(docs, vocabulary), "lexical-postings")
    total = postings.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = _holders(postings, len(vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64)
    plans = []
    for counts in (c for _, c in block):
        own = np.array(sorted(vocabulary[t] for t in counts))
        repeats = {vocabulary[t]: n for t, n in counts.items()}
        plans.append((own, weight[own] * np.array([repeats[i] for i in own])))
    shared = spark.sparkContext.broadcast(plans)
    n_docs, n_terms, size = int(total.docs), int(total.terms), len(vocabulary)
    rows = max(1, min(DOCS, CELLS // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in shared.value]
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                counts = np.zeros((batch.num_rows, size), dtype=np.int64)
                for i, (terms, tf) in enumerate(zip(batch.column("terms"), batch.column("counts"))):
                    counts[i, np.frombuffer(terms.as_buffer(), dtype="<i4")] = np.frombuffer(tf.as_buffer(), dtype="<i8")
                m = BASE + (SLOPE * batch.column("n").to_numpy() * n_docs) // n_terms
                ids = batch.column("doc_id").to_pylist()
                for found, (own, weights) in zip(best, shared.value):
                    masked_best(found, counts[:, own], weights, m, ids)
        out = [(i, None if none else doc_id, -low) for i, found in enumerate(best) for low, none, doc_id in found.rows]
        item, doc_id, score = zip(*out) if out else ((), (), ())
        columns = [pa.array(item, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    found = postings.mapInArrow(run, "item long, doc_id long, score long")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item long, item_id long")
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` highest-scoring documents of every item, as far as they score above 0.

    ``docs`` needs doc_id and text, ``items`` item_id and text; further columns are allowed. Texts are taken whole,
    null texts have no terms; items without terms, and an empty table on either side, give no rows. Repeated rows of
    documents are ranked each, equal scores by ascending doc_id with null last; rows of items are each an item.

    Items come in blocks of bounded size. For a block, one pass reduces every document to its counts of the block's
    terms (written to the shared folder); N, L and the documents holding each term are sums over those. A second pass
    keeps, in every task, the best documents of each item: no document leaves its task but those, so no term or
    document can be hot, and the ranking sorts ``top`` rows a task and item.
    """
    found = None
    for block in _blocks(items):
        part = _search_block(docs, block, top)
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = f"""
with d as (select row_number() over () as row, doc_id, unnest({_TERMS}) as term from documents),
sizes as (select row, doc_id, count(*) as n from d group by all),
total as (select count(*)::bigint as docs, sum(n)::bigint as terms from sizes),
counts as (select row, term, count(*) as tf from d group by all),
df as (select term, count(*) as df from counts group by all),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from df, total),
ms as (select row, doc_id, (25 + (75 * n * docs) // terms)::bigint as m from sizes, total),
items as (select row_number() over () as item, item_id, unnest({_TERMS}) as term from benchmark),
wanted as (select item, item_id, term, count(*) as times from items group by all),
scores as (
  select item, item_id, doc_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from wanted join counts using (term) join weights using (term) join ms using (row) group by all),
ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
