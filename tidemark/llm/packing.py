"""Packing token sequences: vector bin packing under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, table

#: Vocabulary files of the byte-level BPE (names below the public tokenizers' folder), the id behind each document.
VOCABULARY, RANKS, END_ID = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", 0
SPECIAL = "<|endoftext|>"
#: Limits of a sequence: tokens, pieces of documents, loss-bearing tokens.
TOKENS, SEGMENTS = 1024, 64
#: Pieces that wait in a task for a sequence, and encoded words that a worker remembers.
POOL, MEMORY = 256, 400_000
#: Only where a space meets further white space, or ends the text, do ids depend on more than one space-led chunk.
CROSSING = re.compile(r" \s| $")


class Encoder:
    """Ids of a byte-level BPE, equal to the ``tokenizers`` library's for the same vocabulary.

    Its split puts a space in front of the word behind it, so that a text is encoded chunk by chunk, each remembered.
    Texts where white space follows a space are encoded whole; those that spell a special token go through the
    ``tokenizers`` library itself.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self.vocabulary = public_tokenizers.path(vocabulary)
        self.whole = None
        self.memory: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.vocabulary)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if CROSSING.search(text):
            return np.array(self.plain.encode_ordinary(text), dtype="<u4")
        memory = self.memory
        if len(memory) > MEMORY:
            memory.clear()
        chunks = text.split(" ")
        first = chunks.pop(0)
        out = [np.array(self.plain.encode_ordinary(first), dtype="<u4").tobytes()]
        for chunk in chunks:
            ids = memory.get(chunk)
            if ids is None:
                ids = memory[chunk] = np.array(self.plain.encode_ordinary(" " + chunk), dtype="<u4").tobytes()
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<u4")


@lru_cache(maxsize=1)
def encoder(vocabulary: str, ranks: str) -> Encoder:
    return Encoder(vocabulary, ranks)


class Packer:
    """Fills sequences from a bounded pool of pieces.

    A piece needs a vector (tokens, one segment, loss-bearing tokens), a sequence has a vector of what is left. Each
    step takes the piece that fits and has the largest dot product of the two, each dimension divided by its limit and
    weighted by the pool's demand for it. Where none fits, a piece is cut to what is left. What remains at the end
    goes into sequences whose lengths are powers of two, so it needs no padding either.
    """

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int | None = None, pool: int = POOL):
        self.limits = np.array([tokens, segments, loss or tokens], dtype=np.int64)
        self.size = pool
        self.docs: list[tuple] = []  # (ids, doc_id, first token that bears loss)
        self.start: list[int] = []
        self.needs = np.zeros((0, 3), dtype=np.int64)
        self.sequences = 0

    def _need(self, doc: tuple, start: int, stop: int) -> list[int]:
        return [stop - start, 1, max(0, stop - max(start, doc[2]))]

    def _fit(self, doc: tuple, start: int, left: np.ndarray) -> int:
        """The most tokens from ``start`` that fit into ``left``."""
        free = max(0, doc[2] - start)
        return int(min(len(doc[0]) - start, left[0], free + left[2])) if left[1] > 0 else 0

    def add(self, doc_id, ids: np.ndarray, loss_from: int = 0) -> Iterator[list]:
        """A document joins: full sequences at once, its rest waits in the pool."""
        doc, start = (ids, doc_id, loss_from), 0
        while len(ids) - start >= self.limits[0] and (n := self._fit(doc, start, self.limits)) == self.limits[0]:
            yield self._close([(doc, start, n)])
            start += n
        if start < len(ids):
            self._wait(doc, start)
        while len(self.docs) >= self.size:
            yield self._close(self._fill())

    def finish(self) -> Iterator[list]:
        while self.docs:
            total = int(self.needs[:, 0].sum())
            if total >= self.limits[0]:
                yield self._close(self._fill())
            else:
                yield self._close(self._fill(1 << (total.bit_length() - 1)))

    def _wait(self, doc: tuple, start: int) -> None:
        self.docs.append(doc)
        self.start.append(start)
        self.needs = np.vstack([self.needs, [self._need(doc, start, len(doc[0]))]])

    def _take(self, at: int, n: int) -> tuple:
        doc, start = self.docs[at], self.start[at]
        if start + n == len(doc[0]):
            last = len(self.docs) - 1
            self.docs[at], self.start[at], self.needs[at] = self.docs[last], self.start[last], self.needs[last]
            self.docs.pop()
            self.start.pop()
            self.needs = self.needs[:last]
        else:
            self.start[at] = start + n
            self.needs[at] = self._need(doc, start + n, len(doc[0]))
        return doc, start, n

    def _fill(self, tokens: int | None = None) -> list[tuple]:
        left = self.limits.copy()
        if tokens:
            left[0] = tokens
        pieces = []
        while self.docs and left[0] > 0 and left[1] > 0:
            weights = self.needs.mean(axis=0) / self.limits
            gain = (self.needs / self.limits * weights) @ (left / self.limits)
            fits = np.all(self.needs <= left, axis=1)
            if left[1] == 1:  # the last segment should fill the sequence
                fits &= self.needs[:, 0] == left[0]
            if fits.any():
                at = int(np.where(fits, gain, -1.0).argmax())
                n = int(self.needs[at, 0])
            else:
                whole, bearing = self.needs[:, 0], self.needs[:, 2]
                room = np.minimum(np.minimum(whole, left[0]), whole - bearing + left[2])
                at = int(room.argmax())
                n = room[at]
                if n == 0:
                    break
            pieces.append(self._take(at, n))
            left -= self._need(*pieces[-1][:2], pieces[-1][1] + n)
        return pieces

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        """(doc_id, start, length, document's tokens, sequence, offset, first place that bears loss, ids) of each piece."""
        out, offset = [], 0
        for (ids, doc_id, loss_from), start, n in pieces:
            free = min(n, max(0, loss_from - start))
            out.append((doc_id, start, n, len(ids), self.sequences, offset, free, ids[start : start + n].tobytes()))
            offset += n
        self.sequences += 1
        return out


SHAPE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, loss_start long, ids binary"
NAMES = [part.split()[0] for part in SHAPE.split(", ")]


def pack(
    docs: DataFrame, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int | None = None, prompt: str | None = None,
    vocabulary: str = VOCABULARY, ranks: str = RANKS, pool: int = POOL,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_start, ids.

    ``ids`` are the piece's token ids as little-endian 32-bit numbers, ``ids_crc32`` is their digest; the tokens from
    place ``loss_start`` to the piece's end bear loss (none where it is ``length``). A sequence is its pieces' ids in
    order of ``offset`` (``sequences``).
    ``docs`` needs doc_id and text; with ``prompt``, that column's tokens come first and bear no loss. Every document
    is its ids and one end id; null and empty texts are the end id alone. Each task packs what it reads, from a pool
    of ``pool`` pieces, so nothing is shuffled and a hot source costs nothing; sequence ids carry the task's partition
    in their high bits. Repeated rows are packed as often as they come; an empty table gives an empty result.
    """
    names = ["doc_id", "text"] + ([prompt] if prompt else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, packer = encoder(vocabulary, ranks), Packer(tokens, segments, loss, pool)
        base = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            doc_ids, *numbers, ids = zip(*rows)
            numbers = [np.array(c, dtype=np.int64) for c in numbers]
            numbers[NAMES.index("sequence_id") - 1] += base
            rows.clear()
            columns = [pa.array(doc_ids, pa.int64()), *[pa.array(c) for c in numbers], pa.array(ids, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=NAMES)

        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            given = [batch.column(i) for i in range(len(names))]
            for i in range(batch.num_rows):
                head = code.encode(given[2][i].as_py() or "") if prompt else end[:0]
                ids = np.concatenate([head, code.encode(given[1][i].as_py() or ""), end])
                for pieces in packer.add(given[0][i].as_py(), ids, len(head)):
                    rows.extend(pieces)
            if len(rows) > 10_000:
                yield out()
        for pieces in packer.finish():
            rows.extend(pieces)
        if rows:
            yield out()

    pieces = pick(docs, *names).mapInArrow(run, SHAPE)
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset", "loss_start", "ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, loss_mask) of ``pack``'s rows: whole training sequences, and 1 for each token that bears loss."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        ids = np.frombuffer(b"".join(rows["ids"]), dtype="<u4").astype(np.int32)
        mask = np.concatenate([np.arange(n) >= free for n, free in zip(rows["length"], rows["loss_start"])]).astype(np.int8)
        return pd.DataFrame({"sequence_id": [rows["sequence_id"].iloc[0]], "ids": [ids], "loss_mask": [mask]})

    return pieces.groupBy("sequence_id").applyInPandas(run, "sequence_id long, ids array<int>, loss_mask array<byte>")


def op6_vector_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents").select("doc_id", F.col("text")))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


#: Subword ids have no SQL counterpart; tests check round trips against the tokenizers library.
SQL = None
