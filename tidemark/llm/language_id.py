"""Language identification: known words by log frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import by_place, checkpointed, fold, pick, table

#: Texts per language that the model is fitted on, the first by hash of their id: the model's bound.
SAMPLE = 4_000
#: Entries kept per language, the most frequent first: words, and n-grams of each length. They bound the broadcast.
WORDS, GRAMS, LONGEST = 20_000, 8_000, 5
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Unseen words whose backoff a worker remembers before it starts anew; a longer text goes in parts of that length.
MEMORY = 200_000


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    langs: list[str]
    #: 0: word -> row, n: n-gram -> row of ``logs[n]``, which has a log frequency per language
    rows: list[dict[str, int]]
    logs: list[np.ndarray]

    def __post_init__(self):
        self.forget()

    def __getstate__(self):
        return {"langs": self.langs, "rows": self.rows, "logs": self.logs}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.forget()

    def forget(self) -> None:
        """Known words only; rows of unseen words are added behind as they come, up to MEMORY."""
        self.index = dict(self.rows[0]) if self.rows else {}
        self.known = len(self.index)
        self.table = np.zeros((self.known + MEMORY, len(self.langs)))
        if self.known:
            self.table[: self.known] = self.logs[0]

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequencies of the known n-grams of the greatest length that has any; none known: no evidence."""
        for n in range(LONGEST, 0, -1):
            known = [self.rows[n][g] for g in grams(word, n) if g in self.rows[n]]
            if known:
                return self.logs[n][known].mean(axis=0)
        return np.zeros(len(self.langs))

    def evidence(self, words: list[str]) -> np.ndarray:
        """Summed log frequencies per language."""
        total = np.zeros(len(self.langs))
        for start in range(0, len(words), MEMORY):
            part = words[start : start + MEMORY]
            new = set(part).difference(self.index)
            if len(self.index) - self.known + len(new) > MEMORY:
                self.forget()
                new = set(part).difference(self.index)
            for word in new:
                self.table[len(self.index)] = self.unseen(word)
                self.index[word] = len(self.index)
            total += self.table[[self.index[w] for w in part]].sum(axis=0)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall((text or "").lower())
        if not words or not self.langs:
            return UNKNOWN, 0.0
        total = self.evidence(words)
        chance = np.exp(total - total.max())
        best = int(chance.argmax())
        return self.langs[best], float(chance[best] / chance.sum())


def _out(counts: Counter) -> pa.RecordBatch:
    langs, kinds, texts = zip(*counts)
    columns = {"lang": pa.array(langs, pa.string()), "kind": pa.array(kinds, pa.int32()), "gram": pa.array(texts, pa.string())}
    return pa.RecordBatch.from_pydict(columns | {"n": pa.array(list(counts.values()), pa.int64())})


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, 0, word, n), pre-added and emptied when large."""
    counts: Counter = Counter()
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            counts.update((lang, 0, w) for w in WORD.findall(text.lower()))
            if len(counts) > 300_000:
                yield _out(counts)
                counts.clear()
    if counts:
        yield _out(counts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, k, k-gram, n) of counted words, pre-added and emptied when large."""
    counts: Counter = Counter()
    for batch in batches:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "gram", "n"))):
            for k in range(1, LONGEST + 1):
                for g in grams(word, k):
                    counts[lang, k, g] += n
            if len(counts) > 300_000:
                yield _out(counts)
                counts.clear()
    if counts:
        yield _out(counts)


def sample_ids(ids: DataFrame, most: int) -> DataFrame:
    """The ``most`` distinct (doc_id, lang) pairs of each language that come first by hash of the id, then by id.

    Pairs are first counted by language and the 16 leading bits of the hash; a language's pairs beyond the bits in which
    it reaches ``most`` cannot be among them. So what one task ranks is the sample and a 65,536th of a language, also
    where one language holds all rows. Repeated pairs count once, a null id is an id, null languages are left out.
    """
    pairs = checkpointed(ids.where("lang is not null").distinct().withColumn("place", F.xxhash64("doc_id")))
    pairs = pairs.withColumn("bits", F.shiftright("place", 48))
    before = F.sum("n").over(W.partitionBy("lang").orderBy("bits").rowsBetween(W.unboundedPreceding, -1))
    counted = pairs.groupBy("lang", "bits").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    last = counted.where(F.col("before") < most).groupBy("lang").agg(F.max("bits").alias("last"))
    ahead = pairs.join(last, "lang").where(F.col("bits") <= F.col("last"))
    ranked = ahead.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("place", "doc_id")))
    return ranked.where(F.col("rank") <= most).select("doc_id", "lang")


def fit(docs: DataFrame) -> Model:
    """The model from texts with a language outside the held-out fold, at most SAMPLE per language."""
    given = pick(docs, "doc_id", "text", "lang").where("text is not null and lang is not null")
    given = given.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    # ids alone are ranked, and only those that can be among the first; at most SAMPLE ids a language are broadcast
    ids = sample_ids(given.select("doc_id", "lang"), SAMPLE)
    sample = given.join(F.broadcast(ids), ["doc_id", "lang"]).select("text", "lang")
    shape, keys = "lang string, kind int, gram string, n long", ["lang", "kind", "gram"]
    words = checkpointed(sample.mapInArrow(_count_words, shape).groupBy(*keys).agg(F.sum("n").alias("n")))
    counts = words.union(words.mapInArrow(_count_grams, shape).groupBy(*keys).agg(F.sum("n").alias("n")))
    every = W.partitionBy("lang", "kind")
    ranked = counts.withColumn("rank", F.row_number().over(every.orderBy(F.desc("n"), "gram")))
    kept = ranked.where(F.col("rank") <= F.when(F.col("kind") == 0, WORDS).otherwise(GRAMS)).select("lang", "kind", "gram", "n").toPandas()
    langs = sorted(kept["lang"].unique())
    rows: list[dict[str, int]] = []
    logs: list[np.ndarray] = []
    for kind in range(LONGEST + 1):
        part = kept[kept["kind"] == kind].sort_values(["gram", "lang"])
        names = {g: i for i, g in enumerate(dict.fromkeys(part["gram"]))}
        n = np.zeros((len(names), len(langs)))
        n[[names[g] for g in part["gram"]], [langs.index(x) for x in part["lang"]]] = part["n"]
        # half a count for what a language has not shown, so that no word rules a language out
        logs.append(np.log(n + 0.5) - np.log(n.sum(axis=0) + 0.5 * max(1, len(names))))
        rows.append(names)
    return Model(langs, rows, logs)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and lang_score (0 to 1) behind its columns; whole texts are read.

    Null texts and texts without a letter are ``und`` with score 0; so is everything when no language was learned.
    Languages that score the same go by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "lang_score"])

    plain, at, kept = by_place(docs)
    done = plain.withColumn("_found", run(F.col(at["text"])))
    return done.select(*kept, F.col("_found.lang_pred").alias("lang_pred"), F.col("_found.lang_score").alias("lang_score"))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(pick(docs, "doc_id", "text"), fit(docs))
    return found.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


#: A trained model has no SQL counterpart; tests measure held-out accuracy and compare scores with brute force.
SQL = None
