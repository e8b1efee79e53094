"""Toxicity by maximum-scoring segments: token log-odds, every significant passage, extreme-value calibration."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_place, fold, pick, saved, table

#: Labelled documents of each class that the model is fitted on, the first by hash of their id: the model's bound.
SAMPLE = 20_000
#: Entries of the lexicon, the most significant first: its size is part of the model and bounds the broadcast.
LEXICON = 50_000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
#: The Dirichlet prior weighs as much as this share of the sampled documents; a token is in the lexicon from so many texts.
PRIOR, FEWEST = 0.05, 5
#: Log-odds count from this many standard deviations on: chance ones of rare tokens would else add up.
Z = 3.0
#: Word starts that stand for words outside the lexicon, longest first, so that inflected and compound forms share evidence.
STEMS = (6, 5, 4)
#: What a word adds is lowered by so many standard deviations, and left out below the least.
SURE, LEAST = 2.0, 0.5
#: A text counts a token once, and once more for each so many words, so that a run of one word is no evidence.
APART = 20
#: Each word costs at least this much beside its gain, so that passages of clean text lose on the whole; no gain exceeds the most.
DRIFT, MOST = 0.01, 8.0
#: A passage is significant where clean text of this many words holds fewer than so many of its score.
WINDOW, EXPECT = 1000, 0.02
#: The most that one passage, and all, count for.
BEST, ALL = 40.0, 80.0
#: Words whose gain a worker remembers before it starts anew.
MEMORY = 400_000
#: Steps of the gains' histogram in one unit.
STEPS = 1024
WORD = re.compile(r"[^\W\d_]+")


def tokens_of(word: str) -> list[str]:
    """The word and its starts, longest first; starts end in ``*``."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def segments(gains: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last place, score) of a sequence of signed gains, in one pass: candidates
    are kept with the sums before and behind them, and a new one swallows those from the last that starts lower and
    ends lower than it. Only places with a gain above 0 begin or end a segment.
    """
    sums = np.append(0.0, np.cumsum(gains))
    places = np.flatnonzero(gains > 0)
    out: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum behind
    for place, before, total in zip(places.tolist(), sums[places].tolist(), sums[places + 1].tolist()):
        first = place
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= before:
                j -= 1
            if j < 0 or out[j][3] >= total:
                out.append((first, place, before, total))
                break
            first, before = out[j][0], out[j][2]
            del out[j:]
    return [(a, b, behind - before) for a, b, before, behind in out]


@dataclass
class Model:
    lexicon: dict[str, float]  # log-odds of a text that holds the token
    rates: dict[str, float]  # surely known log ratio of how often the token is met among a toxic and a clean text's words
    rate: float  # lambda of the extreme-value distribution
    scale: float  # K of the same
    weights: tuple[float, ...]
    drift: float = DRIFT

    def __post_init__(self):
        self.memory: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"memory": {}}

    def gain(self, word: str) -> float:
        """What a word adds: the strongest log ratio of its tokens (0 for none), less the drift; remembered per worker."""
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        found = self.memory[word] = max((self.rates.get(t, 0.0) for t in tokens_of(word)), key=abs) - self.drift
        return found

    def gains(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").lower())
        known = self.memory.get
        return np.array([self.gain(w) if (g := known(w)) is None else g for w in words], dtype=float)

    def bits(self, score: float) -> float:
        """Significance of a passage: clean text holds K n exp(-lambda score) passages of its score in n words, and this
        is how far that lies, as a logarithm, below the limit for a window of fixed length."""
        return self.rate * score - math.log(max(self.scale * WINDOW, 1e-9) / EXPECT)

    def passages(self, text: str | None) -> tuple[list[tuple[int, int, float]], float]:
        """Significant passages (first, last word, bits), and the highest bits of any passage."""
        found = [(a, b, self.bits(s)) for a, b, s in segments(self.gains(text))]
        return [f for f in found if f[2] > 0], max((f[2] for f in found), default=-BEST)

    def features(self, bits: list[float], best: float) -> tuple[float, ...]:
        """Inputs of the logistic map. None depends on the text's length, and words without a significant passage add
        nothing but what stays below the limit of significance."""
        return (1.0, max(min(best, 0.0), -BEST / 4), min(max(best, 0.0), BEST), min(sum(bits), ALL))

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        found, best = self.passages(text)
        odds = sum(w * v for w, v in zip(self.weights, self.features([f[2] for f in found], best)))
        return 1 / (1 + math.exp(-max(min(odds, 50.0), -50.0))), found


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic, part) of the bounded sample, and how many labelled documents one of each class stands for; equal
    texts count once. The id list is 2 x SAMPLE rows at most."""
    known = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("part", fold(F.col("doc_id"), FOLDS)).where(F.col("part") != HELD_OUT)
    shares = {r.toxic: max(1.0, r.n / SAMPLE) for r in known.where(F.col("toxic").isin(0, 1)).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("toxic") == c).orderBy(*order).limit(SAMPLE) for c in (0, 1)]
    ids = chosen[0].union(chosen[1])
    texts = pick(docs, "doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")
    return texts.select("text", F.col("toxic").cast("int").alias("toxic"), "part"), shares


def _most(words: Sequence) -> float:
    """How often a text counts a token at most."""
    return 1 + len(words) / APART


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, toxic, n, met): in how many texts of each class a token is, and how often; pre-added, emptied when large."""
    counts: Counter = Counter()
    met: Counter = Counter()

    def out():
        return pa.RecordBatch.from_pydict({
            "token": [k[0] for k in counts], "toxic": pa.array([k[1] for k in counts], pa.int32()), "n": list(counts.values()),
            "met": pa.array([met[k] for k in counts], pa.float64()),
        })

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = WORD.findall(text.lower())
            here: Counter = Counter()
            for word, n in Counter(words).items():
                for token in tokens_of(word):
                    here[token, toxic] += n
            counts.update(here.keys())
            most = _most(words)
            for key, n in here.items():
                met[key] += min(n, most)
            if len(counts) > 300_000:
                yield out()
                counts.clear()
                met.clear()
    if counts:
        yield out()


def _rate(values: np.ndarray, counts: np.ndarray) -> float:
    """lambda > 0 with mean exp(lambda x gain) = 1 over the words of clean texts, from a histogram of their gains; one
    word of half the most gain is added so that it exists."""
    values, counts = np.append(values, MOST / 2), np.append(counts, 1.0)
    low, high = 1e-6, 50.0 / MOST
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (counts * np.expm1(middle * values)).sum() < 0 else (low, middle)
    return low


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression by Newton's method; each row counts ``weight`` times."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def _hits(learn: DataFrame, model: Model) -> dict[int, tuple[int, int, float]]:
    """By class: texts, words, and words that have a gain of their own (no more than a text counts of one token)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gains = [model.gains(t) for t in batch.column("text").to_pylist()]
            own = [min(np.count_nonzero(g != -model.drift), _most(g)) for g in gains]
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic"), "words": pa.array(map(len, gains), pa.int64()), "own": pa.array(own, pa.float64()),
            })

    seen = learn.select("text", "toxic").mapInArrow(count, "toxic int, words long, own double").groupBy("toxic")
    return {r.toxic: (r.n, r.w, r.own) for r in seen.agg(F.count("*").alias("n"), F.sum("words").alias("w"), F.sum("own").alias("own")).collect()}


def _lexicon(learn: DataFrame, shares: dict[int, float]) -> tuple[dict[str, float], dict[str, float]]:
    """Signed log-odds of tokens between toxic and clean texts, with a Dirichlet prior of both classes' pooled shares, and
    of the same tokens the log ratio of how often they are met among the words, which sets a word that toxic texts repeat
    apart from one that clean texts hold by chance. The ratio is lowered by its uncertainty, taken from the number of texts
    because one text may repeat a word."""
    sizes = _hits(learn, Model({}, {}, 1.0, 1.0, ()))
    (n_toxic, toxic_words, _), (n_clean, clean_words, _) = (sizes.get(c, (0, 0, 0.0)) for c in (1, 0))
    if not (n_toxic and n_clean):
        return {}, {}
    counts = learn.select("text", "toxic").mapInArrow(_presence, "token string, toxic int, n long, met double")
    of = lambda c, k: F.sum(F.when(F.col("toxic") == c, F.col(k)).otherwise(0))
    both = counts.groupBy("token").agg(
        of(1, "n").alias("t"), of(0, "n").alias("c"), of(1, "met").alias("tm"), of(0, "met").alias("cm")
    ).where(F.col("t") + F.col("c") >= FEWEST)

    def alpha(t: str, c: str, toxic: int, clean: int):
        pooled = F.col(t) * shares[1] + F.col(c) * shares[0]
        return F.lit(PRIOR * (toxic + clean)) * pooled / (toxic * shares[1] + clean * shares[0])

    prior, texts = PRIOR * (n_toxic + n_clean), alpha("t", "c", n_toxic, n_clean)
    # Null for a token of all texts, which says nothing.
    odds = lambda k, n: F.log(F.try_divide(F.col(k) + texts, n + prior - F.col(k) - texts))
    delta = odds("t", n_toxic) - odds("c", n_clean)
    deviation = F.sqrt(1 / (F.col("t") + texts) + 1 / (F.col("c") + texts))
    places, words = PRIOR * (toxic_words + clean_words), alpha("tm", "cm", toxic_words, clean_words)
    share = lambda k, n: F.log((F.col(k) + words) / (1 + n + places - F.col(k) - words))
    ratio = share("tm", toxic_words) - share("cm", clean_words)
    sure = both.select("token", delta.alias("delta"), deviation.alias("deviation"), ratio.alias("ratio")).where(
        F.abs("delta") > Z * F.col("deviation")
    )
    rows = sure.orderBy(F.desc(F.abs("delta") / F.col("deviation")), "token").limit(LEXICON).collect()
    rates = {r.token: math.copysign(min(abs(r.ratio) - SURE * r.deviation, MOST), r.ratio) for r in rows if abs(r.ratio) - SURE * r.deviation > LEAST}
    return {r.token: max(-MOST, min(r.delta, MOST)) for r in rows}, rates


def _drift(learn: DataFrame, model: Model) -> float:
    """What a word without a gain says: how much rarer such words are among a toxic text's words, as a logarithm."""
    hits = _hits(learn, model)
    plain = {c: math.log((words - own + 1) / (words + 2)) for c, (_, words, own) in hits.items()}
    return max(DRIFT, plain.get(0, 0.0) - plain.get(1, 0.0)) if model.rates else DRIFT


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from labelled rows outside the held-out fold, at most SAMPLE of each class. The lexicon comes from
    three folds, extreme-value parameters and the logistic map from the fourth; without labels, or documents, all scores
    are alike. A document with several labels is toxic if one of them says so, null labels and ids are left out, equal
    texts of a class count once. Where a class is cut to SAMPLE, its documents count as often as keeps the classes' true
    shares, so that neither the prior of the lexicon nor the decision at 0.5 moves with the number of labels. The driver
    gets the lexicon, a histogram and four numbers for each text of the fourth fold, all bounded."""
    sample, shares = _sample(docs, labels)
    sample = saved(sample.distinct(), "toxic-sample")
    learn, tune = sample.where(F.col("part") != CALIBRATION), sample.where(F.col("part") == CALIBRATION).select("text", "toxic")
    model = Model(*_lexicon(learn, shares), 1.0, 1.0, (-5.0, 0.0, 0.0, 0.0))
    model.drift = _drift(learn, model)
    model.memory.clear()

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(4 * int(MOST) * STEPS, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                np.add.at(seen, np.round(model.gains(text) * STEPS).astype(int) + len(seen) // 2, 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"step": at - len(seen) // 2, "n": seen[at]})

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gains = [model.gains(t) for t in batch.column("text").to_pylist()]
            best = [max((s for _, _, s in segments(g)), default=0.0) for g in gains]
            yield pa.RecordBatch.from_pydict({"n": pa.array(map(len, gains), pa.int64()), "best": pa.array(best, pa.float64())})

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.passages(t) for t in batch.column("text").to_pylist()]
            x = [model.features([f[2] for f in some], best) for some, best in found]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "x": pa.array(x, pa.list_(pa.float64()))})

    clean = tune.where("toxic = 0")
    bins = clean.mapInArrow(histogram, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()
    model.rate = _rate(np.array([r.step / STEPS for r in bins]), np.array([float(r.n) for r in bins]))
    mass = F.sum(F.col("n") * F.exp(-model.rate * F.col("best")))
    seen = clean.mapInArrow(tops, "n long, best double").agg(F.count("*").alias("texts"), mass.alias("mass")).first()
    model.scale = seen.texts / seen.mass if seen.mass else 1.0
    rows = tune.mapInArrow(inputs, "toxic int, x array<double>").collect()  # bounded like the sample
    y = np.array([r.toxic for r in rows], dtype=float)
    if len(y) and 0 < y.mean() < 1:
        model.weights = _logistic(np.array([r.x for r in rows]), y, np.array([shares[r.toxic] for r in rows]))
    return model


SPANS = "array<struct<first:int,last:int,bits:double>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with toxic_score (0 to 1), toxic_pred (1 from 0.5) and toxic_spans behind its columns.

    Spans are the significant passages: first and last word (letters only, from 0) and their bits. Whole texts are
    scanned in linear time; null and empty texts score like texts without a passage, repeated rows alike, and an empty
    table gives none. Clean words behind a text do not change its prediction, because passages are judged against a
    window of fixed length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(f"toxic_score double, toxic_spans {SPANS}")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.score(t) for t in texts]
        spans = [[{"first": a, "last": b, "bits": x} for a, b, x in some] for _, some in found]
        return pd.DataFrame({"toxic_score": pd.Series([f[0] for f in found], dtype=float), "toxic_spans": pd.Series(spans, dtype=object)})

    plain, at, kept = by_place(docs)
    done = plain.withColumn("_found", run(F.col(at["text"])))
    found = F.col("_found.toxic_score")
    return done.select(*kept, found.alias("toxic_score"), (found >= 0.5).cast("int").alias("toxic_pred"), F.col("_found.toxic_spans").alias("toxic_spans"))


def op8_toxic_segments(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(pick(docs, "doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("toxic_score").alias("score"),
        F.col("toxic_pred").alias("predicted"), F.size("toxic_spans").cast("long").alias("n_passages"),
    )


#: A trained model has no SQL counterpart; tests measure held-out accuracy and compare segments with brute force.
SQL = None
