"""From raw documents to packed training sequences: toxicity, language, near-duplicates, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language_id, mixing, packing, simhash, toxic_segments
from tidemark.llm.common import saved, table

#: A document whose best language is less likely than this is rejected, as is one without a letter.
SUREST = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on labelled documents of this input, does not call toxic."""
    scored = toxic_segments.score(docs, toxic_segments.fit(docs, table(spark, sf_dir, "labels")))
    return scored.where("toxic_pred = 0").select(*docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: not ``und``, and surer than an even guess."""
    found = language_id.identify(docs, language_id.fit(docs))
    return found.where((found["lang_pred"] != language_id.UNKNOWN) & (found["lang_score"] >= SUREST)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the SimHash operator links, with the shingle length and bit distance of its contract."""
    return simhash.one_per_group(docs, simhash.SHINGLE, simhash.MOST_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models, fingerprints and subword ids have no SQL counterpart; tests check every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
