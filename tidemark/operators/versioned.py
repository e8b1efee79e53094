"""Parquet tables whose content changes in one step: new files lie beside the old ones until one manifest names them.

A table's folder holds ``data/run=<id>/...``, written once and never changed, and ``manifest/<version>-<id>/``, each a
single small file that names the run of every partition. Readers take the newest manifest. A job that dies before its
manifest leaves the table as it was (its files belong to no version), one that dies after it leaves the new content.
One writer at a time is assumed; readers need no lock.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import delete_path, work_path

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "run string, part string, live boolean, layout string, place string"
#: Folders of a run that are listed one by one; of more, the run is listed as a whole and filtered by partition.
_FEW = 16


@dataclass(frozen=True)
class Place:
    """The column that a table is partitioned by, and how it follows from a row."""

    name: str
    kind: str  # a type whose values read like the folder names
    value: Column
    coarse: bool = False  # so few values that each task may write a file for every one

    def add(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn(self.name, self.value.cast(self.kind))

    def label(self) -> Column:
        return F.concat(F.lit(f"{self.name}="), F.coalesce(F.col(self.name).cast("string"), F.lit(NO_VALUE)))


def by_day(column: str, grain: str = "day") -> Place:
    """By the day of a date or instant column, or the first day of its ``grain``. Years are few."""
    return Place("part_date", "date", F.to_date(F.date_trunc(grain, column)), coarse=grain == "year")


def by_bucket(key: str, buckets: int) -> Place:
    """By a hash of the key: a keyed table without a day, of which a small change should rewrite little."""
    return Place("part_bucket", "int", F.pmod(F.xxhash64(key), F.lit(buckets)))


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[tuple[str, str], ...]  # (run, folder below it)
    dead: tuple[tuple[str, str], ...]  # folders of the same runs that later runs replaced
    layout: T.StructType
    place: str | None  # "name type" of the partition column


def _found(spark: SparkSession, path: str) -> DataFrame | None:
    """Files below a path, by name alone; none where the path is missing."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def version(spark: SparkSession, root: str) -> Version | None:
    """The newest version; none where the table does not exist."""
    files = _found(spark, f"{root}/manifest")
    newest = files.agg(F.max("path")).first()[0] if files is not None else None
    if newest is None:
        return None
    rows = spark.read.schema(_MANIFEST).json(newest).collect()  # one row a partition, and one for the layout
    head = next(r for r in rows if r.layout is not None)
    number = int(newest.rsplit("/", 2)[1].split("-")[0])
    parts = [tuple((r.run, r.part) for r in rows if r.live is live) for live in (True, False)]
    return Version(number, *parts, T.StructType.fromJson(json.loads(head.layout)), head.place)


def _frame(spark: SparkSession, root: str, at: Version, parts: Sequence[tuple[str, str]]) -> DataFrame:
    schema = T.StructType(list(at.layout.fields))
    if at.place is not None:
        name, kind = at.place.split()
        schema = schema.add(name, T.DateType() if kind == "date" else T.IntegerType())
    if not parts:
        return spark.createDataFrame([], schema)
    paths, conditions = [], []
    for run in sorted({run for run, _ in parts}):
        folder = f"{root}/data/run={run}"
        wanted, dead = [p for r, p in parts if r == run], [p for r, p in at.dead if r == run]
        others = dead + sorted({p for r, p in at.parts if r == run} - set(wanted))
        if others and len(wanted) <= _FEW:
            paths += [f"{folder}/{p}" for p in wanted]
            continue
        paths.append(folder)
        if others:
            name = at.place.split()[0]
            label = F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit(NO_VALUE)))
            here = label.isin(wanted) if len(wanted) < len(others) else ~label.isin(others)
            conditions.append((F.col("run") != run) | here)
    found = spark.read.schema(T.StructType(list(schema.fields)).add("run", T.StringType())).option("basePath", f"{root}/data").parquet(*paths)
    for condition in conditions:
        found = found.where(condition)
    return found.drop("run")


def read(spark: SparkSession, root: str) -> DataFrame:
    """The newest content, with its partition column last, so that filters on it prune folders."""
    at = version(spark, root)
    if at is None:
        raise FileNotFoundError(f"no table at {root}")
    return _frame(spark, root, at, at.parts)


def _write_run(frame: DataFrame, root: str, place: Place | None, cluster: Sequence[str]) -> list[tuple[str, str]]:
    """Write rows as a new run; its id and the folders it filled. The rebalance hint lets adaptive execution split a
    very large day over several tasks and put small days together, instead of one task per day. Rows of a coarse place
    are not shuffled for it: each task writes what it has of every span."""
    run = uuid.uuid4().hex
    path = f"{root}/data/run={run}"
    if place is None:
        (frame.sortWithinPartitions(*cluster) if cluster else frame).write.parquet(path)
        return [(run, "")]
    rows = (frame if place.coarse else frame.hint("rebalance", place.name)).sortWithinPartitions(place.name, *cluster)
    rows.write.partitionBy(place.name).parquet(path)
    folder = F.regexp_extract("path", f"({place.name}=[^/]+)/[^/]*$", 1)
    filled = _found(frame.sparkSession, path).select(folder.alias("part")).distinct().collect()
    return [(run, r.part) for r in filled]


def _write_manifest(spark: SparkSession, root: str, at: Version) -> None:
    """The step that makes a version current: one file, which exists whole or not at all."""
    runs = {run for run, _ in at.parts}
    rows = [(run, part, True, None, None) for run, part in sorted(at.parts)]
    rows += [(run, part, False, None, None) for run, part in sorted(at.dead) if run in runs]
    head = (None, None, None, at.layout.json(), at.place)
    spark.createDataFrame([head, *rows], _MANIFEST).coalesce(1).write.json(f"{root}/manifest/{at.number:010d}-{uuid.uuid4().hex}")


def _described(place: Place | None) -> str | None:
    return None if place is None else f"{place.name} {place.kind}"


def write(frame: DataFrame, root: str, place: Place | None = None, cluster: Sequence[str] = ()) -> None:
    """Replace a table's whole content, or create it; rows of a file are sorted by ``cluster``."""
    spark = frame.sparkSession
    before = version(spark, root)
    parts = _write_run(frame if place is None else place.add(frame), root, place, cluster)
    _write_manifest(spark, root, Version(before.number + 1 if before else 1, tuple(parts), (), frame.schema, _described(place)))


def replace(
    fresh: DataFrame, root: str, keys: Sequence[str], place: Place | None, cluster: Sequence[str] = (),
    gone: DataFrame | None = None, fixed_place: bool = False,
) -> int:
    """Put ``fresh`` in place of the rows with the same keys, and of those with the keys ``gone``; other rows stay.

    Only partitions that lose or gain a row are written again: those of ``fresh`` and, unless a key never moves
    (``fixed_place``), those where its keys lie now. Returns their number. A table without a partition column is
    written again as a whole.
    """
    spark = fresh.sparkSession
    at = version(spark, root)
    if at is None:
        raise FileNotFoundError(f"no table at {root}")
    aside = work_path(spark, "replace")
    kinds = {f.name: f.dataType for f in at.layout}
    shaped = fresh.select(*[c if c not in kinds or kinds[c] == t else F.col(c).cast(kinds[c]) for c, t in _columns(fresh)])
    added = _write_run(shaped if place is None else place.add(shaped), root, place, cluster or keys)  # no version names it yet
    new = _frame(spark, root, at, added)
    touched = new.select(*keys)
    if gone is not None:
        gone.select(*keys).distinct().write.parquet(f"{aside}/gone")
        touched = touched.union(spark.read.parquet(f"{aside}/gone")).distinct()
    current = _frame(spark, root, at, at.parts)
    if place is None:
        stale, hit = list(at.parts), {""}
        if new.isEmpty() and current.join(touched, list(keys), "left_semi").isEmpty():
            hit = set()
    else:
        hit = {part for _, part in added}
        if not fixed_place or gone is not None:
            labels = current.join(touched, list(keys), "left_semi").select(place.label().alias("part"))
            hit |= {r.part for r in labels.distinct().collect()}  # partitions, not rows
        stale = [p for p in at.parts if p[1] in hit]
    if hit:
        kept = _frame(spark, root, at, stale).join(touched, list(keys), "left_anti")
        written = _write_run(kept.select(*shaped.columns, *([] if place is None else [place.name])), root, place, cluster or keys)
        dropped = set(stale)
        parts = tuple(p for p in at.parts if p not in dropped) + tuple(written) + tuple(added)
        _write_manifest(spark, root, Version(at.number + 1, parts, at.dead + tuple(stale), at.layout, _described(place)))
    delete_path(spark, aside)
    return len(hit)


def _columns(frame: DataFrame) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in frame.schema]


def expire(spark: SparkSession, root: str) -> int:
    """Delete the runs that the newest version does not name, and in others the folders that later runs replaced; call it
    when no reader of an older version is left. Returns the number of runs."""
    at = version(spark, root)
    files = _found(spark, f"{root}/data")
    if at is None or files is None:
        return 0
    live = {run for run, _ in at.parts}
    runs = files.select(F.regexp_extract("path", "/run=([0-9a-f]+)/", 1).alias("run")).distinct().collect()
    old = [r.run for r in runs if r.run not in live]
    for run in old:
        delete_path(spark, f"{root}/data/run={run}")
    for run, part in at.dead:
        if run in live and part:
            delete_path(spark, f"{root}/data/run={run}/{part}")
    return len(old)
