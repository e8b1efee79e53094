import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import versioned
from tidemark.session import work_path

ROWS = "k int, at timestamp, v string"
DAY = [ts(f"2024-01-0{d} 05:00:00") for d in (1, 2, 3, 4)]
OLD = [(1, DAY[0], "a"), (2, DAY[0], "b"), (3, DAY[1], "c"), (5, DAY[3], "e"), (6, None, "f")]
DELTA = [(3, DAY[2], "c2"), (1, DAY[0], "a2"), (4, DAY[2], "d")]
NEW = [(1, "a2"), (2, "b"), (3, "c2"), (4, "d"), (6, "f")]


def fresh_root(spark):
    return work_path(spark, "versioned" + uuid.uuid4().hex)


def content(spark, root):
    return rows(versioned.read(spark, root).select("k", "v"), "k")


@pytest.mark.parametrize("make", [lambda: versioned.by_day("at"), lambda: versioned.by_day("at", "month"), lambda: versioned.by_bucket("k", 3), lambda: None])
def test_replace_moves_adds_and_removes(spark, make):
    root, place = fresh_root(spark), make()
    versioned.write(spark.createDataFrame(OLD, ROWS), root, place)
    gone = spark.createDataFrame([(5,), (77,)], "k int")
    for _ in range(2):  # a repeated run changes nothing
        assert versioned.replace(spark.createDataFrame(DELTA, ROWS), root, ["k"], place, gone=gone) > 0
        assert content(spark, root) == NEW
    assert versioned.replace(spark.createDataFrame([], ROWS), root, ["k"], place) == 0
    assert versioned.expire(spark, root) > 0 and content(spark, root) == NEW
    versioned.write(spark.createDataFrame([], ROWS), root, place)
    assert content(spark, root) == [] and versioned.read(spark, root).schema["at"].dataType.simpleString() == "timestamp"


def test_days_that_do_not_change_keep_their_files(spark):
    root = fresh_root(spark)
    versioned.write(spark.createDataFrame(OLD, ROWS), root, versioned.by_day("at"))
    before = dict((part, run) for run, part in versioned.version(spark, root).parts)
    assert versioned.replace(spark.createDataFrame(DELTA, ROWS), root, ["k"], versioned.by_day("at")) == 3
    after = dict((part, run) for run, part in versioned.version(spark, root).parts)
    same = {p for p in after if before.get(p) == after[p]}
    assert same == {"part_date=2024-01-04", f"part_date={versioned.NO_VALUE}"} and "part_date=2024-01-02" not in after
    plan = versioned.read(spark, root).where("part_date = DATE'2024-01-04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_date" in plan and rows(versioned.read(spark, root).where("part_date = DATE'2024-01-04'").select("k")) == [(5,)]


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["fresh", "run", "half a run", "manifest"])
def test_a_run_that_dies_leaves_old_or_new_rows(spark, monkeypatch, step):
    """Killed before the delta lies aside, before or after the new files, and after the manifest; then repeated."""
    root, place = fresh_root(spark), versioned.by_day("at")
    versioned.write(spark.createDataFrame(OLD, ROWS), root, place)
    old = content(spark, root)
    write_run, write_manifest = versioned._write_run, versioned._write_manifest

    def die(*_):
        raise Killed

    def run_then_die(*args):
        write_run(*args)
        raise Killed

    def manifest_then_die(*args):
        write_manifest(*args)
        raise Killed

    with monkeypatch.context() as patch:
        if step == "fresh":
            patch.setattr(versioned, "work_path", die)
        elif step == "run":
            patch.setattr(versioned, "_write_run", run_then_die)
        elif step == "half a run":
            patch.setattr(versioned, "_write_run", lambda frame, *args: run_then_die(frame.where(F.col("k") < 3), *args))
        else:
            patch.setattr(versioned, "_write_manifest", manifest_then_die)
        with pytest.raises(Killed):
            versioned.replace(spark.createDataFrame(DELTA, ROWS), root, ["k"], place)
    want = [*NEW[:4], (5, "e"), NEW[4]]
    assert content(spark, root) == (want if step == "manifest" else old)
    versioned.replace(spark.createDataFrame(DELTA, ROWS), root, ["k"], place)
    assert content(spark, root) == want


def test_missing_tables_are_told_apart(spark):
    assert versioned.version(spark, fresh_root(spark)) is None and versioned.expire(spark, fresh_root(spark)) == 0
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, fresh_root(spark))


def test_years_are_written_from_where_rows_lie(spark):
    """Each task writes what it has of every year; rows are not gathered by year first."""
    root = fresh_root(spark)
    frame = spark.range(30).selectExpr("id as k", "date_add(DATE'2020-01-01', int(id % 2) * 400) as day").repartition(3)
    versioned.write(frame, root, versioned.by_day("day", "year"), ("k",))
    assert versioned.read(spark, root).select(F.input_file_name()).distinct().count() == 6
    assert [r.k for r in versioned.read(spark, root).where("part_date = DATE'2021-01-01'").orderBy("k").collect()] == list(range(1, 30, 2))


@pytest.mark.parametrize("grain", ["day", "year"])
def test_replace_writes_new_rows_once(spark, monkeypatch, grain):
    stored = spark.range(400).selectExpr("id as k", "date_add(DATE'2020-01-01', int(id * 5)) as day", "'old' as v")
    root, place = fresh_root(spark), versioned.by_day("day", grain)
    versioned.write(stored, root, place, ("k",))
    runs, write_run = [], versioned._write_run

    def seen(frame, *args):
        runs.append(frame.count())
        return write_run(frame, *args)

    monkeypatch.setattr(versioned, "_write_run", seen)
    fresh = stored.where("k % 2 = 0 and k < 100").withColumn("v", F.lit("new"))
    gone = spark.createDataFrame([(1,), (3,)], "k long")
    assert versioned.replace(fresh, root, ["k"], place, gone=gone) == (2 if grain == "year" else 52)
    assert runs == ([50, 95] if grain == "year" else [50, 0])
    found = {r.k: r.v for r in versioned.read(spark, root).collect()}
    assert found == {k: "new" if k % 2 == 0 and k < 100 else "old" for k in range(400) if k not in (1, 3)}
