"""Lexical search, Merkle manifest and removal of repeated strings: brute force, odd and empty tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm_contracts import SF, empty_documents, odd_documents
from tidemark.llm import lexical_search, merkle, suffix_dedup
from tidemark.llm.registry import QUERIES


def brute_search(docs, items, top=10):
    terms = [(d, lexical_search.terms_of(None if t is None else t.encode())) for d, t in docs]
    terms = [(d, t) for d, t in terms if t]
    total, words = len(terms), sum(len(t) for _, t in terms)
    df = Counter(t for _, found in terms for t in set(found))
    out = []
    for item, text in items:
        scored = []
        for doc, found in terms:
            m, tf = 25 + (75 * len(found) * total) // words, Counter(found)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in lexical_search.terms_of((text or "").encode()) if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -low) for i, (low, none, doc) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def test_search_of_odd_and_empty_tables(spark, monkeypatch):
    docs = odd_documents(spark)
    items = spark.createDataFrame(
        [(1, "alpha GAMMA alpha", 0), (2, None, 0), (3, "", 0), (4, "x", 0), (None, "sir no Id", 0), (5, "word3 other5 x ümlaut", 0), (6, "absent terms", 0),
         (7, "你好", 0), (1, "x", 0)], "item_id long, text string, ITEM_ID int",
    )
    plain = lambda frame: [(r[0], r[1]) for r in frame.collect()]
    want = brute_search(plain(docs), plain(items))
    found = lexical_search.search(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == want and any(r[2] is None for r in want)
    monkeypatch.setattr(lexical_search, "ITEMS", 2)
    monkeypatch.setattr(lexical_search, "DOCS", 3)
    monkeypatch.setattr(lexical_search, "STEP", 1)
    assert sorted(map(tuple, lexical_search.search(docs.repartition(5), items).collect()), key=repr) == want
    assert lexical_search.search(empty_documents(spark), items).count() == 0
    assert lexical_search.search(docs, items.where("false")).count() == 0


def test_masks_end_before_all_documents_are_scored():
    best = lexical_search.Best(10)
    counts = np.zeros((4000, 3), dtype=np.int64)
    counts[:, 0] = 1
    counts[:40, 1:] = 2
    done = lexical_search.masked_best(best, counts, np.array([5, 900, 900]), np.full(4000, 100), list(range(4000)))
    assert done == 64 and [r[2] for r in best.rows] == list(range(10))
    later = lexical_search.masked_best(best, counts[40:], np.array([5, 900, 900]), np.full(3960, 100), list(range(40, 4000)))
    assert later == 0


def test_search_keeps_ties_by_id_over_tasks(spark):
    docs = spark.range(300).selectExpr("299 - id as doc_id", "'same text here' as text").repartition(7)
    items = spark.createDataFrame([(1, "text text here")], "item_id long, text string")
    other = spark.createDataFrame([(1000 + i, f"other {i}") for i in range(400)], "doc_id long, text string")
    rows = sorted(map(tuple, lexical_search.search(docs.union(other), items).collect()))
    assert [r[2] for r in rows] == list(range(10)) and len({r[3] for r in rows}) == 1


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, lower=False):
    out = []
    for name in merkle.FIELDS:
        v = row[name]
        v = None if v is None else str(v)
        if lower and name == "text" and v is not None:
            v = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in v)
        out.append("-" if v is None else f"{len(v.encode())}:{v}")
    return h(*out)


def brute_tree(digests):
    """root, and each leaf's path of (before, behind)."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, where in enumerate(at):
            run = digests[where // 16 * 16 : where // 16 * 16 + 16]
            paths[i].append(("".join(run[: where % 16]), "".join(run[where % 16 + 1 :])))
            at[i] = where // 16
        digests = [h(*digests[i : i + 16]) for i in range(0, len(digests), 16)]
    return digests[0], paths


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r), brute_leaf(r, True), r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(groups[s])]) for s in order}
    root, tops = brute_tree([trees[s][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for row, path in zip(sorted(groups[s]), trees[s][1]):
            path = path + tops[place]
            changed = row[4] is not None and zlib.crc32(str(row[4]).encode()) % 5 == 0
            folded = row[3] if changed else row[2]
            for before, behind in path:
                folded = h(before, folded, behind)
            out.append((row[4], row[2], trees[s][0], root, h(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=repr)


def manifest_of(spark, docs, tmp_path, name):
    docs.toDF("doc_id", "text", "lang", "source", "n_chars", "x", "y").write.parquet(f"{tmp_path}/{name}/documents.parquet")
    return merkle.op12_merkle_manifest(spark, f"{tmp_path}/{name}")


def test_manifest_of_odd_and_empty_tables(spark, tmp_path):
    docs = odd_documents(spark)
    many = spark.range(400).selectExpr("id * id * 37 - 9000 as doc_id", "'T' || id as text", "null as lang", "'a' as source", "id as n_chars", "'c' as z", "0 as w")
    wide = spark.range(40).selectExpr("id * 1000000007 * 1000003 as doc_id", "'T' as text", "null as lang", "'s' || id as source", "id as n_chars", "'c' as z", "0 as w")
    hot = spark.range(90).selectExpr("cast(null as bigint) as doc_id", "'t' || (id % 50) as text", "'en' as lang", "null as source", "id % 2 as n_chars", "'c' as z", "0 as w")
    for name, frame in (("odd", docs), ("all", docs.union(many).union(wide).union(hot))):
        plain = frame.toDF("doc_id", "text", "lang", "source", "n_chars", "x", "y")
        want = brute_manifest([r.asDict() for r in plain.collect()])
        assert sorted(map(tuple, manifest_of(spark, frame, tmp_path, name).collect()), key=repr) == want
    assert manifest_of(spark, empty_documents(spark), tmp_path, "empty").count() == 0


def test_ids_are_ranked_without_sorting(spark):
    rng = random.Random(5)
    ids = sorted({rng.choice([rng.randrange(-(1 << 63), 1 << 63), rng.randrange(-200, 200), rng.randrange(1 << 20)]) for _ in range(900)})
    frame = spark.createDataFrame([("s", i, 1) for i in ids], "source string, doc_id long, n long")
    leaves = frame.select("source", "doc_id", F.lit("x").alias("leaf"))
    assert [r.doc_id for r in merkle.ranked(leaves).orderBy("place").collect()] == ids
    assert [r.place for r in merkle.ranked(leaves).orderBy("place").collect()] == list(range(len(ids)))


def brute_repeats(rows, length):
    """(doc_id, n_bytes, removed, spans, kept_sha256), sorted."""
    seen, out = set(), []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    for doc_id, text in order:
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                covered[i : i + length] = b"\1" * length
            else:
                seen.add(raw[i : i + length])
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        out.append((doc_id, len(raw), sum(covered), len(bytes(covered).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found_repeats(docs, length=100, texts=True):
    out = []
    for r in suffix_dedup.remove_repeats(docs, length, texts).collect():
        if texts:
            assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
            assert r.n_bytes - len(r.kept) == sum(s.stop - s.start for s in r.spans)
        out.append((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), r.kept_sha256))
    return sorted(out, key=repr)


def made_repeats(seed, n=250):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    shared = [" ".join(word() for _ in range(rng.choice([12, 18, 19, 20, 21, 25, 60]))) for _ in range(9)]
    line = "this line of eighty odd bytes stands in a third of all documents, whatever they say"
    rows = []
    for i in range(n):
        kind = rng.random()
        parts = [" ".join(word() for _ in range(rng.randrange(0, 80)))]
        if kind < 0.4:
            parts += [rng.choice(shared), word(), rng.choice(shared)[rng.randrange(30) :]]
        if kind > 0.6:
            parts += [line, word()]
        if 0.3 < kind < 0.5 and rows:
            old = rng.choice(rows)[1] or ""
            cut = rng.randrange(len(old) + 1)
            parts.append(old[:cut] + rng.choice(["", "Z", "ZZ"]) + old[cut:])
        if kind > 0.97:
            parts.append(rng.choice(["a", "ab", "é"]) * rng.randrange(90, 400))
        rows.append((rng.randrange(n), "".join(parts)))
    return rows + [rows[3], rows[3], (None, rows[4][1]), (None, None), (2, ""), (-7, "x" * 99), (-8, "x" * 100), (-9, "y" * 101)]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_those_of_brute_force(spark, monkeypatch, seed):
    rows = made_repeats(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_repeats(rows, 100)
    assert found_repeats(docs) == want
    # hot buckets are spread, long texts come in pieces
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 2)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    assert found_repeats(docs, texts=False) == want
    assert found_repeats(docs, 40) == brute_repeats(rows, 40)


def test_repeats_of_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    plain = [(r[0], r[1]) for r in docs.collect()]
    assert found_repeats(docs) == brute_repeats(plain, 100)
    assert suffix_dedup.remove_repeats(empty_documents(spark)).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("dedup_texts")]


def test_repeats_query_on_the_sample(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_suffix_dedup"](spark, SF).collect()), key=repr) == brute_repeats(rows, 100)
