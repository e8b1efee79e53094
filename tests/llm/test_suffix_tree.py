"""The suffix tree against a brute-force one over whole strings."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import suffix_tree


def brute(docs):
    """Scores by plain dictionaries: the same counts, gains and smoothing, without hashes, chunks or exchanges."""
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    lines = {i: [*(t or "").split(), None] for i, t in docs}
    count = [Counter(), Counter(), Counter()]
    for i, words in lines.items():
        if not held[i]:
            for n in (1, 2, 3):
                count[n - 1].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    c1, c2, c3 = count
    total, known = sum(c1.values()), len(c1)
    once, twice = sum(v == 1 for v in c1.values()), sum(v == 2 for v in c1.values())
    d = min(max(once / max(1, once + 2 * twice), 0.05), 0.95)
    root = lambda w: (c1[(w,)] - d) / total if c1[(w,)] else d * known / total
    a, b = suffix_tree.WEIGHT
    gain = defaultdict(float)
    for i, words in lines.items():
        for k in range(1, len(words)) if not held[i] else ():
            w, v = words[k], words[k - 1]
            p1 = p2 = root(w)
            if c1[(v,)] >= 2:
                p2 = (c2[v, w] - 1 + a * p1) / (c1[(v,)] - 1 + a)
                gain[(v,)] += math.log(p2 / p1)
            if k > 1 and c2[words[k - 2], v] >= 2:
                u = words[k - 2]
                p3 = (c3[u, v, w] - 1 + b * p2) / (c2[u, v] - 1 + b)
                gain[u, v] += math.log(p3 / p2)
    out = {}
    for i, words in lines.items():
        score = base = 0.0
        for k, w in enumerate(words):
            p = root(w)
            if k and c1[(words[k - 1],)] >= 2 and gain[(words[k - 1],)] >= suffix_tree.GAIN:
                p = (c2[words[k - 1], w] + a * p) / (c1[(words[k - 1],)] + a)
            if k > 1 and c2[words[k - 2], words[k - 1]] >= 2 and gain[words[k - 2], words[k - 1]] >= suffix_tree.GAIN:
                p = (c3[words[k - 2], words[k - 1], w] + b * p) / (c2[words[k - 2], words[k - 1]] + b)
            score += math.log10(p)
            base += math.log10((c1[(w,)] + 0.1) / (total + 0.1 * (known + 1)))
        out[i] = (held[i], len(words), sum(c1[(w,)] > 0 for w in words), total, base, score)
    return out


@pytest.mark.parametrize("chunk", [2_000_000, 40])
def test_scores_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(suffix_tree, "BUCKET", 100)
    random.seed(4)
    words = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(random.choices(words, weights=range(1, 13), k=random.randint(0, 30)))) for i in range(120)]
    docs += [(1000 + i, "a b c d e f g h " * 3) for i in range(6)] + [(2000, None), (2001, ""), (2002, "never seen words here")]
    monkeypatch.setattr(suffix_tree, "CHUNK", chunk)
    got = {r.doc_id: r for r in suffix_tree.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, want in brute(docs).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4]
        assert math.isclose(r.base_score, want[4], abs_tol=1e-9) and math.isclose(r.score, want[5], rel_tol=1e-5, abs_tol=1e-6)


def test_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, DOC_ID string"
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "A b", None), (2, None, "y"), (3, "", "z"), (4, "q " * 100_000, "z")]
    got = suffix_tree.score(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 6 and all(r.score <= 0 and r.base_score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {1}
    assert suffix_tree.score(spark.createDataFrame([], schema)).count() == 0
