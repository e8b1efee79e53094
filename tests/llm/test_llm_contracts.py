"""Oracles, brute-force versions and odd inputs of the operators in tidemark.llm."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat_collapse, components, language_id, mixing, multiset_hash, packing, quality_votes, simhash, toxic_segments, url_rules
from tidemark.llm.registry import ORACLES, QUERIES
from verification.compare import connect, difference

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, DOC_ID string, extra int"


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, a clashing extra column."""
    long_text = " ".join(f"word{i % 977} other{i % 13}." for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta.\nalpha beta gamma delta.", "en", "a"), (1, "alpha beta gamma delta.\nalpha beta gamma delta.", "en", "a"),
        (2, None, "en", "a"), (3, "", "de", None), (4, "\n\n \t", None, "b"), (5, long_text, "en", "a"), (6, long_text, "en", "b"),
        (7, "12345 !!! ###", "fr", "c"), (None, "no id here at all, sir", "en", "a"), (None, None, None, None), (9, "x", "en", "b"),
        (10, "  two  spaces <|endoftext|> end ", "en", "c"), (11, "ÀÉ ümlaut \u00a0 nbsp 你好 🙂.", "de", "c"), (-5, "x", "en", "b"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "clash", 0) for r in rows], DOCS)


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_oracle(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_mix_keeps_to_targets_and_limits(spark):
    docs = spark.range(4000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then 's' || id % 7 end as source", "trim(repeat('w ', cast(1 + id * id % 97 as int))) as text"
    )
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        taken, target = sum(r.copies * r.size * r.n_rows for r in own), own[0].target
        assert abs(taken - target) <= max(r.size for r in own)
        assert all(0 <= r.copies <= 3 for r in own) and target <= 3 * own[0].source_size + 1e-6
    assert abs(sum({r.source: r.target for r in rows}.values()) - sum(r.size * r.n_rows for r in rows)) < 1e-6
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    assert mixing.mixed_rows(docs).count() == sum(r.copies * r.n_rows for r in rows)


def test_mix_of_odd_and_empty_tables(spark):
    rows = mixing.mix(odd_documents(spark)).collect()
    assert sum(r.n_rows for r in rows) == 14 and all(r.copies <= 3 for r in rows)
    assert mixing.mix(empty_documents(spark)).count() == 0


def test_fingerprints_are_order_free_and_incremental(spark):
    frame = spark.createDataFrame([("a\nb\nb", "b\na\nb", "a\nb", "b", "a\nb\nc")], "x string, y string, z string, one string, c string")
    fp = {c: multiset_hash.fingerprint(F.col(c)).alias(c) for c in frame.columns}
    row = frame.select(*fp.values()).select(
        "*", multiset_hash.combine(F.col("z"), F.col("one")).alias("grown"), multiset_hash.combine(F.col("x"), F.col("one"), -1).alias("cut")
    ).first()
    assert row.x == row.y != row.z != row.c
    assert row.grown == row.x and row.cut == row.z


def test_fingerprints_of_odd_and_empty_tables(spark):
    rows = multiset_hash.fingerprints(odd_documents(spark)).collect()
    assert len(rows) == 14 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r.fingerprint)
    assert by_id[2] == by_id[3] and by_id[5] == by_id[6] and len(set(by_id[1])) == 1
    assert multiset_hash.fingerprints(empty_documents(spark)).count() == 0


def brute_repeats(words):
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({i + j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(5)})


def test_quality_measures_against_brute_force(spark):
    random.seed(3)
    texts = ["\n".join(" ".join(random.choices("abc#", k=random.randint(0, 9))) for _ in range(random.randint(0, 9))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_votes.measures(docs).collect():
        text = texts[r.doc_id]
        lines = [x for x in text.split("\n") if x.split()]
        assert r.n_words == len(text.split()) and r.n_symbols == text.count("#") and r.word_chars == len("".join(text.split()))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == brute_repeats(text.split())


def test_quality_of_odd_and_empty_tables(spark):
    rows = {r.doc_id: r for r in quality_votes.judge(odd_documents(spark)).collect()}
    assert not rows[2].kept and rows[2].base_failed and rows[2].n_words == 0
    assert quality_votes.judge(empty_documents(spark)).count() == 0


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = QUERIES["op4_quality_votes"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    rows = judged.select("quality", "kept").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2


def test_likeness_lanes_are_wide_and_many(spark):
    """More equal pieces than a 15-bit lane holds, and more lanes than one 60-bit hash has."""
    n = 300_000
    texts = spark.createDataFrame([("a." * n,), ("one.two.three." * 16,)], "text string")
    prints = texts.coalesce(1).select(multiset_hash.fingerprint(F.col("text")).alias("fp")).cache()
    heavy, light = [r[0] for r in prints.select(multiset_hash._signed(F.col("fp"))).collect()]
    assert len(heavy) == len(light) == 120 and set(heavy) == {n, -n}
    bits = [int(hashlib.md5(w.encode()).hexdigest()[k : k + 15], 16) for k in (0, 15) for w in ("one", "two", "three")]
    want = [16 * sum(1 if (h >> i + 20 * j) & 1 else -1 for h in half) for half in (bits[:3], bits[3:]) for i in range(20) for j in range(3)]
    assert light == want


def brute_components(fps, most=3):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (fps[a] ^ fps[b]).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_links_against_brute_force(spark):
    random.seed(5)
    fps = {}
    for _ in range(60):
        base = random.getrandbits(64)
        for _ in range(random.randint(1, 12)):
            value = base
            for bit in random.sample(range(64), random.randint(0, 5)):
                value ^= 1 << bit
            fps[len(fps)] = value
    signed = {i: v - (1 << 64) if v >> 63 else v for i, v in fps.items()}
    nodes = spark.createDataFrame([(v,) for v in set(signed.values())], "fp long")
    want = defaultdict(set)
    for i, r in brute_components(fps).items():
        want[r].add(signed[i])
    for block in (2048, 2):
        got = defaultdict(set)
        for r in components.components(simhash.link(nodes, block=block)).collect():
            got[r.root] |= {r.root, r.node}
        assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in want.values() if len(x) > 1}


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b")
    rows = components.components(links).collect()
    assert {r.root for r in rows} == {0} and len(rows) == 300


def test_simhash_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: simhash.text_fingerprint((t or "").encode()) for i, t in texts.items()}
    groups = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", groups[i]) for i in fps}


def test_simhash_signatures_stay_out_of_the_driver(spark, monkeypatch):
    """Few enough nodes to be broadcast by their size yield 64 times as many signatures, in the query and in the stage."""
    plans = []

    def seen(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components.components(links)

    monkeypatch.setattr(simhash, "components", seen)
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('word ', id, ' of ', id * 7, ' more') as text")
    assert simhash.near_groups(docs).count() == 3000
    corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert len(plans) == 2
    assert all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in plans)


def test_simhash_of_odd_and_empty_tables(spark):
    rows = simhash.near_groups(odd_documents(spark)).collect()
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add((r.fp, r.component_id))
    assert len(rows) == 14 and found[2] == found[3] == found[4] == {(0, 2)}
    assert found[6] == found[5] and {c for _, c in found[9]} == {-5}
    kept = simhash.one_per_group(odd_documents(spark))
    assert sorted(r[0] or 0 for r in kept.collect()) == sorted([1, 2, 5, 7, 0, -5, 10, 11])
    assert kept.columns == odd_documents(spark).columns
    assert simhash.near_groups(empty_documents(spark)).count() == 0


def check_pieces(rows, texts, segments=64):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want[doc_id] += len(ids)
        if len([1 for d, _ in texts if d == doc_id]) == 1:
            at = 0
            for p in sorted((p for p in rows if p.doc_id == doc_id), key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
    got = Counter()
    sequences = defaultdict(list)
    for p in rows:
        got[p.doc_id] += p.length
        sequences[p.sequence_id].append(p)
    assert got == want
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]] and len(pieces) <= segments
        n = sum(p.length for p in pieces)
        assert n <= 1024
        padding += 0 if n & (n - 1) == 0 else 1024 - n
    return padding / max(1, sum(got.values()))


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op6_vector_packing"](spark, SF).collect()
    assert check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()]) < 0.01
    odd = odd_documents(spark)
    texts = [(r[0], r[1]) for r in odd.collect()]
    check_pieces(packing.pack(odd).collect(), texts)
    assert packing.pack(empty_documents(spark)).count() == 0


def test_packing_limits_segments_and_loss():
    random.seed(1)
    packer = packing.Packer(tokens=64, segments=3, loss=20, pool=16)
    out, loss = [], {}
    for i in range(200):
        n = random.randint(1, 150)
        loss[i] = random.randint(0, n)
        out += packer.add(i, np.arange(n, dtype="<u4"), loss[i])
    out += packer.finish()
    for pieces in out:
        assert sum(p[2] for p in pieces) <= 64 and len(pieces) <= 3
        assert sum(max(0, p[1] + p[2] - max(p[1], loss[p[0]])) for p in pieces) <= 20
    covered = defaultdict(set)
    for p in (p for pieces in out for p in pieces):
        span = set(range(p[1], p[1] + p[2]))
        assert not covered[p[0]] & span
        covered[p[0]] |= span
    assert all(len(covered[i]) > 0 for i in range(200))


def test_packing_returns_sequences_and_loss(spark):
    """The operator's rows make whole sequences: each document's ids come back, and only the text and the end bear loss."""
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [(i, f"word {i} " * (40 * i + 1), "say it " * i) for i in range(12)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string, ask string"), tokens=128, prompt="ask")
    pieces = rows.collect()
    whole = {r.sequence_id: r for r in packing.sequences(rows).collect()}
    assert set(whole) == {p.sequence_id for p in pieces}
    got = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.start):
        ids = np.frombuffer(p.ids, dtype="<u4").tolist()
        assert len(ids) == p.length and p.ids_crc32 == zlib.crc32(p.ids)
        mask = [int(k >= p.loss_start) for k in range(p.length)]
        s = whole[p.sequence_id]
        assert s.ids[p.offset : p.offset + p.length] == ids and s.loss_mask[p.offset : p.offset + p.length] == mask
        got[p.doc_id] += zip(ids, mask)
    for i, text, ask in texts:
        head, tail = tokenizer.encode(ask).ids, tokenizer.encode(text).ids + [0]
        assert got[i] == [(t, 0) for t in head] + [(t, 1) for t in tail]


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.com", "http://a.COM/x?y#z", "https://www.example.com/en/1", "https://m.example.com/en/1", "x://notcom/", "ftp://b.net?/es/", "ftp://b.net/es/a://b"]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate([*urls, urls[4]])], "page_id long, url string, html string, URL int")
    rows = {r.page_id: r for r in url_rules.judge(pages).collect()}
    assert [rows[i].host for i in range(10)] == ["", "", "", "a.com", "a.com", "www.example.com", "m.example.com", "notcom", "b.net", "b.net"]
    assert [rows[i].path for i in range(3, 10)] == ["", "/x", "/en/1", "/en/1", "/", "", "/es/a://b"]
    assert [rows[i].rule for i in range(10)] == [None, None, None, None, "com/", "www.example.com/en/", "example.com/en/", None, None, "net/es/"]
    assert len(rows) == 11 and rows[0].verdict == "allow" and rows[6].verdict == "block"
    assert url_rules.judge(pages.where("false")).count() == 0


def test_url_rules_of_a_very_long_path_against_brute_force(spark):
    """A third of the labelled URLs share one path of 25 pieces; others hold some of its pieces, shuffled."""
    random.seed(7)
    trap = [f"p:{i:02}" for i in range(25)]
    rows = [(random.sample(trap, 25), "block")] * 100 + [(["h:a", "h:b", random.choice("xyz")], random.choice(["allow", "allow", "block"])) for _ in range(200)]
    rows += [(["h:a", "p:00", "p:01"], "allow")] * 4 + [([], "allow")]
    expected = set()
    sets = sorted({t for tokens, _ in rows for t in tokens})
    held = {t: {i for i, (tokens, _) in enumerate(rows) if t in tokens} for t in sets}
    for rule in [(t,) for t in sets] + [(a, b) for a in sets for b in sets if a < b]:
        met = set.intersection(*(held[t] for t in rule))
        for verdict in ("allow", "block"):
            both = sum(rows[i][1] == verdict for i in met)
            if both >= 0.01 * len(rows) and both / len(met) >= 0.6:
                expected.add((rule, verdict, round(both / len(met), 9)))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string").repartition(5)
    mined = url_rules.mine(labelled, confidence=0.6).collect()
    assert {(tuple(r.tokens), r.verdict, round(r.confidence, 9)) for r in mined} == expected and len(mined) == len(expected)
    assert any(rule == ("p:02", "p:24") for rule, *_ in expected)
    assert url_rules.mine(labelled.where("false")).count() == 0


def brute_segments(scores):
    """Ruzzo and Tompa by definition: the best segment, then the same left and right of it."""
    best = max(((sum(scores[i : j + 1]), -(j - i), -i) for i in range(len(scores)) for j in range(i, len(scores))), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[2], -best[2] - best[1]
    return brute_segments(scores[:i]) + [(i, j, best[0])] + [(a + j + 1, b + j + 1, s) for a, b, s in brute_segments(scores[j + 1 :])]


def test_segments_against_brute_force():
    random.seed(2)
    for _ in range(200):
        gains = [random.choice([-0.75, -0.75, -0.75, 0, 1, 2.5, 4, -3]) for _ in range(random.randint(0, 25))]
        got = toxic_segments.segments(np.array(gains))
        assert [(a, b, round(s, 6)) for a, b, s in got] == [(a, b, round(s, 6)) for a, b, s in brute_segments(gains)]


def area(scores, labels):
    """Chance that a toxic text scores above a clean one, ties by half."""
    one, two = (np.array([x for x, y in zip(scores, labels) if y == c]) for c in (1, 0))
    return np.mean([(x > two).mean() + (x == two).mean() / 2 for x in one])


def test_toxicity_held_out_and_length(spark):
    """Held-out texts as they are, and with 5,000 clean words behind them: the same predictions."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxic_segments.fit(docs, labels)
    rows = [r for r in docs.join(labels, "doc_id").where("text is not null").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    calm = " ".join(r.text for r in rows if not r.toxic and model.passages(r.text)[1] < -1).split()
    tail = " " + " ".join(calm[:5000])
    truth = np.array([r.toxic for r in rows])
    plain, long = (np.array([model.score(r.text + more)[0] for r in rows]) for more in ("", tail))
    for got in (plain, long):
        assert area(got, truth) >= 0.94
        assert (got[truth == 0] < 0.5).mean() >= 0.98 and (got[truth == 1] >= 0.5).mean() >= 0.8
    assert ((plain >= 0.5) == (long >= 0.5)).all()
    scored = toxic_segments.score(docs.where("doc_id < 300"), model).collect()
    assert all(r.toxic_pred == (r.toxic_score >= 0.5) and 0 <= r.toxic_score <= 1 for r in scored)
    spans = [(s, toxic_segments.WORD.findall(r.text.lower())) for r in scored for s in r.toxic_spans]
    assert spans and all(model.gain(w[s.first]) > 0 and model.gain(w[s.last]) > 0 and s.bits > 0 for s, w in spans)


def test_toxicity_fit_against_brute_force(spark):
    """Lexicon, lambda and K from the definitions, over the same folds."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxic_segments.fit(docs, labels)
    rows = {(r.text, r.toxic, zlib.crc32(str(r.doc_id).encode()) % 5) for r in docs.join(labels, "doc_id").where("text is not null").collect()}
    learn = [r for r in rows if r[2] in (1, 2, 3)]
    counts = [Counter(), Counter()]
    for text, toxic, _ in learn:
        counts[toxic].update({t for w in set(toxic_segments.WORD.findall(text.lower())) for t in toxic_segments.tokens_of(w)})
    n = [sum(1 for r in learn if r[1] == c) for c in (0, 1)]
    prior, want = toxic_segments.PRIOR * sum(n), {}
    for token in counts[0].keys() | counts[1].keys():
        c, t = counts[0][token], counts[1][token]
        if c + t >= toxic_segments.FEWEST:
            a = prior * (c + t) / sum(n)
            delta = np.log((t + a) / (n[1] + prior - t - a)) - np.log((c + a) / (n[0] + prior - c - a))
            if abs(delta) > toxic_segments.Z * np.sqrt(1 / (t + a) + 1 / (c + a)):
                want[token] = delta
    assert model.lexicon.keys() == want.keys() and all(abs(model.lexicon[t] - x) < 1e-9 for t, x in want.items())
    clean = [model.gains(text) for text, toxic, part in rows if part == 4 and not toxic]
    gains = np.append(np.concatenate(clean), toxic_segments.MOST / 2)
    assert abs(np.mean(np.exp(model.rate * gains)) - 1) < 0.02
    tops = [(len(g), max((s for _, _, s in brute_segments(list(g))), default=0.0)) for g in clean if len(g) < 300]
    assert all(abs(top - max((s for _, _, s in toxic_segments.segments(g)), default=0.0)) < 1e-6 for (_, top), g in zip(tops, [g for g in clean if len(g) < 300]))
    every = [(len(g), max((s for _, _, s in toxic_segments.segments(g)), default=0.0)) for g in clean]
    assert abs(model.scale - len(every) / sum(size * np.exp(-model.rate * top) for size, top in every)) < 1e-6 * model.scale


def test_toxicity_keeps_class_shares_beyond_the_sample(spark, monkeypatch):
    """With more labels than the sample takes, scores are on average those of the model fitted on all labels."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    whole = toxic_segments.fit(docs, labels)
    monkeypatch.setattr(toxic_segments, "SAMPLE", 350)
    cut = toxic_segments.fit(docs, labels)
    texts = [r.text for r in docs.select("text").limit(3000).collect()]
    means = [np.mean([m.score(t)[0] for t in texts]) for m in (whole, cut)]
    assert abs(means[1] - means[0]) < 0.04, means


def test_toxicity_of_words_that_clean_texts_hold_by_chance(spark):
    """A stem that toxic texts repeat (one word in 50) and every fourth clean text holds once."""
    rng = random.Random(5)
    parts = ["la", "de", "ción", "os", "mi", "ra", "que", "jo", "ñue", "ar", "llo", "en"]

    def text(toxic):
        size = rng.randint(200, 400)
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(size)]
        for place in rng.sample(range(size), size // 50 if toxic else int(rng.random() < 0.25)):
            words[place] = "bomente" + rng.choice(parts)
        return " ".join(words)

    rows = [(i, text(i % 10 == 0), int(i % 10 == 0)) for i in range(1500)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxic_segments.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    held = [(model.score(t)[0] >= 0.5, toxic) for i, t, toxic in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got for got, toxic in held if toxic]) >= 0.9
    assert np.mean([not got for got, toxic in held if not toxic]) >= 0.98


def test_toxicity_of_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 1, 0), (None, 0, 1), (77, 1, None)], "doc_id long, quality int, toxic int")
    docs = odd_documents(spark)
    model = toxic_segments.fit(docs, labels)
    scored = toxic_segments.score(docs, model)
    assert scored.columns[:-3] == docs.columns and scored.count() == 14
    assert toxic_segments.score(empty_documents(spark), toxic_segments.fit(empty_documents(spark), labels.where("false"))).count() == 0


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op9_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98


@pytest.mark.parametrize("most", [1, 7, 40, 10_000])
def test_language_sample_is_the_first_by_hash(spark, most):
    """Also with one language holding nearly all rows, repeated rows, null ids and null languages."""
    rows = [(i, "en") for i in range(3000)] + [(i, "de") for i in range(20)] + [(5, "en")] * 500 + [(None, "fr"), (None, "fr"), (1, None)]
    ids = spark.createDataFrame(rows, "doc_id long, lang string").repartition(13)
    hashed = [tuple(r) for r in ids.distinct().where("lang is not null").select("lang", F.xxhash64("doc_id"), "doc_id").collect()]
    expected = Counter()
    for lang in ("en", "de", "fr"):
        first = sorted((r for r in hashed if r[0] == lang), key=lambda r: r[1])[:most]
        expected.update((r[2], lang) for r in first)
    assert Counter(tuple(r) for r in language_id.sample_ids(ids, most).collect()) == expected


def test_language_score_by_hand(spark):
    model = language_id.Model(["a", "b"], [{"yes": 0}, {"q": 0}, {}, {"^zz": 0}, {}, {}], [np.array([[-1.0, -3.0]]), np.array([[-2.0, -1.0]]), np.zeros((0, 2)), np.array([[-5.0, -4.0]]), np.zeros((0, 2)), np.zeros((0, 2))])
    assert model.predict("yes")[0] == "a" and model.predict("zzz")[0] == "b" and model.predict("q q q")[0] == "b"
    assert abs(model.predict("Yes")[1] - 1 / (1 + np.exp(-2))) < 1e-9
    assert model.predict("77 !") == ("und", 0.0) == model.predict(None)
    whole = " ".join(["yes", "zzz", "q", "w"] * 50)
    want = model.predict(whole)
    old, language_id.MEMORY = language_id.MEMORY, 3
    try:
        model.forget()
        assert model.predict(whole)[0] == want[0]
    finally:
        language_id.MEMORY = old


def test_language_of_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    found = language_id.identify(docs, language_id.fit(docs))
    assert found.columns[:-2] == docs.columns
    rows = {r[0]: r["lang_pred"] for r in found.collect()}
    assert rows[2] == rows[3] == rows[7] == "und" and rows[5] == "en"
    assert language_id.identify(empty_documents(spark), language_id.fit(empty_documents(spark))).count() == 0


def test_chat_collapse_of_odd_and_empty_tables(spark):
    rows = [
        (1, 0, "u", "a"), (1, 1, "v", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "v", "b"), (4, 0, "u", None), (5, 0, "u", ""), (6, 0, None, "a"),
        (None, 0, "u", "n"), (7, None, "u", "z"), (8, 0, "u", "a"), (8, 0, "u", "a"), (9, 0, "ua", ""), (10, 0, "u", "x" * 100_000),
    ]
    logs = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, TURN int")
    got = {r.conv_id: r for r in chat_collapse.collapse(logs).collect()}
    assert set(got) == {1, 4, 5, 6, None, 7, 8, 9, 10} and got[1].n_copies == 2 and got[8].n_turns == 2
    assert got[1].rendered == "<|im_start|>u\na<|im_end|>\n<|im_start|>v\nb<|im_end|>\n" and len(got[10].rendered) > 100_000
    assert chat_collapse.collapse(logs.where("false")).count() == 0


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        before, docs = docs, after.cache()
        if name == "near_duplicates":
            fps = {r.doc_id: simhash.text_fingerprint((r.text or "").encode()) for r in before.collect()}
            assert {r.doc_id for r in docs.collect()} == set(brute_components(fps).values())
    pieces = QUERIES["pipeline"](spark, SF).collect()
    taken = Counter(r.doc_id for r in docs.collect())
    assert {p.doc_id for p in pieces} == set(taken)


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    for name, docs in (("odd", odd_documents(spark)), ("empty", empty_documents(spark))):
        folder = f"{tmp_path}/{name}"
        docs.toDF("doc_id", "text", "lang", "source", "n_chars", "x", "y").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        assert (corpus_pipeline.run(spark, folder).count() > 0) == (name == "odd")
