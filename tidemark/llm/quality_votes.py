"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, the posterior decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, saved, table, words

#: Fixed values of the base rule: fewest words, window length, largest percentage of words in repeated windows.
FEWEST, WINDOW, MOST_REPEATED = 10, 5, 20
#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
#: A sentence end: its mark before white space or the text's end.
ENDS = "[.!?]([ \\n]|$)"
#: Rounds of expectation-maximisation.
ROUNDS = 30

#: rule -> (measure, votes good up to, votes bad above); between the two bounds it abstains, as it does without words.
RULES = {
    "symbols": ("n_symbols / n_words", 0.02, 0.1),
    "capitals": ("n_capitals / word_chars", 0.1, 0.4),
    "letters": ("1 - n_alnum / word_chars", 0.07, 0.15),
    "sentences": ("abs(n_ends / n_words - 0.12)", 0.11, 0.115),
    "lines": ("n_dup_lines / n_lines", 0.2, 0.4),
    "variety": ("1 - n_distinct / least(n_words, 400)", 0.6, 0.8),
    "word_length": ("abs(word_chars / n_words - 6)", 2.5, 6.0),
}
#: Where estimation starts, and what it is drawn to: the share of good documents, and in each class the chances of a
#: bad vote and a good vote of a rule that votes. An abstention says nothing, so its factor is 1.
SHARE_GOOD, IN_GOOD, IN_BAD = 0.85, (0.003, 1.0, 0.997), (0.28, 1.0, 0.72)
#: Weight of that start, as a share of all documents: the same at every table size.
PULL = 0.01


def _windows(tokens: Column) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - WINDOW, F.lit(0)))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(WINDOW)]))
    return F.when(F.size(tokens) >= WINDOW, hashed).otherwise(F.array().cast("array<long>"))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id with the counts that the rules read, made row by row without a shuffle. A null text has no words.

    Words in repeated windows: equal hashes show whether any window comes twice; only such texts sort (hash, place),
    take the places that have an equal neighbour, and add up what their windows cover.
    """
    cut = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cut = cut.withColumn("words", words(F.col("text")))
    cut = cut.withColumn("windows", _windows(F.col("words")))
    cut = cut.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))
    ranked = "array_sort(transform(windows, (h, i) -> named_struct('h', h, 'i', i)))"
    cut = cut.withColumn("pairs", F.when(F.size("windows") > F.size(F.array_distinct("windows")), F.expr(ranked)))
    again = (
        "transform(pairs, (p, k) -> named_struct('i', p.i, 'again',"
        " coalesce(p.h = get(pairs, k - 1).h, false) or coalesce(p.h = get(pairs, k + 1).h, false)))"
    )
    cut = cut.withColumn("places", F.expr(f"array_sort(transform(filter({again}, x -> x.again), x -> x.i))"))
    reach = f"transform(places, (i, k) -> least({WINDOW}, coalesce(get(places, k + 1) - i, {WINDOW})))"
    return cut.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"coalesce(aggregate({reach}, 0L, (a, x) -> a + x), 0L)").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(r"[\p{L}\p{N}]")).cast("long").alias("n_alnum"),
        F.regexp_count("text", F.lit(ENDS)).cast("long").alias("n_ends"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )


def votes(measured: DataFrame) -> DataFrame:
    """Adds base_failed and one column per rule: 2 good, 0 bad, 1 abstains."""
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = measured.withColumn("base_failed", failed)
    for rule, (measure, good, bad) in RULES.items():
        value = F.when(F.col("n_words") > 0, F.expr(measure))
        out = out.withColumn(rule, F.when(value <= good, 2).when(value > bad, 0).otherwise(1))
    return out


def posteriors(voted: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(rule columns, quality): the chance that a document with these votes is good, one row per vote pattern.

    Documents enter as counts per pattern, at most 3 ** rules of them whatever the table's size, so that the rounds
    run as one SQL expression over one row. ``good[r][v]`` and ``bad[r][v]`` are the chances of vote v of rule r. The repeat
    measure is left to the base rule: a second vote on the same fault would not be independent of the line rule.
    """
    rules, last = list(RULES), len(RULES) - 1
    patterns = voted.groupBy(*rules).agg(F.count("*").cast("double").alias("n"))
    listed = patterns.agg(F.array_sort(F.collect_list(F.struct(F.array(*rules).alias("v"), "n"))).alias("patterns"))

    def chances(values) -> str:
        return f"array({', '.join(f'{x}D' for x in values)})"

    def posterior(model: str) -> str:
        odds = f"ln({model}.share / (1 - {model}.share)) + aggregate(sequence(0, {last}), 0D, (a, r) -> a + ln({model}.good[r][p.v[r]] / {model}.bad[r][p.v[r]]))"
        return f"1 / (1 + exp(-({odds})))"

    def estimate(weight: str, start) -> str:
        seen = f"aggregate(w, 0D, (a, p) -> a + if(p.v[r] = k, p.n * {weight}, 0D))"
        mass = f"aggregate(w, 0D, (a, p) -> a + if(p.v[r] = 1, 0D, p.n * {weight}))"
        return (
            f"transform(sequence(0, {last}), r -> transform(sequence(0, 2), k -> if(k = 1, 1D,"
            f" ({seen} + {PULL}D * (t + 1) * {chances(start)}[k]) / ({mass} + {PULL}D * (t + 1)))))"
        )

    weighed = f"transform(patterns, p -> named_struct('v', p.v, 'n', p.n, 'q', {posterior('m')}))"
    share = f"(aggregate(w, 0D, (a, p) -> a + p.n * p.q) + {PULL * SHARE_GOOD}D * (t + 1)) / (t + {PULL}D * (t + 1))"
    fitted = f"named_struct('share', {share}, 'good', {estimate('p.q', IN_GOOD)}, 'bad', {estimate('(1 - p.q)', IN_BAD)})"
    start = f"named_struct('share', {SHARE_GOOD}D, 'good', array_repeat({chances(IN_GOOD)}, {last + 1}), 'bad', array_repeat({chances(IN_BAD)}, {last + 1}))"
    # transform over a one-element array names the element, so that it is computed once
    step = f"transform(array({weighed}), w -> {fitted})[0]"
    learned = listed.withColumn("t", F.expr("aggregate(patterns, 0D, (a, p) -> a + p.n)")).withColumn(
        "model", F.expr(f"aggregate(sequence(1, {rounds}), {start}, (m, i) -> {step})")
    )
    each = learned.select("model", F.explode("patterns").alias("p"))
    return each.select(*[F.expr(f"p.v[{i}]").alias(r) for i, r in enumerate(rules)], F.expr(posterior("model")).alias("quality"))


def judge(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: its measures, votes, quality (posterior, 0 to 1), base_failed and kept.

    ``docs`` needs doc_id and text; nulls, repeats and further columns are allowed. Documents that fail the base rule
    are never kept and take no part in the estimation; the others are kept if their posterior is at least a half. At most
    3 ** rules patterns meet the documents again, so that side is broadcast.
    """
    voted = votes(saved(measures(docs), "quality"))
    learned = posteriors(voted.where("not base_failed"), rounds)
    return voted.join(F.broadcast(learned), list(RULES), "left").withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("quality", F.lit(0.0)) >= 0.5)
    )


def op4_quality_votes(spark, sf_dir: str) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *names, *RULES)


def _oracle() -> str:
    rules = list(RULES)
    vote = ", ".join(
        f"CASE WHEN n_words > 0 AND {m.replace(' / ', ' / 1.0 / ')} <= {g} THEN 2 WHEN n_words > 0 AND {m.replace(' / ', ' / 1.0 / ')} > {b} THEN 0 ELSE 1 END AS {r}"
        for r, (m, g, b) in RULES.items()
    )
    odds = "ln(share / (1 - share)) + list_sum([ln(good[r][p.v[r] + 1] / bad[r][p.v[r] + 1]) for r in range(1, {n})])".format(n=len(rules) + 1)

    def estimate(weight, start):
        return (
            f"[[CASE WHEN k = 2 THEN 1 ELSE (coalesce(list_sum([CASE WHEN p.v[r] + 1 = k THEN p.n * {weight} ELSE 0 END for p in w]), 0) + {PULL} * (t + 1) * {list(start)}[k])"
            f" / (coalesce(list_sum([CASE WHEN p.v[r] = 1 THEN 0 ELSE p.n * {weight} END for p in w]), 0) + {PULL} * (t + 1)) END for k in range(1, 4)] for r in range(1, {len(rules) + 1})]"
        )

    return rf"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
  SELECT doc_id, i, list_aggregate(words[i + 1 : i + {WINDOW}], 'string_agg', ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(len(words) - {WINDOW - 1})) AS i FROM cut WHERE len(words) >= {WINDOW})),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range({WINDOW}) AS r(j) GROUP BY doc_id),
measured AS (
  SELECT c.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '{SYMBOLS}')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(v.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
         len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]')) AS n_alnum, len(regexp_extract_all(text, '{ENDS}')) AS n_ends, len(list_distinct(words)) AS n_distinct
  FROM cut c LEFT JOIN covered v ON c.doc_id = v.doc_id),
voted AS (SELECT *, n_words < {FEWEST} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed, {vote} FROM measured),
listed AS (
  SELECT coalesce(list({{'v': [{', '.join(rules)}], 'n': n}} ORDER BY {', '.join(rules)}), []) AS patterns, coalesce(sum(n), 0) AS t
  FROM (SELECT {', '.join(rules)}, CAST(count(*) AS DOUBLE) AS n FROM voted WHERE NOT base_failed GROUP BY ALL)),
em AS (
  SELECT 0 AS i, {SHARE_GOOD}::DOUBLE AS share, [{list(IN_GOOD)}::DOUBLE[] for r in range({len(rules)})] AS good, [{list(IN_BAD)}::DOUBLE[] for r in range({len(rules)})] AS bad
  UNION ALL
  SELECT i + 1, ((coalesce(list_sum([p.n * p.q for p in w]), 0) + {PULL * SHARE_GOOD} * (t + 1)) / (t + {PULL} * (t + 1)))::DOUBLE,
         {estimate('p.q', IN_GOOD)}::DOUBLE[][], {estimate('(1 - p.q)', IN_BAD)}::DOUBLE[][]
  FROM (SELECT i, t, [{{'v': p.v, 'n': p.n, 'q': 1 / (1 + exp(-({odds})))}} for p in patterns] AS w FROM em, listed WHERE i < {ROUNDS}))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 1 / (1 + exp(-({odds.replace('p.v', '[' + ', '.join(rules) + ']')}))) >= 0.5 AS kept, {', '.join(rules)}
FROM voted, (SELECT * FROM em WHERE i = {ROUNDS})
"""


SQL = _oracle()
