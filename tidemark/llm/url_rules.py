"""URL filtering: hand rules by host and path first, association rules mined from labelled URLs for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, pick, saved, table

#: (verdict, host, path): the rule fits the host and its subdomains where the URL's path starts with the rule's.
HAND_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: An association rule needs this share of the labelled URLs, this confidence, and at most so many tokens.
SUPPORT, CONFIDENCE, MOST_TOKENS = 0.01, 0.95, 2
BLOCK, ALLOW = "=block", "=allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for null and for a URL without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.substring_index(F.substr(whole, F.instr(whole, "://") + 3), "#", 1)).otherwise(F.lit(""))
    rest = F.substring_index(rest, "?", 1)
    host = F.substring_index(rest, "/", 1)
    return ascii_lower(host), F.substr(rest, F.char_length(host) + 1)


def hand_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = HAND_RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, ties by text; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: each label of the host, the domain ending, each piece of the path."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    pieces = F.transform(F.filter(F.split(path, r"/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    ending = F.when(host != "", F.array(F.concat(F.lit("t:"), F.substring_index(host, ".", -1)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(labels, pieces, ending))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """(tokens, verdict, confidence, support) of association rules tokens -> label, from (tokens, verdict) rows.

    FP-growth runs distributed over the baskets token set + label; what comes back is pruned by support, confidence
    and length. ``support`` is a share, so the number of frequent sets does not grow with the table. Tokens that occur
    in exactly the same baskets, as the pieces of one much-visited path do, are mined as one and spelled out in the
    rules afterwards: FP-growth enumerates every subset of what it is given. An empty table gives no rule.
    """
    label = F.when(F.col("verdict") == "block", F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    baskets = labelled.select("tokens", label.alias("label"))
    twins = _twins(baskets, support)
    # at most (mean tokens of a basket) / support tokens are frequent, so few can be left out
    left_out = [row.token for row in twins.where("token <> lead").select("token").collect()]
    kept = F.array_except("tokens", F.lit(left_out).cast("array<string>")) if left_out else F.col("tokens")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets.select(F.concat(kept, F.array("label")).alias("items")))
    rules = model.associationRules.where(F.size("consequent") == 1).withColumn("label", F.col("consequent")[0])
    rules = rules.where(F.col("label").isin(BLOCK, ALLOW)).where(F.size("antecedent") <= most_tokens)
    rules = rules.where(~F.arrays_overlap("antecedent", F.array(F.lit(BLOCK), F.lit(ALLOW))))
    rules = rules.select(F.col("antecedent").alias("leads"), F.substr("label", F.lit(2)).alias("verdict"), "confidence", "support")
    return _spelled_out(rules, twins, most_tokens)


def _twins(baskets: DataFrame, support: float) -> DataFrame:
    """(token, lead) of each frequent token; tokens of exactly the same baskets share the first of them as lead. The
    baskets of a token are compared by two 64-bit hashes over them, each distinct basket once."""
    sets = baskets.groupBy(F.array_sort("tokens").alias("tokens"), "label").agg(F.count("*").alias("n"))
    marked = sets.select("n", F.xxhash64("tokens", "label").alias("x"), F.xxhash64("label", "tokens").alias("y"), F.explode("tokens").alias("token"))
    seen = marked.groupBy("token").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    total = baskets.count()
    return saved(
        seen.where(F.col("n") >= support * total).groupBy("n", "x", "y")
        .agg(F.min("token").alias("lead"), F.collect_list("token").alias("tokens"))  # frequent tokens only: bounded
        .select("lead", F.explode("tokens").alias("token")),
        "twins",
    )


def _spelled_out(rules: DataFrame, twins: DataFrame, most_tokens: int) -> DataFrame:
    """Each rule over leads as the rules over their tokens: all sets of at most ``most_tokens`` tokens that hold one of
    every lead. Tokens are added in ascending order, so each set comes up once."""
    none = F.array().cast("array<string>")
    grown, whole = rules.withColumn("tokens", none).withColumn("used", none), None
    for _ in range(most_tokens):
        added = grown.withColumn("lead", F.explode("leads")).join(twins, "lead")
        last = F.try_element_at("tokens", F.lit(-1))
        added = added.where(last.isNull() | (F.col("token") > last))
        grown = added.select(
            "leads", "verdict", "confidence", "support", F.concat("tokens", F.array("token")).alias("tokens"),
            F.array_union("used", F.array("lead")).alias("used"),
        )
        done = grown.where(F.size("used") == F.size("leads")).select("tokens", "verdict", "confidence", "support")
        whole = done if whole is None else whole.union(done)
    return whole


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, verdict) of each distinct token set that a rule fits.

    Inverted index: a rule is filed under its first token; a set looks up each of its tokens and keeps the rules whose
    tokens it has all. The surest rule wins, then the better supported, the longer, the blocking, the first by text.
    """
    index = rules.select(F.col("tokens")[0].alias("key"), F.col("tokens").alias("rule"), "verdict", "confidence", "support")
    met = sets.select("tokens", F.explode("tokens").alias("key")).join(index, "key").where(F.size(F.array_except("rule", "tokens")) == 0)
    best = F.min_by("verdict", F.struct(-F.col("confidence"), -F.col("support"), -F.size("rule"), F.col("verdict") == "allow", "rule"))
    return met.groupBy("tokens").agg(best.alias("mined"))


def judge(pages: DataFrame, labels: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = HAND_RULES, **limits) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page.

    A URL that a hand rule fits gets its verdict. The others get that of the best association rule, and ``allow``
    where none fits. ``labels`` (url, verdict) is what rules are mined from; without it, the URLs that hand rules
    decide are the labels. Equal token sets are matched once, so a very common host is one lookup. Null URLs and
    URLs without ``://`` have empty host and path and are allowed. An empty table gives an empty result.
    """
    host, path = split_url(F.col("url"))
    cut = pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    ruled = cut.withColumn("hand", hand_rule(F.col("host"), F.col("path"), rules)).withColumn("tokens", tokens(F.col("host"), F.col("path")))
    ruled = saved(ruled.select("page_id", "host", "path", F.col("hand.rule").alias("rule"), F.col("hand.verdict").alias("hand"), "tokens"), "urls")
    if labels is None:
        labelled = ruled.where("hand is not null").select("tokens", F.col("hand").alias("verdict"))
    else:
        seen_host, seen_path = split_url(F.col("url"))
        labelled = pick(labels, "url", "verdict").select(seen_host.alias("h"), seen_path.alias("p"), "verdict")
        labelled = labelled.select(tokens(F.col("h"), F.col("p")).alias("tokens"), "verdict")
    mined = match(ruled.where("hand is null").select("tokens").distinct(), mine(labelled, **limits))
    joined = ruled.join(mined, (ruled["tokens"] == mined["tokens"]) & ruled["hand"].isNull(), "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("hand", "mined", F.lit("allow")).alias("verdict"))


def op7_url_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    fit = "\n".join(
        f"         WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h}{p}', 'verdict': '{v}'}}"
        for v, h, p in sorted(HAND_RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    )
    return rf"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url[instr(url, '://') + 3 :], '^[^?#]*') ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         rest[length(split_part(rest, '/', 1)) + 1 :] AS path FROM rests),
ruled AS (
  SELECT *, row_number() OVER () AS row_no, CASE
{fit}
         END AS hand,
         list_distinct([concat('h:', x) for x in string_split(host, '.') if x <> ''] || [concat('p:', x) for x in string_split(path, '/') if x <> '']
           || CASE WHEN host = '' THEN [] ELSE [concat('t:', string_split(host, '.')[-1])] END) AS tokens
  FROM cut),
baskets AS (SELECT row_number() OVER () AS b, tokens, hand.verdict AS verdict FROM ruled WHERE hand IS NOT NULL),
total AS (SELECT count(*) AS every FROM baskets),
ones AS (SELECT b, verdict, unnest(tokens) AS t FROM baskets),
sets AS (
  SELECT b, verdict, [t] AS rule FROM ones
  UNION ALL SELECT x.b, x.verdict, [x.t, y.t] FROM ones x JOIN ones y ON x.b = y.b AND x.t < y.t),
counted AS (
  SELECT rule, verdict, count(*) AS both_n, sum(count(*)) OVER (PARTITION BY rule) AS n FROM sets GROUP BY rule, verdict),
mined AS (
  SELECT rule, verdict, both_n / n AS confidence, both_n AS support FROM counted, total
  WHERE both_n >= ceil({SUPPORT} * every) AND both_n / n >= {CONFIDENCE}),
met AS (
  SELECT r.row_no, r.page_id, r.host, r.path, r.tokens, r.hand, m.* FROM ruled r LEFT JOIN mined m ON r.hand IS NULL AND list_has_all(r.tokens, m.rule))
SELECT page_id, host, path, any_value(hand.rule) AS rule,
       coalesce(any_value(hand.verdict), arg_min(verdict, (-confidence, -support, -len(rule), verdict = 'allow', rule)), 'allow') AS verdict
FROM met GROUP BY page_id, row_no, host, path
"""


SQL = _oracle()
