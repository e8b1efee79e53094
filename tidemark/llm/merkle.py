"""Merkle manifest of a dataset: ranks from bitmaps of ids, levels from slot arrays, proofs and their verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, by_place, pick, saved, table

#: Children of a node.
FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of an id that one level of the popcount directory spans, and bits of a bitmap word.
DIRECTORY, WORD_BITS = (48, 32, 16), 6
#: Tampered rows are those where this number divides the id's crc32.
TAMPERED = 5


def leaf_digest(*values: Column) -> Column:
    """sha256 of values joined as ``-`` for null, else UTF-8 byte count, ``:``, value."""
    coded = []
    for value in values:
        text = value.cast("string")
        coded.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _parents(n: str, how=F.max) -> Column:
    """The number of nodes one level above ``n``."""
    up = F.expr(f"({n} + {FAN - 1}) div {FAN}")
    return (how(up) if how else up).alias("n")


def _before(frame: DataFrame, within: list[str], order: str, amount: str) -> DataFrame:
    """``frame`` with ``before``: the sum of ``amount`` over earlier rows (null first) of the same ``within``."""
    window = W.partitionBy(*within).orderBy(F.asc_nulls_first(order)).rowsBetween(W.unboundedPreceding, -1)
    return frame.withColumn("before", F.coalesce(F.sum(amount).over(window), F.lit(0).cast("long")))


def _met(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Left join in which null keys are equal; the right side's keys go."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(named, on, "left").drop(*[f"_{k}" for k in keys])


def _place_in_word() -> Column:
    return F.col("doc_id").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")


def words(ids: DataFrame) -> DataFrame:
    """(source, word, bits, extra, base) of (source, doc_id, n): the compressed bitmap of each source's ids.

    A word stands for 64 neighbouring ids and is stored only where one of them occurs (null ids have a null word,
    before all). ``bits`` are its ids, ``extra`` the further rows of ids that come more than once, ``base`` the rows
    in front of the word. Bases come from popcount directories: rows are counted for each 16-bit, 32-bit and 48-bit
    span of ids, and prefix sums are taken among the neighbours below one parent. A parent has at most 65,536 spans
    (a 16-bit one 1,024 words), so no window grows with a source.
    """
    at = _place_in_word()
    bit = F.expr(f"shiftleft(1L, cast(doc_id & {(1 << WORD_BITS) - 1} as int))")
    packed = ids.groupBy("source", F.shiftright("doc_id", WORD_BITS).alias("word")).agg(
        F.bit_or(bit).alias("bits"),
        F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > 1, F.struct(at.alias("at"), (F.col("n") - 1).alias("more")))).alias("extra"),
    )
    spans = {b: packed.withColumn(f"s{b}", F.shiftright("word", b - WORD_BITS)).groupBy("source", f"s{b}").agg(F.sum("n").alias("n")) for b in DIRECTORY}
    parents: list[str] = []
    placed = None
    for b in DIRECTORY:
        here = spans[b]
        for parent, up in zip(parents, DIRECTORY):
            here = here.withColumn(parent, F.shiftright(f"s{b}", up - b))
        here = _before(here, ["source", *parents[-1:]], f"s{b}", "n")
        if placed is not None:
            here = _met(here, placed, "source", parents[-1]).withColumn("before", F.col("before") + F.col("base"))
        placed = here.select("source", f"s{b}", F.col("before").alias("base"))
        parents.append(f"s{b}")
    last = f"s{DIRECTORY[-1]}"
    inner = _before(packed.withColumn(last, F.shiftright("word", DIRECTORY[-1] - WORD_BITS)), ["source", last], "word", "n")
    return _met(inner, placed, "source", last).select("source", "word", "bits", "extra", (F.col("before") + F.col("base")).alias("base"))


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, doc_id, leaf, ...) with ``place``, its row's place in its source by (doc_id, leaf), from 0.

    A rank is the word's base, the popcount of the word's lower bits and what repeated ids add; nothing is sorted.
    Rows that share an id are ordered by leaf: counts of the first 16 bits of the digest split even a hot id before
    the few rows behind one of them are numbered.
    """
    index = words(leaves.groupBy("source", "doc_id").agg(F.count("*").alias("n")))
    met = _met(leaves.withColumn("word", F.shiftright("doc_id", WORD_BITS)), index, "source", "word")
    met = met.withColumn("at", _place_in_word())
    lower = F.coalesce(F.expr("bit_count(bits & ~shiftleft(-1L, at))"), F.lit(0))
    more = F.expr("aggregate(extra, 0L, (sum, x) -> sum + if(x.at < at, x.more, 0L))")
    met = met.withColumn("place", F.col("base") + lower + more).withColumn("again", F.expr("exists(extra, x -> x.at <=> at)"))
    placed = saved(met.select(*leaves.columns, "place", "again"), "merkle-placed")

    ties = placed.where("again").withColumn("head", F.substring("leaf", 1, 4))
    heads = _before(ties.groupBy("source", "doc_id", "head").agg(F.count("*").alias("n")), ["source", "doc_id"], "head", "n").drop("n")
    near = W.partitionBy("source", "doc_id", "head").orderBy("leaf")
    own = _met(ties, heads, "source", "doc_id", "head").withColumn("place", F.col("place") + F.col("before") + F.row_number().over(near) - 1)
    return placed.where("not again").drop("again").union(own.select(*leaves.columns, "place"))


def _levels(nodes: DataFrame, group: str) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of each level, lowest first, and the tops (group, digest), of nodes (group, place, digest, n).

    n is the number of nodes of the group on that level. A slot array (group, place, slots) is keyed by its parent's
    place and holds the run's digests in order; the parent is its hash. Groups with a single node are done.
    """
    levels: list[DataFrame] = []
    tops = nodes.where("n = 1").select(group, "digest")
    most = nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        run = nodes.where("n > 1").groupBy(group, F.expr(f"place div {FAN}").alias("place")).agg(
            F.expr("transform(array_sort(collect_list(struct(place, digest))), x -> x.digest)").alias("slots"), _parents("n")
        )
        level = saved(run, "merkle-level")
        levels.append(level.select(group, "place", "slots"))
        nodes = level.select(group, "place", _digest(F.array_join("slots", "")).alias("digest"), "n")
        tops = tops.union(nodes.where("n = 1").select(group, "digest"))
        most = -(-most // FAN)
    return levels, tops


def _step(slots: str, slot: str) -> Column:
    """What stands in a run before and behind one of its slots."""
    return F.array(F.expr(f"struct(array_join(slice({slots}, 1, {slot}), '') as before, array_join(slice({slots}, {slot} + 2, {FAN}), '') as behind)"))


def _below(level: DataFrame, paths: DataFrame, group: str) -> DataFrame:
    """Slot arrays beside the path of the node they hash to, and its further columns."""
    named = level.select(*[F.col(c).alias(f"_{c}") for c in level.columns])
    return named.join(paths, F.col(f"_{group}").eqNullSafe(F.col(group)) & (F.col("_place") == F.col("place")))


def _paths(levels: list[DataFrame], group: str, above: DataFrame) -> DataFrame:
    """(group, place, path, ...) of the lowest nodes: for each level up to the root what is in its run before and behind.

    ``above`` is (group, path, ...) of the tops. Going down, a node's step among its run's slots stands in front of its
    parent's path, so that a path is worked out once for all leaves below it.
    """
    more = [c for c in above.columns if c not in (group, "path")]
    paths = above.withColumn("place", F.lit(0).cast("long"))
    for level in reversed(levels):
        down = _below(level, paths, group).select(group, F.col("_place").alias("up"), "_slots", "path", *more, F.posexplode("_slots").alias("slot", "digest"))
        step = F.concat(_step("_slots", "slot"), "path").alias("path")
        lower = down.select(group, (F.col("up") * FAN + F.col("slot")).alias("place"), step, *more)
        # a group with fewer levels starts where its single node is
        here = level.select(F.col(group).alias("_group")).distinct()
        single = paths.join(here, F.col("_group").eqNullSafe(F.col(group)), "left_anti").select(group, "place", "path", *more)
        paths = saved(lower.union(single), "merkle-paths")
    return paths


def _order(tops: DataFrame) -> DataFrame:
    """(source, digest, place): sources by UTF-8 bytes, null first; sorted in ranges, counted by range."""
    sorted_ = tops.repartitionByRange(F.asc_nulls_first("source")).sortWithinPartitions(F.asc_nulls_first("source"))
    placed = saved(sorted_.withColumn("at", F.monotonically_increasing_id()), "merkle-sources")
    part = F.shiftright("at", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = counts.withColumn("start", F.sum("n").over(W.orderBy("part")) - F.col("n"))  # one row a range
    own = placed.withColumn("part", part).join(starts.select("part", "start"), "part")
    return own.select("source", "digest", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("place"))


def fold_up(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings give."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.concat(x["before"], digest, x["behind"]).cast("binary"), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["behind"])), "")


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, doc_id, leaf, further columns) with subroot, root and path.

    Leaves ascend by doc_id in their source (null first, repeated ids by leaf; equal rows are leaves of their own).
    Every FAN neighbours become their hash until one node is left, the source's subroot; subroots, by source with null
    first, become the root alike. ``path`` is an array of (before, behind), the siblings from the leaf to the root. An
    empty table gives an empty result. Ids are ranked over bitmaps, and nodes are keyed by (source, place), so a source
    with most of the rows is spread like any other. Rows move into their run of FAN leaves once, and meet their path
    there.
    """
    payload = [c for c in leaves.columns if c != "source"]
    placed = ranked(leaves)
    sizes = leaves.groupBy("source").agg(F.count("*").alias("n"))
    slots = F.array_sort(F.collect_list(F.struct("place", *payload))).alias("slots")
    runs = _met(placed, sizes, "source").groupBy("source", F.expr(f"place div {FAN}").alias("place")).agg(slots, F.max("n").alias("n"))
    runs = saved(runs, "merkle-runs")
    hashed = F.when(F.col("n") > 1, _digest(F.array_join("slots.leaf", ""))).otherwise(F.col("slots")[0]["leaf"])
    levels, tops = _levels(runs.select("source", "place", hashed.alias("digest"), _parents("n", None)), "source")

    subroots = saved(_order(tops), "merkle-subroots")
    forest = subroots.select(F.lit(0).alias("all"), "place", "digest", F.lit(subroots.count()).cast("long").alias("n"))
    upper, roots = _levels(forest, "all")
    root = next((r.digest for r in roots.collect()), None)  # one row
    none = F.array().cast("array<struct<before:string,behind:string>>")
    top_paths = _paths(upper, "all", roots.select("all", none.alias("path")))
    above = subroots.join(top_paths.select("place", "path"), "place").select("source", "path", F.col("digest").alias("subroot"))

    met = _below(runs, _paths(levels, "source", above), "source").select("source", "_slots", "_n", "path", "subroot", F.posexplode("_slots").alias("slot", "own"))
    path = F.when(F.col("_n") > 1, F.concat(_step("_slots.leaf", "slot"), "path")).otherwise(F.col("path")).alias("path")
    return met.select("source", *[F.col("own")[c].alias(c) for c in payload], "subroot", F.lit(root).alias("root"), path)


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), *FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    plain = [F.col(f) for f in FIELDS]
    leaves = docs.select(
        "source", "doc_id", leaf_digest(*plain).alias("leaf"), F.when(tampered, leaf_digest(*plain[:-1], ascii_lower(plain[-1]))).alias("changed")
    )
    made = manifest(leaves)
    folded = fold_up(F.coalesce("changed", "leaf"), F.col("path"))
    return made.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels that the SQL unrolls: sources of up to 16^7 rows.
_DEPTH = 7
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_leaf(text: str) -> str:
    coded = [f"coalesce(strlen({v}::varchar) || ':' || {v}, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(coded)})"


def _sql_tree(name: str, group: str) -> str:
    """Levels ``name``0.. of nodes (group, place, digest, n): each adds what its run holds before and behind."""
    out = []
    for i in range(_DEPTH):
        out.append(f"""{name}{i + 1} as (select {group}, place // {FAN} as place, case when any_value(n) > 1 then sha256(string_agg(digest, '' order by place)) else any_value(digest) end as digest,
            (any_value(n) + {FAN - 1}) // {FAN} as n from {name}{i} group by {group}, place // {FAN})""")
        out.append(f"""{name}s{i} as (select {group}, place, digest, n,
            case when n > 1 then coalesce(string_agg(digest, '') over (partition by {group}, place // {FAN} order by place rows between unbounded preceding and 1 preceding), '') else '' end as before,
            case when n > 1 then coalesce(string_agg(digest, '') over (partition by {group}, place // {FAN} order by place rows between 1 following and unbounded following), '') else '' end as behind
            from {name}{i})""")
    return ", ".join(out)


def _sql_walk(name: str, group: str, below: str, column: str) -> str:
    """From ``below`` (id, group, place, proof, folded): the path through all levels of a tree; one-node levels pass."""
    out = []
    for i in range(_DEPTH):
        prior = below if i == 0 else f"{column}{i}"
        out.append(f"""{column}{i + 1} as (select b.* replace (b.proof || s.before || s.behind as proof,
            case when s.n > 1 then sha256(s.before || b.folded || s.behind) else b.folded end as folded, b.place // {FAN} as place)
            from {prior} b join {name}s{i} s on b.{group} is not distinct from s.{group} and b.place = s.place)""")
    return ", ".join(out)


SQL = f"""
with crc as (select list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
leaves as (select row_number() over () as id, doc_id, source, {_sql_leaf("text")} as leaf,
    case when (4294967295 - list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % {TAMPERED} = 0 then {_sql_leaf(_LOWER)} end as changed from documents, crc),
a0 as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place,
    count(*) over (partition by source) as n, leaf as digest from leaves),
{_sql_tree("a", "source")},
b0 as (select 0 as every, source, digest, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n from a{_DEPTH}),
{_sql_tree("b", "every")},
w0 as (select id, doc_id, source, leaf, place, '' as proof, coalesce(changed, leaf) as folded from a0),
{_sql_walk("a", "source", "w0", "w")},
v0 as (select w.id, w.doc_id, w.leaf, w.proof, w.folded, 0 as every, b.place, b.digest as subroot from w{_DEPTH} w join b0 b on w.source is not distinct from b.source),
{_sql_walk("b", "every", "v0", "v")}
select v.doc_id, v.leaf, v.subroot, b.digest as root, sha256(v.proof) as proof_sha256, v.folded as folded_root, v.folded = b.digest as verified
from v{_DEPTH} v, b{_DEPTH} b
"""
