"""URL filters by a cascade of Bloom filters, with DataFrame functions only.

A rule is a host and a path.  The keys a URL can match are its host suffixes joined to the starts of its path that are as long as some
rule's path.  All such keys of the corpus form the universe.  Level 1 of a cascade encodes the listed keys; level 2 the keys of the
universe that level 1 takes wrongly; level 3 the listed keys that level 2 takes wrongly, and so on until nothing is wrong.  A key is
listed if the first level that refuses it is an even one (or if no level refuses it and their number is odd).  Every URL of the corpus
therefore gets an exact answer from a few bits per rule, without a join.

Level 1 is sized so that about as many keys pass wrongly as are listed, from the number of distinct keys in the universe (a sketch,
merged across tasks); later levels halve.  All levels after the first are built from sets about as large as the rule list, so only the
universe is big, and it is never shuffled: only the few keys that level 1 passes are.  Each filter is a table of one row in the shared
folder; a scalar subquery hands it to the tasks once, so the plan holds no filter.  Its size is bounded by the number of rules
(``MAX_RULES``; more raise an error).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.common import adds, quoted
from lamina.session import cut_lineage

MAX_RULES = 1_000_000
WORD_BITS = 64


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(u, r"(?s)^(?:(?!://).)*+://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    return F.regexp_extract(u, r"(?s)^(?:(?!://).)*+://[^/?#]*([^?#]*)", 1)


def keys(host_column: str, path_column: str, label_counts: list[int], path_lengths: list[int]) -> Column:
    """Distinct keys that a rule for this URL could have: host suffixes of as many labels times starts of the path as long as some rule's."""
    n_labels = f"char_length({host_column}) - char_length(replace({host_column}, '.', '')) + 1"
    suffixes = f"filter(transform(array({', '.join(map(str, label_counts))}), n -> IF(n <= {n_labels}, substring_index({host_column}, '.', -n), NULL)), h -> h IS NOT NULL)"
    starts = f"filter(transform(array({', '.join(map(str, path_lengths))}), n -> IF(n <= char_length({path_column}), substring({path_column}, 1, n), NULL)), p -> p IS NOT NULL)"
    return F.expr(f"array_distinct(flatten(transform({suffixes}, h -> transform({starts}, p -> concat(h, p)))))")


def _bits(key: str, level: int, m: int, k: int) -> str:
    """SQL: the k bit numbers of a key at one level."""
    return f"transform(sequence(0, {k - 1}), j -> pmod(xxhash64({key}, {level}, j), {m}L))"


class Level:
    """One Bloom filter: ``m`` bits as 64-bit words, ``k`` bits a key; ``words`` is a written table of one row that holds them all."""

    def __init__(self, listed: DataFrame, name: str, number: int, count: int, share: float):
        self.column = f"__{name}_{number}"
        self.number = number
        self.k = max(1, round(-math.log2(share)))
        self.m = max(WORD_BITS, math.ceil(-count * math.log(share) / math.log(2) ** 2))
        bits = listed.select(F.explode(F.expr(_bits("key", number, self.m, self.k))).alias("bit"))
        marked = bits.select(F.expr(f"bit div {WORD_BITS}").alias("w"), F.expr(f"shiftleft(1L, CAST(bit % {WORD_BITS} AS int))").alias("v"))
        blank = listed.sparkSession.range(self.m // WORD_BITS + 1).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v"))
        filled = marked.union(blank).groupBy("w").agg(F.bit_or("v").alias("v"))
        # bounded: m / 64 words
        self.words = cut_lineage(filled.agg(F.expr("transform(array_sort(collect_list(struct(w, v))), x -> x.v)").alias("words")))

    def has(self, key: str) -> str:
        """SQL over rows with this level's column (see ``holding``): whether all bits of a key are set."""
        return f"forall({_bits(key, self.number, self.m, self.k)}, b -> getbit(get({self.column}, CAST(b div {WORD_BITS} AS int)), CAST(b % {WORD_BITS} AS int)) = 1)"


def holding(df: DataFrame, levels: list[Level]) -> DataFrame:
    """``df`` with the filter of each level as a column, read once and handed to all tasks."""
    return df.select("*", *(level.words.scalar().alias(level.column) for level in levels))


def cascade(listed: DataFrame, universe: DataFrame, distinct: int, name: str = "listed", limit: int = 64) -> list[Level]:
    """Levels that tell listed keys from all others of the universe (both: column ``key``)."""
    inside = cut_lineage(listed.select("key").distinct())
    n = inside.count()
    if not n:
        return []
    share = min(0.5, max(1e-12, n / math.sqrt(2) / max(1, distinct)))
    levels = [Level(inside, name, 1, n, share)]

    def passed(df: DataFrame) -> DataFrame:
        return holding(df.select("key"), levels[-1:]).where(levels[-1].has("key")).select("key")

    # what passes the level wrongly; about as many keys as are listed
    this, other = inside, cut_lineage(passed(universe).distinct().join(F.broadcast(inside), "key", "left_anti"))
    while (count := other.count()) and len(levels) < limit:
        levels.append(Level(other, name, len(levels) + 1, count, 0.5))
        this, other = other, cut_lineage(passed(this))
    if count:
        raise ValueError("the cascade doesn't end")
    return levels


def member(levels: list[Level], key: str) -> str:
    """SQL over rows that hold the levels: whether a key of the universe is listed."""
    out = "true" if len(levels) % 2 else "false"
    for level in reversed(levels):
        out = f"CASE WHEN NOT {level.has(key)} THEN {'false' if level.number % 2 else 'true'} ELSE {out} END"
    return out


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows as a table without Python rows behind it."""
    text = "array(" + ", ".join("named_struct('verdict', {}, 'host', {}, 'path', {})".format(*("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in r)) for r in rules) + ")"
    return spark.sql(f"SELECT inline({text})")


def judge(df: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict (columns of these names give way).

    ``rules``: (verdict, host, path), verdict 'allow' or 'block'.  A rule fits its host and all subdomains if the path starts with the
    rule's.  The longest fitting key (host and path together) wins; of equally long ones the longer host; a key that is both allowed
    and blocked is blocked.  ``otherwise`` is the verdict where none fits: unlisted URLs are allowed, as the filter lists what to judge.
    Null URLs and those without ``://`` have an empty host and path and fit no rule with a host; repeated rows stay; an empty table or
    an empty rule list is fine.  Rules that no URL can have (a host with a slash, a path without one in front) fit nothing.  A URL is cut
    only where some rule could end, so hosts of many labels and long paths cost no more than others.
    """
    host_of, path_of = F.lower(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))
    listed = cut_lineage(rules.select("verdict", host_of.alias("host"), path_of.alias("path")).where(r"NOT host RLIKE '[/?#]' AND (path = '' OR startswith(path, '/'))").distinct())
    labels = F.expr("char_length(host) - char_length(replace(host, '.', '')) + 1")
    shape = listed.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(labels)).alias("labels"), F.array_sort(F.collect_set(F.char_length("path"))).alias("lengths")).first()
    if shape["n"] > MAX_RULES:
        raise ValueError(f"{shape['n']} rules: more than {MAX_RULES}")
    kept = adds(df, "host", "path", "rule", "verdict")
    split = df.select(*quoted(kept), host(F.col(quoted([url])[0])).alias("host"), path(F.col(quoted([url])[0])).alias("path"))
    if not shape["n"]:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    own = keys("host", "path", shape["labels"], shape["lengths"])
    universe = split.select("host", "path").select(F.explode(own).alias("key"))
    distinct = universe.agg(F.approx_count_distinct("key")).first()[0]
    filters = {}
    for verdict in ("block", "allow"):
        filters[verdict] = cascade(listed.where(F.col("verdict") == verdict).select(F.concat("host", "path").alias("key")), universe, distinct, verdict)
    is_block, is_allow = member(filters["block"], "k"), member(filters["allow"], "k")
    order = "'n', char_length(k), 'h', char_length(substring_index(k, '/', 1))"
    matched = F.expr(f"array_max(filter(transform(__keys, k -> CASE WHEN {is_block} THEN named_struct({order}, 'block', true, 'key', k) WHEN {is_allow} THEN named_struct({order}, 'block', false, 'key', k) END), x -> x IS NOT NULL))")
    out = holding(split.withColumn("__keys", own), [level for levels in filters.values() for level in levels]).withColumn("__hit", matched)
    verdict = F.when(F.col("__hit.block"), "block").when(~F.col("__hit.block"), "allow").otherwise(otherwise)
    return out.select(*quoted(kept), "host", "path", F.col("__hit.key").alias("rule"), verdict.alias("verdict"))
