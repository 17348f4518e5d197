"""URL filters: host and path rules, then exact membership by a cascade of Bloom filters."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.store import keep
from wattloom.llm.text import lower_ascii

#: The rules of the contract, verdict by host and path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
BITS_PER_KEY, HASHES = 10, 4
#: Keys in one level of a slice of a cascade, some 125 KB of filter.
SLICE_KEYS = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, lower-cased, and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits; the first of equal lengths."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


class Level:
    """One Bloom filter of a cascade for each slice of the keys, as arrays of 64-bit words.

    A single slice is a constant of the plan; several are a table ``slice, level_<n>``.
    """

    def __init__(self, members: DataFrame, number: int, slices: int):
        self.number, self.name = number, f"level_{number}"
        most = members.groupBy("slice").count().agg(F.max("count")).first()[0]
        n_words = max(1, -(-most * BITS_PER_KEY // 64))
        self.bits = 64 * n_words
        spots = members.select("slice", F.explode(F.array(*self._positions(F.col("key")))).alias("spot"))
        set_bits = spots.select(
            "slice", F.expr("spot div 64").alias("word"), F.expr("shiftleft(1L, CAST(spot % 64 AS INT))").alias("bits")
        )
        empty = members.sparkSession.range(slices * n_words).selectExpr(
            f"id div {n_words} AS slice", f"id % {n_words} AS word", "0L AS bits"
        )
        by_word = set_bits.unionByName(empty).groupBy("slice", "word").agg(F.bit_or("bits").alias("bits"))
        # The words of a slice are bounded by SLICE_KEYS.
        filled = F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"]
        table = by_word.groupBy("slice").agg(filled.alias(self.name))
        if slices == 1:
            self.table, self.words = None, F.from_json(F.lit(json.dumps(table.first()[1])), "array<bigint>")
        else:
            self.table, self.words = keep(table, f"cascade-level-{number}"), F.col(self.name)

    def _positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(j)), F.lit(self.bits)) for j in range(HASHES)]

    def beside(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the filter of their slice."""
        return rows if self.table is None else rows.join(self.table, "slice")

    def has(self, key: Column) -> Column:
        def bit(spot: Column) -> Column:
            word = F.get(self.words, F.floor(spot / 64).cast("int"))
            return F.getbit(word, F.pmod(spot, F.lit(64)).cast("int")) == 1

        return reduce(Column.__and__, [bit(p) for p in self._positions(key)])


def cascade(universe: DataFrame, slices: int) -> list[Level]:
    """Filters for ``universe`` of distinct keys ``(key, listed, slice)``.

    Level 1 holds the listed keys, level 2 the unlisted ones that level 1 lets through, level 3
    the listed ones that level 2 lets through, and so on until none is left. Over the universe
    the answer is then exact.
    """
    members, others, levels = universe.where("listed"), universe.where("NOT listed"), []
    while not members.isEmpty():
        level = Level(members, len(levels) + 1, slices)
        levels.append(level)
        if len(levels) > 40:
            raise ValueError("the cascade does not end: keys repeat with both marks")
        passed = level.beside(others).where(level.has(F.col("key"))).select("key", "listed", "slice")
        members, others = keep(passed, f"cascade-{len(levels)}"), members
    return levels


def listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed; the filters of its slice are beside it."""
    answer = F.lit(False)
    for level in reversed(levels):
        answer = level.has(key) & ~answer
    return answer


def _slice(key: Column, slices: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(slices)).cast("long").alias("slice")


def filter_urls(pages: DataFrame, blocklist: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    A fitting rule decides; otherwise the page is blocked if its ``host || path`` is among the
    keys of ``blocklist`` (column ``key``; null keys and repeats are ignored). The keys of the
    pages are the universe over which a cascade of filters is exact. As long as no level holds
    more than ``SLICE_KEYS`` keys, listed ones or false positives among the others, the filters are
    constants of the plan and the pages are only mapped; beyond that the keys are cut into slices
    by a hash, and every page meets the filters of its slice. Null
    urls have an empty host and path. Every row is judged by itself.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("key", F.concat("host", "path"))
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("*", rule.alias("rule"), said.alias("said"))
    keys = parsed.select("key").distinct()
    marks = blocklist.select("key").where("key IS NOT NULL").distinct().withColumn("mark", F.lit(True))
    universe = keys.join(marks, "key", "left").select("key", F.expr("mark IS NOT NULL").alias("listed"))
    universe = keep(universe, "url-universe")
    n = universe.agg(F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("others")).first()
    # The second level holds what the first lets through of all other keys, give or take a tenth.
    passing = 1.1 * (1 - math.exp(-HASHES / BITS_PER_KEY)) ** HASHES
    slices = max(1, math.ceil(max(n.listed, passing * n.others) / SLICE_KEYS))
    levels = cascade(universe.select("*", _slice(F.col("key"), slices)), slices)
    beside = parsed.select("*", _slice(F.col("key"), slices))
    for level in levels:
        beside = level.beside(beside)
    judged = beside.withColumn("listed", listed(levels, F.col("key")))
    verdict = F.when(F.col("said").isNotNull(), F.col("said")).when(F.col("listed"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all pages.

    The tables carry no blocklist, so every key whose MD5 begins with 0 is listed.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    key = F.concat(*host_and_path(F.col("url")))
    return filter_urls(pages, pages.select(key.alias("key")).where(F.md5("key").startswith("0")))


OP5_SQL = r"""
WITH p AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), q AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM p
), r AS (
    SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS t(said, rule_host, rule_path)
), f AS (
    SELECT page_id, arg_max(rule_host || rule_path, len(rule_host || rule_path)) AS rule,
           arg_max(said, len(rule_host || rule_path)) AS said
    FROM q JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN md5(host || path)[1] = '0' THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN f USING (page_id)
"""
