"""URL filter: a Bloom filter cascade over the corpus's complete key universe.

Level 0 encodes the listed keys. The keys of the universe that are not listed
but hit level 0 (its false positives) are encoded in level 1, the listed keys
that hit level 1 in level 2, and so on until a level has no false positive.
A key of the universe is then judged exactly by the first level it misses:
no join, no key lookup. The filters are arrays of 64-bit words, built by
``bit_or`` aggregates and read as scalar subqueries; their size follows the
list (about ``BITS_PER_KEY`` bits a listed key, geometrically less for each
later pair of levels), not the pages, and is checked against ``max_bits``.

Defined results: a null URL or one without ``://`` has an empty host and path
and is allowed; null and empty listed keys are ignored; repeated rows are
judged alike; an empty list allows every key; an empty table gives no rows.
Further columns of the input are ignored unless they are the id or URL column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import lower_ascii, staged

BITS_PER_KEY = 10
MAX_BITS = 1 << 28


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased A-Z."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_keys(host: Column) -> Column:
    """The host and its parent domains of two labels or more (a host of one
    label: itself; an empty host: none)."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, n), "."),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(parents)


def _positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(hashes)]


def _words(keys: DataFrame, level: int, hashes: int, bits: int) -> DataFrame:
    """One row: the filter of ``keys`` as an array of ``bits / 64`` words."""
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, hashes, bits))).alias("p"))
    some = (
        at.withColumn("w", F.expr("shiftleft(1L, cast(p % 64 as int))"))
        .groupBy(F.expr("p div 64").alias("i"))
        .agg(F.bit_or("w").alias("w"))
    )
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w"))
    filled = some.unionByName(every).groupBy("i").agg(F.bit_or("w").alias("w"))
    return filled.agg(F.expr("transform(sort_array(collect_list(struct(i, w))), x -> x.w)").alias("words"))


@dataclass
class Level:
    words: DataFrame
    number: int
    hashes: int
    bits: int

    @property
    def column(self) -> str:
        return f"__filter{self.number}"

    def hit(self, key: Column) -> Column:
        """Needs the columns of ``with_filters``."""
        words = F.col(self.column)
        tests = [
            F.getbit(F.get(words, F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1
            for p in _positions(key, self.number, self.hashes, self.bits)
        ]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


def build_cascade(
    universe: DataFrame, listed: DataFrame, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS
) -> list[Level]:
    """The cascade of ``listed`` (column ``key``) over ``universe`` (``key``,
    repeats allowed). Raises when one filter would pass ``max_bits``."""
    keys = staged(
        universe.select("key", F.lit(False).alias("listed"))
        .unionByName(listed.select("key", F.lit(True).alias("listed")))
        .filter(F.col("key").isNotNull() & (F.col("key") != ""))
        .groupBy("key")
        .agg(F.max("listed").alias("listed")),
        "url-keys",
    )
    inside, outside = keys.filter("listed").select("key"), keys.filter("not listed").select("key")
    hashes = max(1, round(bits_per_key * math.log(2)))
    levels: list[Level] = []
    n = inside.count()
    while n:
        bits = 64 * math.ceil(n * bits_per_key / 64)
        if bits > max_bits:
            raise ValueError(f"a filter of {n} keys needs {bits} bits, over max_bits={max_bits}")
        number = len(levels)
        level = Level(staged(_words(inside, number, hashes, bits), "url-filter"), number, hashes, bits)
        levels.append(level)
        wrong = staged(with_filters(outside, [level]).filter(level.hit(F.col("key"))).select("key"), "url-wrong")
        inside, outside = wrong, inside
        n = wrong.count()
    return levels


def with_filters(df: DataFrame, levels: list[Level]) -> DataFrame:
    """``df`` with each level's filter as a column: a scalar subquery, whose
    one value every row refers to."""
    return df.select("*", *[level.words.scalar().alias(level.column) for level in levels])


def is_listed(levels: list[Level], key: Column) -> Column:
    """Exact for keys of the universe: the first missed level decides."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(~level.hit(key), F.lit(level.number % 2 == 1)).otherwise(out)
    return out


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    bits_per_key: int = BITS_PER_KEY,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Judge every page: the longest fitting rule, else the cascade over the
    listed domains (a domain covers its subdomains).

    -> ``<id_col>, host, path, rule, verdict, listed``.
    """
    urls = pages.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    universe = urls.select("host").distinct().select(F.explode(host_keys(F.col("host"))).alias("key"))
    levels = build_cascade(universe, listed, bits_per_key, max_bits)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name)):
        host = F.col("host")
        fits = ((host == r.host) | host.endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule = F.when(fits, F.lit(r.name)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    in_list = F.exists(F.col("keys"), lambda k: is_listed(levels, k)) if levels else F.lit(False)
    return (
        with_filters(urls.withColumn("keys", host_keys(F.col("host"))), levels)
        .withColumn("listed", in_list)
        .withColumn("rule", rule)
        .withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")))
        .select(id_col, "host", "path", "rule", "verdict", "listed")
    )
