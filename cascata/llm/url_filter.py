"""URL verdicts by host and path rules and by a list of canonical URLs, in DataFrame functions only.

A blocked Bloom filter of the listed URLs (256 bits to a block, eight words of 32 bits with one
bit each) is built by an aggregation per block and broadcast; the number of blocks is bounded, so
the broadcast is. What it lets pass goes to an exact hash join with the list, which removes the
false positives; the other rows are never shuffled.

Cases: a null URL and one without ``://`` have an empty host and path, fit no rule and are not
listed; repeated rows are judged each; a very frequent URL is a plain join key, which Spark's skew
join splits; an empty list or table works; extra columns are carried along, and of those that clash
with the result's names the result's win.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 8


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.`` and path without ``.html`` and closing slashes; null without a host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    short = F.regexp_replace(F.regexp_replace(path, r"\.html$", ""), "/+$", "")
    return F.when(host != "", F.concat(bare, short))


def _matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of rules of equal length the first given."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.name))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bit(url: Column, word: int) -> Column:
    place = F.shiftright(F.xxhash64(url, F.lit(1)), 5 * word).bitwiseAND(F.lit(31)).cast("int")
    return F.call_function("shiftleft", F.lit(1), place)


def bloom_filter(listed: DataFrame, url_column: str, blocks: int) -> DataFrame:
    """One row per block that holds a URL: its number and eight words."""
    url = F.col(url_column)
    bits = listed.where(url.isNotNull()).select(_block(url, blocks).alias("_block"), *(_bit(url, w).alias(f"_w{w}") for w in range(WORDS)))
    return bits.groupBy("_block").agg(*(F.bit_or(f"_w{w}").alias(f"_w{w}") for w in range(WORDS)))


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[Rule],
    url_column: str = "url",
    listed_column: str = "canonical_url",
    bits_per_url: int = 16,
    most_blocks: int = 1 << 19,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``canonical_url``, ``rule``, ``listed`` and ``verdict``.

    The filter has ``bits_per_url`` bits for each listed URL, up to ``most_blocks`` blocks of 32
    bytes: 16 MB of bits at the default, in at most 524,288 rows, which take some five times that as the
    hashed relation of a broadcast join. A longer list raises the share of false positives that reach the
    join, and changes no result.
    """
    names = ["host", "path", "canonical_url", "rule", "listed", "verdict"]
    exact = listed.select(F.col(listed_column).alias("_listed_url")).where("_listed_url is not null").distinct()
    blocks = max(1, min(most_blocks, -(-exact.count() * bits_per_url // (32 * WORDS))))
    filter_ = F.broadcast(bloom_filter(exact, "_listed_url", blocks))  # at most most_blocks rows
    url = F.col(url_column)
    kept = pages.drop(*(n for n in names if n != url_column))
    parsed = kept.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    parsed = parsed.withColumn("canonical_url", canonical(F.col("host"), F.col("path")))
    name, verdict = _matching_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("rule", name).withColumn("_verdict", verdict).withColumn("_block", _block(F.col("canonical_url"), blocks))
    probed = parsed.join(filter_, "_block", "left")
    hit = F.col("canonical_url").isNotNull()
    for w in range(WORDS):
        hit &= F.coalesce(F.col(f"_w{w}"), F.lit(0)).bitwiseAND(_bit(F.col("canonical_url"), w)) != 0
    probed = probed.withColumn("_hit", hit).drop("_block", *(f"_w{w}" for w in range(WORDS)))
    passed = probed.where("_hit").join(exact.hint("shuffle_hash"), F.col("canonical_url") == F.col("_listed_url"), "left")
    others = probed.where("not _hit").withColumn("_listed_url", F.lit(None).cast("string"))
    both = passed.unionByName(others).withColumn("listed", F.col("_listed_url").isNotNull())
    final = F.coalesce("_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return both.withColumn("verdict", final).select(*kept.columns, *names)
