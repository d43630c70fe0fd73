"""URL filters: host rules, and a list of canonical URLs behind a blocked Bloom filter. DataFrame functions only.

A URL's canonical form is its host (A-Z lower-cased, one leading `www.` or `m.` dropped) and its path without `/` at the end;
scheme, query and fragment don't count. The filter is a table of 256-bit blocks made by bit_or; a URL looks at the one block
of its hash, and only URLs whose eight bits are all set go on to an exact join with the list, which removes false positives.
Null URLs and such without `://` have an empty host and path, fit no rule and are on no list.

The filter is broadcast where its size, which follows from the list's count, is at most `broadcast` bytes. Beyond, the pages'
distinct canonical URLs meet it by block, then the list, and only page rows of a listed URL's partition travel: the pages join the
listed URLs found, which Spark broadcasts while they are few. Copies of a URL are one row on the way through the filter, and AQE
splits a hot one in the joins.

Up to `inline` rules are conditions of the plan. More are a table: each distinct host gets the rules of its domains, longest
first, and takes the first whose path fits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_WORDS, _BITS = 4, 8


@dataclass(frozen=True)
class Config:
    #: Bits of the filter for each listed URL.
    bits: int = 16
    broadcast: int = 8 << 20
    #: So many rules at most are conditions of the plan.
    inline: int = 200


def host(url: Column) -> Column:
    return F.translate(_raw_host(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def _raw_host(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*", 0)


def path(url: Column) -> Column:
    return F.regexp_extract(F.substr(_rest(url), F.length(_raw_host(url)) + 1), "^[^?#]*", 0)


def canonical(host_: Column, path_: Column) -> Column:
    """Null without host."""
    return F.when(host_ != "", F.concat(F.regexp_replace(host_, r"^(?:www|m)\.", ""), F.regexp_replace(path_, "/+$", "")))


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest (verdict, host, path) rule that fits, as its string, and its verdict; nulls where none fits. Of equal length, the first in the alphabet."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[2], r[0]))
    name = verdict = None
    for v, h, p in ordered:
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        name, verdict = (F.when(fits, x) if so_far is None else so_far.when(fits, x) for so_far, x in ((name, h + p), (verdict, v)))
    return (F.lit(None).cast("string"),) * 2 if name is None else (name, verdict)


def _with_rules(seen: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """seen (host, path) with rule and _v, by a table of rules: as rule_of."""
    spark = seen.sparkSession
    table = spark.createDataFrame(rules, "v string, h string, p string").groupBy("h").agg(F.collect_set(F.struct((-F.length("h") - F.length("p")).alias("n"), F.concat("h", "p").alias("rule"), "p", "v")).alias("own"))
    parts = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = seen.select("host").distinct().select("host", F.explode(domains).alias("h")).join(table, "h")
    known = hosts.groupBy("host").agg(F.sort_array(F.flatten(F.collect_list("own"))).alias("_rules"))
    best = F.get(F.filter("_rules", lambda r: F.startswith(F.col("path"), r["p"])), 0)
    return seen.join(known, "host", "left").withColumn("_best", best).select(*seen.columns, F.col("_best.rule").alias("rule"), F.col("_best.v").alias("_v"))


def _places(blocks: int) -> tuple[Column, list[Column]]:
    """Block of the URL in _u and, for each of its words, the bits to set."""
    bit = lambda i: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(1, _u), {6 * i}) & 63 as int))")
    return F.pmod(F.xxhash64("_u"), F.lit(blocks)), [bit(w).bitwiseOR(bit(w + _WORDS)) for w in range(_WORDS)]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of listed (one column, _u): block and its words."""
    block, words = _places(blocks)
    return listed.select(block.alias("_block"), *(w.alias(f"_w{i}") for i, w in enumerate(words))).groupBy("_block").agg(*(F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(_WORDS)))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], config: Config = Config(), url: str = "url", listed_url: str = "url") -> DataFrame:
    """pages with host, path, rule, listed (whether the canonical URL is on the list) and verdict: the rule's, else block if listed, else allow.

    Columns of these names are replaced. listed holds URLs in any form; nulls, and such without host, aren't listed.
    """
    base = pages.drop("host", "path", "rule", "listed", "verdict", "_u", "_block", "_v", "_rules", "_best")
    u = F.col(url)
    seen = base.withColumn("host", F.coalesce(host(u), F.lit(""))).withColumn("path", F.coalesce(path(u), F.lit("")))
    if len(rules) <= config.inline:
        name, verdict = rule_of(F.col("host"), F.col("path"), rules)
        seen = seen.withColumns({"rule": name, "_v": verdict})
    else:
        seen = _with_rules(seen, rules)
    seen = seen.withColumn("_u", canonical(F.col("host"), F.col("path")))
    on_list = listed.select(canonical(host(F.col(listed_url)), path(F.col(listed_url))).alias("_u")).where("_u is not null").distinct()
    total = on_list.count()
    blocks = max(1, -(-total * config.bits // (64 * _WORDS)))
    table = bloom(on_list, blocks)
    block, words = _places(blocks)
    hit = F.lit(True)
    for i, w in enumerate(words):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(w) == w)
    hit = F.coalesce(hit & F.col("_u").isNotNull(), F.lit(False))
    marked = on_list.withColumn("listed", F.lit(True))
    if blocks * 8 * (_WORDS + 1) <= config.broadcast:
        probe = seen.withColumn("_block", F.when(F.col("_u").isNull(), F.pmod(F.xxhash64(url), F.lit(blocks))).otherwise(block)).join(F.broadcast(table), "_block", "left")
        sure = probe.where(hit).select(*seen.columns).join(marked, "_u", "left").select(*seen.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
        out = probe.where(~hit).select(*seen.columns, F.lit(False).alias("listed")).unionByName(sure)
    else:
        passed = seen.select("_u").where("_u is not null").distinct().withColumn("_block", block).join(table, "_block").where(hit).select("_u")
        found = passed.join(marked, "_u")
        # a null URL is on no list; a key of its own row keeps such rows from meeting in one task
        side = seen.withColumn("_block", F.coalesce("_u", F.concat(F.lit("?"), F.monotonically_increasing_id().cast("string"))))
        out = side.join(found.select(F.col("_u").alias("_block"), "listed"), "_block", "left").select(*seen.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    return out.withColumn("verdict", F.coalesce("_v", F.when(F.col("listed"), "block").otherwise("allow"))).select(*base.columns, "host", "path", "rule", "listed", "verdict")
