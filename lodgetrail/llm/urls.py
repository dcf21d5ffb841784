"""Verdicts on URLs by rules of host and path: a blocked Bloom filter in front of an exact hash join.

A rule fits a URL if the URL's host is the rule's or below it and its path
starts with the rule's path. So a URL can only be fitted by the rules that have
the last labels of its host and the first letters of its path, as many of each
as some rule has: these are its probes. Each probe asks one block of the filter,
and only those that may be listed go on to the exact join.

Everything here is DataFrame expressions; no row leaves the JVM.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodgetrail.operators import enrich, pick

BITS_PER_RULE = 16
#: A block is as long as a cache line; a key sets one bit in each of its words.
WORDS, WORD_BITS = 8, 64
#: The filter's blocks, some 100 bytes each as rows, go to every executor. Rules beyond what they hold well
#: let more probes pass, which the exact join then removes.
MOST_BLOCKS = 1 << 16
#: Rules of up to this many bytes go to every executor; more are joined by a shuffle.
BROADCAST_RULES = 32 << 20

ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, in lower case, and what follows that up to ``?`` or ``#``.

    Only A to Z are lowered. Both are empty for a NULL url and one without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    lowered = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(at > 0, lowered).otherwise(""), F.when(at > 0, path).otherwise("")


def labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """``rule_host``, ``rule_path``, ``verdict``, each host and path once.

    A NULL path is empty. Rules without a host or a verdict are left out. Of
    equal rules with several verdicts ``block`` counts, as the last in order.
    """
    host = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    named = rules.select(host.alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
    known = named.where((F.col("rule_host") != "") & F.col("verdict").isNotNull())
    return known.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("rule_host", "rule_path"), F.lit(blocks))


def _masks() -> list[Column]:
    """For each word of the block, the bit this key sets there."""
    bits = F.xxhash64("rule_path", "rule_host")
    places = [F.shiftrightunsigned(bits, 6 * n).bitwiseAND(F.lit(WORD_BITS - 1)) for n in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int")) for place in places]


def bloom_filter(rules: DataFrame, blocks: int) -> DataFrame:
    """``block``, ``w0`` to ``w7``: the blocks that hold a rule, their words put together by bitwise or."""
    masked = rules.select(_block(blocks).alias("block"), *[m.alias(f"w{n}") for n, m in enumerate(_masks())])
    return masked.groupBy("block").agg(*[F.bit_or(f"w{n}").alias(f"w{n}") for n in range(WORDS)])


def probes(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """``host``, ``path`` with each ``rule_host``, ``rule_path`` that a rule of these shapes would need to have."""
    listed = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("letters")) for n, m in shapes])
    opened = urls.where(F.col("host") != "").select("host", "path", F.explode(listed).alias("shape"))
    long_enough = (labels(F.col("host")) >= F.col("shape.labels")) & (F.length("path") >= F.col("shape.letters"))
    return opened.where(long_enough).select(
        "host",
        "path",
        F.expr("substring_index(host, '.', -shape.labels)").alias("rule_host"),
        F.expr("substring(path, 1, shape.letters)").alias("rule_path"),
    )


def possible_hits(probed: DataFrame, rules: DataFrame, count: int) -> DataFrame:
    """The probes whose bits are all set in their block of the filter over ``rules``."""
    blocks = min(MOST_BLOCKS, max(1, -(-count * BITS_PER_RULE // (WORDS * WORD_BITS))))
    held = F.broadcast(bloom_filter(rules, blocks))  # at most MOST_BLOCKS rows of nine numbers
    asked = probed.withColumn("block", _block(blocks)).join(held, "block")
    for n, mask in enumerate(_masks()):
        asked = asked.where(F.col(f"w{n}").bitwiseAND(mask) == mask)
    return asked.select(*probed.columns)


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict``: for each host and path that a rule fits, the longest such rule.

    Lengths are of host and path together; of equally long ones the longer host
    wins. ``rules`` are canonical ones.
    """
    shape = F.struct(labels(F.col("rule_host")).alias("labels"), F.length("rule_path").alias("letters"))
    # Two numbers, and as many pairs as rules have label counts and path lengths.
    found = rules.agg(F.count("*").alias("rules"), F.collect_set(shape).alias("shapes")).first()
    shapes = sorted((s["labels"], s["letters"]) for s in found["shapes"])
    rule = F.concat("rule_host", "rule_path")
    if not shapes:
        none = F.lit(None).cast("string")
        return urls.where("false").select("host", "path", none.alias("rule"), none.alias("verdict"))
    hits = possible_hits(probes(urls, shapes), rules, found["rules"])
    exact = hits.join(enrich.broadcast_if_small(rules, BROADCAST_RULES), ["rule_host", "rule_path"])
    longest = F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host"), rule.alias("rule"), "verdict"))
    return exact.groupBy("host", "path").agg(longest.alias("best")).select("host", "path", "best.rule", "best.verdict")


def judged(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` for every row of ``pages``, repeated rows and NULL keys included.

    ``rules`` has ``host``, ``path`` and ``verdict``. Where no rule fits,
    ``rule`` is NULL and the verdict is ``default``: only listed URLs are
    judged. Only ``key`` and ``url`` are read, whatever other columns there
    are. An empty table of pages gives no rows, one of rules the default for
    all. URLs of any length are handled whole.

    A URL that a third of the rows have is one row per task in the grouping,
    and adaptive execution splits its rows in the join back.
    """
    rules = canonical_rules(rules)
    host, path = host_and_path(F.col(url))
    urls = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    # Host, then path: a host holds no slash and a path that is not empty starts with one.
    site = F.concat("host", "path")
    verdicts = fitting_rules(urls, rules).select(site.alias("site"), "rule", "verdict")
    fitted = pick.join_by_key(urls.withColumn("site", site), verdicts, "site", "left")
    return fitted.select(key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, listed: list[tuple[str, str, str]]) -> DataFrame:
    """A few rules, (host, path, verdict) each, as a table."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in listed]
    return spark.range(1).select(F.inline(F.array(*rows)))
