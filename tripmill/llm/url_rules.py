"""URL filters: nested host and path rules as intervals, found by a sorted sweep.

A url's host is cut into its suffixes and each is written with its labels reversed
(``com``, ``com.example``, ``com.example.www``). Under one such key a rule is an interval of
paths: all that start with the rule's path. Rules and urls are sorted together by path, and
each url takes over the stack of nested rules of the last rule before it. The deepest one
on that stack whose interval reaches the url is the rule of that host key; of the keys'
rules the longest wins.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import ascii_lower

RULE_SCHEMA = "host string, path string, verdict string"

# (host, path, verdict), fixed by the query's contract.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

ROWS_PER_SWEEP = 5_000


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat_ws(".", F.reverse(F.split(host, r"\.")))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Per host key and path: the rules there whose paths are prefixes of it, shortest first.

    A rule is found by its path among the prefixes of the other, by an equi-join.
    """
    clean = (
        rules.where(F.col("host").isNotNull() & F.col("verdict").isin("allow", "block"))
        .groupBy(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max("verdict").alias("verdict"))
        .select(reversed_host(F.col("host")).alias("key"), "path", "verdict", F.concat("host", "path").alias("rule"))
    )
    outer = clean.select("key", F.col("path").alias("start"), "verdict", "rule")
    return (
        clean.select("key", "path", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n"))
        .select("key", "path", F.expr("substring(path, 1, n)").alias("start"))
        .join(outer, ["key", "start"])
        .groupBy("key", "path")
        .agg(F.array_sort(F.collect_list(F.struct(F.length("start").alias("n"), "start", "rule", "verdict"))).alias("stack"))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", rows_per_sweep: int = ROWS_PER_SWEEP) -> DataFrame:
    """Each page with the ``host``, ``path``, ``rule`` and ``verdict`` of its ``url``.

    A rule fits its host and all subdomains if the url's path starts with the rule's. The
    rule with the longest host and path wins, the longer host among equals; two verdicts for
    one host and path count as block. Without a rule the verdict is ``default``. Null urls
    and urls without ``://`` have an empty host and path. Every input row is returned once
    with its other columns, repeated rows as often as they occur; columns of the input named
    like the four added ones are replaced. Empty tables give no rows, and no rules leave
    every url to the default.

    Equal urls are judged once. Keys that hold many urls are swept in several parts, each
    beside a copy of that key's rules; ``rows_per_sweep`` is the size of a part, or eight times
    the number of those rules if that is more, so that copies stay few beside the urls.
    """
    url = pages.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    stacks = rule_stacks(rules)
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1  # no rule lies deeper
    keyed = (
        url.select("host", "path")
        .distinct()
        .withColumn("labels", F.reverse(F.split("host", r"\.")))
        .withColumn("n", F.explode(F.expr(f"sequence(1, least(size(labels), {deepest}))")))
        .select("host", "path", F.expr("concat_ws('.', slice(labels, 1, n))").alias("key"))
        .join(stacks.select("key").distinct(), "key", "left_semi")
    )
    counts, sizes = keyed.groupBy("key").agg(F.count("*").alias("urls")), stacks.groupBy("key").agg(F.count("*").alias("rules"))
    size = F.greatest(F.lit(rows_per_sweep), 8 * F.col("rules"))
    parts = counts.join(sizes, "key").select("key", F.ceil(F.col("urls") / size).cast("int").alias("parts"))
    urls = keyed.join(parts, "key").select(
        "key", F.pmod(F.xxhash64("host", "path"), F.col("parts")).cast("int").alias("part"), "path", "host", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack")
    )
    marks = stacks.join(parts, "key").select(
        "key", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "path", F.lit(None).cast("string").alias("host"), "stack"
    )
    sweep = Window.partitionBy("key", "part").orderBy("path", F.col("host").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    best = F.max(F.struct(F.length("rule"), F.length("key"), F.col("verdict"), F.col("rule")))
    found = (
        marks.unionByName(urls)
        .withColumn("open", F.last("stack", ignorenulls=True).over(sweep))
        .where(F.col("host").isNotNull())
        .withColumn("fits", F.expr("filter(open, r -> startswith(path, r.start))"))
        .where(F.size("fits") > 0)
        .select("host", "path", "key", F.element_at("fits", -1).alias("r"))
        .select("host", "path", "key", "r.rule", "r.verdict")
        .groupBy("host", "path")
        .agg(best.alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    return url.join(found, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def contract_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_SCHEMA)
