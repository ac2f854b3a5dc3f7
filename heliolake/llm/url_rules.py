"""URL allow and block rules by a sorted sweep over reversed-host intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliolake.llm.shared import written

RULE_SCHEMA = "host string, path string, verdict string"
#: Sorts after every character that a URL can hold (the last code point).
END = "\U0010ffff"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; else ''."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end; else ''."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column, most: Column) -> Column:
    """The host and the domains above it that have at most ``most`` labels, the shortest first;
    none for an empty host. So a host of very many labels has no more suffixes than the longest
    rule has labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when((host == "") | (most < 1), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.least(n, most)),
                    lambda i: F.array_join(F.slice(labels, n - i + F.lit(1), i), ".")))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               spread: int = 8) -> DataFrame:
    """The longest fitting rule of every URL.

    A rule (host, path, verdict) fits its host and all its subdomains where the URL's path
    starts with the rule's. Longest: the longest host, then the longest path. Rules that
    repeat a (host, path) count once, the verdict that sorts first wins ('allow' < 'block').

    Each distinct (host, path) becomes one point per domain of its host that has a rule,
    with the canonical key reversed domain + ' ' + path. A rule is the interval from its key to
    its key + END, so the rules of one domain are properly nested intervals. Points and
    interval ends of a domain are sorted by key and swept once. The stack of open rules
    never has to be kept: an end hands over to the enclosing rule, which is the nearest rule
    whose path is a prefix, so the rule in force is the last one any event named.

    A domain's points are dealt over a number of slices that follows its share of all
    points (``spread`` slices per shuffle partition in total), so a hot domain such as a
    top-level one is no hot key; its rules are copied to its slices only.

    Returns page_id, url, host, path, rule (host + path; null without one), verdict (the
    rule's, else ``default``), one row per input row. Null or empty URLs and those without
    ``://`` have host and path '' and no rule; repeated rows and null ids stay; empty tables
    give no rows; other columns of pages are ignored.
    """
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"),
                        url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rules = (rules.select(F.lower("host").alias("domain"),
                          F.coalesce("path", F.lit("")).alias("prefix"), "verdict")
             .filter(F.coalesce("domain", F.lit("")) != "")
             .groupBy("domain", "prefix").agg(F.min("verdict").alias("verdict")))
    domains = rules.select("domain").distinct()
    most = domains.agg(F.max(F.size(F.split("domain", r"\.")))).first()[0] or 0
    points = (seen.select("host", "path").distinct()
              .select("host", "path", F.explode(_suffixes(F.col("host"), F.lit(most))).alias("domain"))
              .join(domains, "domain", "left_semi"))
    points = written(points, "url-points")
    counts = points.groupBy("domain").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row per domain that has rules
    slices = counts.select("domain", F.ceil(F.lit(float(spread * parts)) * F.col("n") / total)
                           .cast("int").alias("slices"))
    # the rule that encloses each rule: the longest other prefix of the same domain
    up = (rules.select("domain", "prefix", F.explode(F.sequence(F.lit(0), F.length("prefix")))
                       .alias("k")).filter(F.col("k") < F.length("prefix"))
          .select("domain", "prefix", F.expr("left(prefix, k)").alias("outer")))
    up = (up.join(rules.select("domain", F.col("prefix").alias("outer"),
                               F.col("verdict").alias("outer_verdict")), ["domain", "outer"])
          .groupBy("domain", "prefix")
          .agg(F.max(F.struct(F.length("outer").alias("n"), "outer", "outer_verdict")).alias("o")))
    rules = rules.join(up, ["domain", "prefix"], "left")
    none = F.struct(F.lit(None).cast("string").alias("rule"),
                    F.lit(None).cast("string").alias("verdict"))

    def named(path: Column, verdict: Column) -> Column:
        return F.struct(F.concat("domain", path).alias("rule"), verdict.alias("verdict"))

    def key(path: Column) -> Column:
        return F.concat(_reversed(F.col("domain")), F.lit(" "), path)

    opens = F.struct(key(F.col("prefix")).alias("key"), F.length("prefix").alias("depth"),
                     F.lit(0).alias("kind"),
                     named(F.col("prefix"), F.col("verdict")).alias("names"))
    # inner intervals that end at the same key close first
    closes = F.struct(F.concat(key(F.col("prefix")), F.lit(END)).alias("key"),
                      (-F.length("prefix")).alias("depth"), F.lit(2).alias("kind"),
                      F.when(F.col("o").isNull(), none)
                      .otherwise(named(F.col("o.outer"), F.col("o.outer_verdict"))).alias("names"))
    ends = (rules.join(slices, "domain")
            .select("domain", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
                    F.explode(F.array(opens, closes)).alias("e"))
            .select("domain", "slice", "e.key", "e.kind", "e.depth", "e.names",
                    F.lit(None).cast("string").alias("host"),
                    F.lit(None).cast("string").alias("path")))
    at = points.join(slices, "domain").select(
        "domain", F.pmod(F.xxhash64("host", "path"), F.col("slices")).cast("int").alias("slice"),
        key(F.col("path")).alias("key"), F.lit(1).alias("kind"), F.lit(0).alias("depth"),
        F.lit(None).cast("struct<rule:string,verdict:string>").alias("names"), "host", "path")
    sweep = Window.partitionBy("domain", "slice").orderBy("key", "kind", "depth")
    hit = (at.unionByName(ends)
           .withColumn("in_force", F.last("names", ignorenulls=True).over(
               sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
           .filter((F.col("kind") == 1) & F.col("in_force.rule").isNotNull())
           .groupBy("host", "path")
           .agg(F.max(F.struct(F.length("domain").alias("n"), "in_force")).alias("best")))
    return (seen.join(hit, ["host", "path"], "left")
            .select("page_id", "url", "host", "path", F.col("best.in_force.rule").alias("rule"),
                    F.coalesce("best.in_force.verdict", F.lit(default)).alias("verdict")))


def rules_frame(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table from (host, path, verdict) tuples."""
    return spark.createDataFrame(rows, RULE_SCHEMA)
