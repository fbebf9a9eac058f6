"""URL rules by a sort-merge range join, in DataFrame functions only.

A rule is a host and a path prefix; it fits its host, all subdomains, and the paths that
start with its path. Hosts are turned round by label (``org.example.blog``). The suffixes
of a url's host that some rule names (found by an equi-join on the reversed hosts) become
its canonical keys: reversed host, then the path's bytes. Under one host a path prefix is
the interval from its bytes to the same bytes and 0xFF, which no UTF-8 text holds, so
the rules of a host are nested intervals.

The sweep orders rule starts, rule ends and urls of a host by key. The running sum of
starts minus ends is the depth of the stack; the top of the stack at a row is the latest
start at that depth, because a later rule can only reach the same depth after the earlier
one has ended. Both are window functions over the sorted sequence. Of the tops a url gets
under the suffixes of its host, the longest rule (host and path) wins.

Urls are first reduced to distinct (host, path) pairs, which are judged and joined back.
A host with many urls is dealt out over salts: as many as its share of all keys times
``SPREAD``, so no part holds more than about 1 / SPREAD of the keys whatever the input
size; the host's rules are copied to each of its salts.

Cases: a null url, or one without ``://``, has an empty host and path and gets no rule;
no rule fits a url: verdict ``DEFAULT``; a rule listed twice counts once, and blocks if
any of its listings does; rules that tie in length: the longer host wins; repeated rows
are judged alike; an empty table or rule list is fine; further columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, lower_ascii, staged, table

DEFAULT = "allow"
SPREAD = 1024

#: (verdict, host, path prefix): the rules of op3.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """verdict, host, path of each rule as a DataFrame."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def host_suffixes(host: Column) -> Column:
    """The reversed host's label prefixes: org, org.example, org.example.blog."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, 1, k), "."))


def judge(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) -> plus rule and verdict, for the pairs some rule fits."""
    rules = staged(rules.groupBy(reversed_host(lower_ascii(F.col("host"))).alias("g"), lower_ascii(F.col("host")).alias("r_host"),
                                 F.col("path").alias("r_path")).agg(F.max("verdict").alias("r_verdict")), "url-rules")
    named = broadcast_if_small(staged(rules.select(F.col("g").alias("r_g")).distinct(), "url-hosts"))
    keys = pairs.select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("g")) \
        .join(named, F.col("g") == F.col("r_g"), "left_semi")
    keys = staged(keys, "url-keys")

    load = keys.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    load = load.select("g", F.ceil(F.col("c") * SPREAD / F.sum("c").over(Window.partitionBy())).cast("int").alias("salts"))
    load = broadcast_if_small(staged(load, "url-load"))
    salted = keys.join(load, "g").withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.col("salts")).cast("int"))
    spread = rules.join(load, "g").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))

    none = F.lit(None).cast("string")
    rule = F.struct((F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"),
                    F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))
    start = F.encode("r_path", "utf-8")
    no_rule = F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>")
    opens = spread.select("g", "salt", start.alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("step"), rule.alias("rule"),
                          none.alias("host"), none.alias("path"))
    ends = spread.select("g", "salt", F.concat(start, F.lit(b"\xff")).alias("at"), F.lit(1).alias("kind"), F.lit(-1).alias("step"),
                         no_rule.alias("rule"), none.alias("host"), none.alias("path"))
    urls = salted.select("g", "salt", F.encode("path", "utf-8").alias("at"), F.lit(2).alias("kind"), F.lit(0).alias("step"),
                         no_rule.alias("rule"), "host", "path")

    so_far = (Window.unboundedPreceding, Window.currentRow)
    sweep = Window.partitionBy("g", "salt").orderBy("at", "kind").rowsBetween(*so_far)
    level = Window.partitionBy("g", "salt", "depth").orderBy("at", "kind").rowsBetween(*so_far)
    swept = opens.unionByName(ends).unionByName(urls).withColumn("depth", F.sum("step").over(sweep))
    swept = swept.withColumn("top", F.last("rule", ignorenulls=True).over(level))
    hits = swept.filter((F.col("kind") == 2) & (F.col("depth") > 0))
    best = hits.groupBy("host", "path").agg(F.max("top").alias("top"))
    return best.select(F.col("host").alias("j_host"), F.col("path").alias("j_path"),
                       F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages."""
    urls = staged(pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")), "urls")
    found = judge(urls.select("host", "path").distinct(), rules)
    out = urls.join(found, (F.col("host") == F.col("j_host")) & (F.col("path") == F.col("j_path")), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
ORACLE = f"""
WITH r(r_verdict, r_host, r_path) AS (VALUES {_VALUES}),
u AS (
  SELECT row_number() OVER () AS i, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
f AS (
  SELECT i, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS verdict
  FROM u JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM u LEFT JOIN f USING (i)
"""
