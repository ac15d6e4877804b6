"""URL filters as a sort-merge range join, in DataFrame functions only.

A host is keyed by its labels reversed ("www.example.org" -> "org.example.www."). A rule for a host and its
subdomains is then the interval of keys that start with the rule's key, and intervals nest or are disjoint. A
sweep over the sorted rule borders keeps a stack of open rules; the stack after each border is stored. The url
keys are sorted among those borders, and each takes the stack of the last border at or before it. What is left to
do for a url is to take the longest rule in its stack whose path starts the url's path.

The borders go to every sorted run of urls, so they must be few. For long lists of rules the same intervals are found
by equal keys instead: of each distinct url the keys that hold its own, then the paths of these rules by their lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

#: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Open rules at all borders together, up to which the borders are sent to every run of urls; of a host's lookup the parts.
MOST_SWEPT, PARTS = 20_000, 16
LAST = "\U0010ffff"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    return _ascii_lower(host), path


def host_key(host: Column) -> Column:
    """Labels reversed, each ended by a dot, so that one key starts another only at a label's end."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


Rules = list[tuple[str, str, str]]
OPEN = "array<struct<size:int,deep:int,rule:string,path:string,verdict:string>>"


def swept(rules: Rules, most: int) -> list[tuple[str, list[tuple]]] | None:
    """(key, open rules from this key on, longest first) at each border, in the order of keys; None as soon as these
    are more than `most` in all. Of rules with one host and path the first counts."""
    by_key: dict[str, dict[str, tuple]] = {}
    for host, path, verdict in rules:
        host = host.translate(_LOWER)
        key = "".join(x + "." for x in reversed(host.split("."))) if host else ""
        by_key.setdefault(key, {}).setdefault(path, (-len(host + path), -len(host), host + path, path, verdict))
    out, stack, held = [], [], 0

    def put(key):
        nonlocal held
        found = sorted(x for _, own in stack for x in own)
        held += len(found) + 1
        out.append((key, found))

    for key in [*sorted(by_key), None]:
        while stack and (key is None or not key.startswith(stack[-1][0])):  # this rule's interval is over
            end = stack.pop()[0] + LAST
            put(end)
        if key is not None:
            stack.append((key, list(by_key[key].values())))
            put(key)
        if held > most:
            return None
    return out


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _by_sweep(urls: DataFrame, borders: list[tuple[str, list[tuple]]], parts: int) -> DataFrame:
    """Adds fit: the rule that wins, or null."""
    marks = urls.sparkSession.createDataFrame(borders, f"key string, stack {OPEN}")
    given = urls.select(F.pmod(F.xxhash64("page_id", "url"), F.lit(parts)).cast("int").alias("run"), host_key(F.col("host")).alias("key"), F.lit(1).alias("is_url"), "page_id", "host", "path", F.lit(None).cast(OPEN).alias("stack"))
    marks = marks.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("run"), "key", F.lit(0).alias("is_url"),
        F.lit(None).cast(urls.schema["page_id"].dataType).alias("page_id"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack",
    )
    # of borders with one key the one with most open rules, which opens, comes last
    order = W.partitionBy("run").orderBy("key", "is_url", F.size("stack")).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = given.unionByName(marks).withColumn("open", F.last("stack", ignorenulls=True).over(order)).where("is_url = 1")
    return found.withColumn("fit", F.get(F.filter("open", lambda r: F.col("path").startswith(r["path"])), F.lit(0)))


def _by_keys(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same from a table of rules, of any number: nothing is sent, and hot hosts are dealt in parts."""
    kept = rules.select(F.monotonically_increasing_id().alias("n"), _ascii_lower(F.col("host")).alias("h"), F.col("path").alias("p"), "verdict")
    kept = kept.groupBy("h", "p").agg(F.min_by("verdict", "n").alias("verdict"))
    kept = kept.select(host_key(F.col("h")).alias("key"), F.struct((-F.length(F.concat("h", "p"))).alias("size"), (-F.length("h")).alias("deep"), F.concat("h", "p").alias("rule"), F.col("p").alias("path"), "verdict").alias("rule_"))
    by_host = kept.groupBy("key").agg(F.collect_set(F.length("rule_.path")).alias("lengths")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    distinct = urls.select("host", "path").distinct()
    labels = F.split(host_key(F.col("host")), r"\.", -1)
    # the key of a host and of every host above it; the empty key holds all
    above = F.transform(F.sequence(F.lit(0), F.size(labels) - 1), lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(labels, 1, F.greatest(i, F.lit(1))), "."), F.lit("."))))
    keys = distinct.withColumn("key", F.explode(F.when(F.col("host") == "", F.array(F.lit(""))).otherwise(above)))
    keys = keys.withColumn("part", F.pmod(F.xxhash64("host", "path"), F.lit(PARTS)).cast("int")).join(by_host, ["key", "part"])
    starts = keys.select("host", "path", "key", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n")).withColumn("start", F.expr("substring(path, 1, n)"))
    hits = starts.join(kept.withColumn("start", F.col("rule_.path")), ["key", "start"])
    best = stored(hits.groupBy("host", "path").agg(F.min("rule_").alias("fit")), "fits")  # a plain table: hot urls can be split
    return urls.join(best, ["host", "path"], "left")


def url_rules(pages: DataFrame, rules: Rules | DataFrame = RULES, default: str = "allow", parts: int | None = None, most_swept: int = MOST_SWEPT) -> DataFrame:
    """Per row: page_id, host, path, rule (host and path of the longest rule that fits, else null), verdict.

    `rules` (host, path, verdict) are a list or a table. A rule fits its host and all subdomains if the url's path
    starts with the rule's path; the longest wins (host and path together, then the longer host); an empty host holds
    all urls. Of several rules with one host and path the first counts. Urls without a rule get `default`. Null urls and
    urls without "://" have an empty host and path, which only rules of an empty host and path fit. Urls are dealt by a
    hash of page_id and url over `parts` sorted runs, so neither a hot host nor a hot url fills one task; every run gets
    the borders, of which there are two per host with rules. Beyond `most_swept` open rules at all borders, and for
    rules in a table, rules are joined by equal keys instead, with the same result. Equal rows (page_id and url) are
    returned as often as they occur. Other columns are ignored; no rules and no pages are fine."""
    spark = pages.sparkSession
    parts = parts or 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    found = swept(rules, most_swept) if isinstance(rules, list) else None
    if found is None:
        table_of = rules if isinstance(rules, DataFrame) else spark.createDataFrame(rules, "host string, path string, verdict string")
        judged = _by_keys(urls, table_of)
    else:
        judged = _by_sweep(urls, found, parts)
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit(default)).alias("verdict"))


def query(spark, sf_dir):
    return url_rules(table(spark, sf_dir, "pages"))


_HOST = r"translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_HOST} AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path FROM cut),
rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
hit AS (SELECT *, (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1) AS rule FROM parts)
SELECT page_id, host, path, rule, coalesce((SELECT v FROM rules WHERE h || p = rule), 'allow') AS verdict FROM hit"""
