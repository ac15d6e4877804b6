"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Rules flag a document when a metric exceeds (or falls below) a cutoff. Cutoffs come from labelled holdout rows:
per stratum and metric a fixed grid of cutoffs is tested. All rules together may falsely reject at most `risk` of a
stratum's good documents, so each has an equal part of it: a cutoff is safe when the exact binomial (Clopper-Pearson)
test rejects "it falsely rejects more than that part of good documents". The level is divided by the number of all
tests made (Bonferroni), so with probability 1 - delta every chosen cutoff keeps its promise, and with it every
stratum the whole. Of the safe cutoffs the strictest is used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table

#: Fixed value: characters counted as symbols.
SYMBOLS = "#*$%&|<>"

#: Metric name -> (expression over the base counts, cutoffs from strict to loose). A document fails above the cutoff.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3]),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", [0.02, 0.05, 0.1, 0.2, 0.3, 0.5]),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", [0.01, 0.02, 0.05, 0.1, 0.15, 0.2]),
    "upper_share": ("n_upper / greatest(word_chars, 1)", [0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5]),
    "long_word_mean": ("word_chars / greatest(n_words, 1)", [8.0, 9.0, 10.0, 12.0, 15.0, 20.0]),
}


#: Good documents of a stratum that all rules together may falsely reject, as a share.
RISK = 0.05
#: Cutoffs of this many strata are broadcast (some numbers each); of more they are joined, in so many parts a stratum.
SENT_STRATA, PARTS = 1000, 16
#: Up to this many false rejections the sum begins with its first term, else with its last, which the others soon fall
#: short of: both are the whole sum.
SUMMED = 10_000


def _found(pattern: str) -> Column:
    """How often the pattern is in the text; splitting is several times cheaper here than translate() or regexp_replace()."""
    return (F.size(F.split("_text", pattern, -1)) - 1).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words (long). A null text has
    no words. Columns are added step by step, each used more than once by the next, so Spark keeps them apart and
    evaluates none of them twice."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    out = docs.withColumns({"_text": text, "_lines": lines, "_words": F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")})
    out = out.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    out = out.withColumns({
        "n_words": F.size("_hashes").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": _found("[" + SYMBOLS + "]"),
        "n_upper": _found("[A-Z]"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # five hashes of words in a row tell a window; windows are compared within one text only. Fewer than five
        # words: an empty array (sequence(0, -1) would count down)
        "_windows": F.when(F.size("_hashes") >= 5, F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - 5),
            lambda i: F.xxhash64(*[F.get("_hashes", i + j) for j in range(5)]),
        )).otherwise(F.array().cast("array<bigint>")),
    })
    # only texts with a repeat go on: their windows sorted by hash, those equal to a neighbour kept in text order
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("_ranked", F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    same = lambda x, i, d: F.coalesce(F.get("_ranked", i + d)["h"] == x["h"], F.lit(False))
    twice = F.filter("_ranked", lambda x, i: same(x, i, -1) | same(x, i, 1))
    out = out.withColumn("_twice", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "_twice", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-5).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(5), i - acc["last"])).cast("bigint").alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return out.withColumn("n_repeat_words", covered).drop("_text", "_lines", "_words", "_hashes", "_windows", "_ranked", "_twice")


def _with_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({f"_m_{k}": F.expr(e).cast("double") for k, (e, _) in RULES.items()})


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of Binomial(n, p), summed term by term; null n or k gives null. From k = n * p on 1, which is above the
    true value and never safe. Beyond `SUMMED` false rejections the last term comes from Stirling's series, whose error is
    far below that of a double there, and the sum goes down from it: 12 standard deviations further a term is e**-72 of
    the last one."""
    ratio = F.log(F.lit(p / (1 - p)))
    start = n * F.log(F.lit(1 - p))
    low = (k < n * F.lit(p))
    terms = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), F.when(low, F.least(k, F.lit(SUMMED))).otherwise(0).cast("bigint")),
        F.struct(start.cast("double").alias("t"), F.lit(0.0).alias("sum")),
        lambda acc, i: F.struct(
            (acc["t"] + ratio + F.log(F.greatest(n - i, F.lit(1)) / (i + 1))).cast("double").alias("t"),
            (acc["sum"] + F.exp(acc["t"])).cast("double").alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    large = low & (k > SUMMED)
    share = k / n
    off = share - F.lit(p)
    rest = n - k
    series = lambda x: 1 / (12 * x) - 1 / (360 * F.pow(x.cast("double"), 3))
    last = F.exp(-n * (share * F.log1p(off / F.lit(p)) + (1 - share) * F.log1p(-off / F.lit(1 - p))) - F.log(2 * math.pi * k * (rest / n)) / 2 + series(n) - series(k) - series(rest))
    down = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), F.when(large, F.least(k, F.ceil(12 * F.sqrt(n * F.lit(p * (1 - p)))))).otherwise(0).cast("bigint")),
        F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("sum")),
        lambda acc, i: F.struct(
            (acc["t"] * (k - i) / (rest + i + 1) * F.lit((1 - p) / p)).cast("double").alias("t"),
            (acc["sum"] + acc["t"]).cast("double").alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(k.isNull() | n.isNull(), F.lit(None).cast("double")).when(~low, F.lit(1.0)).when(k <= SUMMED, terms).otherwise(last * down)


def thresholds(metrics: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = 0.05, min_good: int = 100) -> DataFrame:
    """(stratum, metric, cutoff, n_good, n_false, p_value): the strictest safe cutoff per stratum and metric.

    `metrics` holds doc_id, the stratum and the columns of `RULES` as _m_<name>. Only labelled rows with quality 1
    count. Strata with fewer than `min_good` such rows get no cutoff, nor does a metric without a safe one."""
    good = metrics.join(labels.where("quality = 1").select("doc_id").dropDuplicates(), "doc_id", "left_semi")
    good = good.withColumn("stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    grid = [(k, c) for k, (_, cuts) in RULES.items() for c in cuts]
    # one pass: each test is a sum, so the table shrinks to a row per stratum before any shuffle
    sums = good.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n_good"),
        *[F.sum((F.col(f"_m_{k}") > c).cast("long")).alias(f"x{i}") for i, (k, c) in enumerate(grid)],
    )
    long = sums.select("stratum", "n_good", F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.lit(float(c)).alias("cutoff"), F.col(f"x{i}").alias("n_false")) for i, (k, c) in enumerate(grid)
    ])).alias("t")).select("stratum", "n_good", "t.*").where(F.col("n_good") >= min_good)
    tests = sums.where(F.col("n_good") >= min_good).agg((F.count(F.lit(1)) * len(grid)).alias("tests"))
    # the number of strata is a single row
    tested = long.join(F.broadcast(tests)).withColumn("p_value", binomial_cdf(F.col("n_false"), F.col("n_good"), risk / len(RULES)))
    safe = tested.where(F.col("p_value") <= F.lit(delta) / F.col("tests"))
    best = safe.groupBy("stratum", "metric").agg(F.min(F.struct("cutoff", "n_good", "n_false", "p_value")).alias("b"))
    return best.select("stratum", "metric", "b.*")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = 0.05) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed (under 10 words, or over a fifth of the words in repeated
    five-word windows), failed_rules (names of rules whose cutoff for the row's stratum is exceeded) and kept.

    Null or empty text: no words, so base_failed. Null stratum is a stratum of its own. Rows of strata without
    cutoffs are judged by the base rules. Repeated rows are judged each; of labels with one doc_id any quality 1
    counts; null doc_ids match no label. Other columns are ignored. With no documents or no labels the result is
    empty, or judged by the base rules alone."""
    # texts are read once: what follows are numbers
    rows = stored(_with_metrics(base_counts(docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))).drop("text")), "metrics")
    cut = thresholds(rows, labels, "stratum", risk, delta).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("metric", "cutoff"))).alias("cuts"))
    cut = stored(cut, "cutoffs")
    if cut.count() <= SENT_STRATA:
        judged = rows.join(F.broadcast(cut), "stratum", "left")
    else:  # very many strata: a hot one is dealt in parts
        parts = cut.withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        judged = rows.withColumn("_p", F.pmod(F.xxhash64("doc_id", "word_chars"), F.lit(PARTS)).cast("int")).join(parts, ["stratum", "_p"], "left")
    failed = F.filter(
        F.array(*[F.when(F.col(f"_m_{k}") > F.col("cuts")[k], F.lit(k)) for k in RULES]), lambda x: x.isNotNull()
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.withColumn("base_failed", base).withColumn("failed_rules", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules",
        (~base & (F.size("failed_rules") == 0)).alias("kept"),
    )


def query(spark, sf_dir):
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.drop("failed_rules")


def _oracle() -> str:
    part = RISK / len(RULES)
    grid = [(k, c) for k, (_, cuts) in RULES.items() for c in cuts]
    metric = ", ".join(f"CAST({e.replace(' / ', '::DOUBLE / ')} AS DOUBLE) AS m_{k}" for k, (e, _) in RULES.items())
    tests = " UNION ALL ".join(
        f"SELECT stratum, '{k}' AS metric, CAST({c} AS DOUBLE) AS cutoff, count(*) AS n, sum(CASE WHEN m_{k} > {c} THEN 1 ELSE 0 END) AS x FROM good GROUP BY stratum" for k, c in grid
    )
    fails = " OR ".join(f"coalesce(m_{k} > (SELECT min(cutoff) FROM safe WHERE safe.stratum = metrics.stratum AND safe.metric = '{k}'), FALSE)" for k in RULES)
    return rf"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w
  FROM documents),
lined AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines,
         list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i+4], ' ')) AS g
  FROM words),
numbered AS (SELECT row_number() OVER () AS r, * FROM lined),
grams AS (SELECT r, unnest(g) AS gram, unnest(range(len(g))) AS i FROM numbered),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
spans AS (SELECT r, least(5, i - lag(i, 1, -5) OVER (PARTITION BY r ORDER BY i)) AS c FROM twice),
repeats AS (SELECT r, CAST(sum(c) AS BIGINT) AS c FROM spans GROUP BY r),
counts AS (
  SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[ \t-\r]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
    coalesce(repeats.c, 0) AS n_repeat_words
  FROM numbered LEFT JOIN repeats USING (r)),
metrics AS (SELECT *, {metric} FROM counts),
good AS (SELECT metrics.* FROM metrics WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
tests AS (SELECT * FROM ({tests}) WHERE n >= 100),
pvalues AS (
  SELECT *, CASE WHEN x >= n * {part} THEN 1.0 ELSE list_sum(list_transform(range(CAST(x AS BIGINT) + 1),
      lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({part}) + (n - k) * ln(1 - {part})))) END AS p
  FROM tests),
safe AS (SELECT * FROM pvalues WHERE p <= 0.05 / (SELECT count(*) FROM tests))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT ({fails}) AS kept
FROM metrics"""


ORACLE_SQL = _oracle()
