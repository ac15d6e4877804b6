"""Packing into optimal length buckets.

The histogram of document lengths is global and exact. Dynamic programming over it picks the bucket boundaries
with the least padding; inside a bucket, batches are cut so that rows times the bucket's length stay in a token
budget.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` intervals of the sorted lengths with the least total padding, in whole numbers.

    A last bucket of lengths i..j costs length_j * (documents in i..j) - (tokens in i..j). For a fixed i that is a line
    in length_j, less terms of j alone, and the slopes fall as i grows, so the lower envelope of the lines is kept as a
    stack and walked once: a bucket more takes time in proportion to the number of lengths."""
    if not lengths:
        return []
    n, s = [0, *accumulate(counts)], [0, *accumulate(x * c for x, c in zip(lengths, counts, strict=True))]
    best = [x * n[j + 1] - s[j + 1] for j, x in enumerate(lengths)]  # one bucket over 0..j
    cuts = []
    for _ in range(1, min(buckets, len(lengths))):
        new, cut, lines, at = best[:], [-1] * len(lengths), [], 0
        for j, x in enumerate(lengths):
            if j:  # a last bucket that starts at j
                a, b = -n[j], best[j - 1] + s[j]
                while len(lines) > 1 and (b - lines[-2][1]) * (lines[-2][0] - lines[-1][0]) <= (lines[-1][1] - lines[-2][1]) * (lines[-2][0] - a):
                    lines.pop()
                lines.append((a, b, j))
                at = min(at, len(lines) - 1)
                while at + 1 < len(lines) and lines[at + 1][0] * x + lines[at + 1][1] <= lines[at][0] * x + lines[at][1]:
                    at += 1
                cost = lines[at][0] * x + lines[at][1] + x * n[j + 1] - s[j + 1]
                if cost < new[j]:
                    new[j], cut[j] = cost, lines[at][2]
        best = new
        cuts.append(cut)
    out, j = [], len(lengths) - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:  # else fewer buckets do as well
            out.append(lengths[j])
            j = cut[j] - 1
    return [*reversed([*out, lengths[j]])]


def length_histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(length, documents), a row per distinct length: at most as many as the longest document has tokens, however many
    documents there are."""
    return [(int(r.n_tokens), int(r.n)) for r in lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").collect()]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 65_536, group: int = 50_000) -> DataFrame:
    """Per row: doc_id, n_tokens (words and one end mark), bucket, bucket_length, batch_id, slot, n_padding.

    Every document is whole and in exactly one batch. A batch holds rows of one bucket, at most
    max(1, budget // bucket_length) of them: a document beyond the budget is a batch of its own. Buckets of more
    than `group` documents are numbered in sub-groups dealt by a hash of the row's number, so no task gets a whole hot
    bucket, not even one of equal rows; each sub-group ends with at most one partial batch. Which documents share a
    batch depends on how the table is cut into partitions, the boundaries do not. Null or empty text: one token, the
    end mark. Null doc_ids come first; equal rows get slots of their own. An empty table gives an empty table. Other
    columns are ignored."""
    text = F.coalesce("text", F.lit(""))
    words = F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), r"[\x20\x09-\x0D]+", ""))
    # texts are read once; the numbers of rows hold from here on
    sized = stored(docs.select("doc_id", (words + 1).cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("_r")), "lengths")
    histogram = length_histogram(sized)
    ends = boundaries([x for x, _ in histogram], [n for _, n in histogram], buckets) or [1]
    number = [0] * len(ends)
    for x, n in histogram:
        number[bisect_left(ends, x)] += n
    literal = lambda xs: F.array(*[F.lit(int(x)) for x in xs])
    bucket = F.size(F.filter(literal(ends), lambda e: e < F.col("n_tokens")))
    groups = [max(1, -(-n // group)) for n in number]
    placed = sized.withColumn("bucket", bucket).withColumns({
        "bucket_length": F.get(literal(ends), F.col("bucket")).cast("long"),
        "_g": F.pmod(F.xxhash64("_r"), F.get(literal(groups), F.col("bucket"))).cast("int"),
    })
    order = W.partitionBy("bucket", "_g").orderBy("doc_id", "n_tokens", "_r")
    rows = F.greatest(F.floor(F.lit(budget) / F.col("bucket_length")), F.lit(1))
    placed = placed.withColumn("_n", F.row_number().over(order) - 1)
    return placed.select(
        "doc_id", "n_tokens", "bucket", "bucket_length",
        F.concat_ws("-", "bucket", "_g", F.floor(F.col("_n") / rows)).alias("batch_id"),
        (F.col("_n") % rows).cast("int").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("n_padding"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
