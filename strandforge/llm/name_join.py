"""Edit-distance name join: two tries walked together under the edit automaton for one edit.

1. Each side's names are made distinct before anything else, with what a name stands for summed up.
2. The upper part of the common trie is cut where a subtree holds at most `LIMIT` names of both sides together, so cuts
   lie deeper where names crowd. A subtree's names meet in one group.
3. While no edit has been made, both sides are at the same node, so below the cut only pairs of equal subtrees remain:
   each group builds a minimal acyclic automaton of either side, and both are walked together. Common prefixes are walked
   once, and after an edit both must go on alike, which is remembered per pair of states.
4. An edit above the cut leads from there to two different subtrees that must go on alike to the end. Such a walk is an
   equality of all that is left, so these pairs of subtrees are joined by key: the name with the edit undone.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Names that a group holds, both sides together.
LIMIT = 256
#: Prefixes counted in the first round of cutting; each round counts twice as many.
STEP = 8

_WHITE = "\t\n\x0b\x0c\r "


def form(name: Column) -> Column:
    """A-Z lower-cased, ASCII white space removed."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(name, upper + _WHITE, upper.lower())


def misspelt(name: Column, vendor_id: Column) -> Column:
    """Two neighbouring code points exchanged, in names of two and more whose id's hash is even."""
    h, size = F.crc32(vendor_id.cast("string").cast("binary")), F.length(name)
    at = (h % F.greatest(size - 1, F.lit(1))).cast("int")
    swapped = F.concat(F.substring(name, F.lit(1), at), F.substring(name, at + 2, F.lit(1)), F.substring(name, at + 1, F.lit(1)), F.substring(name, at + 3, size))
    return F.when((h % 2 == 0) & (size >= 2), swapped).otherwise(name)


# ---- the cut ----------------------------------------------------------------------------------------------------------

def _node(name: Column, depth: Column) -> Column:
    """A number for the trie's node at this depth on the way of `name`; the name's end is a node of its own. Two nodes
    of one number would only be one group together."""
    return F.xxhash64(F.substring(name, F.lit(1), depth), depth > F.length(name))


def cut(names: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """(name, side, cut, depth) for distinct (name, side): the first node on the way whose subtree holds at most `limit`
    names. Rounds look at `step` depths, twice as many in each further one, and only at names that have no cut yet."""
    done, rest, base = [], names, 0
    while True:
        depths = F.sequence(F.lit(base + 1), F.least(F.length("name") + 1, F.lit(base + step)))
        ways = rest.select("name", "side", F.explode(depths).alias("depth")).withColumn("cut", _node(F.col("name"), F.col("depth")))
        # written, so that Spark can split the names of one crowded node in the join
        crowded = stored(ways.groupBy("cut").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("cut"), "crowded")
        # ends are never crowded: a name is there once a side
        deepest = ways.join(crowded.hint("merge"), "cut", "left_semi").groupBy("name", "side").agg(F.max("depth").alias("crowded"))
        told = stored(rest.join(deepest.hint("merge"), ["name", "side"], "left").withColumn("depth", F.coalesce("crowded", F.lit(base)) + 1).drop("crowded"), "cuts")
        open_ = F.col("depth") > base + step
        done.append(told.where(~open_).withColumn("cut", _node(F.col("name"), F.col("depth"))))
        rest, base, step = told.where(open_).select("name", "side"), base + step, 2 * step
        if rest.isEmpty():
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select("name", "side", "cut", "depth")


# ---- below the cut ----------------------------------------------------------------------------------------------------

def automaton(words: list[str]) -> tuple[list[dict[str, int]], list[bool]]:
    """The minimal acyclic automaton of sorted distinct words: each state's ways on, and whether a word ends there. Built
    a word at a time; states behind the last common prefix are final and replaced by equal ones."""
    ways: list[dict[str, int]] = [{}]
    ends, known, path, last = [False], {}, [0], ""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            same = known.setdefault((ends[state], tuple(ways[state].items())), state)
            ways[path[-1]][last[len(path) - 1]] = same

    for w in words:
        depth = 0
        while depth < min(len(w), len(last)) and w[depth] == last[depth]:
            depth += 1
        settle(depth)
        for c in w[depth:]:
            ways.append({})
            ends.append(False)
            ways[path[-1]][c] = len(ways) - 1
            path.append(len(ways) - 1)
        ends[path[-1]], last = True, w
    settle(0)
    return ways, ends


def walk(left: list[str], right: list[str]) -> list[tuple[str, str, int]]:
    """Pairs of a word of `left` and one of `right`, both sorted and distinct, at distance 0 or 1, each once."""
    (on_l, end_l), (on_r, end_r) = automaton(left), automaton(right)
    out: list[tuple[str, str, int]] = []
    tails: dict[tuple[int, int], list[str]] = {}

    def alike(a: int, b: int) -> list[str]:
        """What both states accept."""
        found = tails.get((a, b))
        if found is None:
            found, todo = [], [(a, b, "")]
            while todo:
                x, y, t = todo.pop()
                if end_l[x] and end_r[y]:
                    found.append(t)
                for c, z in on_l[x].items():
                    if c in on_r[y]:
                        todo.append((z, on_r[y][c], t + c))
            tails[a, b] = found
        return found

    todo = [(0, 0, "")]
    while todo:
        x, y, p = todo.pop()  # no edit so far
        if end_l[x] and end_r[y]:
            out.append((p, p, 0))
        for c, z in on_l[x].items():
            if c in on_r[y]:
                todo.append((z, on_r[y][c], p + c))
            # p is all that the two have in common at their beginnings, so a pair is found at one place only
            out += [(p + c + t, p + t, 1) for t in alike(z, y) if t[:1] != c]
            for d, u in on_r[y].items():
                if c != d:
                    out += [(p + c + t, p + d + t, 1) for t in alike(z, u)]
                    if d in on_l[z] and c in on_r[u]:
                        out += [(p + c + d + t, p + d + c + t, 1) for t in alike(on_l[z][d], on_r[u][c])]
        for d, u in on_r[y].items():
            out += [(p + t, p + d + t, 1) for t in alike(x, u) if t[:1] != d]
    return out


def _walked(left: pa.Table, right: pa.Table) -> pa.Table:
    # by code points, as Python compares
    found = walk(sorted(left.column("left").to_pylist()), sorted(right.column("right").to_pylist()))
    return pa.table({"left": pa.array([x[0] for x in found], pa.string()), "right": pa.array([x[1] for x in found], pa.string()), "distance": pa.array([x[2] for x in found], pa.int32())})


# ---- above the cut ----------------------------------------------------------------------------------------------------

def _edited(side: DataFrame, out: str, left: bool) -> DataFrame:
    """(kind, at, key, name, cut): a name as it is, and with each edit above its cut undone. Keys of the left side stand
    for it as it is (0), without a code point or with two exchanged (1), and with one left open (2); those of the right
    without a code point (0), as it is (1), and with one left open (2)."""
    name, size = F.col("name"), F.length("name")
    upto = lambda n: F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    places = upto(F.least(F.col("depth"), size) - 1)
    without = lambda i: F.concat(F.substring(name, F.lit(1), i), F.substring(name, i + 2, size))
    row = lambda kind, at, key: F.struct(F.lit(kind).alias("kind"), at.alias("at"), key.alias("key"))
    rows = lambda kind, keys: F.transform(F.array_distinct(keys), lambda k: row(kind, F.lit(-1), k))
    whole = F.array(row(0 if left else 1, F.lit(-1), name))
    open_ = F.transform(places, lambda i: row(2, i, without(i)))
    if left:
        swaps = F.filter(upto(F.least(F.col("depth"), size - 1) - 1), lambda i: F.substring(name, i + 1, F.lit(1)) != F.substring(name, i + 2, F.lit(1)))
        swapped = F.transform(swaps, lambda i: F.concat(F.substring(name, F.lit(1), i), F.substring(name, i + 2, F.lit(1)), F.substring(name, i + 1, F.lit(1)), F.substring(name, i + 3, size)))
        keys = F.concat(whole, rows(1, F.concat(F.transform(places, without), swapped)), open_)
    else:
        keys = F.concat(whole, rows(0, F.transform(places, without)), open_)
    return side.select(name.alias(out), F.col("cut").alias(f"cut_{out}"), F.explode(keys).alias("k")).select(out, f"cut_{out}", "k.*")


def name_pairs(left: DataFrame, right: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """(left, right, distance): pairs of distinct names, tables of one column `name`, at an unrestricted
    Damerau-Levenshtein distance of 0 or 1 in code points, each once. Null and empty names take no part; empty tables give
    an empty one. No table of names is sent anywhere whole: all joins are by key, and groups are bounded by `limit`."""
    side = lambda t, x: t.select("name").where("name != ''").distinct().withColumn("side", F.lit(x))
    cuts = stored(cut(stored(side(left, 0).unionByName(side(right, 1)), "names"), limit, step), "cut")
    a, b = cuts.where("side = 0"), cuts.where("side = 1")
    # below the cut: subtrees that both sides have
    here = lambda x, y, n: x.select(F.col("cut").alias(f"cut_{n}"), F.col("name").alias(n)).join(y.select(F.col("cut").alias("_c")).hint("merge"), F.col(f"cut_{n}") == F.col("_c"), "left_semi")
    low = here(a, b, "left").groupBy("cut_left").cogroup(here(b, a, "right").groupBy("cut_right")).applyInArrow(_walked, "left string, right string, distance int")
    # above the cut: subtrees that an edit leads to
    high = _edited(a, "left", True).join(_edited(b, "right", False).hint("merge"), ["kind", "at", "key"]).where("cut_left != cut_right")
    return low.unionByName(high.select("left", "right", F.lit(1).alias("distance")))


def name_join(clients: DataFrame, vendors: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """Per vendor and distance with a pair of names that close: vendor_id, distance, n_clients, first_client_id,
    clients_crc.

    clients: (client_id, name), vendors: (vendor_id, name), names in the form to compare. Every pair of rows counts, so
    repeated rows count as often as they are there, and rows that share a vendor_id are summed up. A null client_id is
    counted and adds nothing to the sum; null vendor_ids are one vendor. Null and empty names take no part. Other columns
    are ignored; empty tables give an empty one."""
    told = clients.where("name != ''").groupBy("name").agg(
        F.count(F.lit(1)).alias("n_clients"), F.min(F.col("client_id").cast("long")).alias("first_client_id"), F.sum(F.crc32(F.col("client_id").cast("string").cast("binary"))).alias("clients_crc"))
    told = stored(told, "clients")
    given = stored(vendors.where("name != ''").select("vendor_id", "name"), "vendors")
    pairs = name_pairs(told, given, limit, step)
    sums = [F.sum("n_clients").alias("n_clients"), F.min("first_client_id").alias("first_client_id"), F.sum("clients_crc").alias("clients_crc")]
    close = pairs.join(told.withColumnRenamed("name", "left").hint("merge"), "left").groupBy("right", "distance").agg(*sums)
    return given.join(close.withColumnRenamed("right", "name").hint("merge"), "name").groupBy("vendor_id", "distance").agg(*sums)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = table(spark, sf_dir, "clients").select("client_id", form(F.col("name")).alias("name"))
    vendors = table(spark, sf_dir, "vendors").select("vendor_id", form(misspelt(F.col("name"), F.col("vendor_id"))).alias("name"))
    return name_join(clients, vendors)


def _crc(x: str) -> str:
    """CRC-32 of the decimal digits of a number, a bit at a time."""
    bits = "list_reduce(list_concat([xor(a, CAST(ascii(c) AS BIGINT))], [0, 0, 0, 0, 0, 0, 0, 0]), lambda p, q: CASE WHEN p & 1 = 1 THEN xor(p >> 1, 3988292384) ELSE p >> 1 END)"
    steps = f"list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {steps}), lambda a, c: {bits.replace('CAST(ascii(c) AS BIGINT)', 'c')}))"


_FORM = "regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]', '', 'g')"
#: One edit is where the common beginning of p code points ends.
_ONE = ("(m = n AND (substr(c, p + 2) = substr(v, p + 2) OR (substr(c, p + 1, 1) = substr(v, p + 2, 1) AND substr(c, p + 2, 1) = substr(v, p + 1, 1) AND substr(c, p + 3) = substr(v, p + 3)))"
        " OR m = n + 1 AND substr(c, p + 2) = substr(v, p + 1) OR n = m + 1 AND substr(c, p + 1) = substr(v, p + 2))")
ORACLE_SQL = f"""
WITH own AS MATERIALIZED (SELECT client_id, {_FORM.format('name')} AS c, {_crc('client_id')} AS crc FROM clients WHERE name IS NOT NULL),
hashed AS (SELECT vendor_id, name, length(name) AS l, {_crc('vendor_id')} AS h FROM vendors WHERE name IS NOT NULL),
spelt AS (SELECT vendor_id, CASE WHEN h % 2 = 0 AND l >= 2 THEN concat(substr(name, 1, h % (l - 1)), substr(name, h % (l - 1) + 2, 1), substr(name, h % (l - 1) + 1, 1), substr(name, h % (l - 1) + 3)) ELSE name END AS name FROM hashed),
other AS MATERIALIZED (SELECT vendor_id, {_FORM.format('name')} AS v FROM spelt),
near AS (SELECT *, len(list_filter(range(1, least(m, n) + 1), lambda i: substr(c, 1, i) = substr(v, 1, i))) AS p
  FROM (SELECT *, length(c) AS m, length(v) AS n FROM own JOIN other ON abs(length(c) - length(v)) <= 1 WHERE c <> '' AND v <> ''))
SELECT vendor_id, CAST(CASE WHEN c = v THEN 0 ELSE 1 END AS INT) AS distance, count(*) AS n_clients, min(client_id) AS first_client_id, CAST(sum(crc) AS BIGINT) AS clients_crc
FROM near WHERE c = v OR {_ONE} GROUP BY 1, 2"""
