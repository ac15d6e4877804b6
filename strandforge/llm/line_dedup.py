"""Line dedup with a log-template tree.

A line's way through the tree is fixed: its number of tokens, then its leading tokens. Tokens with digits, addresses
and the like are variable from the start. In a leaf with several different lines, the commonest token of each
position is the leaf's template; lines that agree with it in most positions beyond the leading ones belong to it, and
the positions where they differ are variable too. Lines that belong to none are grouped by the tokens they share at one
or two positions, and each group has a template likewise, so a leaf may hold many. Templates found in many documents are dropped from them. Documents that hold next to
nothing but recurring lines may be copies of each other, whose text recurs without being boilerplate: they are told
apart by the rarest of their templates, and those with the same one count as one document.

Everything about a leaf is a sum (documents per leaf, per line, per position and token), so a hot leaf is
pre-aggregated before any shuffle and never gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, KEY_SCHEMA, key_of, keyed, mixed, plainly, quoted, raw, runs, signed, span_hashes, spans, spelled, stored, table

DEPTH = 3
#: Positions whose tokens, alone and in pairs, group the lines of a leaf; lines with fewer use all.
ANCHORS = 8
#: Lines of fewer words are templates only as they are, digits included, and in `SHORT` times as many documents.
SHORTEST, SHORT = 3, 2
#: Two documents whose recurring lines are the same can be near duplicates at this percentage of shared words.
NEAR = 85
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


_VARIABLE = np.uint64(0x5851F42D4C957F2D)
_MARKS = np.zeros(256, bool)
_MARKS[[*range(48, 58), 64]] = True


def _tokens_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, where words with a digit, an address or a path share one; and hashes of the words as they are."""
    exact = span_hashes(data, start, end)
    h = exact.copy()
    marks = _MARKS[data]
    if len(data) > 2:
        marks[:-2] |= (data[:-2] == 58) & (data[1:-1] == 47) & (data[2:] == 47)
    h[np.searchsorted(start, np.flatnonzero(marks), "right") - 1] = _VARIABLE
    return h, exact


def parsed(texts: list[bytes | None]):
    """Of each line with a word: its document (place in `texts`), number, first token, token count, leaf, and hash of
    the masked line (as it is, if short or of variable tokens only); and the tokens."""
    data = np.frombuffer(b"\n".join(x or b"" for x in texts), np.uint8)
    start, end = spans(data)
    if not len(start):
        return None
    h, exact = _tokens_of(data, start, end)
    newlines = np.flatnonzero(data == 10)
    size = np.bincount(np.searchsorted(newlines, start), minlength=len(newlines) + 1)
    own = np.array([x.count(b"\n") + 1 if x else 1 for x in texts])
    line_at = np.flatnonzero(size)
    doc = np.repeat(np.arange(len(texts)), own)[line_at]
    number = line_at - (np.cumsum(own) - own)[doc]
    n = size[line_at]
    first = np.cumsum(n) - n
    at = np.arange(len(h)) - np.repeat(first, n)
    places = mixed(np.arange(int(n.max()), dtype=np.uint64) * _A)
    as_is = (n < SHORTEST) | (np.bincount(np.repeat(np.arange(len(n)), n), weights=h != _VARIABLE, minlength=len(n)) == 0)
    told = np.where(np.repeat(as_is, n), exact, h)
    line = mixed(np.add.reduceat(mixed(told + places[at]), first) + n.astype(np.uint64))
    leaf = mixed(n.astype(np.uint64) * _B)
    for k in range(DEPTH):
        leaf = mixed(leaf + np.where(k < n, h[np.minimum(first + k, len(h) - 1)], np.uint64(k)))
    leaf = np.where(as_is, mixed(line + _B), leaf)  # nothing to generalise: a leaf of its own
    return doc, number, first, n, leaf, line, h


def _new(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """1 at the first row of each document and key, else 0."""
    order = np.lexsort((key, doc))
    changed = np.r_[True, (np.diff(doc[order]) != 0) | (key[order][1:] != key[order][:-1])] if len(order) else np.empty(0, bool)
    out = np.zeros(len(doc), np.int8)
    out[order] = changed
    return out


def _lines(batches):
    for b in batches:
        key, texts = key_of(b), raw(b, "text")
        for lo, hi in runs(texts):
            if got := parsed(texts[lo:hi]):
                doc, number, _, n, leaf, line = got[:6]
                words = np.bincount(doc, weights=n).astype(np.int32)[doc]
                cols = (*[k[lo + doc] for k in key], number.astype(np.int32), n.astype(np.int32), words, signed(leaf), signed(line), _new(doc, leaf), _new(doc, line))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], [*KEY, "number", "n", "words", "leaf", "line", "new_leaf", "new_line"])


def _tokens(batches):
    """The tokens of chosen lines, as hashes."""
    for b in batches:
        texts, picks = raw(b, "text"), b.column("picks").to_pylist()
        for lo, hi in runs(texts):
            doc, number, first, n, _, _, h = parsed(texts[lo:hi])
            where = {x: i for i, x in enumerate(zip(doc.tolist(), number.tolist(), strict=True))}
            chosen = [(x, where[d, x["number"]]) for d, own in enumerate(picks[lo:hi]) for x in own]
            tokens = [signed(h[first[i]: first[i] + n[i]]) for _, i in chosen]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([x[c] for x, _ in chosen], pa.int64()) for c in ("leaf", "line", "docs")], pa.array(tokens, pa.list_(pa.int64()))], ["leaf", "line", "docs", "tokens"])


def _anchors(batches):
    """Groups of lines that share a token at a position beyond the leading ones, or two."""
    for b in batches:
        leaf, line, docs, groups = [], [], [], []
        for f, x, d, tokens in zip(b.column("leaf").to_pylist(), b.column("line").to_pylist(), b.column("docs").to_pylist(), b.column("tokens").to_pylist(), strict=True):
            at = np.unique(np.linspace(DEPTH, len(tokens) - 1, min(ANCHORS, len(tokens) - DEPTH)).astype(int))
            one = mixed(np.array(tokens, np.int64)[at].view(np.uint64) + mixed((at + 1).astype(np.uint64) * _B))
            own = np.unique(np.r_[one, one + np.roll(one, 1), one + np.roll(one, 2)] + np.array([f], np.int64).view(np.uint64))
            groups.append(mixed(own))
            leaf += [f] * len(own)
            line += [x] * len(own)
            docs += [d] * len(own)
        g = signed(np.concatenate(groups)) if groups else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(g), *[pa.array(x, pa.int64()) for x in (leaf, line, docs)]], ["g", "leaf", "line", "docs"])


def _general(lines: DataFrame, tokens: DataFrame, min_docs: int, alike: float) -> DataFrame:
    """(leaf, line, docs, template) of lines that agree with their group's commonest tokens, in enough documents."""
    at = tokens.select("g", "leaf", "line", "docs", (F.size("tokens") - DEPTH).alias("n"), F.posexplode("tokens").alias("p", "token")).where(F.col("p") >= DEPTH)
    votes = at.groupBy("g", "p", "token").agg(F.sum("docs").alias("votes"))
    mode = votes.groupBy("g", "p").agg(F.max(F.struct("votes", "token")).alias("m")).select("g", "p", F.col("m.token").alias("common"))
    agree = at.join(mode, ["g", "p"]).groupBy("g", "leaf", "line").agg(F.sum((F.col("token") == F.col("common")).cast("long")).alias("same"), F.max("n").alias("n"))
    members = agree.where(F.col("same") >= alike * F.col("n") - 1e-9).select("g", "leaf", "line")
    held = lines.join(members, ["leaf", "line"]).select("g", *KEY).distinct().groupBy("g").agg(F.count(F.lit(1)).alias("docs"))
    return members.join(held.where(F.col("docs") >= min_docs), "g").select("leaf", "line", "docs", F.col("g").alias("template"))


def _cut(batches):
    for b in batches:
        cols = [[] for _ in range(5)]
        for text, found, gone in zip(raw(b, "text"), b.column("found").to_pylist(), b.column("gone").to_pylist(), strict=True):
            lines = text.split(b"\n") if text else []
            drop = set(gone or ())
            for col, x in zip(cols, (sum(bool(x.split()) for x in lines), len(found or ()), len(drop), b"\n".join(x for i, x in enumerate(lines) if i not in drop) if text is not None else None, sorted(drop)), strict=True):
                col.append(x)
        rest = [c for c in b.schema.names if c not in ("text", "found", "gone")]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in rest], pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.binary()).cast(pa.string()), pa.array(cols[4], pa.list_(pa.int32()))],
            [*rest, "n_lines", "n_recurring", "n_removed", "kept_text", "removed_lines"],
        )


def recurring_lines(docs: DataFrame, min_docs: int = 5, alike: float = 0.6) -> DataFrame:
    """(key, number, gone): lines of templates that at least `min_docs` documents hold; `gone` where these are that
    many with copies counted once."""
    texts = keyed(docs).select(*KEY, "text")
    if not docs.groupBy("doc_id").count().where("count > 1").isEmpty():  # equal rows count once; without any, no text moves
        texts = texts.dropDuplicates(KEY)
    lines = stored(texts.mapInArrow(
        _lines, f"{KEY_SCHEMA}, number int, n int, words int, leaf long, line long, new_leaf byte, new_line byte"), "lines")
    leaves = lines.groupBy("leaf").agg(F.sum("new_leaf").alias("docs"), F.min("line").alias("a"), F.max("line").alias("b"), F.max("n").alias("n"))
    leaves = leaves.where((F.col("docs") >= min_docs) & (F.col("n") >= SHORTEST))
    kinds = lines.groupBy("leaf", "line").agg(F.sum("new_line").alias("docs"), F.min(F.struct(*KEY, "number")).alias("at"), F.max("n").alias("n"))
    enough = F.when(F.col("n") < SHORTEST, SHORT * min_docs).otherwise(min_docs)
    # lines that recur as they are (variable tokens masked)
    exact = kinds.where(F.col("docs") >= enough).select("leaf", "line", "docs", F.col("line").alias("template"))
    # leaves with several lines: first one template from the commonest token of each position
    several = kinds.join(leaves.where("a != b").select("leaf"), "leaf").select("leaf", "line", "docs", "at.*")
    picks = several.groupBy(*KEY).agg(F.collect_list(F.struct("number", "leaf", "line", "docs")).alias("picks"))
    tokens = texts.join(picks, KEY).select("text", "picks").mapInArrow(
        _tokens, "leaf long, line long, docs long, tokens array<long>")
    tokens = stored(tokens, "tokens")
    general = stored(_general(lines, tokens.withColumn("g", F.col("leaf")), min_docs, alike), "general")
    # the others by shared tokens; groups of the same lines are one
    others = tokens.join(general.select("leaf", "line"), ["leaf", "line"], "left_anti")
    anchors = stored(others.mapInArrow(_anchors, "g long, leaf long, line long, docs long"), "anchors")
    groups = anchors.groupBy("leaf", "g").agg(F.sum("docs").alias("docs"), F.bit_xor("line").alias("all"), F.count(F.lit(1)).alias("lines"))
    groups = groups.where((F.col("docs") >= min_docs) & (F.col("lines") > 1)).groupBy("leaf", "all", "lines").agg(F.min("g").alias("g"))
    grouped = anchors.drop("docs").join(groups.select("leaf", "g"), ["leaf", "g"]).join(tokens, ["leaf", "line"])
    general = general.unionByName(_general(lines, grouped, min_docs, alike))
    # a line belongs to the template that most documents hold
    chosen = exact.unionByName(general).groupBy("leaf", "line").agg(F.max(F.struct("docs", "template")).alias("t")).select("leaf", "line", "t.*")
    chosen = stored(chosen, "chosen")  # a plain table, so that a line that stands almost everywhere can be split
    found = stored(lines.join(chosen, ["leaf", "line"]).select(*KEY, "number", "n", "words", "docs", "template"), "found")
    own = found.groupBy(*KEY).agg(F.sum("n").alias("held"), F.max("words").alias("words"), F.min(F.struct("docs", "template")).alias("rarest"))
    own = own.select(*KEY, F.when((100 + NEAR) * F.col("held") >= 2 * NEAR * F.col("words"), F.col("rarest.template")).otherwise(F.xxhash64(*KEY)).alias("group"))
    support = found.join(own, KEY).groupBy("template", "group").agg(F.max("n").alias("n")).groupBy("template").agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("n"))
    support = stored(support.select("template", (F.col("groups") >= enough).alias("gone")), "support")  # plain, as above
    return found.join(support, "template").select(*KEY, "number", "gone")


def line_dedup(docs: DataFrame, min_docs: int = 5, alike: float = 0.6) -> DataFrame:
    """Drops lines whose template is found in at least `min_docs` documents, first occurrences included.

    Returns the columns of `docs`, less text and any of the names added, and n_lines (lines with a word),
    n_recurring, n_removed, kept_text, removed_lines (numbers from 0). Documents with so few words outside recurring
    lines that they may be near duplicates count once if the rarest of their templates is the same: lines that recur
    in copies of one document only stay (n_recurring counts them), and deduplication of documents decides about them.
    Lines of one or two words go if they recur exactly, in twice `min_docs` documents; lines of nothing but numbers and
    the like are data, and go only if they recur as they are. Null text stays null, empty stays empty; lines without a word are
    never removed. Equal rows (same doc_id and text) count as one document and are each returned; a null doc_id is
    a document like any other. An empty table gives an empty table."""
    added = {"n_lines", "n_recurring", "n_removed", "kept_text", "removed_lines", "found", "gone", *KEY}
    more = [c for c in docs.columns if c not in added | {"doc_id", "text"}]
    found = recurring_lines(docs, min_docs, alike).groupBy(*KEY).agg(F.collect_list("number").alias("found"), F.collect_list(F.when(F.col("gone"), F.col("number"))).alias("gone"))
    given = keyed(docs, *more).join(found, KEY, "left").select("doc_id", *map(quoted, more), "text", "found", "gone")
    given = plainly(given, ("doc_id", "text", "found", "gone"))
    schema = spelled(given, ("text", "found", "gone"))
    out = given.mapInArrow(_cut, f"{schema}, n_lines long, n_recurring long, n_removed long, kept_text string, removed_lines array<int>")
    return out.toDF("doc_id", *more, *out.columns[1 + len(more):])


def query(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_recurring", "n_removed", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))


ORACLE_SQL = None
