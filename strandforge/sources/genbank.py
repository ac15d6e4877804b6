"""GenBank flat files: the feature table, locations, and the marker cut out of a record."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

Segment = tuple[int, int, bool]  # first and last base from 1, and whether on the other strand

_TOKEN = re.compile(r"\s*(complement|join|order|[(),]|[^\s(),]+)")
_RANGE = re.compile(r"[<>]?(\d+)(?:\.\.[<>]?(\d+))?$")
_BETWEEN = re.compile(r"\d+\^\d+$")
#: Bases and ambiguity codes with their complements.
_COMPLEMENT = str.maketrans("ACGTUMRWSYKVHDBNacgtumrwsykvhdbn", "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn")


def segments(location: str) -> list[Segment] | None:
    """A location's pieces in the order in which they are read: nested joins, orders and complements, partial ends. A
    place between two bases has none. None for what cannot be told from the record alone or is not well-formed: other
    records' bases, one of several places, unknown words."""
    tokens, at = _TOKEN.findall(location), 0
    if "".join(tokens) != re.sub(r"\s", "", location):
        return None

    def one() -> list[Segment] | None:
        nonlocal at
        if at >= len(tokens):
            return None
        word, at = tokens[at], at + 1
        if word in ("complement", "join", "order"):
            if at >= len(tokens) or tokens[at] != "(":
                return None
            parts, at = [], at + 1
            while True:
                part = one()
                if part is None or at >= len(tokens):
                    return None
                parts.append(part)
                end, at = tokens[at], at + 1
                if end == ")":
                    break
                if end != "," or word == "complement":
                    return None
            flat = [s for p in parts for s in p]
            return [(a, b, not back) for a, b, back in reversed(flat)] if word == "complement" else flat
        if _BETWEEN.match(word):
            return []
        if m := _RANGE.match(word):
            a, b = int(m[1]), int(m[2] or m[1])
            return [(a, b, False)] if 0 < a <= b else None
        return None

    out = one()
    return out if at == len(tokens) else None


def cut(pieces: list[Segment] | None, sequence: str) -> str | None:
    """The bases of a location; None if it has none or goes beyond the sequence."""
    if not pieces or any(b > len(sequence) for _, b, _ in pieces):
        return None
    return "".join(sequence[a - 1: b].translate(_COMPLEMENT)[::-1] if back else sequence[a - 1: b] for a, b, back in pieces)


def features(record: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, location, qualifiers) of a record's feature table: keys begin in the 6th column, what belongs to them in the
    22nd. Values lose their quotes; values over several lines are joined by blanks; of a repeated qualifier the first
    counts."""
    found = re.search(r"^FEATURES.*\n((?:[ \t].*(?:\n|$))*)", record, re.M)
    kind, location, told, name, inside = None, "", {}, None, False
    for line in found[1].splitlines() if found else ():
        key, rest = line[5:21].strip() if line[:5].strip() == "" else "", line[21:].strip()
        if key and not inside:
            if kind:
                yield kind, location, _clean(told)
            kind, location, told, name = key, rest, {}, None
        elif inside:
            told[name] += " " + rest
            inside = told[name].count('"') % 2 == 1
        elif rest.startswith("/"):
            name, _, value = rest[1:].partition("=")
            while name in told:
                name += "'"
            told[name] = value
            inside = value.startswith('"') and value.count('"') % 2 == 1
        elif name is None:
            location += rest
        else:
            told[name] += " " + rest
    if kind:
        yield kind, location, _clean(told)


def _clean(told: dict[str, str]) -> dict[str, str]:
    return {k: v[1:-1].replace('""', '"') if len(v) > 1 and v[0] == v[-1] == '"' else v for k, v in told.items() if "'" not in k}


def marker_of(record: str, genes: frozenset[str], products: frozenset[str]) -> str | None:
    """The marker's bases in a record, in upper case: of coding regions whose gene or product is it, else of genes, the
    longest, of several the first. None if the record does not say that it holds the marker, or where."""
    head, _, origin = record.partition("\nORIGIN")
    sequence = re.sub(r"[^A-Za-z-]", "", origin.partition("\n")[2]).upper()
    plain = lambda x: re.sub(r"[\s_-]+", " ", x or "").strip().lower()
    best: dict[str, str] = {}
    for kind, location, told in features(head):
        if kind in ("CDS", "gene") and (plain(told.get("gene")) in genes or plain(told.get("product")) in products):
            found = cut(segments(location), sequence)
            if found and len(found) > len(best.get(kind, "")):
                best[kind] = found
    return best.get("CDS") or best.get("gene")


def marker_sequence(genes: frozenset[str], products: frozenset[str]):
    """A column function over records' texts (`marker_of`), in Arrow batches."""
    @F.pandas_udf(T.StringType())
    def cut_out(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: marker_of(x, genes, products))
    return cut_out
