"""What a command line asks for, done: listings, taxonomy setup and update, classification.

Everything lies under one data folder, in any store Spark knows: downloads/<SOURCE>/<name>-<time>, dumps/ncbi and
dumps/gbif (with a file `release` that names their release), taxonomy/, places/countries and places/<layer> as Parquet,
results/. Fetching files from the network is not part of the engine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators import region, taxonomy
from ..sources import readers
from . import classify, scripts
from .config import COMMANDS, Parameters, parsed, read_config

VERSION = "2"
_IMPORT = {"ncbi": readers.ncbi_taxonomy, "gbif": readers.gbif_taxonomy}


def asked_cores(words: list[str]) -> int | None:
    """The number of cores that a command line asks for, if any."""
    given = words[: next((i for i, w in enumerate(words) if w in COMMANDS), len(words))]
    at = next((i for i, w in enumerate(given) if w in ("-c", "--num_cores")), None)
    return int(given[at + 1]) if at is not None and at + 1 < len(given) and given[at + 1].isdigit() else None


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if _exists(spark, path) else None


def release(spark: SparkSession, folder: str) -> str:
    """The release a folder holds, as its file `release` says; releases are ordered as texts. Empty if there is none."""
    rows = spark.read.text(f"{folder}/release").limit(1).collect() if _exists(spark, f"{folder}/release") else []
    return rows[0].value.strip() if rows else ""


def import_taxonomy(spark: SparkSession, data: str, name: str, only_newer: bool = False) -> bool:
    """Reads a dump into taxonomy/<name>, replacing what is there; with `only_newer` only if its release is newer. Tells
    whether it did."""
    dump, target = f"{data}/dumps/{name}", f"{data}/taxonomy/{name}"
    new = release(spark, dump)
    if only_newer and _exists(spark, target) and new <= release(spark, f"{target}-about"):
        return False
    _IMPORT[name](spark, dump).write.mode("overwrite").parquet(target)
    spark.createDataFrame([(new,)], "value string").coalesce(1).write.mode("overwrite").text(f"{target}-about/release")
    return True


def listing(spark: SparkSession, data: str, kind: str) -> list[str]:
    """Known names of countries, continents, realms or ecoregions, in order."""
    if kind in ("countries", "continents"):
        rows = region.catalogue(spark.read.parquet(f"{data}/places/countries"), {"countries": "country", "continents": "continent"}[kind])
    else:
        layer = {"biogeographic_realms": "realms", "terrestrial_ecoregion": "ecoregions"}[kind]
        rows = region.catalogue(spark.read.parquet(f"{data}/places/{layer}"), "name")
    return [r.name for r in rows.collect()]


def main(spark: SparkSession, words: list[str], data: str = ".", at: datetime | None = None, config: str | None = None) -> list[str]:
    """Does it and returns what there is to say, a line each. `config`: the text of a configuration; without it the file
    default_config.yaml of the data folder counts, if there is one. Its values are defaults of the command line."""
    if words[:1] == ["script"]:
        return scripts.main(spark, words[1:])
    if config is None and _exists(spark, f"{data}/default_config.yaml"):
        config = spark.read.text(f"{data}/default_config.yaml", wholetext=True).first().value
    params = parsed(words, Parameters().merged(read_config(config)) if config else None)
    if "version" in params.options:
        return [VERSION]
    if "citation" in params.options:
        return ["cite the data sources of your run and this engine's repository"]
    if kind := params.region.get("listing"):
        return listing(spark, data, kind)
    if params.action == "download":
        raise ValueError("downloads are not part of the engine: put files under downloads/<SOURCE>/<name>-<time>")
    if params.action == "setup":
        names = [n for n in _IMPORT if f"{n}_taxonomy" in params.options or "reset_taxonomies" in params.options]
        done = [n for n in names if import_taxonomy(spark, data, n)]
        if "gbif_homonyms" in params.options or "reset_taxonomies" in params.options:
            taxonomy.homonyms(spark.read.parquet(f"{data}/taxonomy/gbif")).write.mode("overwrite").parquet(f"{data}/taxonomy/gbif-homonyms")
            done.append("gbif-homonyms")
        return [f"imported {n}" for n in done]
    if params.action == "update":
        asked = params.options
        out = [f"imported {n}" for n in _IMPORT if ("all" in asked or f"{n}_taxonomy" in asked) and import_taxonomy(spark, data, n, only_newer=True)]
        return out + [f"{n}: {'new release' if release(spark, f'{data}/dumps/{n}') > release(spark, f'{data}/taxonomy/{n}-about') else 'up to date'}" for n in _IMPORT if f"check_{n}_taxonomy" in asked]
    if params.action == "classify":
        polygons = {k: t for k in ("realms", "ecoregions") if (t := _table(spark, f"{data}/places/{k}")) is not None}
        backbone = _table(spark, f"{data}/taxonomy/{'ncbi' if params.taxonomy == 'unmapped' else params.taxonomy}")
        out = classify.run(spark, params, f"{data}/results", at or datetime.now(), backbone, _table(spark, f"{data}/places/countries"), polygons, f"{data}/downloads")
        return sorted(out.values())
    return ["name one of download, classify, setup, update"]
