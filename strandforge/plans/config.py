"""Run parameters, the command line that sets them, and the checks across options."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict, dataclass, field, fields, replace
from datetime import datetime

RANKS = ("species", "genus", "family", "order", "class", "phylum", "kingdom")
SOURCES = ("gbol", "bold", "genbank", "midori")
ALL_SOURCES = ("genbank", "gbol", "bold")  # "all" leaves MIDORI out
DEREP = ("lca", "first", "discard")
OUTPUTS = ("table", "fasta", "comparison", "qiime2", "kraken2", "dada2_taxonomy", "dada2_species", "sintax")


@dataclass(frozen=True)
class Parameters:
    taxon: str = "Arthropoda"
    marker: str = "co1"
    fast_run: bool = False
    num_threads: int = 5
    num_cores: int = 5
    action: str | None = None
    options: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    folders: dict = field(default_factory=dict)
    merge: bool = True
    taxonomy: str = "ncbi"
    synonyms_allowed: bool = False
    retain: bool = False
    derep: dict = field(default_factory=dict)
    outputs: tuple[str, ...] = ("table", "fasta", "comparison")
    max_n: int | None = None
    max_g: int | None = None
    min_length: int | None = None
    max_length: int | None = None
    taxon_rank: str | None = None
    region: dict = field(default_factory=dict)
    shapefile: dict = field(default_factory=dict)

    def checked(self) -> Parameters:
        """Raises on options that exclude each other; expands "all"; a source's folder implies the source; a download
        never dereplicates."""
        if self.marker != "co1":
            raise ValueError("the only marker is co1")
        if self.taxonomy not in ("ncbi", "gbif", "unmapped"):
            raise ValueError(f"no taxonomy {self.taxonomy}")
        if "kraken2" in self.outputs and self.taxonomy != "ncbi":
            raise ValueError("kraken2 output needs the NCBI taxonomy")
        if "dada2_species" in self.outputs and self.taxon_rank not in (None, "species"):
            raise ValueError("dada2_species output needs taxon_rank species, or none")
        if self.taxon_rank is not None and self.taxon_rank not in RANKS:
            raise ValueError(f"no rank {self.taxon_rank}; there are {', '.join(RANKS)}")
        if len([k for k in ("path", "attribute", "values") if self.shapefile.get(k)]) not in (0, 3):
            raise ValueError("a custom shapefile needs path, attribute and values")
        if sum(bool(self.derep.get(k)) for k in DEREP) > 1:
            raise ValueError("choose one dereplication strategy")
        if unknown := [x for x in self.outputs if x not in OUTPUTS]:
            raise ValueError(f"no output {unknown[0]}")
        named = [*(ALL_SOURCES if "all" in self.sources else ()), *self.sources, *(k.removesuffix("_release") for k in self.folders)]
        out = replace(self, sources=tuple(x for x in dict.fromkeys(named) if x != "all"))
        return replace(out, derep={}) if self.action == "download" else out

    def merged(self, config: dict) -> Parameters:
        """A config file's sections replace the defaults' whole sections."""
        known = {f.name for f in fields(self)}
        return replace(self, **{k: tuple(v) if isinstance(v, list) else v for k, v in config.items() if k in known})

    def kept(self) -> str:
        """The parameters as JSON, which `of` reads."""
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def of(cls, text: str) -> Parameters:
        """Parameters from JSON: unknown names are refused, missing ones have their defaults."""
        told = json.loads(text)
        if unknown := sorted(set(told) - {f.name for f in fields(cls)}):
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")
        flat = lambda v: tuple(v) if isinstance(v, list) else {k: flat(x) for k, x in v.items()} if isinstance(v, dict) else v
        return cls(**{k: flat(v) for k, v in told.items()}).checked()

    def strategy(self) -> str | None:
        return next((k for k in DEREP if self.derep.get(k)), None)

    def described(self) -> str:
        """The parameters as they go into a run's folder, one a line."""
        return "\n".join(f"{k}: {v}" for k, v in sorted(asdict(self).items()))


def read_config(text: str) -> dict:
    """A configuration file: `name: value` lines and sections of such lines, indented. Names may begin with a colon.
    Sections of switches become what Parameters hold: the taxonomy, the dereplication, and the outputs that are on."""
    top: dict = {}
    section = None
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith(("#", "---")):
            continue
        name, _, value = bare.strip().lstrip(":").partition(":")
        value = {"true": True, "false": False, "": None}.get(value.strip(), value.strip().strip("\"'"))
        value = int(value) if isinstance(value, str) and value.isdigit() else value
        if line[:1].isspace() and section is not None:
            top[section][name] = value
        elif value is None:
            section, top[name] = name, {}
        else:
            section, top[name] = None, value
    out = {k: v for k, v in top.items() if not isinstance(v, dict) and k != "markers" and k != "taxon_rank"}
    if "markers" in top:
        out["marker"] = top["markers"]
    if on := [k for k, v in top.get("taxonomy", {}).items() if v is True and k in ("ncbi", "gbif", "unmapped")]:
        out["taxonomy"] = on[0]
    if "derep" in top:
        names = {"last_common_ancestor": "lca", "random": "first", "discard": "discard"}
        out["derep"] = {names[k]: bool(v) for k, v in top["derep"].items() if k in names}
    if "output" in top:
        out["outputs"] = tuple(k for k in OUTPUTS if top["output"].get(k))
    return out


def _parser(name: str, *options: tuple) -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog=name, add_help=True, allow_abbrev=False)
    for short, long, kind in options:
        out.add_argument(short, long, **({"action": "store_true"} if kind is bool else {"type": kind}))
    return out


def _yes(text: str) -> bool:
    if text.lower() not in ("true", "false", "yes", "no"):
        raise argparse.ArgumentTypeError("true or false")
    return text.lower() in ("true", "yes")


def _list(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(";") if x.strip())


GLOBAL = (("-t", "--taxon", str), ("-m", "--markers", str), ("-f", "--fast_run", _yes), ("-n", "--num_threads", int), ("-c", "--num_cores", int), ("-v", "--version", bool), ("-r", "--citation", bool))
#: Options of the subcommands: short name, long name, kind of value.
COMMANDS = {
    "download": (("-a", "--all", bool), ("-g", "--gbol", bool), ("-o", "--bold", bool), ("-k", "--genbank", bool), ("-m", "--midori", bool), ("-G", "--gbol_dir", str), ("-B", "--bold_dir", str), ("-K", "--genbank_dir", str), ("-i", "--inv_contaminants", bool)),
    "classify": (("-a", "--all", bool), ("-g", "--gbol", bool), ("-b", "--bold", bool), ("-k", "--genbank", bool), ("-m", "--midori", bool), ("-r", "--bold_release", str), ("-G", "--gbol_dir", str), ("-B", "--bold_dir", str), ("-K", "--genbank_dir", str), ("-M", "--midori_dir", str), ("-n", "--no_merge", bool)),
    "setup": (("-n", "--ncbi_taxonomy", bool), ("-g", "--gbif_taxonomy", bool), ("-H", "--gbif_homonyms", bool), ("-x", "--reset_taxonomies", bool)),
    "update": (("-a", "--all", bool), ("-b", "--gbif_taxonomy", bool), ("-n", "--ncbi_taxonomy", bool), ("-B", "--check_gbif_taxonomy", bool), ("-N", "--check_ncbi_taxonomy", bool), ("-m", "--midori_config", bool), ("-g", "--gbol_config", bool)),
    "output": (("-t", "--table", _yes), ("-f", "--fasta", _yes), ("-c", "--comparison", _yes), ("-q", "--qiime2", _yes), ("-k", "--kraken2", _yes), ("-d", "--dada2_taxonomy", _yes), ("-s", "--dada2_species", _yes), ("-x", "--sintax", _yes)),
    "filter": (("-N", "--max_N", int), ("-G", "--max_G", int), ("-l", "--min_length", int), ("-L", "--max_length", int), ("-r", "--taxon_rank", str)),
    "derep": (("-l", "--last_common_ancestor", bool), ("-r", "--random", bool), ("-d", "--discard", bool), ("-n", "--no_derep", bool)),
    "taxonomy": (("-B", "--gbif", bool), ("-n", "--ncbi", bool), ("-u", "--unmapped", bool), ("-s", "--synonyms_allowed", bool), ("-r", "--retain", bool)),
    "region": (("-c", "--country", _list), ("-C", "--available_countries", bool), ("-k", "--continent", _list), ("-K", "--available_continents", bool), ("-b", "--biogeographic_realm", _list), ("-B", "--available_biogeographic_realms", bool),
               ("-e", "--terrestrial_ecoregion", _list), ("-E", "--available_terrestrial_ecoregion", bool), ("-s", "--custom_shapefile", str), ("-S", "--custom_shapefile_attribute", str), ("-v", "--custom_shapefile_values", _list)),
}
ACTIONS = ("download", "classify", "setup", "update")


def parsed(words: list[str], defaults: Parameters | None = None) -> Parameters:
    """Parameters of a command line: global options, then subcommands with options of their own. Words that name no
    subcommand are skipped. At most one action (download, classify, setup, update) may be asked for; of several
    strategies of one kind the last counts."""
    p, parts, at = defaults or Parameters(), [("", [])], 0
    for word in words:
        if word in COMMANDS and not (parts[-1][1] and _takes_value(parts[-1])):
            parts.append((word, []))
        else:
            parts[-1][1].append(word)
    got, _ = _parser("", *GLOBAL).parse_known_args(parts[0][1])
    p = replace(p, options=tuple(k for k in ("version", "citation") if getattr(got, k)))
    p = replace(p, **{k: v for k, v in {"taxon": got.taxon, "marker": got.markers, "fast_run": got.fast_run, "num_threads": got.num_threads, "num_cores": got.num_cores}.items() if v is not None})
    actions = []
    for at, (name, rest) in enumerate(parts[1:]):
        given, _ = _parser(name, *COMMANDS[name]).parse_known_args(rest)
        on = {k: v for k, v in vars(given).items() if v not in (None, False)}
        if name in ACTIONS and on:
            actions.append(name)
            p = replace(p, options=tuple(on))
        if name in ("download", "classify"):
            folders = {k.removesuffix("_dir"): v for k, v in on.items() if k.endswith(("_dir", "_release"))}
            p = replace(p, sources=tuple(k for k in ("all", *SOURCES) if on.get(k)), folders=folders, merge=not on.get("no_merge", False))
        elif name == "output":
            chosen = {k: k in p.outputs for k in OUTPUTS} | {k: v for k, v in vars(given).items() if v is not None}
            p = replace(p, outputs=tuple(k for k in OUTPUTS if chosen[k]))
        elif name == "filter":
            names = {"max_N": "max_n", "max_G": "max_g"}
            p = replace(p, **{names.get(k, k): v for k, v in vars(given).items() if v is not None})
        elif name == "derep":
            names = {"last_common_ancestor": "lca", "random": "first", "discard": "discard", "no_derep": None}
            if last := _last(rest, COMMANDS[name], names):
                p = replace(p, derep={names[last]: True} if names[last] else {})
        elif name == "taxonomy":
            if last := _last(rest, COMMANDS[name], ("gbif", "ncbi", "unmapped")):
                p = replace(p, taxonomy=last)
            p = replace(p, synonyms_allowed=given.synonyms_allowed, retain=given.retain)
        elif name == "region":
            names = {"country": "countries", "continent": "continents", "biogeographic_realm": "realms", "terrestrial_ecoregion": "ecoregions"}
            shape = {k: on[f"custom_shapefile{x}"] for k, x in (("path", ""), ("attribute", "_attribute"), ("values", "_values")) if f"custom_shapefile{x}" in on}
            lists = {"listing": k.removeprefix("available_") for k in on if k.startswith("available_")}
            p = replace(p, region=p.region | {names[k]: v for k, v in on.items() if k in names} | lists, shapefile=p.shapefile | shape)
    if len(set(actions)) > 1:
        raise ValueError(f"more than one action: {', '.join(dict.fromkeys(actions))}")
    return replace(p, action=actions[0] if actions else None).checked()


def _takes_value(part: tuple[str, list[str]]) -> bool:
    """Whether the last word of a part is an option that still waits for its value."""
    options = COMMANDS.get(part[0], GLOBAL)
    return any(part[1][-1] in (short, long) and kind is not bool for short, long, kind in options)


def _last(words: list[str], options: tuple, names) -> str | None:
    """The last of some switches that was given."""
    found = [long[2:] for w in words for short, long, _ in options if w in (short, long) and long[2:] in names]
    return found[-1] if found else None


def run_folder(taxon: str, at: datetime) -> str:
    return f"{taxon}-{at:%Y%m%dT%H%M}"
