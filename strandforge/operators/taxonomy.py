"""Harmonization against a backbone taxonomy(taxon_id, parent_id, name, rank, status, accepted_id, is_extinct)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written

#: From fine to coarse, and the columns that hold them.
RANKS = ["species", "genus", "family", "order", "class", "phylum", "kingdom"]
COLUMNS = {r: "order_name" if r == "order" else r for r in RANKS}


def lineages(taxonomy: DataFrame) -> DataFrame:
    """(taxon_id, path): structs of taxon_id, rank and name from the root down, of any depth.

    Paths are doubled: each round joins every unfinished path to the path of the taxon where it ends, so a tree of depth
    d takes log2(d) rounds. Each round is written, which keeps plans short. A taxon that is its own ancestor is refused;
    one whose parent is not in the table ends there."""
    known = taxonomy.select(F.col("taxon_id").alias("at_"), F.lit(True).alias("there_"))
    start = taxonomy.select("taxon_id", F.when(F.col("parent_id") != F.col("taxon_id"), F.col("parent_id")).alias("at"), F.array(F.struct("taxon_id", "rank", "name")).alias("path"))
    walk = start.join(known, start["at"] == known["at_"], "left").select("taxon_id", F.when(F.col("there_"), F.col("at")).alias("at"), "path")
    while True:
        walk = written(walk, "walk")
        open_, deepest = walk.agg(F.count("at"), F.max(F.size("path"))).first()
        if not open_:
            return walk.select("taxon_id", "path")
        if deepest > 4_000:  # a tree that deep is none
            raise ValueError("the taxonomy has a circle")
        up = walk.select(F.col("taxon_id").alias("up_id"), F.col("at").alias("up_at"), F.col("path").alias("up_path"))
        walk = walk.join(up, walk["at"] == up["up_id"], "left").select("taxon_id", F.col("up_at").alias("at"), F.when(F.col("up_path").isNotNull(), F.concat("up_path", "path")).otherwise(F.col("path")).alias("path"))


def standard_lineages(lines: DataFrame) -> DataFrame:
    """(taxon_id, and a column per standard rank) from paths: other ranks are left out, unknown ones are empty."""
    name = lambda r: F.coalesce(F.get(F.filter("path", lambda x: x["rank"] == r), F.lit(0))["name"], F.lit(""))
    return lines.select("taxon_id", *[name(r).alias(COLUMNS[r]) for r in reversed(RANKS)])


def resolve_synonyms(taxonomy: DataFrame) -> DataFrame:
    """(taxon_id, used_id, used_name): the accepted taxon for a synonym, itself for any other. A synonym of a synonym
    leads on, for as many steps as there are; where an accepted taxon is missing, the last one found is used. Synonyms
    that go round in a circle, or lead into one, stand for nothing and are left out.

    Ways are doubled, and only synonyms take part: usually the first round finds that all have arrived."""
    names = taxonomy.select(F.col("taxon_id").alias("g_id"), F.col("name").alias("g_name"))
    steps = taxonomy.where("accepted_id is not null and accepted_id != taxon_id").select("taxon_id", F.col("accepted_id").alias("to"))
    linked = steps.join(names.select("g_id"), steps["to"] == F.col("g_id"), "left_semi")
    open_ = None
    while True:
        onward = linked.select(F.col("taxon_id").alias("n_id"), F.col("to").alias("n_to"))
        linked = written(linked.join(onward, linked["to"] == onward["n_id"], "left").select("taxon_id", "to", "n_to"), "synonyms")
        before, open_ = open_, linked.agg(F.count("n_to")).first()[0]
        if not open_ or open_ == before:  # all have arrived, or those left never do
            break
        linked = linked.select("taxon_id", F.coalesce("n_to", "to").alias("to"))
    own = taxonomy.select("taxon_id", "name").join(linked.select(F.col("taxon_id").alias("l_id"), "to", "n_to"), F.col("taxon_id") == F.col("l_id"), "left").where("n_to is null")
    return own.join(names, F.col("to") == F.col("g_id"), "left").select("taxon_id", F.coalesce("to", "taxon_id").alias("used_id"), F.coalesce("g_name", "name").alias("used_name"))


def homonyms(taxonomy: DataFrame) -> DataFrame:
    """(name, rank, taxa): names that stand for several taxa of one rank."""
    return taxonomy.groupBy("name", "rank").agg(F.count(F.lit(1)).alias("taxa")).where("taxa > 1")


def finest(frame: DataFrame) -> DataFrame:
    """Adds finest_name, finest_rank and above: rank and name of each coarser known taxon, which tell homonyms apart."""
    known = F.filter(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(COLUMNS[r]).alias("name")) for r in RANKS]), lambda x: x["name"] != "")
    return frame.withColumn("_known", known).withColumns({
        "finest_name": F.get("_known", F.lit(0))["name"], "finest_rank": F.get("_known", F.lit(0))["rank"], "above": F.slice("_known", 2, len(RANKS))}).drop("_known")


def meant(names: DataFrame, taxonomy: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """(finest_name, finest_rank, above, taxon_id, used_id, used_name): the taxon that each of some distinct names means.

    A name at a rank that stands for several taxa is a homonym. Its taxa are told apart by their ways from the root: the
    one counts on which most of the coarser taxa known for the name lie, whatever ranks lie between. If several have as
    many, the name means none of them, unless all stand for one accepted taxon. Ways are looked up for homonyms only, and
    made (`lineages`) only where there are any and `lines` is not given."""
    key = ["finest_name", "finest_rank", "above"]
    found = names.join(taxonomy.select("taxon_id", "name", "rank"), (F.col("finest_name") == F.col("name")) & (F.col("finest_rank") == F.col("rank"))).select(*key, "taxon_id", F.col("name").alias("own_name"))
    found = written(found.join(resolve_synonyms(taxonomy), "taxon_id"), "names")
    one = found.groupBy(*key).agg(F.min("used_id").alias("least"), F.max("used_id").alias("most"), F.min(F.struct(F.col("taxon_id") != F.col("used_id"), "taxon_id", "own_name", "used_id", "used_name")).alias("t"))
    columns = [*key, "t.taxon_id", "t.own_name", "t.used_id", "t.used_name"]
    sure, doubtful = one.where("least = most").select(*columns), one.where("least < most").select(*key)
    if doubtful.isEmpty():
        return sure
    lines = lineages(taxonomy) if lines is None else lines
    homonyms_ = found.join(doubtful, key, "left_semi").join(lines, "taxon_id", "left")
    score = F.size(F.filter("above", lambda a: F.exists(F.coalesce("path", F.array().cast(lines.schema["path"].dataType)), lambda x: (x["rank"] == a["rank"]) & (x["name"] == a["name"]))))
    scored = homonyms_.select(*key, "taxon_id", "own_name", "used_id", "used_name", score.alias("score"))
    best = scored.groupBy(*key).agg(F.max("score").alias("best"))
    told = scored.join(best, key).where("score = best").groupBy(*key).agg(
        F.min("used_id").alias("least"), F.max("used_id").alias("most"), F.min(F.struct(F.col("taxon_id") != F.col("used_id"), "taxon_id", "own_name", "used_id", "used_name")).alias("t"))
    return sure.unionByName(told.where("least = most").select(*columns))


def harmonize(frame: DataFrame, taxonomy: DataFrame, retain: bool = False, synonyms_allowed: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """Adds taxon_id and used_name of the taxon that the finest known name means (`meant`); records without one go
    unless `retain`. Distinct names are matched, not records."""
    told = finest(frame)
    match = meant(told.where("finest_name is not null").select("finest_name", "finest_rank", "above").distinct(), taxonomy, lines)
    own = [F.col("taxon_id"), F.col("own_name").alias("used_name")] if synonyms_allowed else [F.col("used_id").alias("taxon_id"), F.col("used_name")]
    match = match.select(F.col("finest_name").alias("m_name"), F.col("finest_rank").alias("m_rank"), F.col("above").alias("m_above"), *own)
    same = (F.col("finest_name") == F.col("m_name")) & (F.col("finest_rank") == F.col("m_rank")) & (F.col("above") == F.col("m_above"))
    out = told.join(match, same, "left" if retain else "inner")
    return out.select(*frame.columns, "finest_name", "finest_rank", "taxon_id", F.coalesce("used_name", "finest_name").alias("used_name"))


def at_least(frame: DataFrame, rank: str) -> DataFrame:
    """Records determined to `rank` or a finer one."""
    fine = RANKS[: RANKS.index(rank) + 1]
    return frame.where(F.greatest(*[(F.coalesce(F.col(COLUMNS[r]), F.lit("")) != "").cast("int") for r in fine]) == 1)


def harmonized(frame: DataFrame, taxonomy: DataFrame | None, retain: bool = False, synonyms_allowed: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """Records with their standard ranks as the taxonomy has them, taxon_id and used_name. Records that it does not know
    go, or stay as they came if `retain`. Without a taxonomy (unmapped) all stay as they came."""
    ranks = [COLUMNS[r] for r in reversed(RANKS)]
    if taxonomy is None:
        return finest(frame).select(*frame.columns, F.lit(None).cast("long").alias("taxon_id"), F.col("finest_name").alias("used_name"))
    lines = lineages(taxonomy) if lines is None else lines
    told = harmonize(frame, taxonomy, retain, synonyms_allowed, lines)
    lines = standard_lineages(lines).select(F.col("taxon_id").alias("l_id"), *[F.col(c).alias(f"l_{c}") for c in ranks])
    out = told.join(lines, told["taxon_id"] == lines["l_id"], "left")
    return out.select(*[F.when(F.col("l_id").isNotNull(), F.col(f"l_{c}")).otherwise(F.col(c)).alias(c) if c in ranks else F.col(c) for c in frame.columns], F.col("taxon_id").cast("long").alias("taxon_id"), "used_name")


def taxon(taxonomy: DataFrame, name: str, rank: str | None = None) -> tuple[int, str]:
    """(taxon_id, rank) of the one living accepted taxon of a standard rank with this name. Unknown and extinct taxa are
    refused, and names that stand for several unless `rank` tells them apart."""
    given = taxonomy.where((F.col("name") == name) & F.col("rank").isin(RANKS))
    found = given.where(F.col("rank") == rank).collect() if rank else given.collect()  # homonyms of one name
    if not found:
        raise ValueError(f"{name} is no taxon of a standard rank")
    alive = [r for r in found if not r.is_extinct]
    if not alive:
        raise ValueError(f"{name} is extinct")
    accepted = [r for r in alive if r.accepted_id is None] or alive
    if len(accepted) > 1:
        raise ValueError(f"{name} stands for several taxa: {', '.join(sorted(r['rank'] for r in accepted))}")
    return accepted[0].taxon_id, accepted[0]["rank"]


def ancestors(lines: DataFrame, taxon_id: int) -> list[str]:
    """Names from the root down to a taxon."""
    rows = lines.where(F.col("taxon_id") == taxon_id).select(F.transform("path", lambda x: x["name"]).alias("names")).collect()
    return rows[0].names if rows else []


def descendants(lines: DataFrame, taxon_id: int) -> DataFrame:
    """(taxon_id) of a taxon and all below it, from paths."""
    return lines.where(F.exists("path", lambda x: x["taxon_id"] == taxon_id)).select("taxon_id")


def subset(frame: DataFrame, name: str, taxonomy: DataFrame, rank: str | None = None, lines: DataFrame | None = None) -> DataFrame:
    """Records of a taxon: its rank's column holds the name or, where records carry a taxon_id, that lies below it, which
    homonyms and gaps in records cannot disturb."""
    taxon_id, own = taxon(taxonomy, name, rank)
    named = F.col(COLUMNS[own]) == name
    if "taxon_id" not in frame.columns:
        return frame.where(named)
    below = descendants(lineages(taxonomy) if lines is None else lines, taxon_id).select(F.col("taxon_id").alias("d_id"), F.lit(True).alias("d_below"))
    out = frame.join(below, frame["taxon_id"] == below["d_id"], "left")
    return out.where(F.coalesce("d_below", F.lit(False)) | (F.col("taxon_id").isNull() & named)).select(*[frame[c] for c in frame.columns])
