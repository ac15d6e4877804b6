"""MinHash near-dedup with SuperMinHash signatures.

1. A pass over the texts gives each document's shingle-set digest and its SuperMinHash signature: every element
   walks its own random permutation of the signature's slots, one slot a step, and offers step + random fraction;
   a slot keeps the least offer. Ranks within an element are all different, which lowers the variance, and the walk
   stops at the first step after which every slot is taken, since later offers are larger.
2. Documents with equal sets collapse to the least id before anything else, by a pre-aggregated sum.
3. Signatures are cut into bands. In each band bucket everyone is compared with the bucket's least and greatest
   member only; verified links are grouped.
4. Buckets whose members are still in different groups are taken up again, block against block, with their full
   sets: pairs of different groups whose signatures agree enough are verified there, and only links come out. Pairs within a group need no check, as they
   cannot change it. No pair of a bucket is lost, and none is listed that cannot matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, grams, hashed, mixed, raw, released, runs, signed, stored, table
from .components import components

SLOTS, BANDS, ROWS = 64, 16, 4
#: Nodes of rows without a doc_id are from here on; where doc_ids reach that far, all are moved down by as much.
UNKNOWN = 2**62
#: Signatures that agree in less than this share of slots are not verified: 4.5 standard deviations below 0.85.
LEAST_ESTIMATE = 0.65
#: Shingles a block holds, about (8 bytes each).
BLOCK = 16_384


def shingle_sets(texts: list[bytes | None], size: int = 5):
    """Of each text the sorted distinct hashes of its `size`-word shingles; with fewer words, of the whole sequence;
    without words, none."""
    for lo, hi in runs(texts):
        h, count = hashed(texts[lo:hi], lower=True)
        every, at = grams(h, size), 0
        for n in count.tolist():
            yield np.unique(every[at: at + n - size + 1] if n >= size else grams(h[at: at + n], n)) if n else np.empty(0, np.uint64)
            at += n


def superminhash(items: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signature as uint32: step in the high 6 bits, 26 bits of the random fraction below. `slots` is at most 64."""
    n = len(items)
    out = np.full(slots, 0xFFFFFFFF, np.uint32)
    perm = None
    state = items
    for step in range(slots):
        state = mixed(state + np.uint64(step + 1))
        offer = (np.uint32(step) << np.uint32(26)) | (state >> np.uint64(38)).astype(np.uint32)
        k = step + ((state & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            slot, taken = k, k
        else:
            if perm is None:  # most documents never get here
                perm = np.tile(np.arange(slots, dtype=np.int16), (n, 1))
                rows = np.arange(n)
                perm[rows, 0], perm[rows, taken] = perm[rows, taken], 0
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, step]
            perm[rows, step] = slot
        np.minimum.at(out, slot, offer)
        if (out < np.uint32(0xFFFFFFFF)).all():
            break
    return out


def _features(batches):
    for b in batches:
        n, digest, sig = [], [], []
        for s in shingle_sets(raw(b, "text")):
            n.append(len(s))
            digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sig.append(superminhash(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("unknown"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "unknown", "n", "digest", "sig"])


def _bands(batches):
    for b in batches:
        ids = b.column("id").to_numpy()
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(len(ids), SLOTS)
        rows = sig.reshape(len(ids), BANDS, ROWS).astype(np.uint64)
        h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(ids), BANDS)).copy()
        for k in range(ROWS):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k] + np.uint64(1))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, BANDS)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(ids))), pa.array(signed(h.reshape(-1)))], ["id", "band", "bucket"])


def _alike(batches):
    """Keeps pairs whose sizes and signatures do not rule the threshold out."""
    for b in batches:
        if b.num_rows:
            x = np.frombuffer(b"".join(b.column("sig_u").to_pylist()), np.uint32).reshape(-1, SLOTS)
            y = np.frombuffer(b"".join(b.column("sig_v").to_pylist()), np.uint32).reshape(-1, SLOTS)
            keep = pa.array((x == y).mean(axis=1) >= LEAST_ESTIMATE)
            yield b.select(["u", "v"]).filter(keep)


def _verify(percent: int):
    def go(batches):
        for b in batches:
            # a hub's text stands beside many: each text of a batch is taken apart once
            at = {x: i for i, x in enumerate(dict.fromkeys(x for c in ("text_u", "text_v") for x in raw(b, c)))}
            sets, keep = list(shingle_sets(list(at))), []
            for x, y in zip(raw(b, "text_u"), raw(b, "text_v"), strict=True):
                s, t = sets[at[x]], sets[at[y]]
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return go


def _sets(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([x.tobytes() for x in shingle_sets(raw(b, "text"))], pa.binary())], ["id", "items"])


def _blocks(percent: int):
    """Links between different groups, block against block, confirmed on the full sets. A pair that shares several
    buckets is looked at in its first band only, and of two groups one link a block is enough."""
    def unpacked(rows):
        return ([r["id"] for r in rows], np.array([r["component"] for r in rows]), [np.frombuffer(r["items"], np.uint64) for r in rows],
                np.frombuffer(b"".join(r["sig"] for r in rows), np.uint32).reshape(-1, SLOTS))

    def go(batches):
        for b in batches:
            us, vs = [], []
            for band, x, y in zip(b.column("band").to_pylist(), b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                (iu, cu, xu, su), (iv, cv, xv, sv) = unpacked(x), unpacked(y)
                nv, done = np.array([len(z) for z in xv]), set()
                for k in range(len(iu)):
                    same = sv == su[k]
                    n = len(xu[k])
                    ok = (cv != cu[k]) & (same.mean(axis=1) >= LEAST_ESTIMATE) & (100 * np.minimum(nv, n) >= percent * np.maximum(nv, n))
                    ok &= same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
                    for j in np.flatnonzero(ok).tolist():
                        pair = (int(min(cu[k], cv[j])), int(max(cu[k], cv[j])))
                        if pair in done:
                            continue
                        both = len(np.intersect1d(xu[k], xv[j], assume_unique=True))
                        if 100 * both >= percent * (n + int(nv[j]) - both):
                            done.add(pair)
                            us.append(iu[k])
                            vs.append(iv[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])
    return go


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    u = texts.select(F.col("id").alias("u"), F.col("text").alias("text_u"))
    v = texts.select(F.col("id").alias("v"), F.col("text").alias("text_v"))
    return pairs.join(u, "u").join(v, "v").select("u", "v", "text_u", "text_v").mapInArrow(_verify(percent), "u long, v long")


def near_dedup(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Groups documents linked by 100 * |A and B| >= percent * |A or B| of their five-word shingle sets.

    Returns per row: doc_id, n_shingles, component_id (least doc_id reachable), kept (doc_id is component_id).
    Words are cut at ASCII white space after lower-casing A-Z. Null, empty and blank texts have an empty set and
    link with nothing, not even each other. `percent` is 85 or more, for which the signature's bands and estimate
    are sized (a link at exactly 0.85 is missed with a probability under 0.00002). Rows that share a doc_id are
    one node: linked if any of them is; n_shingles is each row's own. Rows with a null doc_id are a node for each
    text, behind all others: such a row is kept if its group holds no doc_id and, of several texts without, the text
    is the first by its hash; component_id is null where the group holds no doc_id. Any long is a doc_id, but beside null
    ones only a range that leaves room for them: with doc_ids under -2**62 and from 2**62 on as well they are refused.
    Other columns are ignored; an empty table gives an empty table."""
    if not 85 <= percent <= 100:
        raise ValueError("percent must be 85 to 100")
    doc_id = F.col("doc_id").cast("long")
    unknown = F.when(doc_id.isNull(), F.lit(UNKNOWN) + F.xxhash64("text").bitwiseAND(F.lit(UNKNOWN - 1)))
    given = docs.select(doc_id.alias("doc_id"), unknown.alias("unknown"), "text")
    feats = stored(given.mapInArrow(_features, "doc_id long, unknown long, n long, digest binary, sig binary"), "features")
    least, most, nulls = feats.agg(F.min("doc_id"), F.max("doc_id"), F.count("unknown")).first()
    shift = UNKNOWN if nulls and most is not None and most >= UNKNOWN else 0
    if shift and least < -UNKNOWN:
        raise ValueError("doc_ids take up the whole range of longs, which leaves none for rows without one")
    node = F.coalesce(F.col("doc_id") - F.lit(shift), "unknown").alias("id")
    feats, given = feats.select("doc_id", node, "n", "digest", "sig"), given.select(node, "text")
    sets = feats.where("digest is not null")
    reps = sets.groupBy("digest").agg(F.min(F.struct("id", "n", "sig")).alias("r"))
    reps = stored(reps.select("digest", F.col("r.id").alias("rep"), F.col("r.n").alias("n"), F.col("r.sig").alias("sig")), "reps")
    links = sets.join(reps.select("digest", "rep"), "digest").select(F.col("id").alias("u"), F.col("rep").alias("v")).where("u != v")
    # rows of one doc_id with different sets have a representative each, of the same id
    signatures = reps.select(F.col("rep").alias("id"), "n", "sig").dropDuplicates(["id", "n", "sig"])
    banded = signatures.select("id", "sig").mapInArrow(_bands, "id long, band int, bucket long")
    shared = banded.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    members = stored(banded.join(shared, "bucket").distinct(), "members")
    near = members.select("id").distinct()
    signatures = stored(signatures.join(near, "id"), "signatures")
    released(docs.sparkSession)
    texts = stored(given.join(near, "id").dropDuplicates(["id", "text"]), "texts")
    released(docs.sparkSession)
    stars = members.select("id", F.explode(F.array("lo", "hi")).alias("hub")).where("id != hub").select(F.greatest("id", "hub").alias("u"), F.least("id", "hub").alias("v")).distinct()
    side = lambda x: signatures.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    stars = stars.join(side("u"), "u").join(side("v"), "v").where(f"100 * least(n_u, n_v) >= {percent} * greatest(n_u, n_v)")
    stars = stars.select("u", "v", "sig_u", "sig_v").mapInArrow(_alike, "u long, v long").distinct()
    found = stored(_verified(stars, texts, percent).unionByName(links), "links")
    released(docs.sparkSession)
    groups = stored(components(found), "groups")
    more = _left_over(members, signatures, texts, groups, percent)
    discard(found, reps, members, signatures, texts)
    if not more.isEmpty():
        # what is linked now are groups: their ids stand for their members
        joined = more.join(groups.select(F.col("id").alias("u"), F.col("component").alias("cu")), "u", "left").join(
            groups.select(F.col("id").alias("v"), F.col("component").alias("cv")), "v", "left")
        merged = components(joined.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
        merged = merged.select(F.col("id").alias("component"), F.col("component").alias("whole"))
        every = groups.unionByName(merged.select(F.col("component").alias("id"), "component")).distinct()
        first, groups = groups, stored(every.join(merged, "component", "left").select("id", F.coalesce("whole", "component").alias("component")).distinct(), "groups")
        discard(first)
    discard(more)
    out = feats.select("doc_id", "id", "n").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    component = F.when(F.col("component") < UNKNOWN, F.col("component") + F.lit(shift)) if nulls else F.col("component")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def _left_over(members: DataFrame, signatures: DataFrame, texts: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between different groups of a bucket. Blocks are bounded by the bytes of their sets."""
    told = members.select("bucket", "band", "id").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    told = told.join(signatures.groupBy("id").agg(F.max("n").alias("n")), "id")
    told = told_all = stored(told, "told")
    split = told.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("bucket")
    told = told.join(split, "bucket")
    sizes = told.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("items"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("size", "component", "items")).alias("m"), F.sum("items").alias("all"))
    main = stored(main.select("bucket", F.col("m.component").alias("main"), F.col("m.items").alias("most"), "all"), "main")  # plain, so that a hot bucket can be split
    told = told.join(main, "bucket").withColumn("is_main", F.col("component") == F.col("main"))
    amount = F.when(F.col("is_main"), F.col("most")).otherwise(F.col("all") - F.col("most"))
    told = told.withColumn("block", F.pmod(F.xxhash64("id"), F.greatest(F.ceil(amount / F.lit(BLOCK)), F.lit(1))).cast("int"))
    near = told.select("id").distinct()
    sets = stored(texts.join(near, "id").select("id", "text").mapInArrow(_sets, "id long, items binary").where("length(items) > 0"), "sets")
    # rows of one id with several texts: each set with its own signature, told apart by their sizes
    full = sets.join(signatures, "id").where(F.length("items") == 8 * F.col("n")).select("id", "sig", "items")
    rows = told.select("bucket", "band", "is_main", "block", "id", "component").join(full, "id")
    blocks = stored(rows.groupBy("bucket", "band", "is_main", "block").agg(F.collect_list(F.struct("id", "component", "sig", "items")).alias("rows")), "blocks")
    x = blocks.where("not is_main").select("bucket", F.col("block").alias("bx"), F.col("rows").alias("x"))
    y = blocks.select("bucket", "band", "is_main", "block", F.col("rows").alias("y"))
    pairs = x.join(y, "bucket").where("is_main or block >= bx").select("band", "x", "y").mapInArrow(_blocks(percent), "u long, v long")
    out = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    discard(told_all, main, sets, blocks)
    return out


def query(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
