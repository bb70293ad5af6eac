"""SimHash near-duplicates: deletion-variant signatures, an equality join, verification.

To link fingerprints that differ in at most ``k`` bits they are cut into ``k // 2 + 1`` segments, fewer
than exact matching would need: one segment then differs by at most one bit. Each segment is
indexed once per bit with that bit left out, so two such segments meet under at least one key.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import components, fresh, per_text
from ledgerlink.operators.keyed import attach
from ledgerlink.staging import stage

SEED = 42
# Keys with more fingerprints than this are first reduced to groups around a centre.
CROWDED = 256
# Up to this many crowded keys (24 bytes each) are sent to every task; more are joined.
SENT_KEYS = 50_000
# Fingerprints of one task before they become 64 rows each.
SPREAD_ROWS = 8192
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, size: int) -> int:
    """The fingerprint of one text, as a signed 64-bit number; no words give 0."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(size, len(words))
    starts = np.r_[0, ends[:-1] + 1][: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    ends = ends[size - 1 :].tolist()
    for at in range(0, len(starts), 1 << 16):
        part = zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)], strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in part], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    bits = (2 * votes > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row."""
    fields = [T.StructField("fp", T.LongType())]
    return per_text(docs, id_col, text_col, fields, lambda texts: [[fingerprint(t, size) for t in texts]])


def variants(fps: DataFrame, k: int) -> DataFrame:
    """64 rows per fingerprint: ``key`` is a segment without one of its bits, ``bit`` that bit.

    ``first`` marks the first bit of a segment, under which equal segments are compared.
    """
    parts = k // 2 + 1
    cuts = [64 * i // parts for i in range(parts + 1)]
    masks = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        segment = ((1 << hi) - 1) ^ ((1 << lo) - 1)
        for bit in range(lo, hi):
            mask = segment & ~(1 << bit)
            signed = mask - (1 << 64) if mask >> 63 else mask
            masks.append(f"named_struct('bit', {bit}, 'first', {bit == lo}, 'lo', {lo}, 'mask', {signed}L)".lower())
    each = F.explode(F.expr(f"array({', '.join(masks)})")).alias("v")
    wide = fps.select("*", each)
    # The segment moves to the low end (at most 32 bits for k >= 2) and the bit number stands above it.
    key = F.expr("shiftrightunsigned(fp & v.mask, v.lo) | shiftleft(cast(v.bit as bigint), 56)")
    return wide.select(*fps.columns, key.alias("key"), F.col("v.bit").alias("bit"), F.col("v.first").alias("first"))


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def spread(fps: DataFrame) -> DataFrame:
    """Fingerprints over as many tasks as their variants are work, not as their few bytes suggest."""
    return fps.repartition(min(20_000, max(1, -(-fps.count() // SPREAD_ROWS))))


def around_centres(fps: DataFrame, k: int, crowded: int) -> tuple[DataFrame, DataFrame | None]:
    """Fingerprints with the group they are already known to be in, and the crowded keys.

    Every member of a crowded key is compared with one centre, the fingerprint most documents have.
    """
    wide = variants(spread(fps), k)
    keys = stage(wide.groupBy("key").agg(F.count("*").alias("members")).filter(F.col("members") > crowded), "crowded_keys")
    n = keys.count()
    if not n:
        return fps.withColumn("grp", F.col("fp")), None
    side = F.broadcast(keys) if n <= SENT_KEYS else keys.hint("merge")
    centres = wide.join(side, "key").groupBy("key").agg(F.max_by("fp", F.struct("n", "fp")).alias("centre"))
    keys = stage(centres, "centres_of_keys")
    side = F.broadcast(keys) if n <= SENT_KEYS else keys.hint("merge")
    near = wide.join(side, "key").filter((F.col("fp") != F.col("centre")) & (distance("fp", "centre") <= k))
    known = components(near.select(F.col("fp").alias("a"), F.col("centre").alias("b")), "centres")
    known = known.select(F.col("node").alias("fp"), F.col("component").alias("grp"))
    labelled = fps.join(known, "fp", "left").withColumn("grp", F.coalesce("grp", "fp"))
    return stage(labelled, "labelled"), keys


def links(fps: DataFrame, k: int, crowded: int = CROWDED) -> DataFrame:
    """Pairs (a, b) of fingerprints at most ``k`` bits apart, enough to connect all that are connected.

    Pairs are verified inside the join, so others never leave it. Within a crowded key only members outside the
    centre's group are met with all members: the others are connected already.
    """
    labelled, keys = around_centres(fps.select("fp", "n"), k, crowded)
    index = variants(spread(labelled.select("fp", "grp")), k)
    if keys is not None:
        main = keys.join(labelled.select(F.col("fp").alias("centre"), F.col("grp").alias("main")), "centre")
        main = main.select("key", "main")
        side = F.broadcast(main) if keys.count() <= SENT_KEYS else main.hint("merge")
        index = index.join(side, "key", "left")
    else:
        index = index.withColumn("main", F.lit(None).cast("long"))
    left, right = index.alias("l"), index.filter("main IS NULL OR grp != main").alias("r")
    x = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    once = F.expr("l.fp < r.fp OR l.grp = l.main")
    wildcard = F.col("l.first") | (F.getbit(x, F.col("l.bit")) == 1)
    condition = (
        (F.col("l.key") == F.col("r.key")) & (F.col("l.grp") != F.col("r.grp")) & once & (F.bit_count(x) <= k) & wildcard
    )
    # Spark takes the variants to be as large as their fingerprints and would send them whole to the driver.
    found = left.join(right.hint("merge"), condition).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    if keys is None:
        return found
    inside = labelled.filter("grp != fp").select(F.col("fp").alias("a"), F.col("grp").alias("b"))
    return found.union(inside)


def simhash_groups(
    docs: DataFrame,
    size: int = 4,
    distance_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowded: int = CROWDED,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    Fingerprints at most ``distance_bits`` apart link, and a component is what links connect; its id is
    the smallest document id in it. Null and empty texts have fingerprint zero and link like any other.
    Repeated rows share a fingerprint. A row with a null id keeps its fingerprint and gets the component's
    id (null if no row in it has one). Other columns are not looked at. Work is done per distinct
    fingerprint, so exact copies cost one row.
    """
    if not 2 <= distance_bits <= 6:
        raise ValueError("distance_bits: 2 to 6")
    printed = stage(fingerprints(docs, size, id_col, text_col), "fingerprints")
    fps = printed.groupBy("fp").agg(F.count("*").alias("n"), F.min(id_col).alias("least"))
    fps = stage(fps, "distinct_fingerprints")
    linked = components(links(fps, distance_bits, crowded), "fingerprint_links")
    linked = linked.withColumnsRenamed({"node": "fp"})
    joined = stage(fps.join(linked, "fp", "left"), "linked_fingerprints")
    # One row per component of several fingerprints; rows meet it, and then theirs, by joins that spread hot keys.
    found = joined.filter("component IS NOT NULL").groupBy("component")
    least_of = stage(found.agg(F.min("least").alias("component_id"), F.count("*").alias("size")), "component_ids")
    ids = attach(joined, least_of, ["component"], "size", ["fp"])
    own = F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id"))
    ids = stage(ids.select("fp", "n", own.alias("component_id")), "fingerprint_components")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return attach(printed, ids, ["fp"], "n", [id_col]).select(id_col, hexed, "component_id")


def keep_one(
    docs: DataFrame,
    groups: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4,
    distance_bits: int = 4,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row of each component of ``groups``, which ``simhash_groups`` made of ``docs`` with the same settings.

    It is the row whose id names the component; if several rows of the component have that id, the smallest of them.
    Components whose rows all lack an id keep their smallest row. An id in several components, and a missing one, names no
    component: those rows are told apart by their fingerprints, made and linked again for them alone.
    """
    name = fresh(docs, "_id")
    ids = groups.groupBy(F.col(id_col).alias(name)).agg(F.count("*").alias("rows"), F.max("component_id").alias("least"))
    same = docs[id_col].eqNullSafe(F.col(name))
    single = docs.join(ids.filter(f"rows = 1 AND `{name}` = least").select(name), same, "left_semi")
    several = stage(ids.filter(f"rows > 1 OR `{name}` IS NULL").select(name), "shared_ids")
    if several.isEmpty():
        return single
    # The fingerprints of all components such an id names: whole components, so their links are all among them.
    named = groups.join(several, F.col("component_id").eqNullSafe(F.col(name)), "left_semi")
    fp = F.conv("fingerprint", 16, -10).cast("long").alias("fp")
    fps = stage(named.groupBy(fp).agg(F.count("*").alias("n"), F.first("component_id").alias("least")), "shared_fingerprints")
    linked = components(links(fps, distance_bits, crowded), "shared_links").withColumnsRenamed({"node": "fp"})
    fps = fps.join(linked, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    rows = docs.join(several, same, "left_semi").select(F.struct(*docs.columns).alias("row"), docs[text_col].alias("text"))
    printed = fingerprints(rows, size, "row", "text").join(fps, "fp")
    printed = printed.filter(F.col("row")[id_col].eqNullSafe(F.col("least")))
    return single.unionByName(printed.groupBy("component").agg(F.min("row").alias("row")).select("row.*"))
