"""Address resolution: primary and optional addresses against the master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.functions.normalize import key, norm
from ledgerlink.operators.keyed import attach, max_seq, shuffled_side
from ledgerlink.operators.numbering import allocate, last_numbers
from ledgerlink.staging import stage

PLACE = ["addr1", "city", "state", "zip5"]
ON = ["empr_id", *PLACE]


def address_inputs(records: DataFrame, cfg: MatchConfig, optional: bool = False) -> DataFrame:
    """Distinct normalised addresses per id, with record count and first record.

    Optional addresses count only where the first line is filled.
    """
    prefix = "opt_" if optional else ""
    rows = records.select(
        F.col(cfg.entity_id).alias("empr_id"),
        *[key(F.col(prefix + c)).alias(c) for c in PLACE],
        cfg.record_id,
    )
    if optional:
        rows = rows.filter(F.col("addr1") != "")
    return rows.groupBy(*ON).agg(
        F.count(F.lit(1)).alias("n"), F.min(cfg.record_id).alias("first_id")
    )


def address_lookup(master: DataFrame) -> DataFrame:
    """Distinct normalised master addresses; the highest number stands for equal ones."""
    return (
        master.select("empr_id", *[norm(F.col(c)).alias(c) for c in PLACE], "addr_snum")
        .groupBy(*ON)
        .agg(F.max("addr_snum").alias("addr_snum"))
    )


def match_addresses(inputs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Inputs with the master's number; a blank first line matches nothing."""
    return inputs.join(shuffled_side(lookup.filter(F.col("addr1") != "")), ON, "left")


def resolve_primary(
    matched: DataFrame, master: DataFrame, cfg: MatchConfig, last: DataFrame | None = None
) -> DataFrame:
    """``matched`` (staged) with numbers for new addresses, in order of first record.

    ``last`` holds the numbers in use where they are kept, here and below.
    """
    known = matched.filter(F.col("addr_snum").isNotNull())
    rest = matched.filter(F.col("addr_snum").isNull())
    skipped = rest.filter(F.lit(False))
    if not cfg.number_blank_address:
        skipped = rest.filter(F.col("addr1") == "")
        rest = rest.filter(F.col("addr1") != "")
    bases = [last_numbers(last, master, ["empr_id"], "addr_snum")]
    new = allocate(rest, bases, ["empr_id"], ["first_id"], "addr_snum", cfg.limits)
    return (
        known.withColumn("origin", F.lit("known"))
        .unionByName(new.withColumn("origin", F.lit("new")))
        .unionByName(
            skipped.withColumn("addr_snum", F.lit(0)).withColumn("origin", F.lit("none"))
        )
    )


def new_primary(primary: DataFrame) -> DataFrame:
    return primary.filter(F.col("origin") == "new").select(*ON, "addr_snum")


def new_optional(matched: DataFrame, primary: DataFrame) -> DataFrame:
    """Optional addresses neither known nor numbered as a primary of this run."""
    rest = matched.filter(F.col("addr_snum").isNull())
    return rest.join(shuffled_side(new_primary(primary)), ON, "left_anti")


def optional_bases(primary: DataFrame, master: DataFrame, last: DataFrame | None = None) -> list[DataFrame]:
    """Numbers in use: the run's own new primaries first, else the master's."""
    return [
        max_seq(new_primary(primary), ["empr_id"], "addr_snum", "last"),
        last_numbers(last, master, ["empr_id"], "addr_snum"),
    ]


def share_primary(matched: DataFrame, primary: DataFrame) -> DataFrame:
    """Optional addresses with ``origin`` known, primary (shares its number) or open."""
    shared = new_primary(primary).withColumnRenamed("addr_snum", "_shared")
    origin = (
        F.when(F.col("addr_snum").isNotNull(), "known")
        .when(F.col("_shared").isNotNull(), "primary")
        .otherwise("open")
    )
    return (
        matched.join(shuffled_side(shared), ON, "left")
        .withColumn("origin", origin)
        .withColumn("addr_snum", F.coalesce("addr_snum", "_shared"))
        .drop("_shared")
    )


def resolve_optional(
    shared: DataFrame, primary: DataFrame, master: DataFrame, cfg: MatchConfig, last: DataFrame | None = None
) -> DataFrame:
    """``shared`` (staged) with numbers for the open ones, in address order."""
    new = allocate(
        shared.filter(F.col("origin") == "open"),
        optional_bases(primary, master, last),
        ["empr_id"],
        PLACE,
        "addr_snum",
        cfg.limits,
    )
    return shared.filter(F.col("origin") != "open").unionByName(
        new.withColumn("origin", F.lit("new"))
    )


def table_indicators(ids: DataFrame, names: DataFrame, pseudo_ids: DataFrame) -> DataFrame:
    """``O`` for ids seen on special records, ``F`` for ids with a name, else ``N``."""
    named = names.select("empr_id").distinct().withColumn("_named", F.lit(True))
    pseudo = pseudo_ids.select("empr_id").distinct().withColumn("_pseudo", F.lit(True))
    ind = F.when(F.col("_pseudo"), "O").when(F.col("_named"), "F").otherwise("N")
    return (
        ids.join(shuffled_side(named), "empr_id", "left")
        .join(shuffled_side(pseudo), "empr_id", "left")
        .withColumn("table_ind", ind)
        .drop("_named", "_pseudo")
    )


def primary_table(
    records: DataFrame,
    master: DataFrame,
    names: DataFrame,
    pseudo_ids: DataFrame,
    linked: DataFrame,
    cfg: MatchConfig,
    last: DataFrame | None = None,
) -> DataFrame:
    """All an address decides: number, origin, id indicator and the name linked to it."""
    matched = match_addresses(address_inputs(records, cfg), address_lookup(master))
    matched = stage(matched, "addr_matched")
    numbered = stage(resolve_primary(matched, master, cfg, last), "addr_numbered")
    ids = numbered.groupBy("empr_id").agg(F.count(F.lit(1)).alias("_n"))
    ids = stage(table_indicators(ids, names, pseudo_ids), "addr_ids")
    flagged = attach(numbered, ids, ["empr_id"], "_n", ["first_id"], cfg.limits)
    return stage(flagged.join(linked, ["empr_id", "addr_snum"], "left"), "addr_table")


def optional_table(
    records: DataFrame,
    primary: DataFrame,
    master: DataFrame,
    cfg: MatchConfig,
    last: DataFrame | None = None,
) -> DataFrame:
    matched = match_addresses(address_inputs(records, cfg, optional=True), address_lookup(master))
    shared = stage(share_primary(matched, primary), "opt_shared")
    return stage(resolve_optional(shared, primary, master, cfg, last), "opt_table")
