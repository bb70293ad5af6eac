"""Name resolution: exact within an id, then Jaro-Winkler, then a new number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.functions.normalize import norm
from ledgerlink.functions.similarity import can_reach, jaro_winkler_score, name_signature
from ledgerlink.operators.keyed import keep_first, shuffled_side
from ledgerlink.operators.numbering import allocate, last_numbers
from ledgerlink.staging import stage

ON = ["empr_id", "nm"]


def name_inputs(records: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Distinct non-blank names per id, with the number of records and the first one."""
    return (
        records.select(
            F.col(cfg.entity_id).alias("empr_id"),
            norm(F.col("qw_employer_name")).alias("nm"),
            cfg.record_id,
        )
        .filter(F.length("nm") > 0)
        .groupBy(*ON)
        .agg(F.count(F.lit(1)).alias("n"), F.min(cfg.record_id).alias("first_id"))
    )


def master_names(names: DataFrame) -> DataFrame:
    """Distinct normalised master names; the lowest number stands for equal ones."""
    return (
        names.select("empr_id", norm(F.col("empr_nm")).alias("nm"), "nm_snum")
        .groupBy(*ON)
        .agg(F.min("nm_snum").alias("nm_snum"))
    )


def exact_names(inputs: DataFrame, names: DataFrame) -> DataFrame:
    """``F`` with the master's number where the normalised name is known, else ``N``."""
    ind = F.when(F.col("nm_snum").isNotNull(), "F").otherwise("N")
    return inputs.join(shuffled_side(master_names(names)), ON, "left").withColumn("name_ind", ind)


def _scorable(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    starts = [F.substring("nm", 1, k).alias(f"p{k}") for k in (1, 2, 3)]
    return (
        df.filter(F.length("nm") >= cfg.min_len)
        .select("*", F.length("nm").alias("len"), *starts, name_signature("nm").alias("_sig"))
        .select("*", "_sig.*")
        .drop("_sig")
    )


def _similar_length(x: str, y: str, cfg: MatchConfig):
    return F.least(x, y) >= F.lit(cfg.ratio) * F.greatest(x, y)


def _cells(left: DataFrame, right: DataFrame, cfg: MatchConfig, cell_rows: int) -> DataFrame:
    """How to cut up every block above ``cell_rows``: cells per id and master name length.

    Only ids with more names than that on one side can have such a block; the lengths of the others are not counted.
    """
    per_id = [df.groupBy("empr_id").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > cell_rows) for df in (left, right)]
    crowded = per_id[0].unionByName(per_id[1]).select("empr_id").distinct()
    left, right = (df.join(crowded, "empr_id", "left_semi") for df in (left, right))
    by_len = left.groupBy("empr_id", "len").agg(F.count(F.lit(1)).alias("rows"))
    master_len = right.groupBy("empr_id", F.col("len").alias("block")).agg(
        F.count(F.lit(1)).alias("right_rows")
    )
    blocks = (
        by_len.join(master_len, "empr_id")
        .filter(_similar_length("len", "block", cfg))
        .groupBy("empr_id", "block")
        .agg(F.sum("rows").alias("left_rows"), F.first("right_rows").alias("right_rows"))
    )
    large = (
        blocks.groupBy("empr_id")
        .agg(F.max("left_rows").alias("_l"), F.max("right_rows").alias("_r"))
        .withColumn("_size", F.greatest("_l", "_r"))
        .filter(F.col("_size") > cell_rows)
        .select("empr_id")
    )
    cuts = [
        F.ceil(F.col(f"{side}_rows") / cell_rows).cast("int").alias(f"{side}_cuts")
        for side in ("left", "right")
    ]
    return blocks.join(large, "empr_id", "left_semi").select("empr_id", "block", *cuts)


def fuzzy_candidates(
    unmatched: DataFrame, names: DataFrame, cfg: MatchConfig
) -> DataFrame:
    """Name pairs of one id that may score above the threshold.

    Pairs pass the length rules and the character bound inside the join, so only
    they reach the scorer. An id with many names is split by name length and then into
    a grid of cells, each its own join key: names meet exactly once, in many tasks. A name of a
    block of n by m cells is sent m (or n) times; the pairs within an id stay quadratic, as scoring asks.
    Both sides and the cells are read more than once, so they are staged.
    """
    left = stage(_scorable(unmatched.select(*ON), cfg), "scorable_names")
    right = stage(_scorable(master_names(names), cfg), "scorable_master")
    cells = stage(_cells(left, right, cfg, cfg.limits.cell_rows), "cells")

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("nm"), F.coalesce(f"{own}_cuts", F.lit(1))).cast("int")
        others = F.sequence(F.lit(0), F.coalesce(f"{other}_cuts", F.lit(1)) - 1)
        return (
            df.withColumn("block", F.coalesce("block", F.lit(-1)))
            .withColumn(f"{own}_cell", mine)
            .withColumn(f"{other}_cell", F.explode(others))
            .drop("left_cuts", "right_cuts")
        )

    l, r, c = left.alias("l"), right.alias("r"), cells.alias("c")
    l_blocks = (F.col("l.empr_id") == F.col("c.empr_id")) & _similar_length("l.len", "c.block", cfg)
    r_blocks = (F.col("r.empr_id") == F.col("c.empr_id")) & (F.col("r.len") == F.col("c.block"))
    cut = [F.col(f"c.{x}") for x in ("block", "left_cuts", "right_cuts")]
    l = placed(l.join(c, l_blocks, "left").select("l.*", *cut), "left", "right")
    r = placed(r.join(c, r_blocks, "left").select("r.*", *cut), "right", "left")
    l, r = l.alias("l"), r.alias("r")
    meet = (
        (F.col("l.empr_id") == F.col("r.empr_id"))
        & (F.col("l.block") == F.col("r.block"))
        & (F.col("l.left_cell") == F.col("r.left_cell"))
        & (F.col("l.right_cell") == F.col("r.right_cell"))
        & _similar_length("l.len", "r.len", cfg)
        & can_reach("l", "r", cfg.threshold)
    )
    return l.join(shuffled_side(r), meet).select(
        "l.empr_id", "l.nm", F.col("r.nm").alias("master_nm"), "r.nm_snum"
    )


def fuzzy_names(
    unmatched: DataFrame, names: DataFrame, cfg: MatchConfig
) -> DataFrame:
    """Scored pairs at or above the threshold."""
    pairs = fuzzy_candidates(unmatched, names, cfg)
    return pairs.withColumn("score", jaro_winkler_score("nm", "master_nm")).filter(
        F.col("score") >= cfg.threshold
    )


def best_fuzzy(scored: DataFrame) -> DataFrame:
    """The best-scoring master names of every input name, ties included."""
    return keep_first(scored, ON, [F.col("score").desc()], ties=True)


def resolve_names(exact: DataFrame, scored: DataFrame) -> DataFrame:
    """One row per name: its exact number, else the best score's, else none."""
    top = F.max(F.struct("score", (-F.col("nm_snum")).alias("neg"))).alias("top")
    best = scored.groupBy(*ON).agg(top).select(*ON, (-F.col("top.neg")).alias("_fuzzy"))
    number = F.coalesce("nm_snum", "_fuzzy")
    return (
        exact.join(best, ON, "left")
        .withColumn("nm_snum", number)
        .withColumn("name_ind", F.when(F.col("nm_snum").isNotNull(), "F"))
        .drop("_fuzzy")
    )


def number_names(resolved: DataFrame, names: DataFrame, cfg: MatchConfig, last: DataFrame | None = None) -> DataFrame:
    """Names that matched nothing get the next numbers of their id, in name order.

    ``last`` holds the numbers in use where they are kept, here and below.
    """
    found = resolved.filter(F.col("nm_snum").isNotNull())
    rest = resolved.filter(F.col("nm_snum").isNull())
    if not cfg.allocate_new_names:
        return found
    bases = [last_numbers(last, names, ["empr_id"], "nm_snum")]
    new = allocate(rest, bases, ["empr_id"], ["nm"], "nm_snum", cfg.limits).withColumn("name_ind", F.lit("N"))
    return found.unionByName(new)


def name_table(
    records: DataFrame, names: DataFrame, cfg: MatchConfig, last: DataFrame | None = None
) -> DataFrame:
    """Number and indicator of every distinct name of the regular records."""
    exact = stage(exact_names(name_inputs(records, cfg), names), "names_exact")
    unmatched = exact.filter(F.col("name_ind") == "N")
    scored = fuzzy_names(unmatched, names, cfg)
    resolved = stage(resolve_names(exact, scored), "names_resolved")
    return stage(number_names(resolved, names, cfg, last), "names_numbered")
