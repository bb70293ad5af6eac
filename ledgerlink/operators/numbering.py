"""Sequence numbers for new entities: last number in use plus rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.config import Limits
from ledgerlink.operators.keyed import attach, max_seq, shuffled_side
from ledgerlink.staging import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def rank_within(
    df: DataFrame, on: Sequence[str], order: Sequence[str], few_rows: bool, limits: Limits = Limits()
) -> DataFrame:
    """``df`` with ``_rank``, counting from 1 within ``on``; ``order`` must be total.

    A window sorts each group in one task, which suits few rows. Otherwise the rows are
    sorted across the cluster: a group may span many range partitions, and its ranks
    follow from the row positions.
    """
    on, order = list(on), list(order)
    if few_rows:
        w = Window.partitionBy(*on).orderBy(*order)
        return df.withColumn("_rank", F.row_number().over(w))

    placed = stage(
        df.repartitionByRange(*on, *order)
        .sortWithinPartitions(*on, *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id"),
        "placed",
    )
    # One row per partition of the sort: a few thousand at most.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    global_row = placed.join(F.broadcast(offsets), "_part").withColumn(
        "_row", F.col("_row") + F.col("_offset")
    )
    starts = global_row.groupBy(*on).agg(
        F.min("_row").alias("_start"), F.count(F.lit(1)).alias("_n")
    )
    ranked = attach(global_row, stage(starts, "starts"), on, "_n", ["_row"], limits)
    rank = (F.col("_row") - F.col("_start") + 1).cast("int")
    return ranked.withColumn("_rank", rank).select(*df.columns, "_rank")


def last_numbers(kept: DataFrame | None, table: DataFrame, on: Sequence[str], seq: str) -> DataFrame:
    """(``on``, last): the highest number of each id, as kept beside the table, else from its rows."""
    return max_seq(table, on, seq, "last") if kept is None else kept.select(*on, "last")


def raised(last: DataFrame, changes: DataFrame, on: Sequence[str], seq: str) -> DataFrame:
    """``last`` after the numbers that a change-set gives. A number counts even if its row is gone by then."""
    return last.unionByName(max_seq(changes, on, seq, "last")).groupBy(*on).agg(F.max("last").alias("last"))


def allocate(
    new: DataFrame,
    bases: Sequence[DataFrame],
    on: Sequence[str],
    order: Sequence[str],
    out: str,
    limits: Limits = Limits(),
) -> DataFrame:
    """Number ``new`` (staged, one row per entity) after the numbers in use.

    Each base is a frame of ``on`` plus one number per id; the first base that knows
    the id counts, else numbering starts at 1.
    """
    on, few_rows = list(on), new.count() <= limits.window_rows
    ranked = rank_within(new, on, order, few_rows, limits)
    ids = new.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    found = []
    for i, base in enumerate(bases):
        (value,) = [c for c in base.columns if c not in on]
        ids = ids.join(shuffled_side(base.withColumnRenamed(value, f"_base{i}")), on, "left")
        found.append(F.col(f"_base{i}"))
    ids = ids.select(*on, "_n", F.coalesce(*found, F.lit(0)).alias("_base"))
    if few_rows:
        based = ranked.join(ids.drop("_n"), on, "left")
    else:
        based = attach(ranked, stage(ids, "bases"), on, "_n", order, limits)
    number = (F.col("_base") + F.col("_rank")).cast("int")
    return based.withColumn(out, number).select(*[c for c in new.columns if c != out], out)
