"""Keyed building blocks: restrict, first row per key, and a skew-proof lookup join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.config import Limits

SPREAD = 1 << 20


def small(df: DataFrame, limits: Limits) -> bool:
    """Whether ``df`` (staged) may be sent to every executor: its rows are counted, and the bytes of so many at most."""
    if df.count() > limits.broadcast_rows:
        return False
    width = reduce(
        Column.__add__,
        [F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(8) for c, t in df.dtypes],
    )
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first().bytes <= limits.broadcast_bytes


def lookup_side(df: DataFrame, limits: Limits) -> DataFrame:
    """``df`` (staged, unique on its key) as the side of a join that is looked up: sent whole if small, else hashed by partition.

    Neither sorts the other side.
    """
    return F.broadcast(df) if small(df, limits) else df.hint("shuffle_hash")


def shuffled_side(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is shuffled, whatever size Spark takes it for.

    The files of a table are a small part of its rows in memory, and a join planned as a broadcast stays one when the rows turn
    out to be many: the driver would gather them all. Tables that grow are therefore never left to that estimate.
    """
    return df.hint("merge")


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def restrict(master: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Master rows whose key occurs in ``keys``.

    How they meet is for the caller to say (``lookup_side``) where ``keys`` are stored; else Spark knows the size of a
    finished shuffle. It splits skewed partitions of the master.
    """
    return master.join(keys.select(*on), list(on), "left_semi")


def keep_first(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], ties: bool = False
) -> DataFrame:
    """The first row per key, or all rows tied for first.

    Spark limits every key before the shuffle (WindowGroupLimit), so a key that holds
    a large share of the rows sends one row per task, not all of them.
    """
    place = F.rank() if ties else F.row_number()
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_place", place.over(w)).filter("_place = 1").drop("_place")


def max_seq(df: DataFrame, on: Sequence[str], seq: str, out: str) -> DataFrame:
    return df.groupBy(*on).agg(F.max(seq).alias(out))


def attach(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    weight: str,
    row_id: Sequence[str],
    limits: Limits = Limits(),
) -> DataFrame:
    """Left join with a lookup that is unique on ``on``, for rows of any skew.

    ``weight`` is the lookup column holding how many left rows a key has. A small
    lookup is broadcast. Otherwise the heaviest keys, a fixed number of them, are
    broadcast, and only the other rows meet in the shuffle: rows that are already
    answered, or have no key, get a made-up key part that spreads them evenly. The lookup is
    hashed there, so the rows are not sorted.
    ``row_id`` names columns that tell left rows apart.
    """
    on = list(on)
    values = [c for c in right.columns if c not in on and c != weight]
    if small(right, limits):
        return left.join(F.broadcast(right.drop(weight)), on, "left")

    heavy = right.orderBy(F.col(weight).desc(), *on).limit(limits.heavy_keys)
    heavy = heavy.select(*on, F.struct(*values).alias("_heavy"))
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    apart = F.col("_heavy").isNotNull() | no_key
    spread = F.when(apart, F.pmod(F.xxhash64(*row_id), F.lit(SPREAD)) + 1).otherwise(F.lit(0))
    tagged = left.join(F.broadcast(heavy), on, "left").withColumn("_spread", spread.cast("long"))
    # Always 0, but not a literal: Spark would turn a join with a literal into a filter
    # and shuffle by the key alone.
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    rest = right.select(*on, zero.alias("_spread"), F.struct(*values).alias("_rest")).hint("shuffle_hash")
    found = F.coalesce("_heavy", "_rest")
    return (
        tagged.join(rest, [*on, "_spread"], "left")
        .withColumn("_found", found)
        .select(*left.columns, *[F.col("_found")[c].alias(c) for c in values])
    )
