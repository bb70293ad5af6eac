"""New master snapshots: the old table with its change-set applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.operators.changeset import TableSpec
from ledgerlink.operators.keyed import shuffled_side


def merge_update(
    master: DataFrame, changes: DataFrame, spec: TableSpec, cfg: MatchConfig
) -> DataFrame:
    """Rows named by a ``U`` get the run's date and update time; nothing else changes."""
    keys = changes.filter(F.col("db_oper_typ") == "U").select(*spec.key).distinct()
    hit = spec.of(master).join(shuffled_side(keys.withColumn("_hit", F.lit(True))), list(spec.key), "left")
    new = {"app_odate": F.lit(cfg.odate), "lu_ts": F.lit(cfg.run_ts)}
    cols = [F.when(F.col("_hit"), new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in spec.columns]
    return hit.select(*cols)


def merge_insert(master: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the ``I`` rows, which change-sets hold once per key; a key the master has is left alone."""
    rows = changes.filter(F.col("db_oper_typ") == "I").select(*spec.columns)
    known = spec.of(master)
    return known.unionByName(rows.join(shuffled_side(known.select(*spec.key)), list(spec.key), "left_anti"))


def merge(master: DataFrame, changes: DataFrame, spec: TableSpec, cfg: MatchConfig) -> DataFrame:
    """Updates and inserts in one pass over the master. A change-set has one row per key, so rows meet once at most."""
    rows = F.struct(*[c for c in spec.rest if c in changes.columns]).alias("_row")
    given = changes.select(*spec.key, F.col("db_oper_typ").alias("_op"), rows)
    both = spec.of(master).withColumn("_known", F.lit(True)).join(given, list(spec.key), "full")
    new = {"app_odate": F.lit(cfg.odate), "lu_ts": F.lit(cfg.run_ts)}

    def value(c: str) -> Column:
        stays = F.when(F.col("_op") == "U", new[c]).otherwise(F.col(c)) if c in new else F.col(c)
        added = F.col("_row")[c] if c in changes.columns else F.lit(None)
        return F.when(F.col("_known"), stays).otherwise(added).alias(c)

    kept = both.filter(F.col("_known") | (F.col("_op") == "I"))
    return kept.select(*spec.key, *[value(c) for c in spec.rest])


def change_counts(name: str, changes: DataFrame) -> DataFrame:
    return changes.groupBy("db_oper_typ").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "db_oper_typ", "rows"
    )
