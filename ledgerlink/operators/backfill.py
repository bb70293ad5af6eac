"""Names for records without one, found through their address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.operators.keyed import shuffled_side


def linked_names(links: DataFrame, names: DataFrame) -> DataFrame:
    """Per address the linked name with the lowest number."""
    known = names.filter(F.col("empr_nm").isNotNull()).select("empr_id", "nm_snum", "empr_nm")
    oldest = F.min(F.struct(F.col("nm_snum"), F.col("empr_nm"))).alias("first")
    return (
        links.select("empr_id", "nm_snum", "addr_snum")
        .join(shuffled_side(known), ["empr_id", "nm_snum"])
        .groupBy("empr_id", "addr_snum")
        .agg(oldest)
        .select(
            "empr_id",
            "addr_snum",
            F.col("first.nm_snum").alias("link_nm_snum"),
            F.col("first.empr_nm").alias("link_nm"),
        )
    )
