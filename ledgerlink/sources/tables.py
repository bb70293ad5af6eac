"""Database tables: sliced reads, key filter on the server, batched writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# A slice test in Spark SQL; pass the server's own text for JDBC reads.
SPARK_SLICE = "pmod(hash({key}), {n}) = {i}"


def slice_predicates(key: str, n: int, test: str = SPARK_SLICE) -> list[str]:
    """One predicate per read partition; every row meets exactly one."""
    return [test.format(key=key, n=n, i=i) for i in range(n)]


def key_filtered(table: str, key: str, key_table: str, columns: Sequence[str]) -> str:
    """A subquery that lets the server drop rows whose key is not in ``key_table``."""
    return (
        f"(SELECT {', '.join('t.' + c for c in columns)} FROM {table} t "
        f"WHERE EXISTS (SELECT 1 FROM {key_table} k WHERE k.{key} = t.{key})) AS src"
    )


def read_sliced(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A JDBC read with one partition per predicate."""
    return spark.read.jdbc(
        url, table, predicates=list(predicates), properties=dict(properties or {})
    )


def write_options(mode: str, batch: int) -> dict[str, str]:
    options = {"batchsize": str(batch), "rewriteBatchedStatements": "true"}
    if mode == "overwrite":
        options["truncate"] = "true"  # keep the table and its grants
    return options


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Append to a table, or replace its rows while keeping the table itself."""
    merged = {**dict(properties or {}), **write_options(mode, batch)}
    df.write.options(**merged).jdbc(url, table, mode=mode)
