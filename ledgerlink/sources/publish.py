"""Run label, and outputs that become visible only when a run has succeeded."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlink.staging import Entry, create_once, last_change, listed, plain_path, remove

MANIFEST = "published"
ENTRY_NAME = re.compile(r"\d{20}\.json")
ENTRY = (
    "seq bigint, label string, attempt string, run_ts timestamp, paths map<string,string>, "
    "buckets int, schemas map<string,string>"
)
# The partition column of master tables.
BUCKET = "id_bucket"

# How an input file name ends, and how the missing parts are written.
DAY_AND_TIME = r"(\.R\d{6}\.T\d{6})$"
DAY = r"(\.R\d{6})$"
TIME_FORMAT, DAY_AND_TIME_FORMAT = ".T%H%M%S", ".R%y%m%d.T%H%M%S"


def run_label(file_name: Column, run_ts: datetime, prefix: str = "EMPLOYERS") -> Column:
    """Output label from an input file name ending in ``.Ryymmdd[.Thhmmss]``.

    The last extension is dropped first. Missing parts come from the run time.
    """
    base = F.regexp_replace(file_name, r"\.[^.]*$", "")
    both = F.regexp_extract(base, DAY_AND_TIME, 1)
    day = F.regexp_extract(base, DAY, 1)
    stamp = (
        F.when(both != "", both)
        .when(day != "", F.concat(day, F.lit(run_ts.strftime(TIME_FORMAT))))
        .otherwise(F.lit(run_ts.strftime(DAY_AND_TIME_FORMAT)))
    )
    return F.concat(F.lit(f"{prefix}.SEQIDS"), stamp)


def label_of_file(spark: SparkSession, name: str, run_ts: datetime, prefix: str = "EMPLOYERS") -> str:
    return spark.range(1).select(run_label(F.lit(name), run_ts, prefix).alias("label")).first().label


def write_snapshots(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every table below this attempt's own folder. Readers do not look there yet.

    Nothing that exists is overwritten.
    """
    paths = {name: f"{folder}/{name}" for name in tables}
    for name, df in tables.items():
        df.write.option("compression", "snappy").parquet(paths[name])
    return paths


class Conflict(RuntimeError):
    """Another run has published since this one read its masters."""


def last(spark: SparkSession, root: str) -> int:
    """The number of the run published last, 0 before the first. Only names are read."""
    names = (e.name for e in listed(spark, f"{root}/{MANIFEST}"))
    return max((int(n.split(".")[0]) for n in names if ENTRY_NAME.fullmatch(n)), default=0)


def publish(
    spark: SparkSession,
    root: str,
    label: str,
    attempt: str,
    run_ts: datetime,
    paths: Mapping[str, str],
    expected: int,
    more: Mapping[str, object] | None = None,
) -> int:
    """Make an attempt the current one. One small file, made once or not at all, switches all its tables together.

    ``expected`` is the number that was last when the attempt read its masters. The attempt takes the next one; if
    that is taken, ``Conflict`` is raised and nothing changes. The order of publishing counts, not the run time: a later
    run may carry an earlier time.
    """
    row = {"seq": expected + 1, "label": label, "attempt": attempt, "run_ts": run_ts.isoformat(), "paths": dict(paths)}
    entry = f"{root}/{MANIFEST}/{expected + 1:020d}.json"
    if last(spark, root) != expected or not create_once(spark, entry, json.dumps(row | dict(more or {}))):
        raise Conflict(f"run {last(spark, root)} was published under {root} after {expected} had been read")
    return expected + 1


def published(spark: SparkSession, root: str, seq: int) -> Row:
    """The manifest row of one run."""
    return spark.read.schema(ENTRY).json(f"{root}/{MANIFEST}/{seq:020d}.json").first()


def current(spark: SparkSession, root: str) -> Row:
    """The manifest row of the run published last."""
    return published(spark, root, last(spark, root))


def read_paths(spark: SparkSession, schema: StructType, paths: Sequence[str]) -> DataFrame:
    """One table from the folders it lies in, no rows if there are none."""
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the run published last."""
    row = current(spark, root)
    if name in row.paths:
        return spark.read.parquet(row.paths[name])
    return read_paths(spark, StructType.fromJson(json.loads(row.schemas[name])), list(bucket_paths(row, name).values()))


# --- masters in buckets of their id


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of an id, padded or not."""
    return F.pmod(F.xxhash64(F.rtrim(key)), F.lit(buckets)).cast("int")


def buckets_in(df: DataFrame, key: Column, buckets: int) -> list[int]:
    """The buckets in which ``df`` has ids: at most ``buckets`` numbers."""
    return sorted(r.b for r in df.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def bucket_paths(row: Row, name: str) -> dict[int, str]:
    """Where the buckets of a master table lie; a bucket without rows lies nowhere."""
    of = (key.rsplit("/", 1) for key in row.paths if key.startswith(f"{name}/"))
    return {int(number): row.paths[f"{name}/{number}"] for _, number in of}


def write_buckets(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> dict[str, str]:
    """Write a master table by bucket of its id; returns manifest paths of the buckets that have rows.

    A bucket's rows come from one task, or several if it is large, and lie in order of their ids, with a Bloom filter on
    them, so a reader that asks for an id skips the row groups without it.
    """
    spark, path = df.sparkSession, f"{folder}/{name}"
    spread = df.withColumn(BUCKET, bucket_of(F.col(key), buckets)).hint("rebalance", BUCKET)
    writer = spread.sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).option("compression", "snappy")
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)
    numbers = (e.name.removeprefix(f"{BUCKET}=") for e in listed(spark, path) if e.name.startswith(f"{BUCKET}="))
    return {f"{name}/{n}": f"{path}/{BUCKET}={n}" for n in numbers}


# --- clearing up


def sweep(spark: SparkSession, root: str, keep: int, older_than: timedelta) -> list[str]:
    """Remove what no kept run needs from ``snapshots``: attempts that were never published, and tables and buckets that
    only runs before the last ``keep`` refer to. Returns the folders removed.

    Attempts in which anything changed within ``older_than`` stay, so a run in progress loses nothing; that age must be
    longer than the longest pause of a run between two writes, and than any reader needs an old run. Manifest entries stay:
    they are small, and their numbers must not be taken again.
    """
    if keep < 1:
        raise ValueError("the current run is always kept")
    newest = last(spark, root)
    rows = [published(spark, root, seq) for seq in range(max(1, newest - keep + 1), newest + 1)]
    needed = {plain_path(spark, p) for row in rows for p in row.paths.values()}
    limit, gone = time.time() - older_than.total_seconds(), []
    top = f"{root}/snapshots"

    def clear(folder: str, entry: Entry) -> None:
        """Removes a folder that is not needed; goes into one that holds something that is."""
        if entry.path in needed:
            return
        if any(p.startswith(f"{entry.path}/") for p in needed):
            for e in listed(spark, folder):
                if e.folder:
                    clear(f"{folder}/{e.name}", e)
            return
        remove(spark, folder)
        gone.append(folder)

    for label in listed(spark, top):
        for attempt in listed(spark, f"{top}/{label.name}"):
            folder = f"{top}/{label.name}/{attempt.name}"
            if last_change(spark, folder) < limit:
                clear(folder, attempt)
    return gone
