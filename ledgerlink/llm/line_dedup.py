"""Line deduplication against levelled sorted runs of line hashes, with DataFrame functions only.

Documents come in batches of ascending ids. The line hashes seen so far are kept as runs, each sorted and bucketed by
hash. A batch's distinct hashes are merged with the runs: those in a run are repeats, the others (an anti join) belong
to the batch's smallest document that has them and become a run of their own. When a level has ``FAN_IN`` runs, they are
merged into one of the next level, so a batch meets few runs however many batches came before it.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import lower_ascii, setting
from ledgerlink.operators.keyed import attach
from ledgerlink.staging import stage, stage_path

BATCHES = 4
FAN_IN = 2
MIN_CHARS = 10
# Buckets of one file are read as sorted, as they were written.
SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    """A line without white space (ASCII) at its ends, A-Z in lower case."""
    trimmed = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.translate(trimmed, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def short_digest(text: Column) -> Column:
    """The first 128 bits of a SHA-256: too long to meet by chance or by craft."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def row_key(doc: Column, text: Column) -> Column:
    """Names a row by what it holds. Rows with equal id and text get equal decisions."""
    return short_digest(F.concat(F.coalesce(doc.cast("string"), F.lit("-")), F.lit(":"), text))


class Runs:
    """Sorted runs of the hashes seen so far, by level. Tables of the session's catalog while in use."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: list[list[str]] = []

    def _write(self, hashes: DataFrame, level: int) -> None:
        name = f"line_run_{uuid4().hex}"
        spread = hashes.select("h").repartition(self.buckets, "h")
        writer = spread.write.bucketBy(self.buckets, "h").sortBy("h").option("path", stage_path(self.spark, name))
        writer.format("parquet").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """Rows whose hash is in no run: an anti join by merging with each."""
        return reduce(lambda left, run: left.join(run.hint("merge"), "h", "left_anti"), self.tables(), hashes)

    def add(self, hashes: DataFrame) -> None:
        """A new run; a full level moves up as one."""
        self._write(hashes, 0)
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            full, self.levels[level] = self.levels[level], []
            # Runs share no hash, so they need no deduplication.
            self._write(reduce(DataFrame.union, [self.spark.table(n) for n in full]), level + 1)
            self._drop(full)
            level += 1

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def close(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = []


def batch_of(docs: DataFrame, batches: int) -> Column:
    """Number of the batch a row's ``id`` belongs to, by cuts of about equal size; rows without an id come last."""
    parts = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("id", parts).alias("cuts")).first().cuts if parts else None
    number = sum(((F.col("id") > cut).cast("int") for cut in sorted(set(cuts or []))), F.lit(0))
    return F.when(F.col("id").isNull(), batches - 1).otherwise(number).cast("int")


def repeated_lines(lines: DataFrame, runs: Runs, number: int) -> DataFrame:
    """(row, at) of the lines of one batch that an earlier document, in a run or in the batch, has too.

    Adds the batch's new hashes to ``runs``. A hash of any number of lines is one row before it is merged; lines meet
    decisions by a join that spreads hot hashes.
    """
    missing = F.max(F.col("id").isNull())
    seen = [F.min("id").alias("owner"), F.max("id").alias("last"), missing.alias("missing"), F.count("*").alias("n")]
    keys = stage(lines.groupBy("h").agg(*seen), f"line_keys_{number}")
    new = stage(runs.unseen(keys), f"line_new_{number}")
    old = keys.join(new.select("h"), "h", "left_anti") if runs.levels else keys.limit(0)
    # Rows without an id are one document, after all others.
    shared = new.filter("owner < last OR (owner IS NOT NULL AND missing)")
    told = old.select("h", F.lit(None).cast("long").alias("owner"), F.lit(True).alias("known"), "n")
    told = told.union(shared.select("h", "owner", F.lit(False), "n"))
    told = stage(told, f"line_decisions_{number}")
    met = attach(lines, told, ["h"], "n", ["row", "at"])
    other = F.col("known") | ~F.col("id").eqNullSafe(F.col("owner"))
    dropped = stage(met.filter(F.col("known").isNotNull() & other).select("row", "at"), f"line_drops_{number}")
    runs.add(new)
    return dropped


def line_dedup(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fan_in: int = FAN_IN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_lines, n_dropped, kept) of every row: its text without lines that an earlier document has.

    Lines are what ``\\n`` separates. Lines of at least ``min_chars`` characters (after ``line_key``) that several
    documents have stay in the one with the smallest id, with all their repeats there. Ids are whole numbers. Rows that
    share an id are one document, and so are all rows without one, which come after the others. A null text is empty and
    has one line. Very long texts are one row each, as given. An empty table gives no rows. Other columns are not looked at. The number of
    batches and ``fan_in`` change the work, not the result.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].alias("given"), docs[id_col].cast("long").alias("id"), text.alias("text"))
    rows = rows.withColumn("row", row_key(F.col("id"), F.col("text")))
    parts = rows.select("id", "row", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keyed = parts.select("id", "row", "at", line_key(F.col("line")).alias("key"))
    keyed = keyed.filter(F.char_length("key") >= min_chars)
    keyed = keyed.select("id", "row", "at", short_digest(F.col("key")).alias("h"), batch_of(rows, batches).alias("batch"))
    lines = stage(keyed, "lines", by=["batch"])
    runs = Runs(spark, fan_in)
    try:
        with setting(spark, SORTED_SCAN, "true"):
            drops = [repeated_lines(lines.filter(f"batch = {i}").drop("batch"), runs, i) for i in range(batches)]
    finally:
        runs.close()
    # A row's line numbers: a set, since equal rows have them in common.
    places = reduce(DataFrame.union, drops).groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    both = rows.join(places, "row", "left").withColumn("lines", F.split("text", "\n"))
    # What stays lies between dropped lines: slices, so the work grows with the lines and not with their square.
    starts = "concat(array(0), transform(gone, x -> x + 1))"
    between = f"flatten(zip_with({starts}, concat(gone, array(size(lines))), (a, b) -> slice(lines, a + 1, b - a)))"
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.expr(f"array_join({between}, '\n')"))
    return both.select(
        F.col("given").alias(id_col),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )


def line_dedup_sql(min_chars: int = MIN_CHARS) -> str:
    """DuckDB SQL over ``documents``, by comparing the lines' keys themselves."""
    trimmed = "regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')"
    return f"""
WITH rows AS (
    SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), cut AS (
    SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM rows
), keyed AS (
    SELECT *, {lower_ascii(trimmed)} AS key FROM cut
), owners AS (
    SELECT key, min(doc_id) AS owner, count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) AS docs FROM keyed
    WHERE length(key) >= {min_chars} GROUP BY key
), marked AS (
    SELECT k.*, o.docs > 1 AND k.doc_id IS DISTINCT FROM o.owner AS gone FROM keyed k LEFT JOIN owners o USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone IS NOT TRUE), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
"""
