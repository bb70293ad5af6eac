"""The paths for large inputs, forced on small ones: same results, hot keys included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlink.config import Limits
from ledgerlink.operators.keyed import attach, keep_first, max_seq
from ledgerlink.operators.numbering import allocate, rank_within
from ledgerlink.staging import stage


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on one id, some without a key."""
    rng = random.Random(5)
    ids = ["HOT"] * 1000 + [f"id{rng.randint(0, 200)}" for _ in range(1900)] + [None] * 100
    rows = [(i, k, f"{rng.randint(0, 10**6):07d}-{i}") for i, k in enumerate(ids)]
    rng.shuffle(rows)
    return stage(spark.createDataFrame(rows, "rid long, k string, word string"), "hot")


def lookup(hot):
    return hot.filter("k is not null and k <> 'id7'").groupBy("k").agg(
        F.count("*").alias("n"), F.max("word").alias("top")
    )


@pytest.mark.parametrize("heavy", [1, 3, 1000])
def test_attach_is_a_left_join(hot, heavy):
    table = lookup(hot)
    got = attach(hot, table, ["k"], "n", ["rid"], Limits(broadcast_rows=0, heavy_keys=heavy))
    want = hot.join(table.drop("n"), "k", "left").select(*hot.columns, "top")
    assert rows_of(got.select("rid", "word", "top")) == rows_of(want.select("rid", "word", "top"))
    small = attach(hot, table, ["k"], "n", ["rid"])
    assert rows_of(small.select("rid", "word", "top")) == rows_of(want.select("rid", "word", "top"))


def test_attach_spreads_the_hot_key(hot):
    """No task of the shuffle gets more than a small share of the rows."""
    table = lookup(hot)
    spark = hot.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(hot, table, ["k"], "n", ["rid"], Limits(broadcast_rows=0, heavy_keys=1))
        part = F.spark_partition_id().alias("part")
        sizes = joined.groupBy(part).agg(F.count("*").alias("rows"), F.max("top")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4
    assert max(r.rows for r in sizes) < 1000  # the hot key alone has 1000


def test_ranks_do_not_depend_on_the_path(hot):
    df = hot.filter("k is not null")
    w = Window.partitionBy("k").orderBy("word")
    want = rows_of(df.withColumn("_rank", F.row_number().over(w)).select("rid", "_rank"))
    for few in (True, False):
        assert rows_of(rank_within(df, ["k"], ["word"], few).select("rid", "_rank")) == want


def test_numbers_continue_and_close_up(hot, spark):
    df = stage(hot.filter("k is not null").drop("rid"), "new")
    first = spark.createDataFrame([("HOT", 50)], "k string, last int")
    second = spark.createDataFrame([("HOT", 7), ("id1", 10)], "k string, last int")
    results = [
        rows_of(allocate(df.repartition(parts), [first, second], ["k"], ["word"], "no", Limits(window_rows=limit)))
        for limit, parts in ((0, 3), (0, 5), (10**6, 2))
    ]
    assert results[0] == results[1] == results[2]
    by_id = {}
    for k, _, no in results[0]:
        by_id.setdefault(k, []).append(no)
    base = {"HOT": 50, "id1": 10}
    for k, numbers in by_id.items():
        start = base.get(k, 0)
        assert sorted(numbers) == list(range(start + 1, start + len(numbers) + 1))


def test_large_path_of_nothing(spark):
    none = stage(spark.createDataFrame([], "k string, word string"), "none")
    base = max_seq(spark.createDataFrame([("a", 1)], "k string, no int"), ["k"], "no", "last")
    assert allocate(none, [base], ["k"], ["word"], "no", Limits(window_rows=-1)).collect() == []


def test_first_row_of_a_hot_key(hot):
    got = keep_first(hot.filter("k is not null"), ["k"], [F.col("rid")])
    want = hot.filter("k is not null").groupBy("k").agg(F.min("rid").alias("rid"))
    assert rows_of(got.select("k", "rid")) == rows_of(want)
