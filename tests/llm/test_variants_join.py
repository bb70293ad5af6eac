"""The join of variants, 64 rows a fingerprint, whose size Spark takes for that of the fingerprints."""

from pyspark.sql import functions as F

from ledgerlink.llm import simhash
from ledgerlink.staging import stage


def prints(spark, n):
    """Distinct fingerprints, every second one bit from the one before it."""
    near = F.when(F.col("id") % 2 == 1, 1 << 7).otherwise(0).cast("long")
    fp = F.xxhash64(F.floor(F.col("id") / 2)).bitwiseXOR(near)
    return stage(spark.range(n).select(fp.alias("fp"), F.lit(1).cast("long").alias("n")), "prints")


def test_variants_are_not_sent_whole(spark):
    fps = prints(spark, 400)
    found = simhash.links(fps, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.distinct().count() == 200


def test_variants_are_not_sent_for_many_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SENT_KEYS", 0)
    fps = prints(spark, 400)
    plans, own = [], simhash.stage
    keep = lambda df, name, *more: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), own(df, name, *more))[1]
    monkeypatch.setattr(simhash, "stage", keep)
    found = simhash.links(fps, 4, crowded=1)
    plan = dict(plans)["centres_of_keys"]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    want = {frozenset((r.a, r.b)) for r in simhash.links(fps, 4).collect()}
    assert {frozenset((r.a, r.b)) for r in found.collect()} == want
