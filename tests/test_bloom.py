"""The Bloom filter before the compat semi join: never a lost match, few chance ones, below the shuffle."""

from pyspark.sql import functions as F

from batchwright.operators import bloom, scd2

from .test_plans import plan

COLS = ["a", "b"]


def _frame(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("a"), (F.col("id") % 7 / 2).alias("b"))


def test_no_match_is_lost_and_few_pass_by_chance(spark):
    tuples, rows = _frame(spark, 0, 20_000), _frame(spark, 0, 100_000)
    kept = bloom.prefilter(rows, tuples, COLS, 10 << 20)
    ids = {r.k for r in kept.select("k").collect()}
    assert ids >= set(range(20_000))
    assert len(ids) - 20_000 < 0.02 * 80_000


def test_nulls_zeroes_and_bounds(spark):
    rows = spark.createDataFrame([(1, "x", 0.0), (2, "x", -0.0), (3, None, 1.0), (4, "y", None), (5, "z", float("nan"))], "k long, a string, b double")
    kept = bloom.prefilter(rows, rows, COLS, 10 << 20)
    assert {r.k for r in kept.collect()} == {1, 2, 5}
    assert kept.columns == rows.columns
    assert bloom.prefilter(rows, rows.limit(0), COLS, 10 << 20).count() == 0
    assert bloom.prefilter(rows, rows, COLS, 10).count() == 5  # no room for a filter: all rows
    assert bloom.prefilter(rows, rows.withColumn("b", F.col("b").cast("float")), COLS, 10 << 20).count() == 5


def test_unchanged_keys_are_the_same(spark):
    source, target = _frame(spark, 500, 900), _frame(spark, 0, 3000)
    plain = scd2.unchanged_keys(source, target, "k", COLS)
    filtered = scd2.unchanged_keys(source, target, "k", COLS, bloom=True)
    assert sorted(plain.collect()) == sorted(filtered.collect()) and plain.count() == 400


def test_filter_lies_below_the_shuffle(spark, ws):
    _frame(spark, 0, 3000).write.parquet(f"{ws}/t")
    text = plan(scd2.unchanged_keys(_frame(spark, 500, 900), spark.read.parquet(f"{ws}/t"), "k", COLS, bloom=True))
    join, lookup = text.index("SortMergeJoin"), text.index("BroadcastHashJoin")
    assert join < text.index("Exchange hashpartitioning(a", join) < lookup < text.index("FileScan parquet", lookup)
    assert "partial_bit_or" in text and "Python" not in text
