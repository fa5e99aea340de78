import pytest
from pyspark.sql import functions as F

from tollbook.operators import joins


def tables(spark):
    """60,000 rows, a third of them under one key; some keys without a match."""
    rows = spark.range(0, 60_000, 1, 6).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("k"),
    )
    lookup = spark.range(600).select(
        F.when(F.col("id") == 599, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    return rows, lookup


@pytest.fixture
def without_adaptive(spark):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "-1")
    yield
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


@pytest.mark.parametrize("how", joins.KINDS)
@pytest.mark.parametrize("rows_per_task", [50, 1000, 10**9])
def test_balanced_join_equals_the_plain_join(spark, how, rows_per_task):
    rows, lookup = tables(spark)
    got = joins.balanced_join(rows, lookup, ["k"], F.col("n"), how, rows_per_task)
    expected = rows.join(lookup, ["k"], how)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_a_heavy_key_is_spread_over_tasks(spark, without_adaptive):
    rows, lookup = tables(spark)

    def largest(joined):
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count()
        return tasks.agg(F.max("count")).first()[0]

    plain = largest(rows.join(lookup, ["k"]))
    balanced = largest(joins.balanced_join(rows, lookup, ["k"], F.col("n"), "inner", 500))
    assert balanced < 0.65 * plain


@pytest.mark.parametrize("hot", ["hot", None])
@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_no_task_gets_much_more_than_promised(spark, without_adaptive, hot, how):
    """40,000 rows, three quarters under one key, which may be NULL, in 40 tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        rows = spark.range(0, 40_000, 1, 8).select(
            F.col("id").alias("n"),
            F.when(F.col("id") % 4 > 0, hot).otherwise((F.col("id") % 997).cast("string")).alias("k"),
        )
        lookup = spark.range(600).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
        joined = joins.balanced_join(rows, lookup, ["k"], F.col("n"), how, 1000)
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count()
        # Rows round the join stay in their 8 tasks; parts of a key meet by chance.
        assert tasks.agg(F.max("count")).first()[0] <= 40_000 / 8 + 1000
        assert joined.count() == rows.join(lookup, ["k"], how).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("how", ["right", "full", "cross"])
def test_other_joins_are_refused(spark, how):
    rows, lookup = tables(spark)
    with pytest.raises(ValueError):
        joins.balanced_join(rows, lookup, ["k"], F.col("n"), how)


def test_a_few_wide_rows_are_not_broadcast(spark, without_adaptive):
    rows, lookup = tables(spark)
    wide = lookup.withColumn("text", F.repeat(F.lit("x"), 10_000))
    joined = joins.lookup_join(rows, wide, ["k"], F.col("n"), max_bytes=1 << 20)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_a_lookup_is_broadcast_only_if_counted_small(spark, without_adaptive):
    rows, lookup = tables(spark)
    small = joins.lookup_join(rows, lookup, ["k"], F.col("n"))
    large = joins.lookup_join(rows, lookup, ["k"], F.col("n"), max_rows=599)
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in (small, large)]
    assert "SortMergeJoin" not in plans[0] and "SortMergeJoin" in plans[1]
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
