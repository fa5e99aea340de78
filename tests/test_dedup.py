from pyspark.sql import functions as F

from samples import DATA, SMS, VOICE, changed, values
from tollbook.operators import dedup, mediation


def clean(spark, *records):
    return mediation.clean_records(mediation.mediate(values(spark, *records)))


def test_caller_key_merges_messages_of_one_moment(spark):
    records = [
        SMS,
        changed(SMS, sender_id="212600000009"),
        changed(SMS, cell_id="CELL_2"),
        DATA,
        VOICE,
        changed(VOICE, cell_id="CELL_2"),
    ]
    rows = clean(spark, *records)
    assert dedup.deduplicate(rows, dedup.CALLER_KEY).count() == 3
    assert dedup.deduplicate(rows, dedup.SUBSCRIBER_KEY).count() == 6


def test_the_survivor_does_not_depend_on_order(spark):
    records = [changed(VOICE, duration_sec=n) for n in (70, 60, 90)]
    for order in (records, records[::-1]):
        rows = dedup.deduplicate(clean(spark, *order).repartition(3), dedup.SUBSCRIBER_KEY)
        assert [r.duration_sec for r in rows.collect()] == [60]


def test_doubling_the_input_changes_nothing(spark):
    rows = clean(spark, VOICE, SMS, DATA, changed(VOICE, caller_id="212600000005"))
    once = dedup.deduplicate(rows, dedup.SUBSCRIBER_KEY)
    twice = dedup.deduplicate(rows.union(rows), dedup.SUBSCRIBER_KEY)
    assert once.columns == rows.columns
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_copies_are_reduced_before_the_shuffle(spark):
    rows = clean(spark, VOICE).crossJoin(spark.range(0, 100_000, 1, 4)).drop("id")
    unique = dedup.deduplicate(rows, dedup.SUBSCRIBER_KEY)
    assert unique.count() == 1
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_repeated_counts_the_surplus(spark):
    rows = clean(spark, VOICE, VOICE, VOICE, SMS)
    surplus = dedup.repeated(rows, dedup.SUBSCRIBER_KEY).collect()
    assert [(r.record_type, r.surplus) for r in surplus] == [("voice", 2)]


def test_key_only_rows(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert dedup.deduplicate(rows, ["a", "b"]).count() == 2
    assert dedup.deduplicate(rows.withColumn("c", F.lit(0)), ["a"]).count() == 2
