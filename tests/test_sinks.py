import glob
import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollbook.operators import billing, rating
from tollbook.schemas import SUMMARY_COLUMNS
from tollbook.sinks import tables as sinks
from tollbook.sources import tables as sources
from tollbook.streaming.billing import start_rebilling
from tollbook.streaming.lifecycle import run_to_end

LAYOUT = (
    "record_type string, event_time timestamp, user_identifier string, cell_id string, "
    "technology string, duration_sec int, data_volume_mb double"
)


def priced(spark, *rows):
    """(user, month, megabytes) each."""
    usage = [("data", datetime(2024, m, 5), u, "c", "4G", 0, float(mb)) for u, m, mb in rows]
    return rating.price(spark.createDataFrame(usage, LAYOUT))


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    load = sinks.rated_batch_writer(str(tmp_path), "rating")
    load(priced(spark, ("u", 1, 10), ("u", 2, 20)), 0)
    load(priced(spark, ("v", 1, 30)), 1)
    load(priced(spark, ("v", 1, 30)), 1)
    table = sources.rated_events(spark, str(tmp_path))
    assert table.count() == 3
    assert {(r.writer, r.batch_id) for r in table.collect()} == {("rating", 0), ("rating", 1)}


def test_empty_batches_write_nothing(spark, tmp_path):
    load = sinks.rated_batch_writer(str(tmp_path), "rating")
    load(priced(spark, ("u", 1, 1)).limit(0), 0)
    load(priced(spark, (None, 1, 1)), 1)
    assert not glob.glob(f"{tmp_path}/*")


def test_periods_select_folders(spark, tmp_path):
    sinks.write_batch(
        rating.sanitize(priced(spark, ("u", 1, 10), ("u", 2, 20), ("u", 3, 30))),
        str(tmp_path),
        "w",
        0,
    )
    rows = sources.rated_events(spark, str(tmp_path), [(2024, 2), (2024, 3)], only_rated=True)
    assert rows.count() == 2
    # The other period is not even listed.
    assert len(rows.inputFiles()) == 2
    assert {(r.writer, r.batch_id, r.billing_month) for r in rows.collect()} == {("w", 0, 2), ("w", 0, 3)}
    assert sources.rated_events(spark, str(tmp_path), [(2023, 2)]).isEmpty()


def test_writing_a_period_again_replaces_only_that_period(spark, tmp_path):
    def summary(*rows):
        return billing.summary(billing.bill(rating.sanitize(priced(spark, *rows))))

    path, stamp = str(tmp_path), datetime(2024, 4, 1)
    both = summary(("u", 1, 10), ("u", 2, 20))
    sinks.write_summary(both, path, stamp)
    sinks.write_summary(both, path, stamp)
    assert same(spark.read.parquet(path).select(*SUMMARY_COLUMNS), both)
    sinks.write_summary(summary(("u", 2, 999)), path, stamp)
    rows = {r.billing_month: r.total_cost for r in spark.read.parquet(path).collect()}
    assert rows == {1: Decimal("1.0000"), 2: Decimal("99.9000")}


def test_rebilling_touches_only_periods_with_news(spark, tmp_path):
    rated, out = f"{tmp_path}/rated", f"{tmp_path}/summary"

    def load(number, *rows):
        sinks.write_batch(rating.sanitize(priced(spark, *rows)), rated, "w", number)

    def run():
        run_to_end(start_rebilling(spark, rated, out, f"{tmp_path}/checkpoint"))
        rows = spark.read.parquet(out).collect()
        return {(r.customer_id, r.billing_month): (r.event_count, r.generated_at) for r in rows}

    load(0, ("u", 1, 10), ("u", 2, 20))
    first = run()
    assert run() == first
    load(1, ("u", 2, 30), ("v", 2, 5))
    second = run()
    assert {k: n for k, (n, _) in second.items()} == {("u", 1): 1, ("u", 2): 2, ("v", 2): 1}
    assert second["u", 1] == first["u", 1] and second["u", 2][1] > first["u", 2][1]


def test_documents_are_one_object_per_line(spark, tmp_path):
    summary = billing.summary(billing.bill(rating.sanitize(priced(spark, ("u", 1, 1000)))))
    folder = sinks.write_documents(summary, str(tmp_path), datetime(2024, 2, 1, 8, 30))
    assert folder.endswith("invoice_batch_20240201_083000")
    (line,) = [l for f in glob.glob(f"{folder}/part-*") for l in open(f)]
    document = json.loads(line)
    assert document["customer_id"] == "u" and document["billing_period"] == "2024-01"
    assert document["final_cost_MAD"] == 84.0 and document["total_events"] == 1
    assert document["generated_at"].startswith("2024-02-01T08:30:00")


def test_a_half_written_batch_is_completed(spark):
    batch = rating.sanitize(priced(spark, ("u", 1, 10), ("v", 1, 20), ("w", 1, 30)))
    written = batch.limit(1).withColumn("batch_key", F.lit("rating/7"))
    other = batch.withColumn("batch_key", F.lit("rating/6"))
    missing = sinks.missing_rows(batch, written.union(other), "rating/7")
    assert missing.count() == 2 and {r.batch_key for r in missing.collect()} == {"rating/7"}


def test_jdbc_options():
    options = sources.jdbc_options(
        "jdbc:x", "rated_events", "me", split_column="event_time",
        lower="2024-01-01", upper="2024-02-01", partitions=64,
    )
    assert options["numPartitions"] == "64" and options["partitionColumn"] == "event_time"
    assert "password" not in options
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x", "t", split_column="event_time")


def test_preview(spark, capsys):
    sinks.preview(spark.range(9), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_two_document_runs_do_not_replace_each_other(spark, tmp_path):
    summary = billing.summary(billing.bill(rating.sanitize(priced(spark, ("u", 1, 1000)))))
    assert len({sinks.write_documents(summary, str(tmp_path)) for _ in range(2)}) == 2
