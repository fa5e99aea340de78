from datetime import datetime

import pytest
from pyspark.sql import functions as F

from test_sinks import priced, same
from tollbook.operators import rating
from tollbook.schemas import PERIOD_COLUMNS
from tollbook.sinks import compaction
from tollbook.sinks import tables as sinks
from tollbook.sources import live
from tollbook.sources import tables as sources


def load(spark, path, number, *rows, writer="load"):
    sinks.write_batch(rating.sanitize(priced(spark, *rows)), path, writer, number)


def users(spark, path, **options):
    return sorted(
        (r.user_identifier, r.billing_month, float(r.data_volume_mb), r.writer, r.batch_id)
        for r in sources.rated_events(spark, path, **options).collect()
    )


@pytest.fixture
def loaded(spark, tmp_path):
    path = str(tmp_path / "rated")
    for number in range(5):
        load(spark, path, number, (f"u{number}", 1, 10 + number), (f"u{number}", 2, 20 + number))
    load(spark, path, 7, ("x", 1, 5), writer="other one")
    return path


def test_readers_see_each_row_once_before_and_after(spark, loaded):
    before = users(spark, loaded)
    assert compaction.compact(spark, loaded) == [(2024, 1), (2024, 2)]
    assert users(spark, loaded) == before
    assert users(spark, loaded, periods=[(2024, 2)]) == [r for r in before if r[1] == 2]
    assert compaction.compact(spark, loaded) == []
    compacted = sources.rated_events(spark, loaded, [(2024, 2)])
    # Four batches in one file, and the newest in its folder.
    assert len(compacted.inputFiles()) == 2
    assert compaction.remove_replaced(spark, loaded) == 8
    assert users(spark, loaded) == before
    load(spark, loaded, 5, ("late", 1, 9))
    compaction.compact(spark, loaded, keep=0)
    assert users(spark, loaded) == sorted([*before, ("late", 1, 9.0, "load", 5)])
    assert len(sources.rated_events(spark, loaded).inputFiles()) == 2


def test_a_compacted_batch_written_again_replaces_itself(spark, loaded):
    compaction.compact(spark, loaded)
    wanted = [r for r in users(spark, loaded) if r[3:] != ("load", 2)]
    # Other rows than before, and none in the second month.
    load(spark, loaded, 2, ("new", 1, 77))
    wanted = sorted([*wanted, ("new", 1, 77.0, "load", 2)])
    assert users(spark, loaded) == wanted
    load(spark, loaded, 2, ("new", 1, 77))
    assert users(spark, loaded) == wanted
    compaction.compact(spark, loaded)
    assert users(spark, loaded) == wanted
    compaction.remove_replaced(spark, loaded)
    assert users(spark, loaded) == wanted
    assert not live.current_list(live.Folders(spark, loaded), (2024, 1)).hidden


def test_a_writer_with_any_name(spark, tmp_path):
    path, name = str(tmp_path / "rated"), "a/b=c %x:ü"
    for _ in range(2):
        load(spark, path, 3, ("u", 1, 10), ("u", 2, 20), writer=name)
    load(spark, path, 3, ("u", 2, 30), writer=name)
    assert users(spark, path) == [("u", 2, 30.0, name, 3)]
    compaction.compact(spark, path, keep=0)
    load(spark, path, 3, ("u", 2, 40), writer=name)
    assert users(spark, path) == [("u", 2, 40.0, name, 3)]


def test_a_batch_that_leaves_a_period_leaves_no_rows(spark, loaded):
    load(spark, loaded, 4, ("moved", 3, 1))
    assert [r for r in users(spark, loaded) if r[3:] == ("load", 4)] == [("moved", 3, 1.0, "load", 4)]


def test_a_failed_swap_leaves_the_old_state(spark, loaded, monkeypatch):
    before = users(spark, loaded)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(live, "commit", fail)
        with pytest.raises(OSError, match="lost"):
            compaction.compact(spark, loaded)
    assert users(spark, loaded) == before
    compaction.compact(spark, loaded)
    assert users(spark, loaded) == before


def test_of_two_compactions_one_commits(spark, loaded):
    folders = live.Folders(spark, loaded)
    held = live.current_list(folders, (2024, 1))
    compaction.compact(spark, loaded)
    with pytest.raises(live.ListConflict):
        live.commit(folders, (2024, 1), held)
    assert not [n for n in folders.names(live.list_folder((2024, 1))) if "draft" in n]


def test_number_of_files_follows_the_size(spark, tmp_path):
    path = str(tmp_path / "rated")
    for number in range(6):
        load(spark, path, number, *[(f"u{k}", 1, k + 1) for k in range(400)])
    size = sum(live.Folders(spark, path).bytes(place) for place in live.batches_of(live.Folders(spark, path), (2024, 1)).values())
    before = sources.rated_events(spark, path).drop(*PERIOD_COLUMNS)
    compaction.compact(spark, path, keep=0, file_bytes=size // 3 + 1)
    after = sources.rated_events(spark, path)
    assert len(after.inputFiles()) == 3
    assert same(before, after.drop(*PERIOD_COLUMNS))


def test_a_large_batch_is_written_by_as_many_tasks_as_it_needs(spark, tmp_path, monkeypatch):
    rows = spark.range(50_000).select(
        F.format_string("u%d", "id").alias("user_identifier"),
        F.lit(datetime(2024, 1, 5)).alias("event_time"),
        F.year(F.lit(datetime(2024, 1, 5))).alias("billing_year"),
        (F.when(F.col("id") < 45_000, 1).otherwise(2)).alias("billing_month"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sized = sinks.sized_for_write(rows, task_rows=3_000)
        assert sized.rdd.getNumPartitions() == 17
        sized.write.partitionBy(*PERIOD_COLUMNS).parquet(f"{tmp_path}/large")
        assert sinks.sized_for_write(rows.limit(0)).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    written = spark.read.parquet(f"{tmp_path}/large")
    assert written.count() == 50_000
    assert 8 < len(written.inputFiles()) <= 17
