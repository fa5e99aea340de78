"""What the physical plans must look like for large inputs."""

import re
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from tollbook.operators import invoicing, rating
from tollbook.plans import catalogue, chains
from tollbook.session import shared_folder
from tollbook.sinks import tables as sinks
from tollbook.sources import tables as sources

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


BATCH = [n for n in entry.queries() if not n.startswith(("stream", "idempotent", "incremental"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_only_needed_columns_are_read(spark):
    text = plan(catalogue.dedup_caller_key(spark, FOLDER))
    assert "props" not in text
    text = plan(catalogue.reject_reasons(spark, FOLDER))
    assert "props" not in text and "Exchange SinglePartition" not in text


def test_the_whole_chain_shuffles_twice(spark):
    assert exchanges(plan(entry.entry(spark))) == 2


def test_pricing_and_line_items_add_no_shuffle(spark):
    events = catalogue.records(spark, FOLDER)
    unique = exchanges(plan(chains.unique_usage(events)))
    assert unique == 1
    assert exchanges(plan(invoicing.line_items(chains.rated_events(events)))) == unique


def test_aggregations_reduce_before_the_shuffle(spark):
    for name in ("service_pivot", "monthly_usage", "invoice_header", "rating_status_counts"):
        text = plan(entry.queries()[name](spark, FOLDER))
        assert "partial_sum(cost" in text, name


def test_status_filter_reaches_the_scan(spark, tmp_path):
    sinks.write_rated(
        catalogue.rated(spark, FOLDER), sinks.batch_folder(str(tmp_path), "w", 0)
    )
    text = plan(sources.rated_events(spark, str(tmp_path), only_rated=True).select("cost"))
    assert "EqualTo(rating_status,rated)" in text
    assert "ReadSchema: struct<cost:decimal(10,4),rating_status:string>" in text


@pytest.mark.parametrize(("limit", "broadcast"), [(100, True), (3, False)])
def test_the_rate_card_is_broadcast_only_if_small(spark, limit, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        usage = chains.unique_usage(catalogue.records(spark, FOLDER))
        priced = rating.price_by_card(usage, rating.rate_card(spark), max_broadcast_rows=limit)
        assert ("SortMergeJoin" not in plan(priced)) is broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_cluster_must_name_its_shared_folder():
    def session(master, folder):
        settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "/warehouse"}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default), sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", "s3://here")).startswith("s3://here/")
    assert shared_folder(session("local[4]", None)).startswith("/warehouse/work/")
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_folder(session("yarn", None))
