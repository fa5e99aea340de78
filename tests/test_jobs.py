import json
from datetime import datetime
from decimal import Decimal

import pytest

from samples import DATA, SMS, VOICE, changed, values
from tollbook import jobs
from tollbook.operators import billing
from tollbook.sinks import tables as sinks
from tollbook.sources import tables as sources
from tollbook.streaming import mediation


def command(*words):
    return jobs.parser().parse_args([str(w) for w in words])


def test_from_raw_text_to_bills(spark, tmp_path):
    """The jobs one after the other, as they are started from a shell."""
    lines = values(spark, VOICE, VOICE, SMS, DATA, changed(VOICE, duration_sec=-1), "junk")
    lines.write.text(f"{tmp_path}/raw")
    jobs.run(spark, command(
        "mediation", "--from-text", tmp_path / "raw", "--clean-text", tmp_path / "clean",
        "--dead-letter-text", tmp_path / "dead", "--checkpoint", tmp_path / "cm", "--once",
    ))
    assert spark.read.text(f"{tmp_path}/clean").count() == 3
    assert spark.read.text(f"{tmp_path}/dead").count() == 2
    jobs.run(spark, command(
        "rating", "--from-text", tmp_path / "clean", "--table", tmp_path / "rated",
        "--checkpoint", tmp_path / "cr", "--once",
    ))
    assert sources.rated_events(spark, f"{tmp_path}/rated").count() == 3
    jobs.run(spark, command(
        "billing", "--table", tmp_path / "rated", "--summary", tmp_path / "summary",
        "--documents", tmp_path / "documents", "--generated-at", "2024-02-01T08:30:00+00:00",
    ))
    assert {r.service for r in spark.read.parquet(f"{tmp_path}/summary").collect()} == {"voice", "sms", "data"}
    (folder,) = (tmp_path / "documents").iterdir()
    assert folder.name == "invoice_batch_20240201_083000"
    documents = [json.loads(r.value) for r in spark.read.text(str(folder)).collect()]
    assert {d["service"] for d in documents} == {"voice", "sms", "data"}


def test_service_invoices_are_stamped(spark):
    rated = spark.createDataFrame(
        [("voice", "u", Decimal("1.5")), ("sms", "u", Decimal("0.05"))],
        "record_type string, user_identifier string, cost decimal(10,4)",
    )
    row = jobs.service_invoices(rated, datetime(2024, 2, 1).date()).first()
    assert row.total_cost == Decimal("1.5500") and row.data_cost is None
    assert row.invoice_date.isoformat() == "2024-02-01"
    assert jobs.service_invoices(rated).first().invoice_date is not None


class Writer:
    """Stands for a database write: records what it was given."""

    def __init__(self, frame, calls):
        self.frame, self.calls = frame, calls

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def option(self, name, value):
        self.calls[name] = value
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def save(self):
        self.calls["columns"] = self.frame.columns


@pytest.fixture
def database(monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    calls = {}
    monkeypatch.setattr(DataFrame, "write", property(lambda frame: Writer(frame, calls)))
    return calls


def events(spark):
    row = ("id", "voice", datetime(2024, 1, 5), "u", "c", "4G", Decimal("1"), 60, Decimal("0"), "rated")
    from tollbook.schemas import RATED_TABLE

    return spark.createDataFrame([row], RATED_TABLE)


def test_invoices_go_to_their_table(spark, database):
    options = sources.jdbc_options("jdbc:x", "invoices", "me")
    sinks.append_invoices(jobs.service_invoices(events(spark)), options)
    assert database["format"] == "jdbc" and database["mode"] == "append"
    assert database["dbtable"] == "invoices" and "total_cost" in database["createTableColumnTypes"]
    assert database["columns"][-1] == "invoice_date"


def test_the_summary_is_stamped_before_it_goes_to_its_table(spark, database):
    summary = billing.summary(billing.bill(events(spark)))
    sinks.append_summary(summary, sources.jdbc_options("jdbc:x", "billing_summary"))
    assert database["mode"] == "append" and database["columns"][-1] == "generated_at"
    assert len(database["columns"]) == 10


def test_jobs_choose_their_transport():
    topics = command(
        "mediation", "--from-topic", "b:1", "raw", "--clean-topic", "b:1", "clean",
        "--dead-letter-topic", "b:1", "dead", "--checkpoint", "c",
    )
    sink = jobs.sink(topics.clean_text, topics.clean_topic)
    assert sink.func is mediation.start_topic_sink
    assert sink.keywords == {"servers": "b:1", "topic": "clean"}
    split = command(
        "invoices", "--jdbc-url", "jdbc:x", "--split", "event_time", "2024-01-01", "2024-02-01",
    )
    assert split.partitions == 64 and jobs.jdbc(split, "invoices")["url"] == "jdbc:x"
    with pytest.raises(SystemExit):
        command("rating", "--checkpoint", "c")
    with pytest.raises(SystemExit):
        jobs.jdbc(command("invoices", "--table", "t"), "invoices")
