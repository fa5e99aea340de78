import pytest

from test_sinks import priced
from tollbook.operators import billing, rating
from tollbook.schemas import SUMMARY_COLUMNS
from tollbook.sinks import tables as sinks
from tollbook.sources import live
from tollbook.sources import tables as sources
from tollbook.streaming import partials
from tollbook.streaming.billing import start_partial_rebilling
from tollbook.streaming.lifecycle import run_to_end

BUCKETS = 8


class Table:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)

    def load(self, number, *rows, writer="load"):
        sinks.write_batch(rating.sanitize(priced(self.spark, *rows)), f"{self.root}/rated", writer, number)

    def bill(self):
        run_to_end(
            start_partial_rebilling(
                self.spark, f"{self.root}/rated", f"{self.root}/sums", f"{self.root}/summary", f"{self.root}/checkpoint",
                buckets=BUCKETS,
            )
        )

    def bills(self):
        return sorted(map(tuple, self.spark.read.parquet(f"{self.root}/summary").select(*SUMMARY_COLUMNS).collect()))

    def whole_bills(self):
        events = sources.rated_events(self.spark, f"{self.root}/rated", only_rated=True)
        return sorted(map(tuple, billing.summary(billing.bill(events)).collect()))


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, tmp_path)


USERS = [(f"u{k}", month, 10 * k + month) for k in range(30) for month in (1, 2)]


def test_sums_of_parts_add_up(spark):
    events = rating.sanitize(priced(spark, *USERS, *USERS, ("u3", 1, 2000)))
    whole = billing.monthly_usage(events)
    first = billing.monthly_usage(events.filter("user_identifier < 'u2'"))
    rest = billing.monthly_usage(events.filter("user_identifier >= 'u2'"))
    merged = billing.merged_usage(first.union(rest).union(rest.limit(0)))
    assert merged.dtypes == whole.dtypes
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_a_late_event_reads_its_batch_and_its_bucket(spark, table, monkeypatch):
    for number in range(3):
        table.load(number, *USERS[number * 20 : number * 20 + 20])
    table.bill()
    table.load(3, ("u4", 1, 5))
    read, before = [], table.bills()

    def reading(spark, path, places):
        read.extend(places)
        return sources.batch_rows(spark, path, places)

    def never(*_, **__):
        raise AssertionError("old events were read")

    monkeypatch.setattr(partials, "batch_rows", reading)
    monkeypatch.setattr(partials, "rated_events", never)
    stamps = {r[0]: r[1] for r in spark.read.parquet(f"{table.root}/summary").select("customer_id", "generated_at").collect()}
    table.bill()
    assert read == ["billing_year=2024/billing_month=1/writer=load/batch_id=3"]
    assert table.bills() == table.whole_bills() != before
    rows = spark.read.parquet(f"{table.root}/summary").filter("billing_month = 1").select("customer_id", "bucket", "generated_at").collect()
    mine = next(r.bucket for r in rows if r.customer_id == "u4")
    # The bills of other buckets were not written again.
    assert {r.bucket for r in rows if r.generated_at > max(stamps.values())} == {mine}
    # Neither events nor other months' sums are in the plan that bills.
    files = partials.changed_bills(spark, f"{table.root}/sums", [((2024, 1), [mine])]).inputFiles()
    assert files and all("/sums/" in f and "billing_month=1" in f for f in files)


def test_a_batch_written_again_replaces_its_sums(table):
    table.load(0, *USERS[:20])
    table.load(1, *USERS[20:40], ("only here", 1, 700), ("and here", 3, 700))
    table.bill()
    assert table.bills() == table.whole_bills()
    # Subscribers and a month that the new version no longer has.
    table.load(1, *USERS[25:45])
    table.bill()
    assert table.bills() == table.whole_bills()
    assert not any(row[0] in ("only here", "and here") for row in table.bills())


def test_merged_sums(spark, table):
    for number in range(4):
        table.load(number, *USERS[number * 10 : number * 10 + 15])
    table.bill()
    before = table.bills()
    assert partials.merge_sums(spark, f"{table.root}/sums", buckets=BUCKETS) == [(2024, 1), (2024, 2)]
    assert partials.merge_sums(spark, f"{table.root}/sums", buckets=BUCKETS) == []
    folders = live.Folders(spark, f"{table.root}/sums")
    held = live.current_list(folders, (2024, 1))
    assert list(live.live_folders(folders, (2024, 1), held)) == [("load", 3)]
    table.load(4, *USERS)
    table.bill()
    assert table.bills() == table.whole_bills() != before
    # A batch that is among the merged ones, and after that one with a number of its own.
    table.load(1, ("u1", 1, 3000))
    table.bill()
    assert table.bills() == table.whole_bills()
    table.load(5, *USERS[:7])
    table.bill()
    partials.merge_sums(spark, f"{table.root}/sums", keep=0, buckets=BUCKETS)
    table.load(0, *USERS[:9])
    table.bill()
    assert table.bills() == table.whole_bills()


@pytest.mark.parametrize("step", ["_write", "changed_bills"])
def test_a_failed_run_is_made_up_for(table, monkeypatch, step):
    table.load(0, *USERS[:20], ("gone later", 1, 500))
    table.bill()
    table.load(0, *USERS[:18])

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(partials, step, fail)
        with pytest.raises(Exception, match="lost"):
            table.bill()
    table.bill()
    assert table.bills() == table.whole_bills()


def test_no_arrivals_change_nothing(table):
    table.load(0, *USERS)
    table.bill()
    before = table.bills()
    table.bill()
    assert table.bills() == before
