import json

import pytest

from samples import VOICE, changed
from test_streams import call, deliver
from tollbook.operators import mediation
from tollbook.sinks.streams import start_text_sink
from tollbook.sources import streams
from tollbook.sources.live import Folders
from tollbook.streaming import single_pass
from tollbook.streaming import mediation as mediation_job
from tollbook.streaming.lifecycle import run_to_end


class Job:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)

    def arrive(self, *records):
        deliver(self.spark, f"{self.root}/in", *records)

    def run(self, **options):
        values = streams.text_stream(self.spark, f"{self.root}/in")
        query = single_pass.start_single_pass(values, f"{self.root}/out", f"{self.root}/checkpoint", once=True, **options)
        run_to_end(query)
        return query

    def output(self, name):
        rows = mediation.parse_clean(single_pass.committed(self.spark, f"{self.root}/out", name)).collect()
        return sorted(f"{r.timestamp:%H:%M} {r.caller_id[-1]}" for r in rows)

    def values(self, name):
        return sorted(r.value for r in single_pass.committed(self.spark, f"{self.root}/out", name).collect())


def with_state(clean, root):
    return start_text_sink(clean, f"{root}/clean", f"{root}/checkpoint", once=True, state_partitions=2)


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


def test_outputs_of_batches(spark, job):
    bad = changed(VOICE, duration_sec=-1)
    job.arrive(call(0), call(0), call(3, "2"), bad, "not json")
    first = job.run()
    # A copy in time, a copy too late, another record too late, and one just in time.
    job.arrive(call(20), call(3, "2"), call(-10, "3"), call(-2, "4"), call(-1, "5"))
    job.run()
    job.arrive(call(20), call(14, "6"), call(14, "6"), call(15, "7"), call(16, "8"))
    job.run()
    assert job.output("clean") == ["11:59 5", "12:00 1", "12:03 2", "12:16 8", "12:20 1"]
    # At the watermark is late, and copies of late records are late each.
    assert job.output("late") == ["11:50 3", "11:58 4", "12:14 6", "12:14 6", "12:15 7"]
    letters = mediation_job.dead_letters(single_pass.committed(spark, f"{job.root}/out", "dead-letter")).collect()
    assert sorted((r.raw, tuple(r.reject_reasons)) for r in letters)[-1][0] == json.dumps(bad)
    assert len(letters) == 2
    # Two outputs and the keys from one reading of the input.
    assert sum(p["numInputRows"] for p in first.recentProgress) == 5
    counts = [tuple(r) for r in single_pass.batch_counts(spark, f"{job.root}/out").orderBy("batch_id").collect()]
    assert counts == [(0, 5, 3, 2, 0), (1, 5, 5, 2, 2), (2, 5, 5, 1, 3)]


def test_keys_behind_the_watermark_are_dropped(spark, job):
    for k in range(5):
        job.arrive(call(20 * k), call(20 * k + 1, "2"))
        job.run()
    folders = Folders(spark, f"{job.root}/out")
    assert folders.names("keys") == ["batch_id=4"]
    assert list(single_pass.last_commit(folders).keys) == [4]


@pytest.mark.parametrize("step", ["move", "create"])
def test_a_batch_that_fails_before_its_commit_is_made_up_for(job, monkeypatch, step):
    job.arrive(call(0), call(1, "2"))
    job.run()
    job.arrive(call(2), call(1, "2"), call(-30, "3"), "not json")
    calls = []

    def fail(self, *args, real=getattr(Folders, step)):
        calls.append(args)
        if len(calls) == (3 if step == "move" else 1):
            raise OSError("lost")
        return real(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(Folders, step, fail)
        with pytest.raises(Exception, match="lost"):
            job.run()
    # Nothing of the failed batch is committed, although some of it is in place.
    assert job.output("clean") == ["12:00 1", "12:01 2"] and job.output("late") == []
    job.run()
    assert job.output("clean") == ["12:00 1", "12:01 2", "12:02 1"]
    assert job.output("late") == ["11:30 3"] and len(job.values("dead-letter")) == 1


def test_a_committed_batch_is_left_as_it_is(spark, job):
    job.arrive(call(0))
    job.run()
    again = spark.createDataFrame([(json.dumps(call(5)),)], "value string")
    done = single_pass.load_batch(again, 0, f"{job.root}/out", ("timestamp", "caller_id", "record_type"), 0)
    assert done.counts["clean"] == 1 and job.output("clean") == ["12:00 1"]


def test_empty_batches_and_no_input(spark, job):
    nothing = spark.createDataFrame([], "value string")
    done = single_pass.load_batch(nothing, 0, f"{job.root}/out", ("timestamp", "caller_id", "record_type"), 0)
    assert done.latest is None and done.counts == {"read": 0, "accepted": 0, "late": 0, "clean": 0}
    assert job.values("clean") == job.values("late") == job.values("dead-letter") == []


@pytest.mark.parametrize("salts", [0, 3])
def test_going_on_from_operator_state(spark, tmp_path, salts):
    """The first part with two state partitions, the second without any: the same copies
    and late records are dropped as by one query for both."""
    first = [call(0), call(0), call(7, "2"), call(9, "3"), call(9, "3")]
    second = [call(9, "3"), call(7, "2"), call(2, "4"), call(5, "5"), call(30)]
    found = {}
    for resized in (False, True):
        root = f"{tmp_path}/{resized}"

        def old(root=root):
            clean = mediation_job.clean_stream(streams.text_stream(spark, f"{root}/in"), salts=salts)
            run_to_end(with_state(clean, root))

        deliver(spark, f"{root}/in", *first)
        old()
        deliver(spark, f"{root}/in", *second)
        if resized:
            single_pass.continue_from(spark, f"{root}/checkpoint", f"{root}/out", f"{root}/new")
            values = streams.text_stream(spark, f"{root}/in")
            query = single_pass.start_single_pass(values, f"{root}/out", f"{root}/new", once=True, state_partitions=8)
            run_to_end(query)
            # What the old query had read is not read again.
            assert sum(p["numInputRows"] for p in query.recentProgress) == len(second)
            lines = spark.read.text(f"{root}/clean").union(single_pass.committed(spark, f"{root}/out", "clean"))
            late = single_pass.batch_counts(spark, f"{root}/out").agg({"late": "sum"}).first()[0]
            assert late == 1
        else:
            old()
            lines = spark.read.text(f"{root}/clean")
        found[resized] = sorted(r.value for r in lines.collect())
    assert found[True] == found[False] and len(found[True]) == 5


def test_a_query_stopped_within_a_batch_is_not_taken_over(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, f"{root}/in", call(0))
    run_to_end(with_state(mediation_job.clean_stream(streams.text_stream(spark, f"{root}/in")), root))
    last = max(int(n) for n in Folders(spark, f"{root}/checkpoint").names("offsets") if n.isdigit())
    Folders(spark, f"{root}/checkpoint").copy(f"offsets/{last}", Folders(spark, f"{root}/checkpoint"), f"offsets/{last + 1}")
    with pytest.raises(ValueError, match="within a batch"):
        single_pass.continue_from(spark, f"{root}/checkpoint", f"{root}/out", f"{root}/new")
