import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_sinks import priced
from tollbook.operators import joins, lateness, quality, rating
from tollbook.sinks import tables as sinks
from tollbook.sources import tables as sources

START = datetime(2024, 1, 1)
ROWS = "id int, k string, t timestamp, _block int"
VERSIONS = "k string, valid_from timestamp, valid_to timestamp, price int"


def at(minute):
    return None if minute is None else START + timedelta(minutes=minute)


def joined(spark, rows, versions, blocks):
    left = spark.createDataFrame([(i, k, at(t), 0) for i, (k, t) in enumerate(rows)], ROWS)
    right = spark.createDataFrame([(k, at(a), at(b), p) for k, a, b, p in versions], VERSIONS)
    found = joins.as_of_join(left, right, ["k"], "t", blocks=blocks)
    assert found.columns == ["id", "k", "t", "_block", "valid_from", "valid_to", "price"]
    return found


@pytest.mark.parametrize("blocks", [1, 7])
def test_as_of_join(spark, blocks):
    rng = random.Random(blocks)
    versions = []
    for key in ("a", "b", "hot"):
        begin = 0
        for price in range(6):
            begin += rng.randint(1, 30)
            end = rng.choice([None, begin + rng.randint(1, 10)])
            versions.append((key, begin, end, price))
            begin = begin if end is None else max(begin, end - 1)
    versions = [v for v in versions if v[2] is None or not any(v[0] == w[0] and v[1] < w[1] < v[2] for w in versions)]
    # A key of two thirds of all rows, many at one time; bounds, gaps, unknown keys and nulls.
    rows = [(rng.choice(("a", "b", "hot", "hot", "hot", "hot", "none", None)), rng.choice([*range(200), 50, None])) for _ in range(3000)]
    rows += [("hot", 50)] * 500 + [(v[0], m) for v in versions for m in (v[1] - 1, v[1], v[2]) if m is not None]
    found = joined(spark, rows, versions, blocks).collect()

    def price(key, minute):
        hits = [p for k, a, b, p in versions if k == key and minute is not None and a <= minute and (b is None or minute < b)]
        begun = [a for k, a, b, p in versions if k == key and minute is not None and a <= minute]
        return next((p for k, a, b, p in versions if hits and k == key and a == max(begun) and (b is None or minute < b)), None)

    assert {r.id: r.price for r in found} == {i: price(*row) for i, row in enumerate(rows)}
    assert len(found) == len(rows)


def test_as_of_join_spreads_a_hot_key(spark):
    rows = [("hot", 50)] * 4000 + [("hot", k) for k in range(100)]
    found = joined(spark, rows, [("hot", 10, None, 1), ("hot", 60, None, 2)], 8)
    assert Counter(r.price for r in found.collect()) == {None: 10, 1: 4050, 2: 40}
    # Rows of one key and time, too, are in ranges of about as many rows.
    sizes = found.groupBy("k").count().first()
    assert sizes["count"] == 4100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    stored = [f for f in found.inputFiles()]
    per_range = [r["count"] for r in spark.read.parquet(*stored).groupBy("_block").count().collect()]
    assert len(per_range) == 8 and max(per_range) < 3 * sum(per_range) / 8


def test_as_of_join_needs_versions_apart(spark):
    for versions in ([("a", 1, 5, 1), ("a", 4, None, 2)], [("a", 1, None, 1), ("a", 1, None, 2)], [("a", None, 3, 1)]):
        with pytest.raises(ValueError, match="overlap"):
            joined(spark, [("a", 1)], versions, 2)
    assert joined(spark, [], [("a", 1, None, 1)], 2).count() == 0
    assert [r.price for r in joined(spark, [("a", 1)], [], 2).collect()] == [None]


def test_a_card_that_always_holds_prices_as_the_tariff(spark):
    usage = priced(spark, *[(f"u{k}", 1 + k % 3, k * 50) for k in range(60)], (None, 1, 7)).drop("cost", "rating_status")
    card = rating.rate_card(spark).withColumns({"valid_from": F.lit(datetime(2000, 1, 1)), "valid_to": F.lit(None).cast("timestamp")})
    dated = rating.price_by_dated_card(usage, card, blocks=3)
    assert sorted(map(str, dated.collect())) == sorted(map(str, rating.price(usage).collect()))
    ended = card.withColumn("valid_to", F.lit(datetime(2024, 2, 1)))
    later = rating.price_by_dated_card(usage, ended).filter("month(event_time) > 1")
    assert {(r.cost, r.rating_status) for r in later.collect()} == {(None, "unrated")}


def test_lateness_and_delays(spark):
    rng = random.Random(5)
    rows = [("s", b, START + timedelta(hours=b) - timedelta(seconds=rng.choice([0, 0, 0, rng.randint(0, 20_000)]))) for b in range(6) for _ in range(4000)]
    rows += [("t", 0, START), ("t", 1, None), ("t", 1, START)]
    frame = spark.createDataFrame(rows, "source string, batch int, time timestamp")
    late = lateness.late_by(frame, "source", "batch", "time")
    by_hand, top = {}, {}
    for source, batch, time in sorted((r for r in rows if r[2]), key=lambda r: r[:2]):
        seen = max((t for (s, b), t in top.items() if s == source and b < batch), default=None)
        by_hand.setdefault(source, []).append(max(0, int((seen - time).total_seconds()) if seen else 0))
        top[source, batch] = max(time, top.get((source, batch), time))
    found = late.filter("late_by is not null").groupBy("source").agg(F.sort_array(F.collect_list("late_by")).alias("l")).collect()
    assert {r.source: [x // 1_000_000 for x in r.l] for r in found} == {s: sorted(v) for s, v in by_hand.items()}
    kept = lateness.sketches(late, "source", "batch")
    assert kept.count() == 8
    # Sketches of batches, merged in any grouping, hold the ranks within their error.
    delays = [1, 60_000_000, 1_800_000_000, 7_200_000_000]
    for part in (kept, kept.filter("batch < 3").union(kept.filter("batch >= 3"))):
        for r in lateness.delay_report(part, "source", delays).collect():
            exact = sum(x * 1_000_000 >= r.delay for x in by_hand[r.source]) / len(by_hand[r.source])
            assert abs(r.share_lost - exact) <= 2 * lateness.ERROR and r.records == len(by_hand[r.source])
    wanted = {r.source: r.delay for r in lateness.delay_for(kept, "source", 0.99).collect()}
    share = sum(x * 1_000_000 >= wanted["s"] for x in by_hand["s"]) / len(by_hand["s"])
    assert abs(share - 0.01) <= 2 * lateness.ERROR


@pytest.mark.parametrize("kind", ["skewed", "hot", "nulls", "times", "one value", "few"])
def test_balanced_predicates(spark, kind):
    rng = random.Random(3)
    count, parts = 5000, 8
    value = {
        "skewed": lambda: int(rng.expovariate(0.001)),
        "hot": lambda: 7 if rng.random() < 0.4 else rng.randint(0, 1000),
        "nulls": lambda: None if rng.random() < 0.5 else rng.randint(0, 1000),
        "times": lambda: START + timedelta(seconds=int(rng.expovariate(0.0001))),
        "one value": lambda: 5,
        "few": lambda: rng.randint(0, 2),
    }[kind]
    schema = f"k {'timestamp' if kind == 'times' else 'int'}, n bigint"
    rows = spark.createDataFrame([(value(), rng.randint(-999, 999)) for _ in range(count)], schema)
    conditions = sources.balanced_predicates(rows, "k", parts, "n")
    hits = [F.when(F.expr(c), 1).otherwise(0) for c in conditions]
    times = rows.select(sum(hits[1:], hits[0]).alias("hits")).groupBy("hits").count().collect()
    assert [tuple(r) for r in times] == [(1, count)]
    sizes = [rows.filter(c).count() for c in conditions]
    assert max(sizes) < 2 * count / parts


def test_balanced_read_of_a_database(spark):
    """With the reader replaced: the first pass takes the columns alone, the second a
    condition for each task."""
    table = spark.range(1000).selectExpr("int(pow(id, 2)) as duration_sec", "id")
    calls = []

    def read(_, options, predicates=None):
        calls.append((options["dbtable"], predicates))
        return table if predicates is None else table.filter(" OR ".join(f"({p})" for p in predicates))

    found = sources.balanced_jdbc_events(spark, {"url": "jdbc:x", "dbtable": "events"}, "duration_sec", 4, "id", read)
    assert found.count() == 1000
    assert calls[0] == ("(SELECT duration_sec, id FROM events) keys", None)
    assert calls[1][0] == "events" and len(calls[1][1]) == 5


def test_ledger_of_batches(spark, tmp_path):
    load = sinks.rated_batch_writer(f"{tmp_path}/rated", "rating", ledger_path=f"{tmp_path}/ledger")
    load(priced(spark, ("u", 1, 10), ("a name that is too long", 2, 20)), 0)
    load(priced(spark, ("v", 1, 30), ("another name of this kind", 1, 1)), 1)
    load(priced(spark, ("v", 1, 30), ("another name of this kind", 1, 1)), 1)
    found = quality.ledger_report(sinks.quality_ledger(spark, f"{tmp_path}/ledger"))
    whole = quality.constraint_report(sources.rated_events(spark, f"{tmp_path}/rated"), "rated_events")
    expected = {r.rule: r.violations for r in whole.collect() if r.rule != "primary key unique"}
    assert {r.rule: r.violations for r in found.collect()} == expected
    assert expected["user_identifier at most 15 characters"] == 2
