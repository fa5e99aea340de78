"""Mediation in one query: a micro-batch is read and parsed once and goes to three outputs,
clean records, dead letters and late records, which are committed together.

What deduplication must remember is a table, not operator state: the keys of records that
may still be repeated, by batch. It has no fixed number of partitions, so a job can be
restarted on a cluster of another size, and it says which records are late, which operator
state only counts. The watermark moves as the engine's does: a batch is measured by the
greatest time that batches before it brought, less the delay, and a record at or before
it is late.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tollbook.operators import dedup, mediation
from tollbook.sinks.streams import start_batch_sink
from tollbook.sources.live import Folders

OUTPUTS = ("clean", "dead-letter", "late")
DELAY = "5 minutes"


@dataclass(frozen=True)
class Commit:
    """What a batch left behind: the greatest accepted time so far and, by batch, the
    greatest time of the keys that are still needed, both in microseconds."""

    batch_id: int = -1
    latest: int | None = None
    keys: dict[int, int] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)

    def watermark(self, delay: int) -> int | None:
        return None if self.latest is None else self.latest - delay

    def text(self) -> str:
        return json.dumps({"latest": self.latest, "keys": self.keys, "counts": self.counts})


def _marker(batch_id: int) -> str:
    return f"{batch_id:012d}.json"


def commits(folders: Folders) -> list[int]:
    return [int(n.removesuffix(".json")) for n in folders.names("_commits") if n.endswith(".json")]


def read_commit(folders: Folders, batch_id: int) -> Commit:
    held = json.loads(folders.read("_commits", _marker(batch_id)))
    return Commit(batch_id, held["latest"], {int(k): v for k, v in held["keys"].items()}, held["counts"])


def last_commit(folders: Folders) -> Commit:
    done = commits(folders)
    return read_commit(folders, done[-1]) if done else Commit()


def micros(spark: SparkSession, delay: str) -> int:
    """Microseconds of an interval in words."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return spark.range(1).select(F.unix_micros(start + F.expr(f"interval {delay}"))).first()[0]


def _keys(records: DataFrame, key: Sequence[str]) -> DataFrame:
    return records.select(*[dedup.key_column(k).alias(k) for k in key])


def load_batch(values: DataFrame, batch_id: int, root: str, key: Sequence[str], delay: int) -> Commit:
    """One micro-batch to its outputs; a committed one is left as it is.

    Each output is written aside and moved as a whole, and the commit comes last. A batch
    that failed on the way is computed anew from the same rows and the same commit
    before it, so what was moved already is what it would write again.
    """
    spark = values.sparkSession
    folders = Folders(spark, root)
    if batch_id in commits(folders):
        return read_commit(folders, batch_id)
    before = last_commit(folders)
    mark = before.watermark(delay)
    time = F.unix_micros("timestamp")
    flagged = mediation.mediate(values).withColumn(
        "late", F.lit(False) if mark is None else F.coalesce(F.col("is_valid") & (time <= F.lit(mark)), F.lit(False))
    )
    flagged = flagged.persist()
    unique = None
    try:
        found = flagged.agg(
            F.count("*").alias("read"),
            F.count_if("is_valid").alias("accepted"),
            F.count_if("late").alias("late"),
            F.max(F.when(F.col("is_valid"), time)).alias("latest"),
        ).first()
        unique = dedup.deduplicate(mediation.clean_records(flagged.filter("not late")), key)
        if before.keys:
            # Each key is once on either side, so none is hot.
            places = [f"{folders.root}/keys/batch_id={n}" for n in sorted(before.keys)]
            known = spark.read.schema(_keys(unique, key).schema).parquet(*places).select(F.struct(*key).alias("known"))
            same = [dedup.key_column(k).eqNullSafe(F.col(f"known.{k}")) for k in key]
            unique = unique.join(known, reduce(and_, same), "left_anti")
        unique = unique.persist()
        outputs = {
            "clean": unique,
            "dead-letter": mediation.with_reasons(mediation.rejected(flagged).drop("late")),
            "late": mediation.clean_records(flagged.filter("late")),
        }
        for name, rows in outputs.items():
            mediation.to_values(rows).write.mode("overwrite").text(f"{folders.root}/_aside/{batch_id}/{name}")
        _keys(unique, key).write.mode("overwrite").parquet(f"{folders.root}/_aside/{batch_id}/keys")
        counts = {"read": found["read"], "accepted": found["accepted"], "late": found["late"], "clean": unique.count()}
    finally:
        flagged.unpersist()
        if unique is not None:
            unique.unpersist()
    latest = max((t for t in (before.latest, found["latest"]) if t is not None), default=None)
    keys = before.keys | ({batch_id: found["latest"]} if counts["clean"] else {})
    needed = {n: t for n, t in keys.items() if t > latest - delay}
    done = Commit(batch_id, latest, needed, counts)
    _settle(folders, done, set(keys) - set(needed))
    return done


def _settle(folders: Folders, done: Commit, forgotten: set[int]) -> None:
    """Move a batch's outputs to their places, commit it, and drop keys that can't come
    again."""
    aside = f"_aside/{done.batch_id}"
    for name in (*OUTPUTS, "keys"):
        folders.make(name)
        if not folders.exists(name, f"batch_id={done.batch_id}"):
            folders.move(f"{aside}/{name}", f"{name}/batch_id={done.batch_id}")
    folders.create(done.text(), "_commits", _marker(done.batch_id))
    folders.remove(aside)
    for number in forgotten:
        folders.remove("keys", f"batch_id={number}")


def start_single_pass(
    values: DataFrame,
    root: str,
    checkpoint: str,
    key: Sequence[str] = dedup.SUBSCRIBER_KEY,
    delay: str = DELAY,
    **run,
) -> StreamingQuery:
    """Start the mediation; ``clean``, ``dead-letter`` and ``late`` below ``root`` get a
    folder of text for each batch. A stream can read ``root/clean/*``: a batch's folder
    appears as a whole."""
    width = micros(values.sparkSession, delay)

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, root, key, width)

    return start_batch_sink(values, load, checkpoint, **run)


def committed(spark: SparkSession, root: str, output: str) -> DataFrame:
    """The text of an output's committed batches, as ``value``."""
    folders = Folders(spark, root)
    folders.make(output)
    last = last_commit(folders).batch_id
    rows = spark.read.schema("value string, batch_id bigint").text(f"{folders.root}/{output}")
    return rows.filter(F.col("batch_id") <= last).select("value")


def batch_counts(spark: SparkSession, root: str) -> DataFrame:
    """What each committed batch read, accepted, wrote and found late, from its commit."""
    folders = Folders(spark, root)
    rows = [(n, c["read"], c["accepted"], c["clean"], c["late"]) for n in commits(folders) for c in [read_commit(folders, n).counts] if c]
    return spark.createDataFrame(rows, "batch_id bigint, read bigint, accepted bigint, clean bigint, late bigint")


def continue_from(
    spark: SparkSession, old_checkpoint: str, root: str, checkpoint: str, key: Sequence[str] = dedup.SUBSCRIBER_KEY, delay: str = DELAY
) -> Commit:
    """Let this job go on where a stopped deduplication with operator state ended.

    The keys in the old query's state, read by the state data source from its last
    stateful step, become this job's, its watermark is kept, and the new checkpoint gets
    the old one's record of what was read; nothing else of the state is taken, so the
    number of partitions that was fixed for it no longer binds. Source and order of
    sources must be those of the old query.
    """
    old, new, folders = Folders(spark, old_checkpoint), Folders(spark, checkpoint), Folders(spark, root)
    last = max(int(n) for n in old.names("commits") if n.isdigit())
    if str(last + 1) in old.names("offsets"):
        raise ValueError("the old query was stopped within a batch; let it finish that one first")
    mark = json.loads(old.read("commits", str(last)).splitlines()[1])["nextBatchWatermarkMs"] * 1000
    operator = max(int(n) for n in old.names("state") if n.isdigit())
    state = spark.read.format("statestore").option("operatorId", operator).load(old.root)
    keys = state.select(*[F.col(f"key.{k}").alias(k) for k in key])
    keys.write.mode("overwrite").parquet(f"{folders.root}/_aside/{last}/keys")
    for name in OUTPUTS:
        spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{folders.root}/_aside/{last}/{name}")
    for part in ("metadata", "offsets", "commits", "sources"):
        if old.exists(part):
            old.copy(part, new, part)
    latest = mark + micros(spark, delay)
    done = Commit(last, latest, {last: latest})
    _settle(folders, done, set())
    return done
