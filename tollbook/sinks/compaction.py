"""Small batch folders into files of good size."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.schemas import PERIOD_COLUMNS
from tollbook.sources import live
from tollbook.sources.tables import rated_events

#: Size of the files that compaction writes, about.
FILE_BYTES = 128 << 20


def _takes(folders: live.Folders, period: live.Period, held: live.LiveList, keep: int) -> dict[str, int]:
    """By writer the highest batch that may be compacted: all but the newest ``keep``,
    which a writer may still repeat."""
    highest = dict(held.covered)
    by_writer: dict[str, list[int]] = {}
    for writer, batch_id in live.batches_of(folders, period):
        by_writer.setdefault(writer, []).append(batch_id)
    for writer, numbers in by_writer.items():
        old = sorted(numbers)[: max(0, len(numbers) - keep)]
        if old:
            highest[writer] = max(old[-1], highest.get(writer, -1))
    return highest


def compact(
    spark: SparkSession,
    path: str,
    periods: list[live.Period] | None = None,
    keep: int = 1,
    file_bytes: int = FILE_BYTES,
) -> list[live.Period]:
    """Rewrite the batches of each period but each writer's newest ``keep`` as files of
    about ``file_bytes`` and commit the list that puts them in the batches' place.
    Returns the periods that were rewritten.

    The rows keep their writer and batch number, so a batch that is written again later
    still replaces itself. Until the commit nothing changes for readers: a run that fails
    before leaves files that no list names, which the next run overwrites or
    ``remove_replaced`` deletes. Of two runs at a time one commits and the other raises
    ``ListConflict``. Replaced folders stay for readers that are still at them.
    """
    folders = live.Folders(spark, path)
    done = []
    for period in live.wanted_periods(folders, periods):
        held = live.current_list(folders, period)
        covered = _takes(folders, period, held, keep)
        new = replace(held, generation=held.generation + 1, covered=covered, hidden=frozenset())
        taken = [b for b in live.live_folders(folders, period, held) if new.covers(b)]
        if not taken and not held.hidden:
            continue
        size = sum(folders.bytes(place) for b, place in live.live_folders(folders, period, held).items() if b in taken)
        if held.generation:
            size += folders.bytes(live.compacted_folder(period, held.generation))
        rows = _covered_rows(spark, path, period, new)
        # Ordered by subscriber, so that a reader of some skips row groups; a subscriber
        # with more than a file's rows goes on in the next one.
        files = max(1, math.ceil(size / file_bytes))
        ranges = rows.repartitionByRange(files, "user_identifier", "event_time", "event_id")
        place = live.compacted_folder(period, new.generation)
        ranges.sortWithinPartitions("user_identifier", "event_time").drop(*PERIOD_COLUMNS).write.mode("overwrite").parquet(
            f"{folders.root}/{place}"
        )
        live.commit(folders, period, new)
        done.append(period)
    return done


def _covered_rows(spark: SparkSession, path: str, period: live.Period, new: live.LiveList) -> DataFrame:
    rows = rated_events(spark, path, [period])
    inside = F.lit(False)
    for writer, batch_id in new.covered.items():
        inside = inside | ((F.col("writer") == writer) & (F.col("batch_id") <= batch_id))
    return rows.filter(inside)


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Delete what no list names any more: covered batch folders, older and unfinished
    compactions, older lists. Run it when no reader from before the last compaction is
    left, and not beside a compaction. Returns how many folders went."""
    folders = live.Folders(spark, path)
    removed = 0
    for period in live.periods_of(folders) if live.has_lists(folders) else []:
        held = live.current_list(folders, period)
        counted = set(live.live_folders(folders, period, held))
        for batch, place in live.batches_of(folders, period).items():
            if batch not in counted:
                folders.remove(place)
                removed += 1
        top = f"_compacted/{live.period_name(period)}"
        for name in folders.names(top):
            if live.of_name(name) != str(held.generation):
                folders.remove(top, name)
                removed += 1
        for name in folders.names(live.list_folder(period)):
            if name.endswith(".json") and int(name.removesuffix(".json")) < held.version:
                folders.remove(live.list_folder(period), name)
    return removed
