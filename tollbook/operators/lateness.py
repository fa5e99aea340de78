"""How late records come, as sketches that can be merged, and what a delay would lose."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.operators.joins import lookup_join

#: Size of a sketch; a rank is off by less than ERROR with a probability beyond 99 %.
ACCURACY, ERROR = 400, 0.01


def late_by(rows: DataFrame, source: str, batch: str, time: str) -> DataFrame:
    """The rows with ``late_by``: microseconds by which a record is behind the greatest
    time that earlier batches of its source brought, 0 for one that is not. A watermark
    with a delay drops the records that are late by the delay or more."""
    tops = rows.groupBy(source, batch).agg(F.max(F.unix_micros(time)).alias("top"))
    earlier = Window.partitionBy(source).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    seen = tops.select(source, batch, F.max("top").over(earlier).alias("seen"))
    found = lookup_join(rows, seen, [source, batch], F.col(time))
    behind = F.greatest(F.col("seen") - F.unix_micros(time), F.lit(0).cast("long"))
    return found.withColumn("late_by", F.when(F.col(time).isNotNull(), F.coalesce(behind, F.lit(0).cast("long")))).drop("seen")


def sketches(late: DataFrame, source: str, batch: str, accuracy: int = ACCURACY) -> DataFrame:
    """A row per source and batch, which can be kept and merged whatever comes later."""
    known = late.filter("late_by is not null")
    return known.groupBy(source, batch).agg(F.kll_sketch_agg_bigint("late_by", F.lit(accuracy)).alias("sketch"))


def delay_report(kept: DataFrame, source: str, delays: Sequence[int]) -> DataFrame:
    """Per source and delay in microseconds, the number of records and about which share
    of them the delay would lose, from the sketches of any batches."""
    merged = kept.groupBy(source).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    lost = [
        F.struct(
            F.lit(d).cast("long").alias("delay"),
            (1 - F.kll_sketch_get_rank_bigint("sketch", F.lit(d - 1).cast("long"))).alias("share_lost"),
        )
        for d in delays
    ]
    each = merged.select(source, F.kll_sketch_get_n_bigint("sketch").alias("records"), F.explode(F.array(*lost)).alias("of"))
    return each.select(source, "of.delay", "records", "of.share_lost")


def delay_for(kept: DataFrame, source: str, share_kept: float) -> DataFrame:
    """Per source the least delay, in microseconds, that keeps about such a share."""
    merged = kept.groupBy(source).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    latest = F.kll_sketch_get_quantile_bigint("sketch", F.lit(share_kept))
    return merged.select(source, (latest + 1).alias("delay"))
