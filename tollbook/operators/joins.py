"""Joins of many rows to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollbook.session import shared_folder

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 5_000_000
#: Joins that keep no lookup row for its own sake; a repeated one does no harm there.
KINDS = ("inner", "left", "left_semi", "left_anti")


def is_small(table: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Counted and measured, by its rows as text, up to one row past the limit."""
    text = F.to_json(F.struct(*table.columns))
    seen = table.limit(max_rows + 1).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")
    ).first()
    return seen["rows"] <= max_rows and seen["bytes"] <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Column,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast the lookup if it is found to be small, else join balanced."""
    if is_small(lookup, max_rows, max_bytes):
        return rows.join(F.broadcast(lookup), list(on), how)
    return balanced_join(rows, lookup, on, spread, how)


def balanced_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Column,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shuffled join in which no key puts more than about ``rows_per_task``
    rows on one task, however many rows share it.

    Keys are counted first. A key above the limit is divided into numbered
    parts: its rows choose theirs by a hash of ``spread``, and its lookup row is
    repeated once per part. All other keys have the single part 0. With N rows
    there are at most N / limit divided keys, and the limit grows with N so
    that this list never exceeds what may be broadcast. Rows with a NULL in
    their key match nothing and go round the join.
    """
    if how not in KINDS:
        raise ValueError(f"a balanced join is one of {', '.join(KINDS)}, not {how}")
    keyed = rows.dropna(subset=list(on))
    sizes = keyed.groupBy(*on).agg(F.count("*").alias("size"))
    seen = sizes.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("total"),
        F.count_if(F.col("size") > rows_per_task).alias("heavy"),
    ).first()
    if seen["heavy"]:
        limit = rows_per_task
        if seen["heavy"] > BROADCAST_ROWS:
            limit = max(limit, seen["total"] // BROADCAST_ROWS + 1)
        joined = _divided_join(keyed, lookup, on, spread, how, sizes, limit)
    else:
        joined = keyed.join(lookup, list(on), how)
    if how in ("inner", "left_semi"):
        return joined
    without_key = rows.filter(reduce(or_, [F.col(c).isNull() for c in on]))
    added = [
        F.lit(None).cast(field.dataType).alias(field.name)
        for field in joined.schema.fields
        if field.name not in rows.columns
    ]
    return joined.union(without_key.select("*", *added).select(*joined.columns))


def _divided_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Column,
    how: str,
    sizes: DataFrame,
    limit: int,
) -> DataFrame:
    divided = sizes.filter(F.col("size") > limit).select(
        *on, F.ceil(F.col("size") / limit).cast("int").alias("parts")
    )
    parts = F.coalesce(F.col("parts"), F.lit(1))
    left = rows.join(F.broadcast(divided), list(on), "left").withColumn(
        "part", F.pmod(F.xxhash64(spread), parts).cast("int")
    )
    right = lookup.join(F.broadcast(divided), list(on), "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return left.drop("parts").join(right.drop("parts"), [*on, "part"], how).drop("part")


def overlapping(versions: DataFrame, on: Sequence[str], valid_from: str, valid_to: str) -> DataFrame:
    """Versions that begin before the one before them of the same key has ended, or with
    it, and versions without a beginning."""
    order = Window.partitionBy(*on).orderBy(F.col(valid_from).asc_nulls_first())
    ended = F.lag(valid_to).over(order)
    again = F.lag(valid_from).over(order)
    looked = versions.withColumns({"_ended": ended, "_again": again, "_place": F.row_number().over(order)})
    return looked.filter(
        F.col(valid_from).isNull()
        | ((F.col("_place") > 1) & ((F.col("_again") == F.col(valid_from)) | (F.col("_ended") > F.col(valid_from))))
    ).drop("_ended", "_again", "_place")


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    time: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    blocks: int | None = None,
) -> DataFrame:
    """Each row with the version of its key that is valid at its time: from ``valid_from``
    on, up to but without ``valid_to``, or to the next version where that is NULL. Rows
    without a valid version, in a gap or with a NULL in key or time, have NULLs.

    Rows and versions are sorted together and each row takes the last version before it;
    no row meets more than one version. The order is cut into ranges of about as many
    rows, so a key with very many is spread over ranges, each of which starts with the
    version that the key's ranges before it ended with. The ranges are stored, as drawing
    them again could draw them elsewhere. There are as many as shuffle partitions, or
    ``blocks``. Versions of a key must not overlap.
    """
    spark = rows.sparkSession
    if not overlapping(versions, on, valid_from, valid_to).isEmpty():
        raise ValueError("versions of a key overlap, or one has no beginning")
    added = [c for c in versions.columns if c not in on]
    version = F.struct(*[F.col(c) for c in added])
    kind = versions.select(version.alias("v")).schema["v"].dataType
    row = F.struct(*[F.col(c) for c in rows.columns])
    row_kind = rows.select(row.alias("r")).schema["r"].dataType
    keys = [f"_k{k}" for k in range(len(on))]
    whole = reduce(and_, [F.col(c).isNotNull() for c in (*on, time)])
    spread = F.xxhash64(*[F.col(c).cast("string") for c in rows.columns])
    union = rows.filter(whole).select(
        *[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)], F.col(time).alias("_at"), F.lit(1).alias("_is_row"),
        spread.alias("_spread"), row.alias("_row"), F.lit(None).cast(kind).alias("_version"),
    ).union(
        versions.dropna(subset=list(on)).select(
            *[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)], F.col(valid_from).alias("_at"), F.lit(0).alias("_is_row"),
            F.lit(0).cast("long").alias("_spread"), F.lit(None).cast(row_kind).alias("_row"), version.alias("_version"),
        )
    )
    order = ["_at", "_is_row", "_spread"]
    ranged = union.repartitionByRange(*([blocks] if blocks else []), *keys, *order).withColumn("_block", F.spark_partition_id())
    path = f"{shared_folder(spark)}/as-of"
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per key and range, whatever the rows.
    ends = placed.groupBy(*keys, "_block").agg(F.max_by("_version", F.when(F.col("_is_row") == 0, F.col("_at"))).alias("_end"))
    carried = ends.select(*keys, "_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    running = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = placed.withColumn("_running", F.last("_version", ignorenulls=True).over(running))
    found = within.join(carried, [*keys, "_block"]).filter("_is_row = 1")
    last = F.coalesce("_running", "_carried")
    valid = last[valid_to].isNull() | (F.col("_at") < last[valid_to])
    joined = found.withColumn("_version", F.when(valid, last)).select(
        *[F.col("_row")[c].alias(c) for c in rows.columns], *[F.col("_version")[c].alias(c) for c in added]
    )
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in kind.fields]
    return joined.union(rows.filter(~whole).select("*", *nulls))
