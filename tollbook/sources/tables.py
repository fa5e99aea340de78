"""Batch tables: rated events from files or from a database."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.operators.rating import rated_only
from tollbook.schemas import RATED_TABLE_ON_DISK
from tollbook.sources import live


def rated_events(
    spark: SparkSession,
    path: str,
    periods: Iterable[tuple[int, int]] | None = None,
    only_rated: bool = False,
) -> DataFrame:
    """The rated-events table. With ``periods`` only their folders are listed, so
    that the batches ever written to other periods cost nothing. Where batches were
    compacted, the committed lists say which files count."""
    reader = spark.read.schema(RATED_TABLE_ON_DISK)
    folders = live.Folders(spark, path)
    if live.has_lists(folders):
        table = _listed(spark, folders, live.wanted_periods(folders, periods))
    elif periods is None:
        table = reader.parquet(path)
    else:
        wanted = sorted(set(periods))
        found = [f for f in (period_folder(path, *p) for p in wanted) if _exists(spark, f)]
        if found:
            table = reader.option("basePath", path).parquet(*found)
        else:
            table = spark.createDataFrame([], RATED_TABLE_ON_DISK)
    return rated_only(table) if only_rated else table


def _listed(spark: SparkSession, folders: live.Folders, periods: list[tuple[int, int]]) -> DataFrame:
    """Live batch folders and compacted files of some periods."""
    plain, compacted, hidden = [], [], []
    for period in periods:
        held = live.current_list(folders, period)
        plain += live.live_folders(folders, period, held).values()
        if held.generation:
            compacted.append(live.compacted_folder(period, held.generation))
            hidden += [(*period, *batch) for batch in sorted(held.hidden)]
    parts = [batch_rows(spark, folders.root, plain)]
    if compacted:
        base = f"{folders.root}/_compacted"
        files = spark.read.schema(RATED_TABLE_ON_DISK).option("basePath", base)
        rows = files.parquet(*[f"{folders.root}/{place}" for place in compacted])
        for year, month, writer, batch_id in hidden:
            same = F.col("billing_year").eqNullSafe(F.lit(year)) & F.col("billing_month").eqNullSafe(F.lit(month))
            rows = rows.filter(~(same & (F.col("writer") == writer) & (F.col("batch_id") == batch_id)))
        parts.append(rows.select(*parts[0].columns))
    return reduce(DataFrame.unionByName, parts)


def batch_rows(spark: SparkSession, path: str, places: Iterable[str]) -> DataFrame:
    """The rows of batch folders, named by their places below the table, and no others."""
    found = [f"{path.rstrip('/')}/{place}" for place in places]
    if not found:
        return spark.createDataFrame([], RATED_TABLE_ON_DISK)
    return spark.read.schema(RATED_TABLE_ON_DISK).option("basePath", path).parquet(*found)


def period_folder(path: str, year: int, month: int) -> str:
    return f"{path.rstrip('/')}/billing_year={year}/billing_month={month}"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    split_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a table read, split into ranges of ``split_column``.

    The bounds only place the cuts: rows outside them are read as well.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if split_column:
        if lower is None or upper is None:
            raise ValueError("a split read needs both bounds")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def balanced_predicates(
    keys: DataFrame, column: str, parts: int, spread: str | None = None, accuracy: int = 10_000
) -> list[str]:
    """SQL conditions that cut a table into parts of about as many rows each, from the
    quantiles of a numeric, date or timestamp column, read once. Each row meets exactly
    one; a part is off by two parts in ``accuracy`` of all rows at most.

    A value, or NULL, that fills more than a part is taken out, and divided by the
    remainders of ``spread``, an integer column, where one is given.
    """
    shares = [k / parts for k in range(1, parts)]
    found = keys.agg(
        F.percentile_approx(column, shares, accuracy).alias("cuts") if shares else F.lit(None).alias("cuts"),
        F.count("*").alias("rows"),
        F.count_if(F.col(column).isNull()).alias("nulls"),
    ).first()
    times = Counter(found["cuts"] or [])
    empty_parts = round(parts * found["nulls"] / found["rows"]) if found["rows"] else 0
    out: list[str] = []
    lower = None
    for value in sorted(times):
        shown = _literal(value)
        if times[value] > 1:
            out.append(" AND ".join([*([lower] if lower else []), f"{column} < {shown}"]))
            out += _divided(f"{column} = {shown}", times[value], spread)
            lower = f"{column} > {shown}"
        else:
            out.append(" AND ".join([*([lower] if lower else []), f"{column} < {shown}"]))
            lower = f"{column} >= {shown}"
    out.append(lower or f"{column} IS NOT NULL")
    missing = f"{column} IS NULL"
    return [*out, *_divided(missing, max(1, empty_parts), spread)]


def _divided(condition: str, parts: int, spread: str | None) -> list[str]:
    if not spread or parts < 2:
        return [condition]
    rest = f"MOD(ABS({spread}), {parts})"
    return [f"{condition} AND ({rest} = {k}{f' OR {spread} IS NULL' if k == 0 else ''})" for k in range(parts)]


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    return repr(value) if isinstance(value, float) else str(value)


def jdbc_reader(spark: SparkSession, options: dict[str, str], predicates: list[str] | None = None) -> DataFrame:
    """A table of a database, a task for each predicate."""
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)


def balanced_jdbc_events(
    spark: SparkSession,
    options: dict[str, str],
    column: str,
    parts: int,
    spread: str | None = None,
    read: Callable[..., DataFrame] = jdbc_reader,
) -> DataFrame:
    """The rated-events table of a database in parts of about as many rows, however its
    column is distributed: a first pass reads the column alone."""
    wanted = ", ".join([column, *([spread] if spread else [])])
    keys = read(spark, {**options, "dbtable": f"(SELECT {wanted} FROM {options['dbtable']}) keys"})
    return read(spark, options, balanced_predicates(keys, column, parts, spread))


def jdbc_rated_events(
    spark: SparkSession, options: dict[str, str], only_rated: bool = False
) -> DataFrame:
    """The rated-events table of a database; the status filter is pushed to it."""
    table = spark.read.format("jdbc").options(**options).load()
    return rated_only(table) if only_rated else table
