"""What several operators share: the shared folder, stored tables, row keys, joins by hot keys."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The code points that separate words, as in ``[^\x20\x09-\x0D]+`` (fixed values).
SPACES = " \t\n\x0b\x0c\r"


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or where that is unset below
    the warehouse. Off a local master that could be a folder of the driver's own
    machine, so there the cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, and
    still there when the executor that computed them is gone."""
    spark = rows.sparkSession
    path = work_folder(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again. Shuffle files go with the last
    reference to what was shuffled, so that is dropped first."""
    for table in tables:
        for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
            place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def released(spark: SparkSession) -> None:
    """Let the driver notice that finished stages' shuffles are no longer referred to;
    it does so only when it happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def reachable(spark: SparkSession) -> SparkSession:
    """Python workers started from now on find this package where the driver did."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def text_of(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def with_row(docs: DataFrame, key: str, *columns: str | Column) -> DataFrame:
    """``_row`` (a long, unique), the key and the columns.

    Where the key has neither nulls nor repeats it serves as the row's number;
    otherwise rows are numbered and stored, so that every later scan sees the
    same numbers.
    """
    slim = docs.select(F.col(key).cast("long").alias(key), *columns)
    repeated = slim.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull())
    if repeated.limit(1).count() == 0:
        return slim.withColumn("_row", F.col(key))
    return stored(slim.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Left join of ``rows`` to ``table``, which has each key once and in ``weight``
    the number of rows that carry it.

    Keys with a five-hundredth of all rows or more, of which there can be five
    hundred at most, are broadcast; their rows are then spread in the shuffled
    join that serves the others, so that no task gets a hot key's rows.
    """
    values = [c for c in table.columns if c not in (*keys, weight)]
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    floor = max(1000, total // 500)
    heavy = table.filter(F.col(weight) >= floor).select(
        *[F.col(k).alias(f"_h_{k}") for k in keys], F.struct(*values).alias("_heavy")
    )
    light = table.filter(F.col(weight) < floor).select(
        *[F.col(k).alias(f"_l_{k}") for k in keys],
        F.struct(*values).alias("_light"),
        F.lit(0).cast("long").alias("_l_spread"),
    )
    found = rows.join(F.broadcast(heavy), [F.col(k) == F.col(f"_h_{k}") for k in keys], "left")
    spread = F.when(F.col("_heavy").isNull(), F.lit(0).cast("long")).otherwise(
        1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    )
    joined = found.withColumn("_spread", spread).join(
        light,
        [*[F.col(k) == F.col(f"_l_{k}") for k in keys], F.col("_spread") == F.col("_l_spread")],
        "left",
    )
    return joined.select(
        *rows.columns,
        *[F.coalesce(F.col(f"_heavy.{v}"), F.col(f"_light.{v}")).alias(v) for v in values],
    )


def clusters(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of an undirected graph, for
    every node of ``links`` (``a``, ``b``, longs).

    The graph is contracted until no link is left. Each time every node goes to the
    least among itself and its neighbours, and on to where that one goes, first by their
    numbers, which settles stars, then by hashes that are new in every round, which takes
    at least some share of the nodes of any graph, of a chain in order as well. So rounds
    grow with the logarithm of a chain's length. Minima are taken before the shuffle;
    what a contraction no longer needs is deleted, and the result is a stored table.
    """
    edges = stored(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    parents, contraction = None, 0
    while True:
        label = _contracted(edges, contraction)
        moved = label.select(F.col("node").alias("_n"), F.col("low").alias("_low"))
        if parents is None:
            parents, done = label, None
        else:
            done, parents = parents, stored(
                parents.join(moved, F.col("low") == F.col("_n"), "left").select("node", F.coalesce("_low", "low").alias("low")),
                "parents",
            )
        left = label.select(F.col("node").alias("_a"), F.col("low").alias("la"))
        right = label.select(F.col("node").alias("_b"), F.col("low").alias("lb"))
        rest = stored(
            edges.join(left, F.col("a") == F.col("_a"))
            .join(right, F.col("b") == F.col("_b"))
            .filter("la != lb")
            .select(F.greatest("la", "lb").alias("a"), F.least("la", "lb").alias("b"))
            .distinct(),
            "edges",
        )
        discard(edges, *(x for x in (done, label) if x is not None and x is not parents))
        edges, contraction = rest, contraction + 1
        if edges.limit(1).count() == 0:
            discard(edges)
            least = parents.groupBy("low").agg(F.min("node").alias("component"))
            found = stored(parents.join(least, "low").select("node", "component"), "components")
            discard(parents)
            return found


def _contracted(edges: DataFrame, contraction: int) -> DataFrame:
    """``node`` and ``low``, the node that it goes to."""

    def rank(column: str) -> Column:
        by_hash = F.xxhash64(F.lit(contraction), column) if contraction % 2 else F.lit(0).cast("long")
        return F.struct(by_hash.alias("rank"), F.col(column).alias("node"))

    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
    low = F.when(F.col("near") < rank("a"), F.col("near.node")).otherwise(F.col("a"))
    low = stored(near.select(F.col("a").alias("node"), low.alias("low")), "low")
    # From each node's label to the label of that label.
    label = low.alias("x").join(low.alias("y"), F.col("x.low") == F.col("y.node"), "left").select(
        F.col("x.node").alias("node"), F.coalesce(F.col("y.low"), F.col("x.low")).alias("low")
    )
    label = stored(label, "label")
    discard(low)
    return label
