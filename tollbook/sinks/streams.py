"""Stream sinks. A query's number of state partitions is fixed when it first starts."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

PARTITIONS = "spark.sql.shuffle.partitions"
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Starting takes the session's settings along; one start at a time changes them.
_STARTING = threading.Lock()


def start(
    rows: DataFrame,
    writer: DataStreamWriter,
    checkpoint: str,
    once: bool = False,
    state_partitions: int | None = None,
    idle_batches: bool = True,
    path: str | None = None,
) -> StreamingQuery:
    """Start a query with its own checkpoint; ``once`` stops when caught up.

    Without ``state_partitions`` the session's shuffle partitions apply. Without
    ``idle_batches`` old state is removed by the next batch with rows instead of by one
    of its own; deduplication writes the same. The query takes the session settings
    with it, so they can be put back at once.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    conf = rows.sparkSession.conf
    wanted = {IDLE_BATCHES: str(idle_batches).lower()}
    if state_partitions:
        wanted[PARTITIONS] = str(state_partitions)
    with _STARTING:
        before = {key: conf.get(key) for key in wanted}
        try:
            for key, value in wanted.items():
                conf.set(key, value)
            return writer.start(path) if path else writer.start()
        finally:
            for key, value in before.items():
                conf.set(key, value)


def start_text_sink(values: DataFrame, path: str, checkpoint: str, **run) -> StreamingQuery:
    """Append a ``value`` column to text files."""
    writer = values.writeStream.format("text").outputMode("append")
    return start(values, writer, checkpoint, path=path, **run)


def start_topic_sink(
    values: DataFrame, servers: str, topic: str, checkpoint: str, **run
) -> StreamingQuery:
    """Append a ``value`` column to a topic; needs the Kafka connector."""
    writer = (
        values.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .outputMode("append")
    )
    return start(values, writer, checkpoint, **run)


def start_batch_sink(
    rows: DataFrame,
    load: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    **run,
) -> StreamingQuery:
    """Hand every micro-batch to ``load(batch, batch_id)``."""
    writer = rows.writeStream.foreachBatch(load).outputMode(output_mode)
    return start(rows, writer, checkpoint, **run)
