"""Clean stream to the rated-events table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tollbook.operators import dedup, mediation, rating
from tollbook.sinks.streams import start_batch_sink
from tollbook.sinks.tables import rated_batch_writer
from tollbook.tariff import DEFAULT_TARIFF, Tariff

DELAY = "10 minutes"
SALTS = 16
Load = Callable[[DataFrame, int], None]


def rated_stream(
    values: DataFrame,
    tariff: Tariff = DEFAULT_TARIFF,
    key: Sequence[str] = dedup.USAGE_KEY,
    delay: str = DELAY,
    salts: int = SALTS,
) -> DataFrame:
    """Priced events, each once. The clean stream is read back from storage:
    one query cannot carry a second watermark."""
    usage = rating.to_usage(mediation.parse_clean(values))
    return rating.price(
        dedup.deduplicate_stream(usage, key, "event_time", delay, salts), tariff
    )


def start_rating(
    values: DataFrame,
    table: str | Load,
    checkpoint: str,
    writer: str = "rating",
    tariff: Tariff = DEFAULT_TARIFF,
    delay: str = DELAY,
    salts: int = SALTS,
    output_mode: str = "append",
    report_path: str | None = None,
    **run,
) -> StreamingQuery:
    """Load the stream into a table: a folder, or a function of batch and batch
    number, such as ``jdbc_batch_writer`` makes. Both output modes give the same
    rows; ``update`` needs ``salts=0``."""
    load = rated_batch_writer(table, writer, report_path) if isinstance(table, str) else table
    return start_batch_sink(
        rated_stream(values, tariff, delay=delay, salts=salts),
        load,
        checkpoint,
        output_mode,
        **run,
    )
