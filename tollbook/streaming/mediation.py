"""Raw stream to clean stream and dead-letter stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tollbook.operators import dedup, mediation
from tollbook.schemas import CLEAN_CDR
from tollbook.sinks.streams import start_text_sink, start_topic_sink

DELAY = "5 minutes"
SALTS = 16


def clean_stream(
    values: DataFrame,
    key: Sequence[str] = dedup.SUBSCRIBER_KEY,
    delay: str = DELAY,
    salts: int = SALTS,
) -> DataFrame:
    """Accepted records, each once, as JSON text."""
    records = mediation.clean_records(mediation.mediate(values))
    return mediation.to_values(
        dedup.deduplicate_stream(records, key, "timestamp", delay, salts)
    )


def dead_letter_stream(values: DataFrame, with_raw: bool = True) -> DataFrame:
    """Rejected records as JSON text, by default with their original text and
    the rules they failed; without them, only the fields that could be read."""
    lost = mediation.rejected(mediation.mediate(values))
    if with_raw:
        return mediation.to_values(mediation.with_reasons(lost))
    return mediation.to_values(lost.drop("raw"))


Sink = Callable[..., StreamingQuery]


def start_mediation(
    values: DataFrame,
    clean: str | Sink,
    dead_letter: str | Sink,
    checkpoint: str,
    key: Sequence[str] = dedup.SUBSCRIBER_KEY,
    delay: str = DELAY,
    salts: int = SALTS,
    **run,
) -> list[StreamingQuery]:
    """Both outputs, each as a query with a checkpoint of its own.

    An output is a folder for text files, or a sink: a function that is given the
    values and ``checkpoint``, such as ``topic_sink`` makes.
    """
    outputs = {
        "clean": (clean_stream(values, key, delay, salts), clean),
        "dead-letter": (dead_letter_stream(values), dead_letter),
    }
    return [
        (text_sink(sink) if isinstance(sink, str) else sink)(
            rows, checkpoint=f"{checkpoint}/{name}", **run
        )
        for name, (rows, sink) in outputs.items()
    ]


def text_sink(path: str) -> Sink:
    return partial(start_text_sink, path=path)


def topic_sink(servers: str, topic: str) -> Sink:
    return partial(start_topic_sink, servers=servers, topic=topic)


def dead_letters(lines: DataFrame) -> DataFrame:
    """What a dead-letter sink wrote, as columns for inspection."""
    letter = f"raw string, {CLEAN_CDR}, reject_reasons array<string>"
    return lines.select(F.from_json("value", letter).alias("letter")).select("letter.*")
