"""Append new Bronze files to a Silver table with Structured Streaming.

Keys, dates, flags and word overlap are stateless projections, so the same
build function serves a batch frame and a stream. The checkpoint remembers
which files were taken; a rerun reads only newer ones and writes each once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from assayline.operators.sessions import GAP, sessions
from assayline.sources.tables import Medallion, lower_names


def stream_bronze(layers: Medallion, table: str, max_files: int | None = None) -> DataFrame:
    """A Bronze table as a stream of its files, schema taken from the files."""
    path = layers.path("bronze", table)
    reader = layers.spark.readStream.schema(layers.spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return lower_names(reader.parquet(path))


def append_silver(
    layers: Medallion,
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
) -> StreamingQuery:
    """Build Silver rows from everything new and append them, then stop."""
    return (
        build(stream)
        .writeStream.format("parquet")
        .option("path", layers.path("silver", table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_sessions(
    layers: Medallion,
    events: DataFrame,
    user: str,
    time: str,
    table: str,
    checkpoint: str,
    gap: str = GAP,
    watermark: str = "1 hour",
) -> StreamingQuery:
    """Append the sessions of a stream of events that are over, then stop.

    A session is over when the watermark, the latest event time seen less ``watermark``,
    has passed its last event by the gap; until then it is state in the checkpoint. Events
    that come later than that are not counted, so sessions are those of a batch over all
    events in time.
    """
    return append_silver(layers, events, lambda df: sessions(df, user, time, gap, watermark), table, checkpoint)
