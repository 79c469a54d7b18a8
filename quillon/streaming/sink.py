"""Running a stream to its current end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def run_available(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "append",
) -> StreamingQuery:
    """Process what is there now in micro-batches, then stop; the checkpoint remembers it."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    query.awaitTermination()
    return query
