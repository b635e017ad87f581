"""Streaming sink: every micro-batch is appended in one commit, once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tablelog.operators.write import append_once
from tablelog.sources.table import Table


def writer(df: DataFrame, path: str, app_id: str, checkpoint: str, partition_by: Iterable[str] | None = None, merge_schema: bool = False) -> DataStreamWriter:
    """A stream writer into a table; append mode only.

    A batch's files and its marker (app_id, batch id) are in one commit, so a batch that is run again after a failure finds its
    marker and writes nothing. app_id must stay the same across restarts.
    """
    parts = list(partition_by) if partition_by is not None else None

    def put(batch: DataFrame, batch_id: int) -> None:
        table = Table.for_path(batch.sparkSession, path)
        append_once(table, batch, app_id, batch_id, partition_by=parts, merge_schema=merge_schema)

    return df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(put)


def write_stream(df: DataFrame, path: str, app_id: str, checkpoint: str, available_now: bool = True, poll_ms: int | None = None, **more) -> StreamingQuery:
    """Start writing. available_now: what is there, then the query ends; else on, looking for more every poll_ms."""
    w = writer(df, path, app_id, checkpoint, **more)
    if available_now:
        return w.trigger(availableNow=True).start()
    return (w.trigger(processingTime=f"{poll_ms} milliseconds") if poll_ms is not None else w).start()


def drain(df: DataFrame, path: str, app_id: str, checkpoint: str, **more) -> int:
    """Write all that is there, run after run until one finds nothing; returns the number of runs that wrote. For sources that
    take one bounded batch a run."""
    runs = 0
    while True:
        q = write_stream(df, path, app_id, checkpoint, **more)
        q.awaitTermination()
        if not any(p["numInputRows"] for p in q.recentProgress):
            return runs
        runs += 1
