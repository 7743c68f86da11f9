"""A stored SCD Type 2 history that follows a folder of snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.history import HistoryTable


def batch_writer(history: HistoryTable, effective_col: str, stream: str, deletes: str = "keep") -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: applies the snapshots of a batch in the order of their effective times.

    Each version carries a tag of stream, batch id and effective time in the same commit, so a batch that is run again
    after a failure finds what it has published and adds nothing. An empty batch does nothing. Rows without effective
    time are an error.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        times = [r[0] for r in batch.select(F.col(effective_col).cast("string")).distinct().collect()]  # one per snapshot
        if None in times:
            raise ValueError(f"{effective_col} is NULL in batch {batch_id}")
        for at in sorted(times):
            tag = f"{stream}/{batch_id}/{at}"
            if tag in history.tags():
                continue
            rows = batch.where(F.col(effective_col).cast("string") == at).drop(effective_col)
            if history.is_loaded():
                history.apply(rows, at, deletes=deletes, tag=tag)
            else:
                history.load(rows, at, tag=tag)

    return write


def stream_scd2(
    spark: SparkSession, folder: str, schema: T.StructType | str, history: HistoryTable, effective_col: str, checkpoint: str, *,
    deletes: str = "keep", **trigger,
) -> StreamingQuery:
    """Start a stream that applies the Parquet snapshots arriving in ``folder`` to ``history``.

    A snapshot is all rows of one effective time, and its files must appear in the folder together. ``checkpoint``
    identifies the stream: it remembers which files were read. By default all that is there is applied and the query
    ends; give a ``trigger`` (see ``DataStreamWriter.trigger``) for another pace.
    """
    arriving = spark.readStream.schema(schema).parquet(folder)
    writer = arriving.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return writer.foreachBatch(batch_writer(history, effective_col, checkpoint, deletes)).start()
