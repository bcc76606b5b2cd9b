"""Starting streams and waiting for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.streaming.changelog import batch_writer, snapshot_writer

OUTPUT_MODES = ("append", "update", "complete")


def start(writer: DataStreamWriter, checkpoint: str, mode: str = "append", name: str | None = None,
          interval: str | None = None, until_caught_up: bool = False) -> StreamingQuery:
    """Start a query.

    ``interval`` such as "1 minute" fixes the time between micro-batches; without it the
    next one starts at once. ``until_caught_up`` ends the query when the input present at
    the start is done. Each query needs a ``checkpoint`` of its own.
    """
    if mode not in OUTPUT_MODES:
        raise ValueError(f"output mode {mode!r} is none of {OUTPUT_MODES}")
    if interval and until_caught_up:
        raise ValueError("a query that stops when caught up has no interval")
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def drain(writer: DataStreamWriter, checkpoint: str, mode: str = "append",
          name: str | None = None) -> StreamingQuery:
    """Run a query over all input present now; raises if it fails."""
    query = start(writer, checkpoint, mode, name, until_caught_up=True)
    query.awaitTermination()
    return query


def json_sink(rows: DataFrame, path: str, compression: str = "none") -> DataStreamWriter:
    """JSON lines in a directory, each row once; ``compression`` such as gzip takes a tenth of the space."""
    return rows.writeStream.format("json").option("path", path).option("compression", compression)


def parquet_sink(rows: DataFrame, path: str) -> DataStreamWriter:
    return rows.writeStream.format("parquet").option("path", path)


def changelog_sink(rows: DataFrame, path: str) -> DataStreamWriter:
    """One folder per micro-batch, for the update and complete modes."""
    return rows.writeStream.foreachBatch(batch_writer(path))


def snapshot_sink(rows: DataFrame, path: str) -> DataStreamWriter:
    """The newest results of the complete mode, a folder each."""
    return rows.writeStream.foreachBatch(snapshot_writer(path))


def console_sink(rows: DataFrame, show: int = 20, truncate: bool = True) -> DataStreamWriter:
    """The first ``show`` rows of each micro-batch on the driver's output.

    Spark's own console format brings every row of a batch to the driver, however few it shows; this one brings no
    more than are shown, and one, from each task.
    """
    return rows.writeStream.foreachBatch(console_writer(show, truncate))


def console_writer(show: int, truncate: bool = True) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback that prints the first rows, from one pass over the whole batch.

    A plain ``show`` would end tasks early, before the state and the observed metrics are whole.
    """
    line = "-" * 43

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"{line}\nBatch: {batch_id}\n{line}", flush=True)
        # By partition and place in it, which is the order a plain ``show`` has; tasks keep their first rows.
        placed = batch.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"))
        placed.orderBy("place").select("row.*").show(show, truncate)

    return write
