"""Levelled compaction of a topic folder's finished batches: the last value of each key stays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import STORED_MESSAGE
from millrace.streaming.changelog import batch_numbers, drop_folder
from millrace.streaming.manifests import exists

# Sub-folder of a writer; Spark's readers pass over such names.
LEVELS = "_levels"
SPAN = "span="
UPTO = "upto="


@dataclass(frozen=True)
class Levels:
    """The batches of one writer, merged ``fanout`` at a time, and such merges again.

    A merge on level k holds the last message per key of fanout**k batches in a row, its span. It is made once
    the batch behind them begins, so all of them are finished; a repeated merge replaces its own
    folder. Batches that a merge holds stay for streams that read them one by one until ``keep`` later
    ones are there. So the folders are at most ``keep`` + fanout batches and fanout - 1 merges a level, and
    a message is rewritten once per level.
    """

    writer: str
    fanout: int = 10
    keep: int = 100

    def _batch(self, number: int) -> str:
        return f"{self.writer}/batch_id={number}"

    def _merge(self, span: int, upto: int) -> str:
        return f"{self.writer}/{LEVELS}/{SPAN}{span}/{UPTO}{upto}"

    def _merges(self, spark: SparkSession) -> dict[int, list[int]]:
        """{batches that a merge holds: the last batch of each such merge}; readers need not know the fan-out."""
        folder = f"{self.writer}/{LEVELS}"
        return {span: batch_numbers(spark, f"{folder}/{SPAN}{span}", UPTO) for span in batch_numbers(spark, folder, SPAN)}

    def segments(self, spark: SparkSession, below: int | None = None) -> Iterator[tuple[int, int]]:
        """(span, last batch) of the folders that hold all batches below a number, each batch in one; span 0 is the batch itself."""
        batches = set(batch_numbers(spark, self.writer))
        merges = {span: {upto for upto in found if exists(spark, f"{self._merge(span, upto)}/_SUCCESS")}
                  for span, found in sorted(self._merges(spark).items(), reverse=True)}
        last = max([*batches, *(upto for found in merges.values() for upto in found)], default=-1)
        at = 0
        while at <= (last if below is None else below - 1):
            for span, found in merges.items():
                upto = at + span - 1
                if upto in found and (below is None or upto < below):
                    yield span, upto
                    at = upto + 1
                    break
            else:
                # Batches without messages may have no folder.
                if at in batches:
                    yield 0, at
                at += 1

    def rows(self, spark: SparkSession, segments: list[tuple[int, int]]) -> DataFrame:
        """Messages of the segments with the number of the batch that wrote them."""
        batches = [self._batch(upto) for span, upto in segments if not span]
        merges = [self._merge(span, upto) for span, upto in segments if span]
        whole = spark.createDataFrame([], MERGED)
        if batches:
            # The number of a batch is its folder's.
            whole = whole.unionByName(spark.read.schema(MERGED).option("basePath", self.writer).parquet(*batches))
        return whole.unionByName(spark.read.schema(MERGED).parquet(*merges)) if merges else whole

    def compact(self, spark: SparkSession, started: int) -> None:
        """Merge what is complete now that batch ``started`` begins, and drop what is merged and old."""
        span = self.fanout
        while started and started % span == 0:
            upto = started - 1
            if not exists(spark, f"{self._merge(span, upto)}/_SUCCESS"):
                inside = [(part, last) for part, last in self.segments(spark, started) if last >= started - span and part < span]
                last_messages(self.rows(spark, inside)).write.mode("overwrite").parquet(self._merge(span, upto))
            span *= self.fanout
        self._drop(spark, started)

    def _drop(self, spark: SparkSession, started: int) -> None:
        used = set(self.segments(spark))
        for number in batch_numbers(spark, self.writer):
            if number < started - self.keep and (0, number) not in used:
                drop_folder(spark, self._batch(number))
        for span, merges in self._merges(spark).items():
            for upto in merges:
                # Those that a wider merge took in with this batch may still be read by someone.
                if (span, upto) not in used and upto < started - span:
                    drop_folder(spark, self._merge(span, upto))


MERGED = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in STORED_MESSAGE.fields)}, batch_id bigint"


def last_messages(messages: DataFrame) -> DataFrame:
    """The newest message of each key: by time, then by batch. Messages without a key are one key."""
    newest = F.max_by(F.struct("value", "timestamp", "batch_id"), F.struct("timestamp", "batch_id"))
    return messages.groupBy("key").agg(newest.alias("newest")) \
        .select("key", "newest.value", "newest.timestamp", "newest.batch_id")
