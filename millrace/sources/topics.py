"""Message topics: a Kafka broker, or a Parquet folder per topic with the same columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.schemas import STORED_MESSAGE, TOPIC
from millrace.sources.levels import MERGED, Levels, last_messages
from millrace.streaming.changelog import drop_folder
from millrace.streaming.manifests import commit, committed, move, names
from millrace.streaming.positions import Positions

# Local property in which Spark hands a query's id to its micro-batches; restarts keep the id.
QUERY_ID = "sql.streaming.queryId"


@dataclass(frozen=True)
class Topics:
    """Where topics live. Dataflows see the same columns for both kinds.

    A topic's folder has a sub-folder per writer and in it one per batch, so writers never
    meet. A stream writes as its query's id, so that a stream on a new checkpoint is a new writer.

    A micro-batch is written out of sight first. A manifest of its files, put in place by one
    rename, then decides it, and the files are moved to where readers look. A batch that is repeated
    after a crash starts over if it was not decided, and else only finishes the moves: a reader
    meets each file, and so each message, once. It may meet some files of a batch before the others.
    """

    folder: str | None = None
    brokers: str | None = None
    # Further options of the Kafka connector, such as kafka.security.protocol or minPartitions.
    options: Mapping[str, str] = field(default_factory=dict)
    # For changelogs in a folder: batches that stay for streams; older ones are merged, with the last value of each key.
    keep_batches: int | None = None

    def __post_init__(self) -> None:
        if (self.folder is None) == (self.brokers is None):
            raise ValueError("give either a folder or brokers")

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def stream(self, spark: SparkSession, name: str, starting: str = "earliest",
               files_per_trigger: int | None = None, positions: bool = False,
               after: Positions | None = None) -> DataFrame:
        """Unbounded read. ``starting`` counts only while the query has no checkpoint.

        ``after`` are the positions of a stopped query: the stream goes on behind them.

        A folder fills ``partition`` and ``offset`` only if ``positions`` are asked for, as
        they cost a file name per row.
        """
        if self.brokers:
            offsets = after.offsets(spark, name) if after else None
            return spark.readStream.format("kafka").options(**self.options) \
                .option("kafka.bootstrap.servers", self.brokers) \
                .option("subscribe", name) \
                .option("startingOffsets", offsets or starting) \
                .load()
        if starting != "earliest":
            raise ValueError("a topic folder is read from its first file")
        reader = spark.readStream.schema(STORED_MESSAGE).option("recursiveFileLookup", "true")
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        files = reader.parquet(self.path(name))
        return _as_topic(after.unread(spark, files) if after else files, name, positions)

    def table(self, spark: SparkSession, name: str, positions: bool = False) -> DataFrame:
        """Everything in the topic now, as a bounded table."""
        if self.brokers:
            return spark.read.format("kafka").options(**self.options) \
                .option("kafka.bootstrap.servers", self.brokers) \
                .option("subscribe", name) \
                .load()
        try:
            files = spark.read.schema(STORED_MESSAGE).option("recursiveFileLookup", "true").parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], TOPIC)
        return _as_topic(files, name, positions)

    def publish(self, messages: DataFrame, name: str, records_per_file: int = 0,
                writer: Column | None = None) -> None:
        """Append (key, value) rows to a topic as one batch write.

        In a folder they may be dealt to named writers, whose parts ``part`` reads.
        """
        if self.brokers:
            messages.select("key", "value").write.format("kafka").options(**self.options) \
                .option("kafka.bootstrap.servers", self.brokers) \
                .option("topic", name) \
                .save()
            return
        if writer is None:
            writer = F.lit(uuid.uuid4().hex)
        _stored(messages, writer.alias("writer"), F.lit(0).alias("batch_id")).write.mode("append") \
            .option("maxRecordsPerFile", records_per_file) \
            .partitionBy("writer", "batch_id").parquet(self.path(name))

    def part(self, spark: SparkSession, name: str, writer: str) -> DataFrame:
        """(key, value) of what one named writer published."""
        return spark.read.schema(STORED_MESSAGE).option("recursiveFileLookup", "true") \
            .parquet(f"{self.path(name)}/writer={writer}").select("key", "value")

    def sink(self, messages: DataFrame, name: str, mode: str = "append") -> DataStreamWriter:
        """Stream of (key, value) rows into a topic, to be started in the given output mode."""
        if self.brokers:
            return messages.select("key", "value").writeStream.format("kafka").options(**self.options) \
                .option("kafka.bootstrap.servers", self.brokers) \
                .option("topic", name)
        keep = self.keep_batches if mode == "update" else None
        return _stored(messages).writeStream.foreachBatch(_topic_writer(self.path(name), keep))

    def latest(self, spark: SparkSession, name: str) -> DataFrame:
        """The last message of each key in a folder, (key, value, timestamp): the newest by time, then by batch."""
        writers = [f"{self.path(name)}/{writer}" for writer in names(spark, self.path(name))]
        parts = [levels.rows(spark, list(levels.segments(spark))) for levels in map(Levels, writers)]
        whole = reduce(DataFrame.unionByName, parts, spark.createDataFrame([], MERGED))
        return last_messages(whole).drop("batch_id")


def _topic_writer(path: str, keep: int | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback that writes as the running query."""

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if not query:
            raise RuntimeError("a micro-batch without a query id")
        write_batch(batch, path, query, batch_id)
        if keep is not None:
            Levels(f"{path}/writer={query}", keep=keep).compact(batch.sparkSession, batch_id)

    return write


def write_batch(batch: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """One batch of a writer: staged, decided by its manifest, then moved to the readers file by file."""
    spark = batch.sparkSession
    place = f"writer={writer}/batch_id={batch_id}"
    staged, manifest = f"{path}/_staged/{place}", f"{path}/_manifests/{place}.json"
    files = committed(spark, manifest)
    if files is None:
        batch.write.mode("overwrite").parquet(staged)
        files = names(spark, staged)
        commit(spark, manifest, files)
    for file in files:
        move(spark, f"{staged}/{file}", f"{path}/{place}/{file}")
    drop_folder(spark, staged)
    # A query repeats its last batch at most, so the manifest before is not asked for again.
    drop_folder(spark, f"{path}/_manifests/writer={writer}/batch_id={batch_id - 1}.json")


def _stored(messages: DataFrame, *extra: Column) -> DataFrame:
    return messages.select(*extra, F.col("key").cast("binary").alias("key"),
                           F.col("value").cast("binary").alias("value"),
                           F.current_timestamp().alias("timestamp"))


def _as_topic(files: DataFrame, name: str, positions: bool) -> DataFrame:
    """With positions, every file is a partition and the row's place in it the offset."""
    partition = F.hash("_metadata.file_path") if positions else F.lit(None).cast("int")
    offset = F.col("_metadata.row_index") if positions else F.lit(None).cast("bigint")
    return files.select("key", "value", F.lit(name).alias("topic"), partition.alias("partition"),
                        offset.alias("offset"), "timestamp", F.lit(0).alias("timestampType"))
