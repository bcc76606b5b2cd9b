"""Where a stopped query was in its topics, read from its checkpoint and kept for the query that goes on."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.streaming.changelog import batch_numbers
from millrace.streaming.manifests import committed, exists, names

# Of a file source's log: the lines behind the version, JSON objects.
READ_FILE = "path string, batchId bigint"


@dataclass(frozen=True)
class Positions:
    """Positions at ``path``: the files that were read, as a table, and the offsets of Kafka topics."""

    path: str

    def unread(self, spark: SparkSession, files: DataFrame) -> DataFrame:
        """The rows of ``files`` whose file the stopped query had not read.

        Files that it had read are opened once more, by the first micro-batch. The list is joined by
        a broadcast if it is small, which Spark judges by its size.
        """
        read = spark.read.schema("path string").parquet(f"{self.path}/files")
        here = files.select("*", one_form(F.col("_metadata.file_path")).alias("path"), "_metadata")
        return here.join(read, "path", "left_anti").drop("path")

    def offsets(self, spark: SparkSession, topic: str) -> str | None:
        """Starting offsets of a topic in the form the Kafka connector takes; null if the query had none there."""
        kept = committed(spark, f"{self.path}/offsets.json") or {}
        return json.dumps({topic: kept[topic]}) if topic in kept else None


def one_form(path: Column) -> Column:
    """A path with an empty authority written without it, as Spark writes it now so and now otherwise."""
    return F.regexp_replace(path, "^([^:/]+):///", "$1:/")


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last micro-batch that was finished, which is the version of the state; -1 if none was."""
    return max(batch_numbers(spark, f"{checkpoint}/commits", ""), default=-1)


def source_ends(spark: SparkSession, checkpoint: str) -> list[dict | None]:
    """Where each source of the query ended with its last finished batch, as its offset log has it."""
    last = last_commit(spark, checkpoint)
    if last < 0:
        return []
    text = spark.read.text(f"{checkpoint}/offsets/{last}", wholetext=True).first()[0]
    return [json.loads(line) if line.startswith("{") else None for line in text.split("\n")[2:]]


def read_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path): every file that finished batches of the query had read, whichever source it is of."""
    found = spark.createDataFrame([], "path string")
    for number, end in enumerate(source_ends(spark, checkpoint)):
        log = f"{checkpoint}/sources/{number}"
        if end and "logOffset" in end and exists(spark, log):
            lines = spark.read.text([f"{log}/{name}" for name in names(spark, log)])
            entries = lines.select(F.from_json("value", READ_FILE).alias("entry")).where("entry.path is not null")
            found = found.unionAll(entries.where(F.col("entry.batchId") <= end["logOffset"]).select("entry.path"))
    # The log repeats entries when it is compacted.
    return found.select(one_form(F.col("path")).alias("path")).distinct()


def kafka_offsets(spark: SparkSession, checkpoint: str) -> dict[str, dict]:
    """{topic: {partition: next offset}} of the query's Kafka sources."""
    return {topic: ends for end in source_ends(spark, checkpoint) if end and "logOffset" not in end
            for topic, ends in end.items() if isinstance(ends, dict)}
