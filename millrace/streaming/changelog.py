"""Result tables built from the batches a stream emits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback with one folder per batch; a repeated batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def split_writer(path: str, column: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback that deals a batch's rows to folders by a column, in one pass over them; a repeated
    batch replaces all of its folders."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(column).parquet(f"{path}/batch_id={batch_id}")

    return write


def snapshot_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback for whole results: folders that two later batches have replaced go.

    The batch before the newest stays for readers that have begun with it.
    """
    write = batch_writer(path)

    def write_and_drop(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        for number in batch_numbers(batch.sparkSession, path):
            if number < batch_id - 1:
                drop_folder(batch.sparkSession, f"{path}/batch_id={number}")

    return write_and_drop


def batch_numbers(spark: SparkSession, path: str, prefix: str = "batch_id=") -> list[int]:
    """Numbers of the folders in ``path`` that are named ``prefix`` and a number, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def all_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every emitted row with its ``batch_id``; with the rows' ``schema``, none if nothing was emitted yet."""
    reader = spark.read if schema is None else spark.read.schema(reader_schema(schema))
    try:
        return reader.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], reader_schema(schema))


def reader_schema(schema: T.StructType) -> T.StructType:
    """The rows' schema with the number of their batch."""
    return T.StructType([*(f for f in schema.fields if f.name != "batch_id"), T.StructField("batch_id", T.LongType())])


def last_per_key(changes: DataFrame, keys: Sequence[str], order: str = "batch_id") -> DataFrame:
    """Newest row per key, for changes that hold a key at most once per ``order`` value.

    One ``max_by`` per column, not one over a struct: numbers then stay in hash aggregation.
    """
    values = [name for name in changes.columns if name not in keys and name != order]
    return changes.groupBy(*keys).agg(*[F.max_by(name, order).alias(name) for name in values])


def last_batch(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of the newest batch: the whole result of a complete-mode query."""
    numbers = batch_numbers(spark, path)
    batches = all_batches(spark, path, schema)
    return batches.where(F.col("batch_id") == (numbers[-1] if numbers else -1)).drop("batch_id")
