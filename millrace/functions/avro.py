"""Avro record values, through Spark's own ``spark-avro`` package, which must be loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro, to_avro


def load_schema(path: str) -> str:
    """Avro schema text from a file on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_avro(rows: DataFrame, schema: str, key: str, names: list[str]) -> DataFrame:
    """(key, value) messages: the ``key`` column, and the row as an Avro record.

    The record is positional, so ``names`` are the columns in the order of the schema.
    """
    return rows.select(F.col(key).cast("binary").alias("key"), to_avro(F.struct(*names), schema).alias("value"))


def decode_avro(messages: DataFrame, schema: str) -> DataFrame:
    """Struct column ``value`` from Avro messages. A broken record fails the query."""
    return messages.select(from_avro(F.col("value"), schema).alias("value"))
