"""Message values to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_json(messages: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """Parse the ``value`` bytes into one column per field; keep the ``extra`` columns.

    Text that is no JSON gives nulls throughout, a field of the wrong type a null field.

    The parse sits inside a generator because the optimizer moves filters (also inferred
    ones, like a join's "key is not null") below a projection by repeating its
    expressions, and so would parse every message once more per filter.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(*extra, F.inline(F.array(parsed)))


DAMAGED = "damaged"
RAW = "raw"


def decode_or_keep(messages: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """``decode_json`` with the columns damaged and raw: the text of messages that do not fit the schema, in one parse.

    Damaged are messages that are null, empty or no JSON object, and those with a field of the wrong type; their
    fields are null and ``raw`` is their text. Whole messages have no raw text. An object that lacks fields is whole.
    """
    text = F.col("value").cast("string")
    with_text = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    parsed = F.from_json(text, with_text, {"columnNameOfCorruptRecord": RAW})
    nothing = F.coalesce(F.trim(text) == "", F.lit(True))
    rows = messages.select(*extra, nothing.alias("_nothing"), text.alias("_text"), F.inline(F.array(parsed)))
    damaged = F.col("_nothing") | F.col(RAW).isNotNull()
    fields = [F.when(~F.col(DAMAGED), F.col(name)).alias(name) for name in schema.fieldNames()]
    return rows.withColumn(DAMAGED, damaged) \
        .select(*extra, *fields, DAMAGED, F.when(F.col(DAMAGED), F.col("_text")).alias(RAW))


def encode_json(*columns: Column | str) -> Column:
    """The columns as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*columns))


def message(key: Column, value: Column) -> list[Column]:
    """Select list of a topic message."""
    return [key.cast("binary").alias("key"), value.cast("binary").alias("value")]
