"""Streams over directories and lines."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.streaming.manifests import commit, committed


def json_directory(spark: SparkSession, path: str, files_per_trigger: int | None = 1,
                   schema: T.StructType | None = None, sampling_ratio: float = 1.0) -> DataFrame:
    """Stream of the JSON lines in a directory.

    Without a ``schema`` it is inferred from the files present at the start and then
    fixed; that reads them all once, or the share given by ``sampling_ratio``.
    """
    reader = spark.readStream.format("json").option("path", path)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if schema is not None:
        return reader.schema(schema).load()
    setting = "spark.sql.streaming.schemaInference"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        return reader.option("samplingRatio", sampling_ratio).load()
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


# Types of variants as those that JSON readers give.
PLAIN_TYPES = ((r"\bOBJECT<", "STRUCT<"), (r"\bDECIMAL\(\d+, ?\d+\)", "DOUBLE"), (r"\bVOID\b", "STRING"),
               (r"\bVARIANT\b", "STRING"), (r"\bFLOAT\b", "DOUBLE"))


def found_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the JSON lines in a directory, from one aggregation over them.

    Numbers with a fraction are doubles; fields that are always null, and those whose types conflict, are text. Lines that
    are no JSON objects count for nothing.
    """
    value = F.try_parse_json("value")
    objects = spark.read.text(path).select(value.alias("value")).where(F.schema_of_variant("value").startswith("OBJECT<"))
    text = objects.agg(F.schema_of_variant_agg("value")).first()[0]
    if text is None or not text.startswith("OBJECT<"):
        raise ValueError(f"no JSON object in {path}")
    # Names are quoted where they could be taken for something else, so types stand outside of quotes.
    parts = re.split("(`(?:[^`]|``)*`)", text)
    for number in range(0, len(parts), 2):
        for pattern, plain in PLAIN_TYPES:
            parts[number] = re.sub(pattern, plain, parts[number])
    return spark.createDataFrame([], f"whole {''.join(parts)}").schema["whole"].dataType


def kept_schema(spark: SparkSession, path: str, checkpoint: str) -> T.StructType:
    """The schema kept with a query's checkpoint; at the first start the one found in the files, which is then kept.

    A restart reads no file for it, and the state and sinks of the query never meet another schema.
    """
    place = f"{checkpoint}/source-schema.json"
    kept = committed(spark, place)
    if kept is None:
        kept = found_schema(spark, path).jsonValue()
        commit(spark, place, kept)
    return T.StructType.fromJson(kept)


DRIFT = "drift"
UNFIT = "_unfit"


def with_drift(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = 1,
               strict: bool = False) -> DataFrame:
    """``json_directory`` that reports lines which do not fit the schema.

    They are read as far as they fit, other fields null, and each micro-batch's progress counts them
    under ``drift`` (rows, unfit); with ``strict`` the first of them fails the query.
    """
    wide = T.StructType([*schema.fields, T.StructField(UNFIT, T.StringType())])
    reader = spark.readStream.format("json").option("path", path).schema(wide).option("columnNameOfCorruptRecord", UNFIT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.load()
    unfit = F.col(UNFIT).isNotNull()
    if strict:
        error = F.raise_error(F.concat(F.lit("a line does not fit the kept schema: "), UNFIT)).cast("boolean")
        rows = rows.where(F.when(unfit, error).otherwise(True))
    return rows.observe(DRIFT, F.count(F.lit(1)).alias("rows"), F.count_if(unfit).alias("unfit")).drop(UNFIT)


def source_schema(path: str) -> T.StructType:
    """Schema from a file on the driver: a column list as in DDL, or a schema's JSON."""
    with open(path, encoding="utf-8") as file:
        text = file.read().strip()
    return T.StructType.fromJson(json.loads(text)) if text.startswith("{") else T.StructType.fromDDL(text)


def text_directory(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the lines in a directory of text files, column ``value``."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Stream of the lines a socket sends, column ``value``. It cannot replay, so for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
