from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.session import engine_session  # noqa: E402
from millrace.sources.topics import Topics  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = SparkSession.builder.master("local[8]") \
        .config("spark.sql.shuffle.partitions", "4") \
        .config("spark.ui.enabled", "false") \
        .config("spark.sql.session.timeZone", "UTC") \
        .getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return engine_session(session)


@pytest.fixture
def topics(tmp_path) -> Topics:
    return Topics(folder=str(tmp_path / "topics"))


def messages(spark: SparkSession, values: list) -> DataFrame:
    """Messages with a null key; dicts are written as JSON."""
    texts = [json.dumps(value) if isinstance(value, dict) else value for value in values]
    return spark.createDataFrame([(text,) for text in texts], "value string") \
        .select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def publish(spark: SparkSession, topics: Topics, name: str, *parts: list) -> None:
    """Every part becomes one file, in this order."""
    for part in parts:
        topics.publish(messages(spark, part).coalesce(1), name)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
