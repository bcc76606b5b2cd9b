from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

# Names that operators use inside; a table may well have them too.
CLASHING = ("id", "key", "mark", "first", "count", "kept", "score", "fp", "row", "sha", "run", "k0", "ids", "held_out",
            "lang_pred", "piece", "length", "stretches", "union", "n", "cut")


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) rows with further columns whose names clash, over several partitions."""

    def make(rows: list[tuple], parts: int = 3) -> DataFrame:
        plain = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        return plain.withColumns({name: F.lit(name) for name in CLASHING})

    return make


def collected(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
