"""Avro needs Spark's own package, which is not here; what can be seen without it."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException

from millrace.functions.avro import decode_avro, encode_avro, load_schema
from millrace.resources import INVOICE_ITEM_SCHEMA
from millrace.schemas import AVRO_HEADER, flat_schema


def test_item_schema_names_the_flattened_columns(tmp_path):
    assert [field["name"] for field in json.loads(INVOICE_ITEM_SCHEMA)["fields"]] == flat_schema(AVRO_HEADER).names
    (tmp_path / "items").write_text(INVOICE_ITEM_SCHEMA)
    assert load_schema(str(tmp_path / "items")) == INVOICE_ITEM_SCHEMA


def test_without_the_package_the_error_names_it(spark):
    rows = spark.createDataFrame([], flat_schema(AVRO_HEADER))
    with pytest.raises(AnalysisException, match="spark-avro"):
        encode_avro(rows, INVOICE_ITEM_SCHEMA, "InvoiceNumber", rows.columns)
    with pytest.raises(AnalysisException, match="spark-avro"):
        decode_avro(spark.createDataFrame([], "value binary"), INVOICE_ITEM_SCHEMA)
