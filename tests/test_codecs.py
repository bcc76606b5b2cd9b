"""JSON values: malformed text, wrong types, nulls (permissive parsing)."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import messages
from millrace.functions.codecs import decode_json, encode_json
from millrace.functions.money import loyalty_points
from millrace.functions.times import format_time, parse_time
from millrace.schemas import AVRO_HEADER, FILE_HEADER, INVOICE, TOPIC_HEADER, TRADE, flat_schema


def decoded(spark, *values):
    return [tuple(row) for row in decode_json(messages(spark, list(values)), TRADE).collect()]


def test_fields_are_decoded_in_schema_order(spark):
    trade = {"Type": "SELL", "CreatedTime": "2019-11-30 23:59:01", "Amount": 42, "BrokerCode": "QQ7"}
    assert decoded(spark, trade) == [("2019-11-30 23:59:01", "SELL", 42, "QQ7")]


@pytest.mark.parametrize("value", ["not json", "", None, "[]", "{"])
def test_malformed_values_become_null_rows(spark, value):
    assert decoded(spark, value) == [(None, None, None, None)]


def test_bad_field_alone_is_null(spark):
    assert decoded(spark, {"Type": "BUY", "Amount": "many"}) == [(None, "BUY", None, None)]


def test_number_for_text_and_extra_field(spark):
    assert decoded(spark, {"Type": 7, "Amount": 1, "More": [1]}) == [(None, "7", 1, None)]


ODD = [None, "x", 7, 1.5, True, [], {}, [1], {"a": 1}, "12", "1e400", 2**40]


def damaged(value, draw):
    """A copy with odd values, missing and extra fields here and there."""
    if isinstance(value, dict):
        kept = {key: draw.choice(ODD) if draw.random() < 0.08 else damaged(inner, draw)
                for key, inner in value.items() if draw.random() > 0.05}
        return {**kept, "Extra": draw.choice(ODD)} if draw.random() < 0.05 else kept
    if isinstance(value, list):
        return [draw.choice(ODD) if draw.random() < 0.08 else damaged(inner, draw) for inner in value]
    return value


def test_damaged_messages_are_read_as_by_a_plain_parse(spark):
    draw = random.Random(11)
    item = {"ItemCode": "i", "ItemDescription": "d", "ItemPrice": 5.0, "ItemQty": 2, "TotalValue": 10.0}
    whole = {**{field.name: 1 if field.dataType.simpleString() != "string" else "s" for field in INVOICE},
             "DeliveryAddress": {"AddressLine": "a", "City": "c", "State": "s", "PinCode": "1", "ContactNumber": "2"},
             "InvoiceLineItems": [item, item, item]}
    values = []
    for _ in range(2000):
        text = json.dumps(damaged(whole, draw))
        values.append(text[:draw.randrange(len(text))] if draw.random() < 0.5 else text)
    df = messages(spark, values)
    plain = df.select(F.from_json(F.col("value").cast("string"), INVOICE).alias("value")).select("value.*")
    assert decode_json(df, INVOICE).collect() == plain.collect()
    some = ["InvoiceNumber", "CustomerCardNo", "TotalAmount"]
    assert decode_json(df, INVOICE).select(some).collect() == plain.select(some).collect()


def test_message_cut_before_a_nested_value_keeps_its_header(spark):
    value = '{"InvoiceNumber": "n", "TotalAmount": 2.5, "InvoiceLineItems": [{"ItemCode": "i", "ItemQty":'
    row = decode_json(messages(spark, [value]), INVOICE).first()
    assert (row.InvoiceNumber, row.TotalAmount, row.CustomerCardNo) == ("n", 2.5, None)


def test_message_is_parsed_once_whatever_filters_follow(spark):
    trades = decode_json(messages(spark, ["{}"]), TRADE).filter("Type == 'BUY'") \
        .withColumn("CreatedTime", parse_time("CreatedTime")) \
        .groupBy(F.window("CreatedTime", "15 minutes")).count()
    plan = trades._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_json_leaves_nulls_out(spark):
    found = spark.range(1).select(encode_json(F.lit(None).cast("int").alias("a"), F.lit(2).alias("b")))
    assert found.first()[0] == '{"b":2}'


@pytest.mark.parametrize("amount,points", [
    (9.99, 1), (-9.99, -1), (0.0, 0), (4.99, 0), (5.0, 1), (None, None), (2e10, 2147483647), (-2e10, -2147483648),
    (10737418235.0, 2147483647), (float("nan"), 0), (float("inf"), 2147483647), (float("-inf"), -2147483648)])
def test_points_are_cut_toward_zero_and_held_within_an_int(spark, amount, points):
    df = spark.createDataFrame([(amount,)], "amount double").select(loyalty_points("amount"))
    assert df.first()[0] == points
    assert df.schema[0].dataType == T.IntegerType()


@pytest.mark.parametrize("text,back", [
    ("2024-02-05 10:05:00", "2024-02-05 10:05:00"), ("yesterday", None), ("2024-02-05", None),
    ("2024-13-05 10:05:00", None), (None, None)])
def test_unreadable_times_are_null(spark, text, back):
    df = spark.createDataFrame([(text,)], "t string").select(format_time(parse_time("t")))
    assert df.first()[0] == back


def test_flat_schemas():
    assert flat_schema(FILE_HEADER).names == [
        "InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType", "PaymentMethod",
        "DeliveryType", "City", "State", "PinCode", "ItemCode", "ItemDescription", "ItemPrice",
        "ItemQty", "TotalValue"]
    assert "StoreID" not in flat_schema(TOPIC_HEADER).names
    assert "PaymentMethod" not in flat_schema(AVRO_HEADER).names
    assert "CustomerCardNo" in flat_schema(AVRO_HEADER).names
