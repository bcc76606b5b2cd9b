"""Flatteners, notifications, rewards."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import messages, publish, rows
from millrace.operators.invoices import (flatten, flatten_messages, notifications, reward_messages,
                                         rewards)
from millrace.plans import apps
from millrace.schemas import (AVRO_HEADER, FILE_HEADER, INVOICE, LONG, TOPIC_HEADER, flat_schema)
from millrace.sources.files import json_directory
from millrace.streaming.changelog import all_batches, last_per_key
from millrace.streaming.runner import changelog_sink, drain


def item(code="i1", value=10.0, **more):
    return {"ItemCode": code, "ItemDescription": "thing", "ItemPrice": 5.0, "ItemQty": 2,
            "TotalValue": value, **more}


def invoice(number="n1", items=(), **more):
    return {"InvoiceNumber": number, "CreatedTime": 1595688900348, "StoreID": "STR1", "PosID": "POS1",
            "CashierID": "OAS1", "CustomerType": "PRIME", "CustomerCardNo": "c1",
            "TotalAmount": 100.0, "NumberOfItems": len(items), "PaymentMethod": "CASH", "CGST": 1.0,
            "SGST": 1.0, "CESS": 0.1, "DeliveryType": "TAKEAWAY",
            "DeliveryAddress": {"AddressLine": "a", "City": "Pune", "State": "MH", "PinCode": "411",
                                "ContactNumber": "1"},
            "InvoiceLineItems": list(items), **more}


def test_flatten_columns_of_each_application(spark):
    df = messages(spark, [invoice(items=[item("x"), item("y", 2.5)])])
    for header in (FILE_HEADER, TOPIC_HEADER, AVRO_HEADER):
        flat = flatten_messages(df, header)
        assert flat.schema == flat_schema(header)
        assert [row.ItemCode for row in flat.collect()] == ["x", "y"]
    row = flatten_messages(df, TOPIC_HEADER).first()
    assert tuple(row) == ("n1", 1595688900348, "POS1", "PRIME", "CASH", "TAKEAWAY", "Pune", "MH",
                          "411", "x", "thing", 5.0, 2, 10.0)


def test_invoices_without_items_and_malformed_ones_vanish(spark):
    values = ["not json", "", None, invoice("b"), {"InvoiceNumber": "c"}, invoice("d", [item()])]
    flat = flatten_messages(messages(spark, values), TOPIC_HEADER)
    assert [row.InvoiceNumber for row in flat.collect()] == ["d"]


def test_missing_parts_are_null(spark):
    value = {"InvoiceNumber": "a", "InvoiceLineItems": [{"ItemCode": "x"}, None]}
    flat = flatten_messages(messages(spark, [value]), TOPIC_HEADER).collect()
    assert [(row.InvoiceNumber, row.City, row.ItemCode, row.ItemQty) for row in flat] == [
        ("a", None, "x", None), ("a", None, None, None)]


def test_notifications_keep_malformed_messages(spark):
    values = ["not json", "", None, invoice("a", TotalAmount=9.99), invoice("b", TotalAmount=-9.99),
              invoice("c", TotalAmount=1e12), invoice("d", CustomerCardNo=None), "{}"]
    found = notifications(messages(spark, values)).collect()
    got = [(row.key and bytes(row.key).decode(), json.loads(bytes(row.value).decode())) for row in found]
    assert got == [
        (None, {}), (None, {}), (None, {}),
        ("a", {"CustomerCardNo": "c1", "TotalAmount": 9.99, "EarnedLoyaltyPoints": 1}),
        ("b", {"CustomerCardNo": "c1", "TotalAmount": -9.99, "EarnedLoyaltyPoints": -1}),
        ("c", {"CustomerCardNo": "c1", "TotalAmount": 1e12, "EarnedLoyaltyPoints": 2147483647}),
        ("d", {"TotalAmount": 100.0, "EarnedLoyaltyPoints": 20}),
        (None, {})]


def items_as_values(spark, *items):
    """(type, card, value) as decoded line items."""
    df = spark.createDataFrame(list(items), "CustomerType string, CustomerCardNo string, TotalValue double")
    return df.select(F.struct("*").alias("value"))


def test_points_are_cut_per_item_and_then_added(spark):
    df = items_as_values(spark, ("PRIME", "c", 9.99), ("PRIME", "c", 9.99), ("NONPRIME", "c", 50.0),
                         (None, "c", 50.0), ("prime", "c", 50.0))
    assert rows(rewards(df)) == [("c", 19.98, 2)]
    assert rewards(df).columns == ["CustomerCardNo", "TotalPurchase", "AggregatedRewards"]


def test_null_card_is_a_group_and_points_beyond_an_int_are_its_end(spark):
    df = items_as_values(spark, ("PRIME", None, 5.0), ("PRIME", None, 5.0), ("PRIME", "c", 1e11),
                         ("PRIME", "c", 5.0), ("PRIME", "d", None))
    assert rows(rewards(df)) == sorted([(None, 10.0, 2), ("c", 1e11 + 5, 2147483647 + 1), ("d", None, None)], key=repr)


def test_reward_messages(spark):
    totals = spark.createDataFrame([("c", 1.5, 3), (None, 2.0, 1), ("d", None, None)],
                                   "CustomerCardNo string, TotalPurchase double, AggregatedRewards bigint")
    got = [(row.key and bytes(row.key), bytes(row.value)) for row in reward_messages(totals).collect()]
    assert got == [(b"c", b'{"TotalPurchase":1.5,"AggregatedRewards":3}'),
                   (None, b'{"TotalPurchase":2.0,"AggregatedRewards":1}'), (b"d", b"{}")]


def test_file_application_infers_types_and_takes_one_file_per_batch(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for number, lines in enumerate([[invoice("a", [item(), item("i2")]), "garbage"], [invoice("b", [item()])]]):
        spark.createDataFrame([(json.dumps(line) if isinstance(line, dict) else line,) for line in lines],
                              "value string").coalesce(1).write.mode("append").text(raw)
    stream = json_directory(spark, raw)
    assert "_corrupt_record" in stream.columns
    query = drain(apps.flatten_files(stream, out), str(tmp_path / "checkpoint"))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    found = spark.read.schema(flat_schema(FILE_HEADER, item_qty=LONG)).json(out)
    assert [(row.InvoiceNumber, row.ItemCode, row.ItemQty) for row in found.orderBy("InvoiceNumber", "ItemCode").collect()] == [
        ("a", "i1", 2), ("a", "i2", 2), ("b", "i1", 2)]
    inferred = flatten(spark.read.json(raw), FILE_HEADER)
    assert inferred.schema["ItemQty"].dataType == LONG


def test_declared_schema_needs_no_inference(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.createDataFrame([(json.dumps(invoice("a", [item()])),)], "value string").write.text(raw)
    stream = json_directory(spark, raw, files_per_trigger=None, schema=INVOICE)
    assert stream.schema == INVOICE


def test_json_sink_leaves_nulls_out(spark, tmp_path, topics):
    publish(spark, topics, "invoices", [invoice("a", [{"ItemCode": "x"}], StoreID=None)])
    drain(apps.flatten_topic(topics.stream(spark, "invoices"), str(tmp_path / "out")), str(tmp_path / "c"))
    lines = [row.value for row in spark.read.text(str(tmp_path / "out")).collect()]
    assert [set(json.loads(line)) for line in lines] == [
        {"InvoiceNumber", "CreatedTime", "PosID", "CustomerType", "PaymentMethod", "DeliveryType", "City",
         "State", "PinCode", "ItemCode"}]


def test_publisher_and_rewards_chain(spark, tmp_path, topics):
    publish(spark, topics, "invoices",
            [invoice("a", [item(value=9.5), item(value=20.5)]), "broken"],
            [invoice("b", [item(value=9.5)], CustomerType="NONPRIME"),
             invoice("c", [item(value=9.5)], CustomerCardNo="c2"),
             invoice("d", [item(value=1.0)], CustomerCardNo=None)])
    drain(apps.publish_items(topics.stream(spark, "invoices", files_per_trigger=1), topics), str(tmp_path / "p"))
    query = drain(apps.reward_cards(topics.stream(spark, apps.ITEMS, files_per_trigger=1), topics),
                  str(tmp_path / "r"), mode="update")
    assert query.lastProgress["batchId"] >= 1
    emitted = last_per_key(all_batches(spark, topics.path(apps.REWARDS)), ["key"])
    got = {row.key and bytes(row.key).decode(): json.loads(bytes(row.value).decode()) for row in emitted.collect()}
    assert got == {"c1": {"TotalPurchase": 30.0, "AggregatedRewards": 5},
                   "c2": {"TotalPurchase": 9.5, "AggregatedRewards": 1},
                   None: {"TotalPurchase": 1.0, "AggregatedRewards": 0}}


ITEM = st.tuples(st.sampled_from(["PRIME", "OTHER"]), st.sampled_from(["c1", "c2", None]),
                 st.integers(-500, 500).map(float))


@given(st.lists(st.lists(ITEM, max_size=5), min_size=1, max_size=4))
@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
def test_rewards_do_not_depend_on_the_batches(spark, tmp_path_factory, parts):
    work = tmp_path_factory.mktemp("cuts")
    schema = "CustomerType string, CustomerCardNo string, TotalValue double"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(work / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(work / "in"))
    drain(changelog_sink(rewards(stream.select(F.struct("*").alias("value"))), str(work / "out")),
          str(work / "c"), mode="update")
    whole = rewards(spark.createDataFrame([row for part in parts for row in part], schema)
                    .select(F.struct("*").alias("value")))
    assert rows(last_per_key(all_batches(spark, str(work / "out")), ["CustomerCardNo"])) == rows(whole)
