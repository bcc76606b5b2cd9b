"""Feeds derived from the tables: whole, and bounded however long an order is."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import TESTDATA, rows
from millrace.operators.invoices import flatten
from millrace.plans import feeds, queries
from millrace.plans.feeds import Tables, invoices
from millrace.schemas import INVOICE, TOPIC_HEADER

DAY = dt.datetime(1998, 3, 1)


@pytest.fixture
def small(spark, tmp_path) -> Tables:
    """Order 1 with 50 lines (an unknown part among them), 2 with 3, 3 with none, 4 of nobody."""
    def write(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("orders", [(1, 10, "P", 9.5, DAY, "1-URGENT"), (2, 11, "F", 8.0, DAY, "2-HIGH"),
                     (3, 10, "O", 7.0, DAY, "5-LOW"), (4, 99, "O", 6.0, DAY, "5-LOW")],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
          "o_orderdate timestamp_ntz, o_orderpriority string")
    write("customer", [(10, "C10", 0, "BUILDING"), (11, "C11", 0, "MACHINERY")],
          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    write("nation", [(0, "N0", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("region", [(0, "R0")], "r_regionkey int, r_name string")
    write("part", [(0, "bolt", 1.0), (1, "nut", 2.0)], "p_partkey long, p_name string, p_retailprice double")
    lines = [(1, n % 2, 1.0, float(n)) for n in range(49)] + [(1, 77, 1.0, 49.0)] + \
        [(2, 1, 2.0, 5.0)] * 3 + [(4, 0, 1.0, 1.0)]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double")
    return Tables(spark, str(tmp_path))


def values(df):
    return rows(df.select("InvoiceNumber", F.explode_outer("InvoiceLineItems.TotalValue")))


WHOLE = sorted([("1", float(n)) for n in range(50)] + [("2", 5.0)] * 3 + [("3", None), ("4", 1.0)], key=repr)


def test_an_invoice_per_order(small):
    found = invoices(small)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        (f.name, f.dataType.simpleString()) for f in INVOICE]
    assert values(found) == WHOLE
    header = found.select("InvoiceNumber", "CreatedTime", "CustomerType", "NumberOfItems",
                          "DeliveryAddress.City", "DeliveryAddress.PinCode")
    created = int(DAY.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert rows(header) == [("1", created, "PRIME", 50, "N0", "000000"),
                            ("2", created, "NONPRIME", 3, "N0", "000000"),
                            ("3", created, "PRIME", 0, "N0", "000000"),
                            ("4", created, "NONPRIME", 1, None, None)]


def test_flattening_gives_the_lines_back(small):
    flat = flatten(invoices(small), TOPIC_HEADER)
    assert rows(flat.select("InvoiceNumber", "TotalValue")) == [row for row in WHOLE if row[1] is not None]


def test_common_case_groups_and_joins_on_one_layout(small):
    plan = invoices(small)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_table_rewritten_to_the_same_size_is_published_anew(spark, tmp_path):
    tables = tmp_path / "tables"
    schema = "user_id long, ts timestamp_ntz, event_type string, value double"

    def write(user):
        spark.createDataFrame([(user, DAY, "click", 1.0)], schema).coalesce(1) \
            .write.mode("overwrite").parquet(str(tables / "events.parquet"))
        found = Tables.of(spark, str(tables))
        return [bytes(row.key) for row in found.topics("logins").table(spark, "logins").collect()]

    assert write(1) == [b"1"]
    size = sum(f.stat().st_size for f in tables.rglob("*.parquet") if f.is_file())
    assert write(2) == [b"2"]
    assert size == sum(f.stat().st_size for f in tables.rglob("*.parquet") if f.is_file())


def test_parts_are_split_by_the_tables_columns(spark):
    tables = Tables.of(spark, TESTDATA)
    for feed, topic, writers in (("invoices", "invoices", (feeds.EARLY, feeds.LATE)),
                                 ("logins", "logins", (feeds.EARLY, feeds.LATE)),
                                 ("stock-trades", "stock-trades", (feeds.SALES, feeds.OTHERS))):
        topics = tables.topics(feed)
        counts = [topics.part(spark, topic, writer).count() for writer in writers]
        assert all(counts) and sum(counts) == topics.table(spark, topic).count()


def test_feeds_are_published_once_in_several_files(spark):
    tables = Tables.of(spark, TESTDATA)
    assert tables.feed("logins") == tables.feed("logins")
    topics = tables.topics("logins")
    assert topics.table(spark, "logins").count() == tables["events"].count()
    assert 1 <= tables.files_per_batch(topics.path("logins")) < 16


def test_users_are_all_customers(spark):
    tables = Tables.of(spark, TESTDATA)
    users = feeds.users_table(tables, "/nowhere").read(spark)
    assert users.count() == tables["customer"].count()
    assert isinstance(users.schema["last_login"].dataType, T.TimestampType)


@pytest.mark.parametrize("query", [queries.file_invoice_flatten, queries.topic_invoice_flatten, queries.restart_exactly_once])
def test_flat_json_files_are_compressed(spark, query):
    flat = query(spark, TESTDATA)
    assert all(file.endswith(".json.gz") for file in flat.inputFiles())
    assert flat.count() == spark.read.parquet(f"{TESTDATA}/lineitem.parquet").count()


def test_invoice_files_are_compressed(spark):
    files = spark.read.text(Tables.of(spark, TESTDATA).feed("invoice-files"))
    assert all(file.endswith(".txt.gz") for file in files.inputFiles())
    assert files.count() == spark.read.parquet(f"{TESTDATA}/orders.parquet").count()
