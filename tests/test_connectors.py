"""What is asked of the connectors, whose packages are not here: formats and options only."""

from __future__ import annotations

from unittest.mock import MagicMock

import pytest

from millrace.sources.tables import CassandraTable, cassandra_settings
from millrace.sources.topics import Topics


class Chain:
    """Stands for a reader or writer: notes every call and returns itself."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **options):
            self.calls.append((name, *args, *sorted(options.items())))
            return self
        return call


KAFKA = [("format", "kafka"), ("options", ("minPartitions", "64")), ("option", "kafka.bootstrap.servers", "a:9092,b:9092")]


def test_kafka_stream():
    spark = MagicMock(readStream=Chain())
    found = Topics(brokers="a:9092,b:9092", options={"minPartitions": "64"}).stream(spark, "invoices")
    assert found.calls == [*KAFKA, ("option", "subscribe", "invoices"),
                           ("option", "startingOffsets", "earliest"), ("load",)]


def test_kafka_table_and_batch_write():
    topics = Topics(brokers="a:9092,b:9092", options={"minPartitions": "64"})
    spark = MagicMock(read=Chain())
    assert topics.table(spark, "t").calls == [*KAFKA, ("option", "subscribe", "t"), ("load",)]
    rows = MagicMock()
    rows.select.return_value.write = writer = Chain()
    topics.publish(rows, "t")
    rows.select.assert_called_once_with("key", "value")
    assert writer.calls == [*KAFKA, ("option", "topic", "t"), ("save",)]


@pytest.mark.parametrize("mode", ["append", "update"])
def test_kafka_sink_takes_key_and_value_alone(mode):
    rows = MagicMock()
    rows.select.return_value.writeStream = Chain()
    writer = Topics(brokers="a:9092,b:9092", options={"minPartitions": "64"}).sink(rows, "notifications", mode)
    rows.select.assert_called_once_with("key", "value")
    assert writer.calls == [*KAFKA, ("option", "topic", "notifications")]


def test_cassandra_table():
    table = CassandraTable("shop", "users")
    options = ("options", ("keyspace", "shop"), ("table", "users"))
    spark = MagicMock(read=Chain())
    assert table.read(spark).calls == [("format", "org.apache.spark.sql.cassandra"), options, ("load",)]
    rows = MagicMock(write=Chain())
    table.upsert(rows, 3)
    assert rows.write.calls == [("format", "org.apache.spark.sql.cassandra"), options,
                                ("mode", "append"), ("save",)]
    assert cassandra_settings("db")["spark.cassandra.connection.port"] == "9042"


def test_a_folder_has_no_other_start():
    with pytest.raises(ValueError):
        Topics(folder="f").stream(MagicMock(), "t", starting="latest")
