"""The nine applications: from input stream to a sink that is ready to start."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.avro import decode_avro, encode_avro
from millrace.operators.clicks import clicks_from, impression_clicks, impressions_from, resumed_impression_clicks
from millrace.operators.invoices import (flatten, flatten_messages, item_messages, items_from,
                                         notifications, resumed_rewards, reward_messages, rewards)
from millrace.operators.logins import logins_from, update_last_login
from millrace.operators.skew import hot_keys
from millrace.operators.trades import trades_from, window_totals
from millrace.operators.words import word_counts
from millrace.schemas import AVRO_HEADER, FILE_HEADER, REWARD_TOTAL, TOPIC_HEADER
from millrace.sources.tables import CassandraTable, FileTable
from millrace.sources.topics import Topics
from millrace.streaming.relayout import carried_stream, carry_join, carry_totals, positions
from millrace.streaming.runner import json_sink

# Topic names.
INVOICES = "invoices"
NOTIFICATIONS = "notifications"
ITEMS = "invoice-items"
REWARDS = "customer-rewards"
LOGINS = "logins"
IMPRESSIONS = "impressions"
CLICKS = "clicks"
TRADES = "stock-trades"


def flatten_files(raw: DataFrame, target: str, compression: str = "none") -> DataStreamWriter:
    """Invoice rows of JSON files to flat JSON files. Append mode."""
    return json_sink(flatten(raw, FILE_HEADER), target, compression)


def flatten_topic(messages: DataFrame, target: str, compression: str = "none") -> DataStreamWriter:
    """Invoice messages to flat JSON files. Append mode."""
    return json_sink(flatten_messages(messages, TOPIC_HEADER), target, compression)


def notify(messages: DataFrame, topics: Topics) -> DataStreamWriter:
    """Invoice messages to loyalty notifications. Append mode."""
    return topics.sink(notifications(messages), NOTIFICATIONS)


def publish_items(messages: DataFrame, topics: Topics, schema: str | None = None) -> DataStreamWriter:
    """Invoice messages to line items: Avro records of a ``schema``, JSON without one. Append mode."""
    items = flatten_messages(messages, AVRO_HEADER)
    if schema is None:
        return topics.sink(item_messages(items), ITEMS)
    return topics.sink(encode_avro(items, schema, "InvoiceNumber", items.columns), ITEMS)


def card_totals(messages: DataFrame, schema: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Running totals per card from the line items that ``publish_items`` writes."""
    return running_rewards(items_from(messages, AVRO_HEADER) if schema is None else decode_avro(messages, schema), checkpoint)


def running_rewards(items: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Totals per card; on a ``checkpoint`` that ``carry_rewards`` has begun they go on from those held there."""
    spark = items.sparkSession
    if checkpoint is None or positions(spark, checkpoint) is None:
        return rewards(items)
    return resumed_rewards(items, carried_stream(spark, checkpoint, "totals", REWARD_TOTAL))


def carry_rewards(spark: SparkSession, old: str, new: str) -> None:
    """Begin a new checkpoint of the rewards, for the partitions the session now has, with the totals at an old one."""
    carry_totals(spark, old, new, REWARD_TOTAL)


def reward_cards(messages: DataFrame, topics: Topics, schema: str | None = None,
                 checkpoint: str | None = None) -> DataStreamWriter:
    """Line items to reward messages. Update mode."""
    return topics.sink(reward_messages(card_totals(messages, schema, checkpoint)), REWARDS, mode="update")


def record_logins(messages: DataFrame, users: CassandraTable | FileTable,
                  show: bool = False) -> DataStreamWriter:
    """Login messages to the last login of each known user. Update mode."""
    return logins_from(messages).writeStream.foreachBatch(update_last_login(users, show))


def matched_clicks(impressions: DataFrame, clicks: DataFrame, hot: DataFrame | None = None,
                   checkpoint: str | None = None) -> DataFrame:
    """Impression messages joined with click messages. Append mode.

    On a ``checkpoint`` that ``carry_clicks`` has begun the rows held there take part.
    """
    left, right, spark = impressions_from(impressions), clicks_from(clicks), impressions.sparkSession
    if checkpoint is None or positions(spark, checkpoint) is None:
        return impression_clicks(left, right, hot)
    return resumed_impression_clicks(spark, checkpoint, left, right, hot)


def carry_clicks(spark: SparkSession, old: str, new: str) -> None:
    """Begin a new checkpoint of the join, with the rows held at an old one and the keys that are hot by now spread."""
    carry_join(spark, old, new, "ImpressionID", "ClickID")


def hot_inventory(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Inventory ids that need spreading, judged by the messages present as bounded tables."""
    key = F.get_json_object(F.col("value").cast("string"), "$.InventoryID")
    # As many as the state will have.
    partitions = int(impressions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hot_keys(impressions, key, clicks, key, partitions)


def counted_words(lines: DataFrame) -> DataFrame:
    """Text lines to counts per word. Complete mode."""
    return word_counts(lines)


def trade_totals(messages: DataFrame) -> DataFrame:
    """Trade messages to totals per window. Update mode."""
    return window_totals(trades_from(messages))
