"""Invoices to line items, notifications and rewards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.codecs import decode_json, encode_json, message
from millrace.functions.money import loyalty_points
from millrace.functions.sums import exact_sum, limb_sums
from millrace.schemas import ADDRESS_COLUMNS, INVOICE, ITEM_COLUMNS, NOTIFICATION, flat_schema


def flatten(invoices: DataFrame, header: Sequence[str]) -> DataFrame:
    """One row per line item: header, delivery address and item columns.

    Invoices without items give no row.
    """
    items = invoices.selectExpr(
        *header, *[f"DeliveryAddress.{name}" for name in ADDRESS_COLUMNS],
        "explode(InvoiceLineItems) as LineItem")
    return items.select(
        *header, *ADDRESS_COLUMNS, *[F.col(f"LineItem.{name}").alias(name) for name in ITEM_COLUMNS])


def flatten_messages(messages: DataFrame, header: Sequence[str]) -> DataFrame:
    """``flatten`` over JSON messages."""
    return flatten(decode_json(messages, INVOICE), header)


def notifications(messages: DataFrame) -> DataFrame:
    """Loyalty points of each invoice message as a (key, value) message.

    Malformed messages are kept: null key, empty object.
    """
    invoices = decode_json(messages, INVOICE).select("InvoiceNumber", "CustomerCardNo", "TotalAmount")
    earned = invoices.withColumn("EarnedLoyaltyPoints", loyalty_points("TotalAmount"))
    body = ", ".join(f"'{name}', {name}" for name in NOTIFICATION.fieldNames())
    return earned.select(*message(F.col("InvoiceNumber"), F.expr(f"to_json(named_struct({body}))")))


def rewards(items: DataFrame) -> DataFrame:
    """Running purchase total and points per card of prime customers.

    ``items`` has the line item in the struct column ``value``. Points are cut to whole
    numbers per item, before they are added up.
    """
    return items.filter("value.CustomerType == 'PRIME'") \
        .groupBy("value.CustomerCardNo") \
        .agg(F.sum("value.TotalValue").alias("TotalPurchase"),
             F.sum(loyalty_points("value.TotalValue")).alias("AggregatedRewards"))


def exact_rewards(items: DataFrame) -> DataFrame:
    """``rewards`` whose purchase total is the same to the last bit for any order and cut of the items."""
    sums = items.filter("value.CustomerType == 'PRIME'") \
        .groupBy("value.CustomerCardNo") \
        .agg(*limb_sums(F.col("value.TotalValue"), "total"),
             F.sum(loyalty_points("value.TotalValue")).alias("AggregatedRewards"))
    return sums.select("CustomerCardNo", exact_sum("total").alias("TotalPurchase"), "AggregatedRewards")


def resumed_rewards(items: DataFrame, held: DataFrame) -> DataFrame:
    """``rewards`` of the line items behind a stopped query's positions, on top of the totals it held.

    Cards are emitted when one of the new items changes them.
    """
    earned = items.filter("value.CustomerType == 'PRIME'").select(
        "value.CustomerCardNo", F.col("value.TotalValue").alias("TotalPurchase"),
        loyalty_points("value.TotalValue").cast("bigint").alias("AggregatedRewards"), F.lit(True).alias("fresh"))
    both = earned.unionByName(held.select("*", F.lit(False).alias("fresh")))
    return both.groupBy("CustomerCardNo") \
        .agg(F.sum("TotalPurchase").alias("TotalPurchase"), F.sum("AggregatedRewards").alias("AggregatedRewards"),
             F.max("fresh").alias("fresh")) \
        .where("fresh").drop("fresh")


def reward_messages(totals: DataFrame) -> DataFrame:
    """(key, value) messages of reward totals."""
    return totals.select(*message(F.col("CustomerCardNo"),
                                  encode_json("TotalPurchase", "AggregatedRewards")))


def item_messages(items: DataFrame) -> DataFrame:
    """Flat line items as JSON messages by invoice."""
    return items.select(*message(F.col("InvoiceNumber"), encode_json(*items.columns)))


def items_from(messages: DataFrame, header: Sequence[str]) -> DataFrame:
    """Line items of JSON messages in the struct column ``value``, as ``rewards`` takes them."""
    return decode_json(messages, flat_schema(header)).select(F.struct("*").alias("value"))
