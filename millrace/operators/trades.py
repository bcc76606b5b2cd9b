"""Trades totalled over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.codecs import decode_json
from millrace.functions.times import parse_time
from millrace.schemas import TRADE

# Fixed value: width of a window.
WINDOW = "15 minutes"


def amount_of(kind: str) -> Column:
    """The amount of trades of one type, 0 for every other type."""
    return F.when(F.col("Type") == kind, F.col("Amount")).otherwise(0)


def buy_sell(trades: DataFrame) -> DataFrame:
    """Add the ``Buy`` and ``Sell`` amounts."""
    return trades.withColumns({"Buy": amount_of("BUY"), "Sell": amount_of("SELL")})


def trades_from(messages: DataFrame) -> DataFrame:
    """Trades of JSON messages with their parsed time and both amounts."""
    trades = decode_json(messages, TRADE)
    return buy_sell(trades.withColumn("CreatedTime", parse_time("CreatedTime")))


def window_totals(trades: DataFrame, width: str = WINDOW) -> DataFrame:
    """Buy and sell totals per tumbling window; trades without a time are left out.

    There is no watermark: a late trade always changes its window.
    """
    totals = trades.groupBy(F.window("CreatedTime", width)) \
        .agg(F.sum("Buy").alias("TotalBuy"), F.sum("Sell").alias("TotalSell"))
    return totals.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"),
                         "TotalBuy", "TotalSell")
