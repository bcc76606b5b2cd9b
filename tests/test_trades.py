"""Tumbling windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import messages, publish, rows
from millrace.functions.times import format_time
from millrace.operators.trades import trades_from, window_totals
from millrace.plans import apps
from millrace.streaming.changelog import all_batches, last_per_key
from millrace.streaming.runner import changelog_sink, drain


def trade(time, kind, amount):
    return {"CreatedTime": f"2023-05-06 {time}", "Type": kind, "Amount": amount, "BrokerCode": "B1"}


# The fifth is older than the fourth.
SAMPLE = [trade("09:00:00", "BUY", 70), trade("09:14:59", "BUY", 5), trade("09:20:00", "SELL", 11),
          trade("09:31:00", "BUY", 2), trade("09:16:00", "SELL", 30), trade("09:59:59", "SELL", 1)]
TOTALS = [("09:00", "09:15", 75, 0), ("09:15", "09:30", 0, 41), ("09:30", "09:45", 2, 0),
          ("09:45", "10:00", 0, 1)]


def hours(df):
    return df.select(*[F.substring(format_time(name), 12, 5).alias(name) for name in ("start", "end")],
                     "TotalBuy", "TotalSell")


def test_sample_in_one_table(spark):
    assert rows(hours(window_totals(trades_from(messages(spark, SAMPLE))))) == TOTALS


def test_sample_batch_by_batch(spark, topics, tmp_path):
    publish(spark, topics, "stock-trades", SAMPLE[:3], SAMPLE[3:5], SAMPLE[5:])
    totals = apps.trade_totals(topics.stream(spark, "stock-trades", files_per_trigger=1))
    drain(changelog_sink(totals, str(tmp_path / "out")), str(tmp_path / "c"), mode="update")
    emitted = all_batches(spark, str(tmp_path / "out"))
    # Update mode: only the windows a batch touched. The late trade of 09:16 changes its window.
    assert rows(hours(emitted.where("batch_id = 0"))) == [("09:00", "09:15", 75, 0), ("09:15", "09:30", 0, 11)]
    assert rows(hours(emitted.where("batch_id = 1"))) == [("09:15", "09:30", 0, 41), ("09:30", "09:45", 2, 0)]
    assert rows(hours(emitted.where("batch_id = 2"))) == [("09:45", "10:00", 0, 1)]
    assert rows(hours(last_per_key(emitted, ["start", "end"]))) == TOTALS


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_gives_the_same_totals(spark, topics, tmp_path, seed):
    draw = random.Random(seed)
    trades = draw.sample(SAMPLE, len(SAMPLE))
    cuts = sorted(draw.sample(range(1, len(trades)), 2))
    publish(spark, topics, "stock-trades", trades[:cuts[0]], trades[cuts[0]:cuts[1]], trades[cuts[1]:])
    totals = apps.trade_totals(topics.stream(spark, "stock-trades", files_per_trigger=1))
    drain(changelog_sink(totals, str(tmp_path / "out")), str(tmp_path / "c"), mode="update")
    assert rows(hours(last_per_key(all_batches(spark, str(tmp_path / "out")), ["start", "end"]))) == TOTALS


def test_windows_hold_their_start_but_not_their_end(spark):
    edge = [{"CreatedTime": f"2024-02-05 10:{second}", "Type": "BUY", "Amount": 1}
            for second in ("00:00", "14:59", "15:00")]
    assert rows(hours(window_totals(trades_from(messages(spark, edge))))) == [
        ("10:00", "10:15", 2, 0), ("10:15", "10:30", 1, 0)]


def test_trades_without_a_readable_time_are_left_out(spark):
    odd = [{"CreatedTime": None, "Type": "BUY", "Amount": 1}, {"Type": "BUY", "Amount": 1},
           {"CreatedTime": "soon", "Type": "BUY", "Amount": 1}, "not json", None]
    assert rows(window_totals(trades_from(messages(spark, odd)))) == []


def test_other_types_count_zero_and_missing_amounts_nothing(spark):
    at = "2024-02-05 10:00:00"
    other = [{"CreatedTime": at, "Type": "HOLD", "Amount": 7}, {"CreatedTime": at, "Type": None, "Amount": 7},
             {"CreatedTime": at, "Type": "buy", "Amount": 7}]
    assert rows(hours(window_totals(trades_from(messages(spark, other))))) == [("10:00", "10:15", 0, 0)]
    blank = [{"CreatedTime": at, "Type": "BUY"}]
    assert rows(hours(window_totals(trades_from(messages(spark, blank))))) == [("10:00", "10:15", None, 0)]
    assert rows(hours(window_totals(trades_from(messages(spark, blank + other))))) == [("10:00", "10:15", 0, 0)]


def test_totals_exceed_an_int(spark):
    big = [{"CreatedTime": "2024-02-05 10:00:00", "Type": "SELL", "Amount": 2**31 - 1}] * 3
    assert rows(hours(window_totals(trades_from(messages(spark, big))))) == [("10:00", "10:15", 0, 3 * (2**31 - 1))]


def test_totals_are_combined_before_the_shuffle(spark):
    plan = window_totals(trades_from(messages(spark, SAMPLE)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1
