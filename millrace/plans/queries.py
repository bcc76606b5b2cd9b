"""The dataflows over the given tables, each as a query that returns a batch DataFrame.

Streaming ones publish their feeds, run to the end of the input in several micro-batches
and read back what their sink holds. Times come back as text and sums of doubles rounded
to cents, which makes results comparable across engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.codecs import DAMAGED, RAW, decode_json, decode_or_keep
from millrace.functions.times import format_time, parse_time
from millrace.operators.invoices import exact_rewards, items_from, rewards
from millrace.operators.logins import logins_from, matched_logins
from millrace.operators.skew import frozen
from millrace.operators.trades import buy_sell
from millrace.operators.words import word_counts
from millrace.plans import apps
from millrace.plans.feeds import (EARLY, FIRST, JSON_FILES, LATE, OTHERS, SALES, SECOND, THIRD, Tables, publish_lines,
                                  user_buckets, users_table)
from millrace.schemas import (AVRO_HEADER, FILE_HEADER, INVOICE, LONG, NOTIFICATION, REWARD, REWARD_TOTAL, TOPIC_HEADER,
                              TRADE, flat_schema)
from millrace.session import scratch_dir
from millrace.sources.files import json_directory, kept_schema, text_directory
from millrace.sources.topics import Topics
from millrace.streaming.changelog import all_batches, batch_writer, last_batch, last_per_key, split_writer
from millrace.streaming.progress import ProgressLog
from millrace.streaming.relayout import positions
from millrace.streaming.runner import changelog_sink, console_sink, drain, parquet_sink, snapshot_sink, start


def cents(total: str) -> Column:
    return F.round(total, 2).alias(total)


def _stream(tables: Tables, feed: str, topic: str | None = None, positions: bool = False) -> DataFrame:
    topics = tables.topics(feed)
    name = topic or feed
    files = tables.files_per_batch(topics.path(name))
    return topics.stream(tables.spark, name, files_per_trigger=files, positions=positions)


def file_invoice_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files, whose schema is found once and kept with the checkpoint, to flat JSON files."""
    tables = Tables.of(spark, folder)
    source = tables.feed("invoice-files")
    work = scratch_dir(tables.spark, "file-invoices")
    schema = kept_schema(tables.spark, source, f"{work}/checkpoint")
    raw = json_directory(tables.spark, source, tables.files_per_batch(source), schema)
    drain(apps.flatten_files(raw, f"{work}/out", JSON_FILES), f"{work}/checkpoint")
    return tables.spark.read.schema(flat_schema(FILE_HEADER, item_qty=LONG)).json(f"{work}/out")


def topic_invoice_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice topic to flat JSON files."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "topic-invoices")
    drain(apps.flatten_topic(_stream(tables, "invoices"), f"{work}/out", JSON_FILES), f"{work}/checkpoint")
    return tables.spark.read.schema(flat_schema(TOPIC_HEADER)).json(f"{work}/out")


def loyalty_notifications(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice topic to a topic of notifications, decoded again."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "notifications")
    out = Topics(folder=f"{work}/topics")
    drain(apps.notify(_stream(tables, "invoices"), out), f"{work}/checkpoint")
    return _decoded(out.table(tables.spark, apps.NOTIFICATIONS), NOTIFICATION, "InvoiceNumber")


def _decoded(messages: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    return decode_json(messages, schema, "key") \
        .select(F.col("key").cast("string").alias(key), *schema.fieldNames())


def items_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice topic to a topic of line items, decoded again."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "items")
    out = Topics(folder=f"{work}/topics")
    drain(apps.publish_items(_stream(tables, "invoices"), out), f"{work}/checkpoint")
    return items_from(out.table(tables.spark, apps.ITEMS), AVRO_HEADER).select("value.*")


def _item_values(messages: DataFrame) -> DataFrame:
    """Line items of JSON invoice messages, in the struct column the rewards take."""
    items = decode_json(messages, INVOICE).select(
        "CustomerType", "CustomerCardNo", F.explode("InvoiceLineItems.TotalValue").alias("TotalValue"))
    return items.select(F.struct("*").alias("value"))


def customer_rewards(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice topic to running totals per card, the last total of each."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "rewards")
    totals = rewards(_item_values(_stream(tables, "invoices")))
    drain(changelog_sink(totals, f"{work}/out"), f"{work}/checkpoint", mode="update")
    last = last_per_key(all_batches(tables.spark, f"{work}/out"), ["CustomerCardNo"])
    return last.select("CustomerCardNo", cents("TotalPurchase"), "AggregatedRewards")


def exact_customer_rewards(spark: SparkSession, folder: str) -> DataFrame:
    """``customer_rewards`` with purchase totals that are exact to the last bit, not rounded to cents."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "exact-rewards")
    totals = exact_rewards(_item_values(_stream(tables, "invoices")))
    drain(changelog_sink(totals, f"{work}/out"), f"{work}/checkpoint", mode="update")
    return last_per_key(all_batches(tables.spark, f"{work}/out"), ["CustomerCardNo"])


def trades_and_damaged(spark: SparkSession, folder: str) -> DataFrame:
    """A damaged trade topic: whole messages decoded, the others as they came, from one pass over each micro-batch."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "damaged-trades")
    messages = _stream(tables, "damaged-trades", "stock-trades")
    drain(decode_or_keep(messages, TRADE).writeStream.foreachBatch(split_writer(f"{work}/out", DAMAGED)), f"{work}/checkpoint")
    return all_batches(tables.spark, f"{work}/out").select(*TRADE.fieldNames(), F.col(DAMAGED).cast("boolean").alias(DAMAGED), RAW)


def rewards_from_items_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Rewards chained behind the publisher, through its topic of line items."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "item-rewards")
    totals = apps.card_totals(_stream(tables, "invoice-items"))
    drain(changelog_sink(totals, f"{work}/out"), f"{work}/checkpoint", mode="update")
    last = last_per_key(all_batches(tables.spark, f"{work}/out"), ["CustomerCardNo"])
    return last.select("CustomerCardNo", cents("TotalPurchase"), "AggregatedRewards")


def rewards_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same chain up to its topic: the message a consumer holds last for each key, decoded."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "reward-messages")
    topics = Topics(folder=f"{work}/topics")
    drain(apps.reward_cards(_stream(tables, "invoice-items"), topics), f"{work}/checkpoint", mode="update")
    emitted = all_batches(tables.spark, topics.path(apps.REWARDS)).drop("writer")
    return _decoded(last_per_key(emitted, ["key"]), REWARD, "CustomerCardNo") \
        .select("CustomerCardNo", cents("TotalPurchase"), "AggregatedRewards")


def _publish_part(tables: Tables, topics: Topics, topic: str, writer: str) -> None:
    """One writer's messages of a feed, into a topic of the query's own."""
    topics.publish(tables.topics(topic).part(tables.spark, topic, writer), topic)


def rewards_changelog(spark: SparkSession, folder: str) -> DataFrame:
    """Every total emitted in update mode, over two parts of the orders that arrive in turn."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "reward-changes")
    topics = Topics(folder=f"{work}/topics")
    for writer in (EARLY, LATE):
        _publish_part(tables, topics, apps.INVOICES, writer)
        totals = rewards(_item_values(topics.stream(tables.spark, "invoices")))
        drain(changelog_sink(totals, f"{work}/out"), f"{work}/checkpoint", mode="update")
    return all_batches(tables.spark, f"{work}/out") \
        .select("batch_id", "CustomerCardNo", cents("TotalPurchase"), "AggregatedRewards")


def restart_exactly_once(spark: SparkSession, folder: str) -> DataFrame:
    """The flattener stopped and restarted on its checkpoint: after each part, and with no news."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "restart")
    topics = Topics(folder=f"{work}/topics")
    for writer in (EARLY, LATE, None):
        if writer:
            _publish_part(tables, topics, apps.INVOICES, writer)
        messages = topics.stream(tables.spark, "invoices")
        drain(apps.flatten_topic(messages, f"{work}/out", JSON_FILES), f"{work}/checkpoint")
    return tables.spark.read.schema(flat_schema(TOPIC_HEADER)).json(f"{work}/out")


def last_login_join(spark: SparkSession, folder: str) -> DataFrame:
    """Login topic joined with the user table, every match."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "login-join")
    step = matched_logins(users_table(tables, f"{work}/changes"), batch_writer(f"{work}/out"))
    logins = logins_from(_stream(tables, "logins"))
    drain(logins.writeStream.foreachBatch(step), f"{work}/checkpoint", mode="update")
    return all_batches(tables.spark, f"{work}/out") \
        .select("login_id", "user_name", format_time("last_login").alias("last_login"))


def last_login_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The user table after all logins, which arrive in two parts by time."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "login-upsert")
    topics = Topics(folder=f"{work}/topics")
    users = user_buckets(tables, f"{work}/users")
    for writer in (EARLY, LATE):
        _publish_part(tables, topics, apps.LOGINS, writer)
        messages = topics.stream(tables.spark, apps.LOGINS)
        drain(apps.record_logins(messages, users), f"{work}/checkpoint", mode="update")
    return users.current(tables.spark) \
        .select("login_id", "user_name", format_time("last_login").alias("last_login"))


def impression_click_join(spark: SparkSession, folder: str) -> DataFrame:
    """Impression topic joined with click topic, hot keys spread."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "impression-clicks")

    def find() -> DataFrame:
        return apps.hot_inventory(tables.topics("impressions").table(tables.spark, "impressions"),
                                  tables.topics("clicks").table(tables.spark, "clicks"))

    joined = apps.matched_clicks(_stream(tables, "impressions", positions=True),
                                 _stream(tables, "clicks", positions=True),
                                 frozen(tables.spark, f"{work}/checkpoint/hot-keys", find))
    drain(parquet_sink(joined, f"{work}/out"), f"{work}/checkpoint")
    return tables.spark.read.parquet(f"{work}/out") \
        .withColumn("ClickTime", format_time("ClickTime"))


def clicks_after_relayout(spark: SparkSession, folder: str) -> DataFrame:
    """The join of impressions with clicks that gather on one id: stopped, and continued where that id is spread.

    No id is hot when the first checkpoint begins. The second one begins with the rows that the first
    holds and with the ids that are hot by then.
    """
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "shifting-clicks")
    topics, clicks = Topics(folder=f"{work}/topics"), tables.topics("shifting-clicks")
    topics.publish(tables.topics("impressions").table(tables.spark, "impressions"), "impressions")
    stopped, continued = f"{work}/first-checkpoint", f"{work}/second-checkpoint"
    for part, checkpoint in ((FIRST, stopped), (SECOND, stopped), (THIRD, continued)):
        topics.publish(clicks.part(tables.spark, "clicks", part), "clicks")
        if checkpoint == continued:
            apps.carry_clicks(tables.spark, stopped, continued)
        after = positions(tables.spark, checkpoint)
        left, right = (topics.stream(tables.spark, name, positions=True, after=after) for name in ("impressions", "clicks"))
        hot = frozen(tables.spark, f"{checkpoint}/hot-keys", lambda: apps.hot_inventory(
            topics.table(tables.spark, "impressions"), topics.table(tables.spark, "clicks")))
        # A sink keeps account of one query's batches, so each has its own.
        drain(parquet_sink(apps.matched_clicks(left, right, hot, checkpoint), f"{checkpoint}-out"), checkpoint)
    pairs = [tables.spark.read.parquet(f"{checkpoint}-out") for checkpoint in (stopped, continued)]
    return pairs[0].unionByName(pairs[1]).withColumn("ClickTime", format_time("ClickTime"))


def rewards_after_relayout(spark: SparkSession, folder: str) -> DataFrame:
    """Running totals per card, stopped after the early orders and continued with four times as many state partitions."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "rewards-relayout")
    topics = Topics(folder=f"{work}/topics")
    stopped, continued = f"{work}/first-checkpoint", f"{work}/second-checkpoint"
    emitted = []
    for writer, checkpoint in ((EARLY, stopped), (LATE, continued)):
        if checkpoint == continued:
            partitions = int(tables.spark.conf.get("spark.sql.shuffle.partitions"))
            tables.spark.conf.set("spark.sql.shuffle.partitions", str(4 * partitions))
            apps.carry_rewards(tables.spark, stopped, continued)
        _publish_part(tables, topics, apps.INVOICES, writer)
        messages = topics.stream(tables.spark, "invoices", after=positions(tables.spark, checkpoint))
        totals = apps.running_rewards(_item_values(messages), checkpoint)
        drain(changelog_sink(totals, f"{checkpoint}-out"), checkpoint, mode="update")
        emitted.append(all_batches(tables.spark, f"{checkpoint}-out", REWARD_TOTAL))
    # Batches of the second query come after all of the first.
    later = emitted[1].withColumn("batch_id", F.col("batch_id") + F.lit(1 << 40))
    last = last_per_key(emitted[0].unionByName(later), ["CustomerCardNo"])
    return last.select("CustomerCardNo", cents("TotalPurchase"), "AggregatedRewards")


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of text files to counts per word, in complete mode."""
    tables = Tables.of(spark, folder)
    source = tables.feed("lines")
    work = scratch_dir(tables.spark, "words")
    lines = text_directory(tables.spark, source, tables.files_per_batch(source))
    drain(snapshot_sink(word_counts(lines), f"{work}/out"), f"{work}/checkpoint", mode="complete")
    return last_batch(tables.spark, f"{work}/out")


def trade_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Trade topic to buy and sell totals per window, in update mode."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "trade-windows")
    totals = apps.trade_totals(_stream(tables, "stock-trades"))
    drain(changelog_sink(totals, f"{work}/out"), f"{work}/checkpoint", mode="update")
    last = last_per_key(all_batches(tables.spark, f"{work}/out"), ["start", "end"])
    return last.select(format_time("start").alias("start"), format_time("end").alias("end"),
                       "TotalBuy", "TotalSell")


def word_count_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The whole result that complete mode emits each time: English texts, then all texts."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "word-snapshots")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    for part in (english, ~english):
        publish_lines(tables, f"{work}/lines", part)
        counts = word_counts(text_directory(tables.spark, f"{work}/lines"))
        drain(changelog_sink(counts, f"{work}/out"), f"{work}/checkpoint", mode="complete")
    return all_batches(tables.spark, f"{work}/out")


def trade_windows_changelog(spark: SparkSession, folder: str) -> DataFrame:
    """Every window total emitted in update mode, when all sales arrive late.

    However old a window is, a late trade changes its total.
    """
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "trade-changes")
    topics = Topics(folder=f"{work}/topics")
    for writer in (OTHERS, SALES):
        _publish_part(tables, topics, apps.TRADES, writer)
        totals = apps.trade_totals(topics.stream(tables.spark, apps.TRADES))
        drain(changelog_sink(totals, f"{work}/out"), f"{work}/checkpoint", mode="update")
    return all_batches(tables.spark, f"{work}/out").select(
        "batch_id", format_time("start").alias("start"), format_time("end").alias("end"),
        "TotalBuy", "TotalSell")


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """What three queries over the trades report of themselves: each trigger, named, with rows and observed sales."""
    tables = Tables.of(spark, folder)
    work = scratch_dir(tables.spark, "progress")
    log = ProgressLog()
    tables.spark.streams.addListener(log)
    triggers = {"caught-up": {"until_caught_up": True}, "at-once": {}, "every-second": {"interval": "1 second"}}
    try:
        for name, trigger in triggers.items():
            sales = F.count_if(F.col("Type") == "SELL").alias("sales")
            trades = decode_json(_stream(tables, "stock-trades"), TRADE).observe("trades", sales)
            # The console shows its heading and no rows.
            sink = console_sink(trades, show=0) if name == "caught-up" else parquet_sink(trades, f"{work}/{name}")
            query = start(sink, f"{work}/{name}-checkpoint", name=name, **trigger)
            try:
                if name == "caught-up":
                    query.awaitTermination()
                else:
                    query.processAllAvailable()
            finally:
                query.stop()
            log.wait_for(query)
    finally:
        tables.spark.streams.removeListener(log)
    sales = F.get_json_object("observed", "$.trades.sales").cast("bigint")
    return log.table(tables.spark).groupBy("name").agg(
        F.sum("input_rows").alias("input_rows"), F.sum(sales).alias("sales"), (F.count_distinct("batch_id") > 1).alias("several"))


def _trades(tables: Tables) -> DataFrame:
    messages = tables.topics("stock-trades").table(tables.spark, "stock-trades")
    return decode_json(messages, TRADE)


def json_decode(spark: SparkSession, folder: str) -> DataFrame:
    """The trade topic decoded, all fields."""
    return _trades(Tables.of(spark, folder))


def parse_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """Trade times parsed, as seconds since the epoch."""
    trades = _trades(Tables.of(spark, folder))
    return trades.select("CreatedTime", F.unix_timestamp(parse_time("CreatedTime")).alias("seconds"))


def conditional_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Buy and sell amounts of every trade."""
    return buy_sell(_trades(Tables.of(spark, folder))).select("CreatedTime", "Type", "Buy", "Sell")


def prime_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices of prime customers."""
    tables = Tables.of(spark, folder)
    messages = tables.topics("invoices").table(tables.spark, "invoices")
    return decode_json(messages, INVOICE).filter("CustomerType == 'PRIME'") \
        .select("InvoiceNumber", "CustomerType", "CustomerCardNo")


QUERIES = {query.__name__: query for query in (
    file_invoice_flatten, topic_invoice_flatten, loyalty_notifications, items_roundtrip,
    customer_rewards, rewards_from_items_topic, rewards_messages, rewards_changelog,
    restart_exactly_once, last_login_join, last_login_upsert, impression_click_join,
    clicks_after_relayout, rewards_after_relayout, exact_customer_rewards, trades_and_damaged, word_count,
    word_count_snapshots, stream_progress, trade_windows, trade_windows_changelog, json_decode, parse_timestamp,
    conditional_columns, prime_filter)}
