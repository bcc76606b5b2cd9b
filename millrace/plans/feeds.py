"""Topics, files and tables derived from the star-schema tables.

Each feed is a distributed write of whole tables. Within one Spark application a feed is
published once and then read by every dataflow that needs it, as a topic would be.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.codecs import encode_json, message
from millrace.functions.times import format_time
from millrace.plans import apps
from millrace.schemas import INVOICE, USER
from millrace.session import content_identity, engine_session, folder_size, scratch_dir
from millrace.sources.tables import BucketedTable, FileTable
from millrace.sources.topics import Topics
from millrace.streaming.runner import drain

# Orders before this day are one writer's messages, the others another's.
FIRST_PART_ENDS = "1998-01-01"
EARLY, LATE = "early", "late"
LEAST_PARTITIONS = 8
# More than of a batch shuffle: a state partition keeps stores of its own open.
BYTES_PER_STATE_PARTITION = 128 * 1024 * 1024
SALES, OTHERS = "sales", "others"
# Days on which the second and the third part of the shifting clicks begin.
SECOND_BEGINS, THIRD_BEGINS = "1997-01-01", "1999-01-01"
FIRST, SECOND, THIRD = "first", "second", "third"
# Of plain files: JSON lines repeat their names in every row.
JSON_FILES = "gzip"

_published: dict[tuple, str] = {}
_publishing = threading.RLock()


@dataclass(frozen=True)
class Tables:
    """The input tables of one folder, read in an engine session of their own."""

    spark: SparkSession
    folder: str

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Tables:
        size, _ = folder_size(spark, folder)
        # The checkpoints of these queries end with them, so the cores and the tables' size may set their partitions.
        partitions = max(LEAST_PARTITIONS, spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_STATE_PARTITION))
        return cls(engine_session(spark, input_bytes=size, state_partitions=partitions), folder)

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def identity(self) -> str:
        """Changes with any of the tables' files, so that tables changed in place are published again."""
        return content_identity(self.spark, self.folder)

    def feed(self, name: str) -> str:
        """Folder of a published feed."""
        key = (self.spark.sparkContext.applicationId, self.folder, self.identity, name)
        with _publishing:
            if key not in _published:
                path = scratch_dir(self.spark, f"feed-{name}")
                FEEDS[name](self, path)
                _published[key] = path
            return _published[key]

    def topics(self, name: str) -> Topics:
        """The feed of a topic, as topics."""
        return Topics(folder=self.feed(name))

    def files_per_batch(self, path: str, batches: int = 2) -> int:
        """Files per trigger that cut a folder into a few micro-batches, whatever its size."""
        _, files = folder_size(self.spark, path)
        return max(1, files // batches)

    def file_records(self, rows: int) -> int:
        """Record limit per file that gives even a small feed enough files for some batches."""
        return max(1, -(-rows // (2 * self.spark.sparkContext.defaultParallelism)))


def text(column: str) -> Column:
    return F.col(column).cast("string")


def order_headers(tables: Tables) -> DataFrame:
    """Header fields of an invoice for every order."""
    orders = tables["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                     "o_orderpriority", "o_orderstatus")
    customer = tables["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = tables["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = tables["region"].select("r_regionkey", "r_name")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey, "left") \
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left") \
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
    prime = F.when(F.col("c_mktsegment") == "BUILDING", "PRIME").otherwise("NONPRIME")
    address = F.struct(F.col("c_name").alias("AddressLine"), F.col("n_name").alias("City"),
                       F.col("r_name").alias("State"),
                       F.lpad(text("n_nationkey"), 6, "0").alias("PinCode"),
                       text("o_custkey").alias("ContactNumber"))
    return rows.select(
        "o_orderkey",
        text("o_orderkey").alias("InvoiceNumber"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("CreatedTime"),
        F.concat(F.lit("STR"), F.col("o_custkey") % 100).alias("StoreID"),
        F.concat(F.lit("POS"), F.col("o_custkey") % 10).alias("PosID"),
        F.concat(F.lit("OAS"), F.col("o_custkey") % 7).alias("CashierID"),
        prime.alias("CustomerType"),
        text("o_custkey").alias("CustomerCardNo"),
        F.col("o_totalprice").alias("TotalAmount"),
        F.col("o_orderpriority").alias("PaymentMethod"),
        (F.col("o_totalprice") * 0.025).alias("CGST"),
        (F.col("o_totalprice") * 0.025).alias("SGST"),
        (F.col("o_totalprice") * 0.00125).alias("CESS"),
        F.col("o_orderstatus").alias("DeliveryType"),
        address.alias("DeliveryAddress"))


def invoices(tables: Tables) -> DataFrame:
    """An invoice per order with all its line items."""
    part = tables["part"].select("p_partkey", "p_name", "p_retailprice")
    lines = tables["lineitem"].select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    item = F.struct(text("l_partkey").alias("ItemCode"), F.col("p_name").alias("ItemDescription"),
                    F.col("p_retailprice").alias("ItemPrice"),
                    F.col("l_quantity").cast("int").alias("ItemQty"),
                    F.col("l_extendedprice").alias("TotalValue"))
    items = lines.join(part, lines.l_partkey == part.p_partkey, "left") \
        .groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(item).alias("InvoiceLineItems"))
    whole = order_headers(tables).join(items, "o_orderkey", "left") \
        .withColumn("InvoiceLineItems", F.coalesce("InvoiceLineItems", F.array()))
    return whole.withColumn("NumberOfItems", F.size("InvoiceLineItems")).select(INVOICE.fieldNames())


def _messages(rows: DataFrame, key: str, *extra: Column) -> DataFrame:
    return rows.select(*message(F.col(key), encode_json(*rows.columns)), *extra)


def publish_invoices(tables: Tables, path: str) -> None:
    """Early and late orders are two writers' messages."""
    day = F.unix_millis(F.to_timestamp(F.lit(FIRST_PART_ENDS)))
    writer = F.when(F.col("CreatedTime") < day, EARLY).otherwise(LATE)
    Topics(folder=path).publish(_messages(invoices(tables), "InvoiceNumber", writer.alias("by")), "invoices",
                                tables.file_records(tables["orders"].count()), F.col("by"))


def publish_invoice_items(tables: Tables, path: str) -> None:
    """The line items that the publishing application makes of the invoices."""
    source = tables.topics("invoices")
    messages = source.stream(tables.spark, "invoices",
                             files_per_trigger=tables.files_per_batch(source.path("invoices")))
    drain(apps.publish_items(messages, Topics(folder=path)), scratch_dir(tables.spark, "publisher"))


def publish_invoice_files(tables: Tables, path: str) -> None:
    """Invoices as JSON lines in plain files: the values of the topic."""
    tables.topics("invoices").table(tables.spark, "invoices") \
        .select(F.col("value").cast("string").alias("value")) \
        .write.option("compression", JSON_FILES) \
        .option("maxRecordsPerFile", tables.file_records(tables["orders"].count())).text(path)


def publish_logins(tables: Tables, path: str) -> None:
    """Every event is a login of its user; those before and after the mean time are two writers' messages."""
    events = tables["events"]
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    rows, middle = events.agg(F.count(F.lit(1)), F.avg(second)).first()
    early = F.coalesce(second < F.lit(middle), F.lit(True))
    logins = events.select(format_time("ts").alias("created_time"), text("user_id").alias("login_id"),
                           F.when(early, EARLY).otherwise(LATE).alias("by"))
    messages = logins.select(*message(F.col("login_id"), encode_json("created_time", "login_id")), "by")
    Topics(folder=path).publish(messages, "logins", tables.file_records(rows), F.col("by"))


def publish_impressions(tables: Tables, path: str) -> None:
    """Every order is an impression, its priority the campaign."""
    rows = tables["orders"].select(text("o_orderkey").alias("InventoryID"),
                                   format_time("o_orderdate").alias("CreatedTime"),
                                   F.col("o_orderpriority").alias("Campaigner"))
    Topics(folder=path).publish(_messages(rows, "InventoryID"), "impressions",
                                tables.file_records(tables["orders"].count()))


def publish_clicks(tables: Tables, path: str) -> None:
    """Every line item is a click on its order."""
    rows = tables["lineitem"].select(text("l_orderkey").alias("InventoryID"),
                                     format_time("l_shipdate").alias("CreatedTime"))
    Topics(folder=path).publish(_messages(rows, "InventoryID"), "clicks",
                                tables.file_records(tables["lineitem"].count()))


def publish_shifting_clicks(tables: Tables, path: str) -> None:
    """Line items as clicks in three parts by time; from the second on, those of every other part number are on inventory 0."""
    day = F.col("l_shipdate").cast("timestamp")
    part = F.when(day < F.to_timestamp(F.lit(SECOND_BEGINS)), FIRST) \
        .when(day < F.to_timestamp(F.lit(THIRD_BEGINS)), SECOND).otherwise(THIRD)
    shifted = (F.col("by") != FIRST) & (F.col("l_partkey") % 2 == 0)
    rows = tables["lineitem"].select("l_orderkey", "l_partkey", "l_shipdate", part.alias("by")) \
        .select(F.when(shifted, "0").otherwise(text("l_orderkey")).alias("InventoryID"),
                format_time("l_shipdate").alias("CreatedTime"), "by")
    messages = rows.select(*message(F.col("InventoryID"), encode_json("InventoryID", "CreatedTime")), "by")
    Topics(folder=path).publish(messages, "clicks", tables.file_records(tables["lineitem"].count()), F.col("by"))


def publish_trades(tables: Tables, path: str) -> None:
    """Every event is a trade; types other than buying and selling count for nothing. Sales have a writer of their own."""
    kind = F.when(F.col("event_type") == "purchase", "BUY") \
        .when(F.col("event_type") == "click", "SELL").otherwise(F.upper("event_type"))
    rows = tables["events"].select(format_time("ts").alias("CreatedTime"), kind.alias("Type"),
                                   F.floor("value").cast("int").alias("Amount"),
                                   F.concat(F.lit("B"), F.col("user_id") % 5).alias("BrokerCode"))
    by = F.when(F.col("Type") == "SELL", SALES).otherwise(OTHERS).alias("by")
    Topics(folder=path).publish(_messages(rows, "BrokerCode", by), "stock-trades",
                                tables.file_records(tables["events"].count()), F.col("by"))


def publish_damaged_trades(tables: Tables, path: str) -> None:
    """The trades, some of whose messages have lost their end (broker 3) or have a word for the amount (sales of broker 1)."""
    trades = tables.topics("stock-trades").table(tables.spark, "stock-trades")
    text = F.col("value").cast("string")
    broker = F.col("key").cast("string")
    spoilt = F.when(broker == "B3", F.substring(text, F.lit(1), F.length(text) - 5)) \
        .when((broker == "B1") & text.contains('"SELL"'), F.regexp_replace(text, '"Amount":-?[0-9]+', '"Amount":"many"')) \
        .otherwise(text)
    Topics(folder=path).publish(trades.select("key", spoilt.cast("binary").alias("value")), "stock-trades",
                                tables.file_records(tables["events"].count()))


def publish_lines(tables: Tables, path: str, where: Column | None = None) -> None:
    """The text of every document (or of those chosen), as lines of text files."""
    documents = tables["documents"].where("text is not null")
    if where is not None:
        documents = documents.where(where)
    documents.select("text").write.mode("append") \
        .option("lineSep", "\n") \
        .option("maxRecordsPerFile", tables.file_records(tables["documents"].count())).text(path)


def publish_users(tables: Tables, path: str) -> None:
    """Every customer is a user without a login yet."""
    tables["customer"].select(text("c_custkey").alias("login_id"), F.col("c_name").alias("user_name"),
                              F.lit(None).cast("timestamp").alias("last_login")) \
        .write.parquet(path)


def users_table(tables: Tables, changes: str) -> FileTable:
    return FileTable(base=tables.feed("users"), changes=changes, key="login_id", schema=USER)


def user_buckets(tables: Tables, folder: str) -> BucketedTable:
    """All users in a table of their own, in as many buckets as the state has partitions."""
    buckets = int(tables.spark.conf.get("spark.sql.shuffle.partitions"))
    table = BucketedTable(folder, "login_id", USER, buckets)
    table.load(tables.spark.read.schema(USER).parquet(tables.feed("users")))
    return table


FEEDS = {
    "invoices": publish_invoices,
    "invoice-items": publish_invoice_items,
    "invoice-files": publish_invoice_files,
    "logins": publish_logins,
    "impressions": publish_impressions,
    "clicks": publish_clicks,
    "shifting-clicks": publish_shifting_clicks,
    "stock-trades": publish_trades,
    "damaged-trades": publish_damaged_trades,
    "lines": publish_lines,
    "users": publish_users,
}
