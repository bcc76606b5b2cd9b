"""Message layouts. Every field is nullable."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BINARY, TIMESTAMP = T.BinaryType(), T.TimestampType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Field names and types of the messages.

INVOICE = record(
    InvoiceNumber=STRING, CreatedTime=LONG, StoreID=STRING, PosID=STRING, CashierID=STRING,
    CustomerType=STRING, CustomerCardNo=STRING, TotalAmount=DOUBLE, NumberOfItems=INT,
    PaymentMethod=STRING, CGST=DOUBLE, SGST=DOUBLE, CESS=DOUBLE, DeliveryType=STRING,
    DeliveryAddress=record(AddressLine=STRING, City=STRING, State=STRING, PinCode=STRING,
                           ContactNumber=STRING),
    InvoiceLineItems=T.ArrayType(record(ItemCode=STRING, ItemDescription=STRING, ItemPrice=DOUBLE,
                                        ItemQty=INT, TotalValue=DOUBLE)))

LOGIN = record(created_time=STRING, login_id=STRING)

IMPRESSION = record(InventoryID=STRING, CreatedTime=STRING, Campaigner=STRING)

CLICK = record(InventoryID=STRING, CreatedTime=STRING)

TRADE = record(CreatedTime=STRING, Type=STRING, Amount=INT, BrokerCode=STRING)

USER = record(login_id=STRING, user_name=STRING, last_login=TIMESTAMP)

NOTIFICATION = record(CustomerCardNo=STRING, TotalAmount=DOUBLE, EarnedLoyaltyPoints=INT)

REWARD = record(TotalPurchase=DOUBLE, AggregatedRewards=LONG)

# A card's totals as the rewards hold them.
REWARD_TOTAL = record(CustomerCardNo=STRING, TotalPurchase=DOUBLE, AggregatedRewards=LONG)

# Columns of a topic as the Kafka connector delivers them.
TOPIC = record(key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG,
               timestamp=TIMESTAMP, timestampType=INT)

# What the files of a topic folder store of it; the other columns follow from the file.
STORED_MESSAGE = record(key=BINARY, value=BINARY, timestamp=TIMESTAMP)

ADDRESS_COLUMNS = ("City", "State", "PinCode")

ITEM_COLUMNS = ("ItemCode", "ItemDescription", "ItemPrice", "ItemQty", "TotalValue")

# Header columns kept by each of the three flatteners.
FILE_HEADER = ("InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType",
               "PaymentMethod", "DeliveryType")
TOPIC_HEADER = ("InvoiceNumber", "CreatedTime", "PosID", "CustomerType", "PaymentMethod",
                "DeliveryType")
AVRO_HEADER = ("InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType",
               "CustomerCardNo", "DeliveryType")

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# End of fixed values.


def flat_schema(header: Iterable[str], item_qty: T.DataType = INT) -> T.StructType:
    """Row layout after flattening invoices with the given header columns."""
    address = INVOICE["DeliveryAddress"].dataType
    item = INVOICE["InvoiceLineItems"].dataType.elementType
    schema = T.StructType([INVOICE[name] for name in header])
    for name in ADDRESS_COLUMNS:
        schema = schema.add(address[name])
    for name in ITEM_COLUMNS:
        schema = schema.add(name, item_qty if name == "ItemQty" else item[name].dataType)
    return schema
