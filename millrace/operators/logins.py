"""Logins matched with the table of users."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.codecs import decode_json
from millrace.functions.times import parse_time
from millrace.schemas import LOGIN
from millrace.sources.tables import BucketedTable, CassandraTable, FileTable


def logins_from(messages: DataFrame) -> DataFrame:
    """Logins of JSON messages with their parsed time."""
    return decode_json(messages, LOGIN).withColumn("created_time", parse_time("created_time"))


def with_user(logins: DataFrame, users: DataFrame) -> DataFrame:
    """Logins of known users as rows of the user table; others are dropped."""
    joined = logins.join(users, logins.login_id == users.login_id, "inner").drop(logins.login_id)
    return joined.select("login_id", "user_name", F.col("created_time").alias("last_login"))


def newest_login(logins: DataFrame) -> DataFrame:
    """One row per user, with the latest login; a user's rows are combined before the shuffle."""
    return logins.groupBy("login_id").agg(F.max("created_time").alias("created_time"))


def matched_logins(table: CassandraTable | FileTable | BucketedTable,
                   write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback: every login of a known user, against the table of this moment."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write(with_user(batch, _users(table, batch.sparkSession)), batch_id)

    return step


def update_last_login(table: CassandraTable | FileTable | BucketedTable,
                      show: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback: upsert the last login of each known user in the batch.

    Within a batch the latest login counts, across batches the one that arrives last.
    Logins are reduced to one per user first, which spares the join a user's many rows.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        newest = newest_login(batch)
        if isinstance(table, BucketedTable):
            _upsert_buckets(table, newest, batch_id, show)
            return
        rows = with_user(newest, _users(table, batch.sparkSession))
        if show:
            rows = rows.persist()
        try:
            table.upsert(rows, batch_id)
            if show:
                rows.show()
        finally:
            if show:
                rows.unpersist()

    return step


def _upsert_buckets(table: BucketedTable, newest: DataFrame, batch_id: int, show: bool) -> None:
    """The users of the batch alone are read; its logins, one a user, are kept for the passes over them."""
    newest = newest.persist()
    try:
        rows = with_user(newest, table.read_for(newest).select("login_id", "user_name"))
        if show:
            rows.show()
        table.upsert(rows, batch_id)
    finally:
        newest.unpersist()


def _users(table: CassandraTable | FileTable | BucketedTable, spark: SparkSession) -> DataFrame:
    return table.read(spark).select("login_id", "user_name")
