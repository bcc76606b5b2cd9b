"""Logins joined with the user table, and the upsert of the last login."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import messages, publish, rows
from millrace.functions.times import format_time
from millrace.operators.logins import (logins_from, matched_logins, newest_login, update_last_login,
                                       with_user)
from millrace.plans import apps
from millrace.schemas import USER
from millrace.sources.tables import FileTable
from millrace.streaming.changelog import all_batches, batch_writer
from millrace.streaming.runner import drain

USERS = [("u1", "Asha", dt.datetime(2021, 4, 1, 8, 0)),
         ("u2", "Bela", dt.datetime(2021, 4, 2, 23, 59, 59)),
         ("u3", "Chen", None),
         ("u4", None, dt.datetime(1999, 12, 31)),
         ("u5", "Dana", dt.datetime(2022, 1, 1))]


def login(user, time):
    return {"created_time": f"2023-05-06 {time}:00" if time else None, "login_id": user}


@pytest.fixture
def users(spark, tmp_path) -> FileTable:
    spark.createDataFrame(USERS, USER).write.parquet(str(tmp_path / "users"))
    return FileTable(str(tmp_path / "users"), str(tmp_path / "changes"), "login_id", USER)


def text(df):
    return rows(df.select("login_id", "user_name", format_time("last_login").alias("last_login")))


def run(spark, topics, users, tmp_path, **options):
    return drain(apps.record_logins(topics.stream(spark, "logins"), users, **options),
                 str(tmp_path / "checkpoint"), mode="update")


def test_unknown_users_are_dropped(spark, users):
    logins = logins_from(messages(spark, [login("u1", "10:18"), login("999", "10:18"),
                                          login(None, "10:18"), "not json", None]))
    found = with_user(logins, users.read(spark).select("login_id", "user_name"))
    assert found.columns == ["login_id", "user_name", "last_login"]
    assert text(found) == [("u1", "Asha", "2023-05-06 10:18:00")]


def test_every_login_joins(spark, topics, users, tmp_path):
    publish(spark, topics, "logins", [login("u1", "10:18"), login("u1", "10:17")],
            [login("u2", "10:20"), login("u1", None)])
    step = matched_logins(users, batch_writer(str(tmp_path / "out")))
    stream = logins_from(topics.stream(spark, "logins", files_per_trigger=1))
    drain(stream.writeStream.foreachBatch(step), str(tmp_path / "c"), mode="update")
    assert text(all_batches(spark, str(tmp_path / "out"))) == [
        ("u1", "Asha", "2023-05-06 10:17:00"), ("u1", "Asha", "2023-05-06 10:18:00"),
        ("u1", "Asha", None), ("u2", "Bela", "2023-05-06 10:20:00")]


def test_newest_login_per_user(spark):
    logins = logins_from(messages(spark, [login("a", "10:00"), login("a", "12:00"), login("a", None),
                                          login("b", None)]))
    found = newest_login(logins).select("login_id", format_time("created_time"))
    assert rows(found) == [("a", "2023-05-06 12:00:00"), ("b", None)]


def test_upsert_latest_within_a_batch_last_batch_across(spark, topics, users, tmp_path):
    publish(spark, topics, "logins", [login("u1", "10:18"), login("u1", "10:30"), login("999", "10:00")])
    run(spark, topics, users, tmp_path, show=True)
    publish(spark, topics, "logins", [login("u2", "09:00"), login("u1", "08:00")])
    run(spark, topics, users, tmp_path)
    assert text(users.current(spark)) == [
        ("u1", "Asha", "2023-05-06 08:00:00"), ("u2", "Bela", "2023-05-06 09:00:00"), ("u3", "Chen", None),
        ("u4", None, "1999-12-31 00:00:00"), ("u5", "Dana", "2022-01-01 00:00:00")]


def test_users_added_later_are_seen_by_later_batches(spark, topics, users, tmp_path):
    publish(spark, topics, "logins", [login("7", "10:00")])
    run(spark, topics, users, tmp_path)
    spark.createDataFrame([("7", "Late", None)], USER).write.mode("append").parquet(users.base)
    publish(spark, topics, "logins", [login("7", "11:00")])
    run(spark, topics, users, tmp_path)
    # The login at 10:00 met no user and is lost.
    changes = all_batches(spark, users.changes)
    assert text(changes.where("login_id = '7'")) == [("7", "Late", "2023-05-06 11:00:00")]


def test_a_user_appears_while_the_stream_runs(spark, topics, users, tmp_path):
    publish(spark, topics, "logins", [login("7", "10:00")], [login("7", "11:00")])
    step = update_last_login(users)

    def add_user_after_first(batch, batch_id):
        step(batch, batch_id)
        if batch_id == 0:
            batch.sparkSession.createDataFrame([("7", "Late", None)], USER) \
                .write.mode("append").parquet(users.base)

    stream = logins_from(topics.stream(spark, "logins", files_per_trigger=1))
    drain(stream.writeStream.foreachBatch(add_user_after_first), str(tmp_path / "c"), mode="update")
    assert text(users.current(spark).where("login_id = '7'")) == [("7", "Late", "2023-05-06 11:00:00")]


def test_repeated_batch_does_not_double(spark, users):
    batch = logins_from(messages(spark, [login("u1", "10:18")]))
    step = update_last_login(users)
    step(batch, 0)
    before = text(users.current(spark))
    step(batch, 0)
    assert text(users.current(spark)) == before
    assert all_batches(spark, users.changes).count() == 1


def test_changes_may_add_users_and_take_values_back(spark, users):
    users.upsert(spark.createDataFrame([("1", "One", None), ("u1", "Asha", None)], USER), 0)
    users.upsert(spark.createDataFrame([("1", "Two", dt.datetime(2020, 1, 1))], USER), 1)
    found = users.current(spark)
    assert found.columns == USER.names
    assert text(found)[:2] == [("1", "Two", "2020-01-01 00:00:00"), ("u1", "Asha", None)]
    assert found.count() == 6


def test_table_without_changes_is_its_base(spark, users):
    assert text(users.current(spark)) == text(spark.createDataFrame(USERS, USER))


def test_logins_are_reduced_before_the_join(spark, users):
    logins = logins_from(messages(spark, [login("u1", "10:18")]))
    joined = with_user(newest_login(logins), users.read(spark).select("login_id", "user_name"))
    query = joined._jdf.queryExecution()
    plan = query.optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
    assert "ReadSchema: struct<login_id:string,user_name:string>" in query.executedPlan().toString()


def test_changes_are_merged_into_a_new_base(spark, users, tmp_path):
    table = FileTable(users.base, users.changes, users.key, users.schema, merge_every=2)
    for number in range(6):
        rows_now = [("u1", f"name{number}", None), (f"new{number}", "n", None)]
        table.upsert(spark.createDataFrame(rows_now, USER), number)
        if number == 3:
            spark.createDataFrame([("late", "Late", None)], USER).write.mode("append").parquet(users.base)
        merged = text(table.current(spark))
        assert ("u1", f"name{number}", None) in merged and len(merged) == len(USERS) + number + 1 + (number >= 3)
    left = sorted(path.name for path in (tmp_path / "changes").glob("batch_id=*"))
    assert left == ["batch_id=2", "batch_id=3", "batch_id=4", "batch_id=5"]
    assert [path.name for path in (tmp_path / "changes" / "_bases").glob("upto=*")] != []
    # A base whose writing was cut off does not count.
    (tmp_path / "changes" / "_bases" / "upto=3" / "_SUCCESS").unlink()
    assert ("u1", "name5", None) in text(table.current(spark))
