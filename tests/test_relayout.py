"""State carried over to another checkpoint: keys that grew hot, another number of partitions."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import publish, rows
from millrace.operators import skew
from millrace.operators.clicks import ROW_ID, clicks_from, impressions_from
from millrace.operators.skew import frozen
from millrace.plans import apps
from millrace.streaming.changelog import all_batches, last_per_key
from millrace.streaming.manifests import commit, committed
from millrace.streaming.positions import Positions, kafka_offsets, last_commit, one_form, read_files
from millrace.streaming.relayout import carried_over, join_state, positions
from millrace.streaming.runner import changelog_sink, drain, parquet_sink


def impression(key: str, campaign: str) -> dict:
    return {"InventoryID": key, "CreatedTime": "2020-01-01 00:00:00", "Campaigner": campaign}


def click(key: str, second: int) -> dict:
    return {"InventoryID": key, "CreatedTime": f"2020-01-01 00:{second // 60 % 60:02}:{second % 60:02}"}


def run_join(spark, topics, checkpoint: str) -> None:
    after = positions(spark, checkpoint)
    left, right = (topics.stream(spark, name, positions=True, after=after) for name in (apps.IMPRESSIONS, apps.CLICKS))
    hot = frozen(spark, f"{checkpoint}/hot-keys", lambda: apps.hot_inventory(
        topics.table(spark, apps.IMPRESSIONS), topics.table(spark, apps.CLICKS)))
    drain(parquet_sink(apps.matched_clicks(left, right, hot, checkpoint), f"{checkpoint}-out"), checkpoint)


def pairs(spark, *checkpoints: str) -> list[tuple]:
    found = [spark.read.parquet(f"{checkpoint}-out").withColumn("ClickTime", F.col("ClickTime").cast("string"))
             for checkpoint in checkpoints]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return rows(whole)


def held(spark, checkpoint: str) -> dict[int, int]:
    """Rows of state in each partition."""
    counts: dict[int, int] = {}
    for side in ("left", "right"):
        state = spark.read.format("statestore").option("joinSide", side).load(checkpoint)
        for row in state.groupBy("partition_id").count().collect():
            counts[row["partition_id"]] = counts.get(row["partition_id"], 0) + row["count"]
    return counts


def test_a_key_that_grows_hot_is_spread_in_the_next_checkpoint(spark, topics, tmp_path):
    chance = random.Random(1)
    keys = [str(i) for i in range(300)]
    impressions, clicks = [impression(key, "c") for key in keys], [click(chance.choice(keys), i) for i in range(600)]
    publish(spark, topics, apps.IMPRESSIONS, impressions)
    publish(spark, topics, apps.CLICKS, clicks)
    first, second, third = (str(tmp_path / name) for name in ("first", "second", "third"))
    run_join(spark, topics, first)
    assert spark.read.parquet(f"{first}/hot-keys").count() == 0

    # Null keys are held by neither side; equal messages are messages of their own.
    grown = [impression("7", f"c{i % 50}") for i in range(60)] + [impression(None, "c")]
    hot = [click("7", i % 100) for i in range(1200)] + [click(None, 1)]
    publish(spark, topics, apps.IMPRESSIONS, grown)
    publish(spark, topics, apps.CLICKS, hot)
    run_join(spark, topics, first)
    apps.carry_clicks(spark, first, second)
    apps.carry_clicks(spark, first, second)
    assert [row["key"] for row in spark.read.parquet(f"{second}/hot-keys").collect()] == ["7"]

    late = [impression("7", "late"), impression("8", "late")]
    more = [click("7", 7), click("7", 7), click("9", 9)] + [click(chance.choice(keys), i) for i in range(50)]
    publish(spark, topics, apps.IMPRESSIONS, late)
    publish(spark, topics, apps.CLICKS, more)
    run_join(spark, topics, second)
    counts = held(spark, second)
    assert max(counts.values()) <= 2 * sum(counts.values()) / 4

    # A second change begins from spread state.
    apps.carry_clicks(spark, second, third)
    last = [click("7", 11), click("10", 11)]
    publish(spark, topics, apps.CLICKS, last)
    run_join(spark, topics, third)
    run_join(spark, topics, third)

    left = [(i["InventoryID"], i["Campaigner"]) for i in impressions + grown + late if i["InventoryID"]]
    right = [(c["InventoryID"], c["CreatedTime"]) for c in clicks + hot + more + last if c["InventoryID"]]
    want = sorted(((key, "2020-01-01 00:00:00", campaign, key, time) for key, campaign in left
                   for other, time in right if key == other), key=repr)
    assert pairs(spark, first, second, third) == want


def test_rows_of_a_key_that_no_list_knows_are_held_in_packs(spark, topics, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    publish(spark, topics, apps.IMPRESSIONS, [impression(str(i), "c") for i in range(40)])
    clicks = [click(str(i), i) for i in range(40)]
    publish(spark, topics, apps.CLICKS, clicks)
    run_join(spark, topics, first)
    hot = [click("7", i % 600) for i in range(2000)]
    publish(spark, topics, apps.CLICKS, hot)
    run_join(spark, topics, first)
    assert spark.read.parquet(f"{first}/hot-keys").count() == 0
    held_rows = join_state(spark, first, "right", last_commit(spark, first)).select("ClickID", F.size("right_rows").alias("n"))
    assert held_rows.agg(F.sum("n")).first()[0] == 2040 and held_rows.where("ClickID = '7'").count() < 40

    apps.carry_clicks(spark, first, second)
    assert [row["key"] for row in spark.read.parquet(f"{second}/hot-keys").collect()] == ["7"]
    late = [click("7", 5), click("8", 5)]
    publish(spark, topics, apps.CLICKS, late)
    publish(spark, topics, apps.IMPRESSIONS, [impression("7", "late")])
    run_join(spark, topics, second)
    campaigns = {str(i): ["c"] for i in range(40)} | {"7": ["c", "late"]}
    assert pairs(spark, first, second) == sorted(
        ((c["InventoryID"], "2020-01-01 00:00:00", campaign, c["InventoryID"], c["CreatedTime"])
         for c in clicks + hot + late for campaign in campaigns[c["InventoryID"]]), key=repr)


def test_a_state_without_packs_is_carried_over(spark, topics, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    publish(spark, topics, apps.IMPRESSIONS, [impression("a", "c"), impression("b", "c")])
    publish(spark, topics, apps.CLICKS, [click("a", 1), click("a", 1), click("b", 2), click("z", 3)])
    left = impressions_from(topics.stream(spark, apps.IMPRESSIONS, positions=True)).drop(*ROW_ID)
    right = clicks_from(topics.stream(spark, apps.CLICKS, positions=True)).drop(*ROW_ID)
    drain(parquet_sink(left.join(right, left.ImpressionID == right.ClickID), f"{first}-out"), first)
    apps.carry_clicks(spark, first, second)
    publish(spark, topics, apps.IMPRESSIONS, [impression("z", "c"), impression("a", "late")])
    run_join(spark, topics, second)
    time = "2020-01-01 00:00:0"
    assert pairs(spark, second) == [("a", f"{time}0", "late", "a", f"{time}1")] * 2 + [("z", f"{time}0", "c", "z", f"{time}3")]


def test_packs_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(skew, "PACK", 10)
    chance = random.Random(3)
    plain = [(chance.choice(["a", "b", None, *map(str, range(50))]), i % 2, i if i % 7 else None, f"t{i}") for i in range(500)]
    plain += [("hot", 1, i, None) for i in range(333)]
    chance.shuffle(plain)
    df = spark.createDataFrame(plain, "key string, cell long, number long, text string").repartition(3)
    packs = skew.packed(df, ["key", "cell"], "some_rows")
    assert packs.columns == ["key", "cell", "some_rows"]
    fuller = skew.packed(packs.repartition(2), ["key", "cell"], "some_rows")
    for found, most in ((packs, 10), (fuller, 19)):
        assert max(len(row["some_rows"]) for row in found.collect()) <= most
        assert rows(skew.unpacked(found, "some_rows")) == sorted((row for row in plain if row[0] is not None), key=repr)
    assert fuller.count() < packs.count() < 500


def item(card: str, total: float) -> dict:
    return {"CustomerType": "PRIME", "CustomerCardNo": card, "TotalValue": total}


def run_rewards(spark, topics, checkpoint: str) -> None:
    messages = topics.stream(spark, apps.ITEMS, files_per_trigger=1, after=positions(spark, checkpoint))
    # From JSON items, as the package for Avro is not here.
    drain(changelog_sink(apps.card_totals(messages, checkpoint=checkpoint), f"{checkpoint}-out"), checkpoint, mode="update")


def totals(spark, checkpoint: str) -> list[tuple]:
    return rows(last_per_key(all_batches(spark, f"{checkpoint}-out"), ["CustomerCardNo"]))


def test_the_rows_a_join_holds_are_read_in_one_scan(spark, topics, tmp_path):
    publish(spark, topics, apps.IMPRESSIONS, [impression("a", "c"), impression("b", "c"), impression(None, "c")])
    publish(spark, topics, apps.CLICKS, [click("a", i) for i in range(50)] + [click("b", 1), click("z", 2)])
    checkpoint = str(tmp_path / "c")
    run_join(spark, topics, checkpoint)
    for side in ("left", "right"):
        found = join_state(spark, checkpoint, side, last_commit(spark, checkpoint))
        whole = spark.read.format("statestore").option("joinSide", side).load(checkpoint).select("value.*")
        assert found.schema.simpleString() == whole.schema.simpleString() and rows(found) == rows(whole)
        # Reading a side looks up every row of a key by its number.
        assert "joinSide" not in found._jdf.queryExecution().toString()


def test_totals_go_on_with_more_partitions(spark, topics, tmp_path):
    whole, first, second, third = (str(tmp_path / name) for name in ("whole", "first", "second", "third"))
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", "8")
    parts = [[item(str(i % 7), 10.0 + i) for i in range(40)], [item(str(i % 5), 2.0) for i in range(20)],
             [item("0", 1.0), item("new", 5.0), item("1", -3.0)], [item("0", 100.0)]]
    publish(session, topics, apps.ITEMS, *parts[:2])
    run_rewards(session, topics, first)
    publish(session, topics, apps.ITEMS, parts[2])
    session.conf.set("spark.sql.shuffle.partitions", "32")
    apps.carry_rewards(session, first, second)
    run_rewards(session, topics, second)
    assert session.read.format("state-metadata").load(second).first()["numPartitions"] == 32
    # Cards that no later item changes are not emitted again.
    assert {row["CustomerCardNo"] for row in all_batches(session, f"{second}-out").collect()} == {"0", "1", "new"}
    session.conf.set("spark.sql.shuffle.partitions", "3")
    apps.carry_rewards(session, second, third)
    publish(session, topics, apps.ITEMS, parts[3])
    run_rewards(session, topics, third)
    session.conf.set("spark.sql.shuffle.partitions", "8")
    run_rewards(session, topics, whole)
    latest = {row[0]: row for checkpoint in (first, second, third) for row in totals(session, checkpoint)}
    assert sorted(latest.values(), key=repr) == totals(session, whole)


def test_a_carry_over_that_failed_is_made_again(spark, topics, tmp_path, monkeypatch):
    publish(spark, topics, apps.ITEMS, [item("a", 10.0)])
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    with pytest.raises(ValueError):
        apps.carry_rewards(spark, old, new)
    run_rewards(spark, topics, old)

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patched:
        patched.setattr("millrace.streaming.relayout.read_files", broken)
        with pytest.raises(OSError):
            apps.carry_rewards(spark, old, new)
    assert not carried_over(spark, new) and positions(spark, new) is None
    apps.carry_rewards(spark, old, new)
    publish(spark, topics, apps.ITEMS, [item("a", 5.0)])
    run_rewards(spark, topics, new)
    assert totals(spark, new) == [("a", 15.0, 3)]


def test_positions_of_both_kinds_of_topics(spark, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    for number, ends in ((0, [{"logOffset": 0}, {"t": {"0": 5}}]), (1, [{"logOffset": 1}, {"t": {"0": 9, "1": 3}}]),
                         (2, [{"logOffset": 2}, {"t": {"0": 20}}])):
        (tmp_path / "checkpoint" / "offsets").mkdir(parents=True, exist_ok=True)
        (tmp_path / "checkpoint" / "offsets" / str(number)).write_text(
            "\n".join(["v1", "{}", *map(json.dumps, ends)]))
        (tmp_path / "checkpoint" / "sources" / "0").mkdir(parents=True, exist_ok=True)
        (tmp_path / "checkpoint" / "sources" / "0" / str(number)).write_text(
            "v1\n" + json.dumps({"path": f"file:///f{number}", "timestamp": 1, "batchId": number}))
    (tmp_path / "checkpoint" / "commits").mkdir()
    for number in (0, 1):
        (tmp_path / "checkpoint" / "commits" / str(number)).write_text("v1\n{}")
    # Batch 2 was planned, not finished.
    assert last_commit(spark, checkpoint) == 1
    assert rows(read_files(spark, checkpoint)) == [("file:/f0",), ("file:/f1",)]
    assert kafka_offsets(spark, checkpoint) == {"t": {"0": 9, "1": 3}}
    commit(spark, f"{tmp_path}/positions/offsets.json", kafka_offsets(spark, checkpoint))
    kept = Positions(f"{tmp_path}/positions")
    assert json.loads(kept.offsets(spark, "t")) == {"t": {"0": 9, "1": 3}} and kept.offsets(spark, "other") is None


def test_manifests_are_decided_once(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    assert committed(spark, path) is None
    commit(spark, path, ["x", 1])
    with pytest.raises(FileExistsError):
        commit(spark, path, [])
    assert committed(spark, path) == ["x", 1]
    paths = spark.createDataFrame([("file:///a",), ("file:/a",), ("hdfs://name:1/a",)], "p string")
    assert rows(paths.select(one_form(F.col("p")))) == [("file:/a",), ("file:/a",), ("hdfs://name:1/a",)]
