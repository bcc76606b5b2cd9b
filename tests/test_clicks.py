"""Stream-stream join, plain and with hot keys spread."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import messages, publish, rows
from millrace.functions.times import format_time
from millrace.operators.clicks import clicks_from, impression_clicks, impressions_from
from millrace.operators.skew import HOT_KEYS, frozen, grid, hot_keys
from millrace.plans import apps
from millrace.streaming.runner import drain, parquet_sink

IMPRESSIONS = [
    {"InventoryID": "a1", "CreatedTime": "2023-05-06 07:00:00", "Campaigner": "North"},
    {"InventoryID": "a2", "CreatedTime": "2023-05-06 07:00:01", "Campaigner": "South"},
    {"InventoryID": "b7", "CreatedTime": "2023-05-05 23:59:59", "Campaigner": "North"},
]
CLICKS = [{"InventoryID": number, "CreatedTime": f"2023-05-06 08:00:{second:02}"}
          for second, number in enumerate(["a1", "b7", "a1", "a1", "unknown", "b7"])]


def joined(spark, topics, tmp_path, hot=None, files=1):
    found = apps.matched_clicks(topics.stream(spark, "impressions", files_per_trigger=files, positions=True),
                                topics.stream(spark, "clicks", files_per_trigger=files, positions=True), hot)
    query = drain(parquet_sink(found, str(tmp_path / "out")), str(tmp_path / "checkpoint"))
    return query, spark.read.parquet(str(tmp_path / "out"))


def expected(impressions, clicks):
    return sorted(((i["InventoryID"], i["CreatedTime"], i["Campaigner"], c["InventoryID"], c["CreatedTime"])
                   for i in impressions for c in clicks
                   if i["InventoryID"] is not None and i["InventoryID"] == c["InventoryID"]), key=repr)


def as_text(df):
    return rows(df.withColumn("ClickTime", format_time("ClickTime")))


def test_sample_with_clicks_arriving_in_parts(spark, topics, tmp_path):
    publish(spark, topics, "impressions", IMPRESSIONS[:2], IMPRESSIONS[2:])
    publish(spark, topics, "clicks", CLICKS[:1], CLICKS[1:4], CLICKS[4:])
    _, found = joined(spark, topics, tmp_path)
    assert found.columns == ["ImpressionID", "CreatedTime", "Campaigner", "ClickID", "ClickTime"]
    assert dict(found.dtypes)["CreatedTime"] == "string" and dict(found.dtypes)["ClickTime"] == "timestamp"
    got = as_text(found)
    assert len(got) == 5 and got == expected(IMPRESSIONS, CLICKS)


def test_null_keys_and_bad_messages_never_match(spark, topics, tmp_path):
    publish(spark, topics, "impressions", [{"Campaigner": "x"}, "not json", IMPRESSIONS[0]])
    publish(spark, topics, "clicks", [{"CreatedTime": "2023-05-06 08:00:00"}, None, "", CLICKS[0],
                                      {"InventoryID": "a1", "CreatedTime": "late"}])
    _, found = joined(spark, topics, tmp_path)
    assert [row[3:] for row in as_text(found)] == [("a1", "2023-05-06 08:00:00"), ("a1", None)]


def test_only_append_mode(spark, topics, tmp_path):
    publish(spark, topics, "impressions", IMPRESSIONS)
    publish(spark, topics, "clicks", CLICKS)
    found = apps.matched_clicks(topics.stream(spark, "impressions", positions=True),
                                topics.stream(spark, "clicks", positions=True))
    with pytest.raises(Exception, match="(?i)complete"):
        drain(parquet_sink(found, str(tmp_path / "out")), str(tmp_path / "c"), mode="complete")


def skewed(count, share, seed):
    draw = random.Random(seed)
    return ["hot" if draw.random() < share else f"k{draw.randrange(20)}" for _ in range(count)]


@pytest.mark.parametrize("cut", [(1, 5), (4, 1), (3, 4)])
def test_spread_join_equals_brute_force(spark, cut):
    impressions = [{"InventoryID": key, "CreatedTime": str(n), "Campaigner": "c"}
                   for n, key in enumerate(skewed(60, 0.4, 1))]
    clicks = [{"InventoryID": key, "CreatedTime": "2023-05-06 08:00:00"} for key in skewed(80, 0.4, 2)]

    def numbered(values):
        return messages(spark, values).withColumns({"partition": F.lit(0), "offset": F.monotonically_increasing_id()})

    hot = spark.createDataFrame([("hot", *cut), ("never", 2, 2)], HOT_KEYS)
    found = impression_clicks(impressions_from(numbered(impressions)), clicks_from(numbered(clicks)), hot)
    assert as_text(found) == expected(impressions, clicks)


def test_hot_key_of_a_stream_is_spread_over_state_partitions(spark, topics, tmp_path):
    impressions = [{"InventoryID": key, "CreatedTime": "t", "Campaigner": "c"} for key in ["hot", "k1", "k2"]]
    clicks = [{"InventoryID": key, "CreatedTime": "2023-05-06 08:00:00"} for key in skewed(300, 0.9, 3)]
    publish(spark, topics, "impressions", impressions)
    publish(spark, topics, "clicks", clicks[:150], clicks[150:])
    hot = frozen(spark, str(tmp_path / "hot"), lambda: spark.createDataFrame([("hot", 1, 16)], HOT_KEYS))
    _, found = joined(spark, topics, tmp_path, hot)
    assert as_text(found) == expected(impressions, clicks)
    state = spark.read.format("statestore").option("joinSide", "right").load(str(tmp_path / "checkpoint"))
    per_task = state.where("value.ClickID = 'hot'").groupBy("partition_id").count().collect()
    assert len(per_task) == 4 and max(row["count"] for row in per_task) < 0.6 * 300


def test_spread_join_goes_on_after_a_restart(spark, topics, tmp_path):
    impressions = [{"InventoryID": key, "CreatedTime": str(n), "Campaigner": "c"}
                   for n, key in enumerate(skewed(40, 0.5, 5))]
    clicks = [{"InventoryID": key, "CreatedTime": "2023-05-06 08:00:00"} for key in skewed(40, 0.5, 6)]
    for half in (slice(0, 20), slice(20, 40)):
        publish(spark, topics, "clicks", clicks[half])
        publish(spark, topics, "impressions", impressions[half])
        hot = frozen(spark, str(tmp_path / "hot"), lambda: spark.createDataFrame([("hot", 3, 2)], HOT_KEYS))
        _, found = joined(spark, topics, tmp_path, hot, files=None)
    assert as_text(found) == expected(impressions, clicks)


def test_hot_keys_are_found(spark):
    keys = ["hot"] * 600 + [f"k{n}" for n in range(400)]
    many = messages(spark, [{"InventoryID": key} for key in keys])
    few = messages(spark, [{"InventoryID": f"k{n}"} for n in range(400)] + [{"InventoryID": None}] * 600)
    key = F.get_json_object(F.col("value").cast("string"), "$.InventoryID")
    # A load of 600 / 2000 * 8 fair shares, cut into about twice as many cells.
    assert rows(hot_keys(few, key, many, key, partitions=8)) == [("hot", 1, 5)]
    assert rows(hot_keys(many, key, few, key, partitions=8)) == [("hot", 5, 1)]
    assert rows(hot_keys(many, key, many, key, partitions=8)) == [("hot", 3, 3)]
    assert hot_keys(few, key, few, key, partitions=8).isEmpty()
    assert hot_keys(few.limit(0), key, few.limit(0), key, partitions=8).isEmpty()


@pytest.mark.parametrize("left,right", [(1, 1), (1, 1000), (1000, 1), (0, 5), (5, 0), (30, 1)])
@pytest.mark.parametrize("load", [0.5, 20, 400])
def test_a_grid_has_about_as_many_cells_as_asked_for(left, right, load):
    left_parts, right_parts = grid(left, right, load)
    assert left_parts * right_parts <= 1.5 * load + 2
    if load >= 20:
        assert left_parts * right_parts >= 0.6 * load
        # The copies of both sides together stay near what evenly split rows need.
        copies = left * right_parts + right * left_parts
        assert copies <= 3 * (left + right) * max(1, load ** 0.5)


def test_both_sides_hot_at_a_thousand_partitions(spark):
    rows_now = spark.range(10000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    [(_, left, right)] = rows(hot_keys(rows_now, F.col("k"), rows_now, F.col("k"), 1000).where("key = 'hot'"))
    assert left == right == 20


def test_hot_key_list_stays_as_first_found(spark, tmp_path):
    path = str(tmp_path / "hot")
    first = frozen(spark, path, lambda: spark.createDataFrame([("a", 1, 2)], HOT_KEYS))
    later = frozen(spark, path, lambda: pytest.fail("found again"))
    assert rows(first) == rows(later) == [("a", 1, 2)]
    given = spark.createDataFrame([("a", 1, 2)], HOT_KEYS)
    assert rows(frozen(spark, path, lambda: pytest.fail("found again"), given)) == [("a", 1, 2)]
    with pytest.raises(ValueError, match="hot keys"):
        frozen(spark, path, lambda: pytest.fail("found again"), spark.createDataFrame([("b", 1, 2)], HOT_KEYS))


def test_join_is_not_a_nested_loop(spark):
    df = messages(spark, IMPRESSIONS).withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("bigint")})
    hot = spark.createDataFrame([("hot", 2, 3)], HOT_KEYS)
    plan = impression_clicks(impressions_from(df), clicks_from(df), hot)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and plan.count("from_json") == 2
