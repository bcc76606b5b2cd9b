"""Topics, output modes, triggers, restarts."""

from __future__ import annotations

from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import TESTDATA, publish, rows
from millrace import session
from millrace.plans import apps, feeds
from millrace.schemas import TOPIC, TOPIC_HEADER, flat_schema
from millrace.sources.topics import Topics
from millrace.streaming.changelog import all_batches, batch_writer, last_batch, last_per_key
from millrace.streaming.progress import ProgressLog
from millrace.streaming.runner import (changelog_sink, console_sink, drain, parquet_sink, snapshot_sink,
                                       start)
from test_invoices import invoice, item


def test_topics_are_a_folder_or_brokers():
    for wrong in ({}, {"folder": "a", "brokers": "b"}):
        with pytest.raises(ValueError):
            Topics(**wrong)


def test_topic_columns_are_the_same_for_tables_and_streams(spark, topics):
    publish(spark, topics, "t", ["a", "b"], ["c"])
    table = topics.table(spark, "t", positions=True)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in TOPIC]
    stream = topics.stream(spark, "t")
    assert [(f.name, f.dataType) for f in stream.schema] == [(f.name, f.dataType) for f in TOPIC]
    got = table.select(F.col("value").cast("string"), "topic", "partition", "offset").collect()
    assert {row.value: row.offset for row in got} == {"a": 0, "b": 1, "c": 0}
    assert len({(row.partition, row.offset) for row in got}) == 3
    assert topics.table(spark, "nothing").count() == 0


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        Topics(brokers="localhost:9092").stream(spark, "invoices")


def test_only_the_value_is_read(spark, topics):
    publish(spark, topics, "invoices", [invoice("a", [item()])])
    from millrace.operators.invoices import flatten_messages
    plan = flatten_messages(topics.table(spark, "invoices"), TOPIC_HEADER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<value:binary>" in plan and "Exchange" not in plan


def test_stream_published_topic_is_read_again(spark, topics, tmp_path):
    publish(spark, topics, "in", ["a"], ["b"])
    drain(topics.sink(topics.stream(spark, "in", files_per_trigger=1), "out"), str(tmp_path / "c1"))
    drain(topics.sink(topics.stream(spark, "out"), "again"), str(tmp_path / "c2"))
    assert [bytes(row.value) for row in topics.table(spark, "again").orderBy("value").collect()] == [b"a", b"b"]


def test_changelog_topic_is_read_as_table_and_stream(spark, topics, tmp_path):
    publish(spark, topics, "in", ["a"], ["a"])
    counts = apps.counted_words(topics.stream(spark, "in", files_per_trigger=1).selectExpr(
        "cast(value as string) as value")).selectExpr("word as key", "cast(count as string) as value")
    drain(topics.sink(counts, "out", mode="update"), str(tmp_path / "c1"), mode="update")
    assert sorted(bytes(row.value) for row in topics.table(spark, "out").collect()) == [b"1", b"2"]
    drain(topics.sink(topics.stream(spark, "out"), "again"), str(tmp_path / "c2"))
    assert topics.table(spark, "again").count() == 2


def test_restart_neither_loses_nor_repeats(spark, topics, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for number in range(3):
        publish(spark, topics, "invoices", [invoice(f"n{number}", [item("x"), item("y")])])
        for _ in range(2):  # the second run finds nothing new
            drain(apps.flatten_topic(topics.stream(spark, "invoices"), out), checkpoint)
    found = spark.read.schema(flat_schema(TOPIC_HEADER)).json(out)
    assert rows(found.select("InvoiceNumber", "ItemCode")) == [
        (f"n{number}", code) for number in range(3) for code in "xy"]


def test_state_survives_a_restart(spark, topics, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for words in (["a", "b"], ["a"]):
        publish(spark, topics, "t", words)
        lines = topics.stream(spark, "t").select(F.col("value").cast("string"))
        drain(changelog_sink(apps.counted_words(lines), out), checkpoint, mode="update")
    emitted = all_batches(spark, out)
    assert rows(emitted) == [("a", 1, 0), ("a", 2, 1), ("b", 1, 0)]
    assert rows(last_per_key(emitted, ["word"])) == [("a", 2), ("b", 1)]


def test_a_repeated_batch_replaces_its_folder(spark, tmp_path):
    write = batch_writer(str(tmp_path / "out"))
    write(spark.range(3), 0)
    write(spark.range(2), 0)
    assert all_batches(spark, str(tmp_path / "out")).count() == 2


def test_last_value_may_be_null(spark):
    changes = spark.createDataFrame([("a", 1, 0), ("a", None, 1), (None, 5, 0)], "k string, v int, batch_id bigint")
    assert rows(last_per_key(changes, ["k"])) == sorted([("a", None), (None, 5)], key=repr)


@pytest.mark.parametrize("mode,good", [("append", False), ("update", True), ("complete", True)])
def test_running_totals_need_update_or_complete(spark, topics, tmp_path, mode, good):
    publish(spark, topics, "t", ["a b"])
    counts = apps.counted_words(topics.stream(spark, "t").select(F.col("value").cast("string")))
    writer = changelog_sink(counts, str(tmp_path / "out"))
    if good:
        drain(writer, str(tmp_path / "c"), mode=mode)
        assert all_batches(spark, str(tmp_path / "out")).count() == 2
    else:
        with pytest.raises(AnalysisException):
            drain(writer, str(tmp_path / "c"), mode=mode)


def test_console_with_an_interval_and_a_name(spark, topics, tmp_path):
    publish(spark, topics, "t", ["a"])
    lines = topics.stream(spark, "t").select(F.col("value").cast("string"))
    query = start(console_sink(lines), str(tmp_path / "c"), name="shown", interval="1 minute")
    try:
        query.processAllAvailable()
        assert query.name == "shown"
        assert sum(progress["numInputRows"] for progress in query.recentProgress) == 1
    finally:
        query.stop()


def test_the_state_has_a_partition_for_every_core(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(feeds, "LEAST_PARTITIONS", 1)
    monkeypatch.setattr(feeds, "engine_session", lambda session, **settings: asked.update(settings) or session)
    feeds.Tables.of(spark, TESTDATA)
    assert asked["state_partitions"] == spark.sparkContext.defaultParallelism


def bytes_to_driver(spark, query) -> int:
    """Size of the results of all tasks that a query ran."""
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {stage for job in tracker.getJobIdsForGroup(str(query.runId)) for stage in tracker.getJobInfo(job).stageIds}
    assert stages
    return sum(store.lastStageAttempt(stage).resultSize() for stage in stages)


def test_a_task_of_the_feeds_does_not_grow_with_the_tables(spark, monkeypatch):
    partitions = {}
    for gigabytes in (1, 6):
        monkeypatch.setattr(feeds, "folder_size", lambda *_, size=gigabytes << 30: (size, 14))
        fresh = spark.newSession()
        conf = feeds.Tables.of(fresh, "/any").spark.conf
        batch, state = (int(conf.get(f"spark.sql.{name}")) for name in
                        ("adaptive.coalescePartitions.initialPartitionNum", "shuffle.partitions"))
        # Rows take some thirty times the bytes of the tables' files, and a task has some 1.5 GB; each partition of the state is stores in memory.
        assert batch >= gigabytes * 100 and state <= max(8, fresh.sparkContext.defaultParallelism, gigabytes * 8)
        partitions[gigabytes] = batch
    assert partitions[6] == 6 * partitions[1]


def test_the_console_takes_the_whole_batch_and_brings_few_rows(spark, tmp_path, capsys):
    spark.range(0, 5000, numPartitions=4).withColumn("text", F.lit("x" * 2000)).write.parquet(str(tmp_path / "in"))
    lines = spark.readStream.schema("id bigint, text string").parquet(str(tmp_path / "in"))
    seen = lines.observe("seen", F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))
    for show in (0, 2):
        query = drain(console_sink(seen, show=show), str(tmp_path / f"c{show}"))
        # Of 10 MB of rows.
        assert bytes_to_driver(spark, query) < 1_000_000
        assert [tuple(p.observedMetrics["seen"]) for p in query.recentProgress] == [(5000, 12497500)]
        shown = capsys.readouterr().out
        assert "Batch: 0" in shown and f"only showing top {show} rows" in shown
        assert sum(line.startswith("|") for line in shown.splitlines()) == 1 + show


def test_the_console_leaves_the_state_whole(spark, tmp_path):
    spark.range(0, 1000, numPartitions=4).write.parquet(str(tmp_path / "in"))
    numbers = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    counts = numbers.groupBy((F.col("id") % 100).alias("rest")).count()
    drain(console_sink(counts, show=1), str(tmp_path / "c"), mode="update")
    state = spark.read.format("statestore").load(str(tmp_path / "c"))
    assert rows(state.select("key.*", "value.*")) == sorted([(rest, 10) for rest in range(100)], key=repr)


def test_default_trigger_starts_the_next_batch_at_once(spark, topics, tmp_path):
    publish(spark, topics, "t", ["a"])
    lines = topics.stream(spark, "t").select(F.col("value").cast("string"))
    query = start(parquet_sink(lines, str(tmp_path / "out")), str(tmp_path / "c"))
    try:
        query.processAllAvailable()
        publish(spark, topics, "t", ["b"])
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("a",), ("b",)]


def test_a_failing_batch_raises(spark, topics, tmp_path):
    publish(spark, topics, "t", ["a"])

    def fail(batch, batch_id):
        raise RuntimeError("no sink")

    with pytest.raises(Exception, match="no sink"):
        drain(topics.stream(spark, "t").writeStream.foreachBatch(fail), str(tmp_path / "c"))


def test_wrong_modes_and_triggers():
    with pytest.raises(ValueError):
        start(None, "c", mode="merge")
    with pytest.raises(ValueError):
        start(None, "c", interval="1 minute", until_caught_up=True)


def test_engine_session_is_apart_from_the_callers(spark):
    other = session.engine_session(spark, input_bytes=10 * session.BYTES_PER_SHUFFLE_PARTITION)
    assert other.conf.get("spark.sql.session.timeZone") == "UTC"
    assert other.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert "RocksDB" in other.conf.get("spark.sql.streaming.stateStore.providerClass")
    other.conf.set("spark.sql.shuffle.partitions", "77")
    assert spark.conf.get("spark.sql.shuffle.partitions") != "77"


def test_state_partitions_are_the_configured_ones():
    conf = {"spark.sql.shuffle.partitions": "200"}
    two_cores, inner = MagicMock(), MagicMock()
    two_cores.sparkContext.defaultParallelism = 2
    two_cores.conf.getAll = {}
    two_cores.newSession.return_value = inner
    inner.conf.get.side_effect = lambda key, default=None: conf.get(key, default)
    inner.conf.set.side_effect = conf.__setitem__
    session.engine_session(two_cores)
    assert conf["spark.sql.shuffle.partitions"] == "200"


def test_large_batch_shuffles_have_no_cap():
    conf = {"spark.sql.shuffle.partitions": "200"}
    spark, inner = MagicMock(), MagicMock()
    spark.conf.getAll = {}
    spark.newSession.return_value = inner
    inner.conf.get.side_effect = lambda key, default=None: conf.get(key, default)
    inner.conf.set.side_effect = conf.__setitem__
    session.engine_session(spark, input_bytes=10**6 * session.BYTES_PER_SHUFFLE_PARTITION)
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(10**6)


@pytest.mark.parametrize("mode", ["append", "update"])
def test_writers_of_a_topic_never_meet(spark, topics, tmp_path, mode):
    def copy(source, checkpoint):
        messages = topics.stream(spark, source).select("key", "value")
        if mode == "update":
            messages = messages.groupBy("value").count().select(F.lit("k").alias("key"), "value")
        drain(topics.sink(messages, "out", mode=mode), str(tmp_path / checkpoint), mode=mode)

    def values():
        return sorted(int(bytes(row.value)) for row in topics.table(spark, "out").collect())

    publish(spark, topics, "a", [str(n) for n in range(10)])
    publish(spark, topics, "b", [str(n) for n in range(10, 20)])
    copy("a", "ca")
    copy("b", "cb")
    publish(spark, topics, "out", [str(n) for n in range(20, 30)])
    assert values() == list(range(30))
    publish(spark, topics, "a", ["30"])
    copy("a", "ca")  # a restart
    assert values() == list(range(31))
    copy("b", "cc")  # a new checkpoint is a new writer, which sends everything once more
    assert values() == sorted([*range(31), *range(10, 20)])
    drain(parquet_sink(topics.stream(spark, "out").select("value"), str(tmp_path / "all")), str(tmp_path / "cd"))
    assert spark.read.parquet(str(tmp_path / "all")).count() == 41


def test_superseded_snapshots_go(spark, topics, tmp_path):
    out = str(tmp_path / "out")
    publish(spark, topics, "t", ["a"], ["b"], ["a"], ["c"])
    lines = topics.stream(spark, "t", files_per_trigger=1).select(F.col("value").cast("string"))
    drain(snapshot_sink(apps.counted_words(lines), out), str(tmp_path / "c"), mode="complete")
    assert sorted(path.name for path in (tmp_path / "out").glob("batch_id=*")) == ["batch_id=2", "batch_id=3"]
    assert rows(last_batch(spark, out)) == [("a", 2), ("b", 1), ("c", 1)]


def test_results_of_an_input_without_a_batch_are_empty(spark, tmp_path):
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])
    for found in (all_batches(spark, str(tmp_path / "none"), schema), last_batch(spark, str(tmp_path / "none"), schema)):
        assert found.count() == 0 and found.columns[:2] == ["word", "count"]
    with pytest.raises(AnalysisException):
        all_batches(spark, str(tmp_path / "none"))


def test_scratch_space_is_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_dir(spark, "x")
    assert path != session.scratch_dir(spark, "x")
    if root:
        assert path.startswith(root)


def test_scratch_space_of_a_cluster_must_be_named():
    cluster = MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.master = "spark://master:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(cluster, "x")
    cluster.sparkContext.master = "local[2]"
    assert session.scratch_dir(cluster, "x").startswith("/")


def test_object_store_settings_reach_hadoop(spark):
    session.use_object_store(spark, "store:9000", "org.example.Provider")
    hadoop = spark._jsc.hadoopConfiguration()
    assert hadoop.get("fs.s3a.endpoint") == "store:9000"
    assert hadoop.get("fs.s3a.aws.credentials.provider") == "org.example.Provider"
    assert hadoop.get("fs.s3a.path.style.access") == "true"
    assert hadoop.get("fs.s3a.connection.ssl.enabled") == "false"


def test_progress_as_a_table(spark, topics, tmp_path):
    publish(spark, topics, "t", ["a"], ["b", "c"])
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        lines = topics.stream(spark, "t", files_per_trigger=1).observe("seen", F.count(F.lit(1)).alias("n"))
        query = drain(parquet_sink(lines, str(tmp_path / "out")), str(tmp_path / "c"), name="told")
        log.wait_for(query)
        failing = topics.stream(spark, "t").select(F.raise_error(F.lit("no good")).cast("string").alias("value"))
        with pytest.raises(StreamingQueryException):
            drain(parquet_sink(failing, str(tmp_path / "out2")), str(tmp_path / "c2"))
    finally:
        spark.streams.removeListener(log)
    table = log.table(spark).where("name = 'told'")
    assert sorted((row["batch_id"], row["input_rows"], row["observed"]) for row in table.collect()) == \
        [(0, 1, '{"seen": {"n": 1}}'), (1, 2, '{"seen": {"n": 2}}')]
    assert table.where("query_id is null or started is null or trigger_millis < 0").count() == 0
