from __future__ import annotations

from llm_helpers import documents, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm.quality import quality


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality(docs, labels)
    assert found.count() == docs.count()
    seen = found.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert sum(row["predicted"] == row["quality"] for row in seen) >= 0.95 * len(seen)


def test_edges(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").withColumn("id", F.lit("x"))
    table = [(1, None), (2, ""), (2, "two"), (None, "three"), (4, "x" * 200000)]
    rows = quality(documents(table), labels).collect()
    assert len(rows) == len(table) and all(0 <= row["score"] <= 1 for row in rows)
    assert {row["score"] for row in quality(documents(table), labels.where("false")).collect()} == {0.5}
    assert quality(documents([]), labels).count() == 0


def test_copies_do_not_crowd_out_what_a_view_teaches(spark):
    good = "The river runs slowly past the old mill and people walk along it. Children play there in summer."
    junk = "%%% ### 123 $$$ @@@ 99 &&& xx *** 7 !!! ~~~ 55 ### qq 123 123 $$$ $$$"
    words = "house garden window morning letter winter bread market table water".split()

    def text(kind, i):
        return f"{good} {words[i % 10]} {words[i // 10 % 10]} {words[i // 100 % 10]}." if kind else f"{junk} {i} ### {i * 7} $$$"

    rows, marks = [], []
    for i in range(1600):
        rows.append((i, text(i % 2, i), "seed"))
        marks.append((i, i % 2))
    rows += [(100000 + i, good if i % 2 else f"{junk} ### $$$ %%% ###", f"copies{i % 2}") for i in range(6000)]
    rows += [(10000 + i, text(i % 2, i + 2000) + (" Then home." if i % 2 else ""), f"other{i % 2}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.lit(100))
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = quality(docs, labels).join(docs, "doc_id").groupBy("source").agg(F.avg("metadata_score").alias("score"))
    score = {row["source"]: row["score"] for row in found.collect()}
    assert score["other1"] > 0.7 and score["other0"] < 0.3
