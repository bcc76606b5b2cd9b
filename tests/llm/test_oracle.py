"""Queries against their SQL, on the given tables and on awkward ones."""

from __future__ import annotations

import pytest

from llm_helpers import SMALL, workers_find_the_package  # noqa: F401
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import QUERIES
from oracle_check import connect, spark_rows, sql_rows

SQL_TYPES = {"boolean": "BOOLEAN", "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}
OF_DOCUMENTS = ["op3_substring_dedup", "op6_exact_dedup", "op10_language_id", "op11_periodic_runs"]
PASSAGE = " ".join(f"word{i % 29}x{i}" for i in range(50))
LANGS = ["en", "fr", None, "und"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    tables, found = connect(SMALL), QUERIES[name](spark, SMALL)
    types = tables.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert sorted((column, SQL_TYPES[kind]) for column, kind in found.dtypes) == sorted(row[:2] for row in types)
    got = spark_rows(found)
    assert got == sql_rows(tables, ORACLE[name])
    assert got[1]


@pytest.fixture(scope="module")
def awkward(tmp_path_factory, spark):
    """Nulls, empty and long texts, ties, repeated rows; vectors of several lengths, null and not finite."""
    folder = tmp_path_factory.mktemp("awkward")
    texts = [None, "", " \t\n", "12 34", "a", "Élan ÉLAN élan", PASSAGE, f"x {PASSAGE} y", "la " * 400,
             "ab cd " * 60, "one two three four five six seven eight nine " * 12, f"{PASSAGE} {PASSAGE} {PASSAGE}",
             "same words " + PASSAGE[:120], "same  words " + PASSAGE[:120], "p q r s t u v w " * 3 + "p"]
    rows = [(i, texts[i % len(texts)], LANGS[i % 4]) for i in range(120)] + [(7, texts[6], "en"), (7, texts[6], "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string") \
        .repartition(3).write.parquet(f"{folder}/documents.parquet")
    near = [[1.0 + (i == j) / 40 for j in range(64)] for i in range(20)]
    vectors = [None, [], [0.0] * 64, [1.0] * 63 + [None], [1.0] * 63 + [float("nan")], [1.0] * 3, [2.0] * 3,
               [-1.0] + [0.5] * 63, *near, near[0]]
    spark.createDataFrame(list(enumerate(vectors)) + [(3, near[1])], "vec_id long, embedding array<float>") \
        .repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [*OF_DOCUMENTS, "op5_embedding_near_dedup", "op12_centroid_clusters"])
def test_awkward_rows_equal_sql(spark, awkward, name):
    tables = connect(awkward)
    for table in ("documents", "embeddings"):
        tables.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM read_parquet('{awkward}/{table}.parquet/*.parquet')")
    assert spark_rows(QUERIES[name](spark, awkward)) == sql_rows(tables, ORACLE[name])
