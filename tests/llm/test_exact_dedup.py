from __future__ import annotations

import hashlib
import re

import pytest

from llm_helpers import collected, documents, workers_find_the_package  # noqa: F401
from millrace.llm.exact_dedup import exact_groups, merged, without_copies

ROWS = [(1, "a  b"), (2, "a b"), (3, "a\n\tb"), (4, " a b"), (5, None), (6, ""), (7, "x"), (8, "a b"), (None, "x"),
        (9, "same"), (9, "same"), (9, "other"), (None, "alone"), (10, "word " * 30000), (11, "word\t" * 30000)]


def plain(table: list[tuple]) -> list[tuple]:
    texts = [re.sub("[\x20\x09-\x0D]+", " ", text or "") for _, text in table]
    least, seen, found = {}, set(), []
    for (key, _), text in zip(table, texts):
        known = least.get(text)
        least[text] = key if known is None else known if key is None else min(key, known)
    for (key, _), text in zip(table, texts):
        kept = key == least[text] and (key, text) not in seen
        if kept:
            seen.add((key, text))
        found.append((key, least[text], texts.count(text), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=repr)


def test_groups_like_a_plain_version(documents):
    assert collected(exact_groups(documents(ROWS))) == plain(ROWS)


def test_a_tree_of_many_levels(documents):
    table = [(i, f"text {i % 7}") for i in range(300)]
    assert collected(exact_groups(documents(table), fan_in=2)) == plain(table)


@pytest.mark.parametrize("partitions, fan_in", [(1, 2), (5, 2), (13, 3)])
def test_any_number_of_runs(spark, documents, partitions, fan_in):
    table = [(i, f"text {i % 7}") for i in range(60)] + [(100 + i, f"own {i}") for i in range(20)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert collected(exact_groups(documents(table), fan_in=fan_in)) == plain(table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_round_merges_two_runs(spark):
    schema = "run int, sha string, size int, second long, least long, total long, holders array<int>"
    left = spark.createDataFrame([(0, "a", 1, 1, None, 2, [0]), (0, "b", 1, 1, 7, 1, [0])], schema)
    right = spark.createDataFrame([(0, "a", 1, 1, 4, 3, [1]), (0, "b", 1, 2, 5, 1, [1])], schema)
    both = merged(left, right)
    assert "SortMergeJoin" in both._jdf.queryExecution().toString()
    assert collected(both) == [(0, "a", 1, 1, 4, 5, [0, 1]), (0, "b", 1, 1, 7, 1, [0]), (0, "b", 1, 2, 5, 1, [1])]


def test_copies_of_one_row_in_several_pieces(documents, monkeypatch):
    monkeypatch.setattr("millrace.llm.exact_dedup.COPIES_PER_PIECE", 3)
    table = [(1, "a")] * 10 + [(2, "a")] * 3
    assert collected(exact_groups(documents(table))) == plain(table)


def test_rows_that_stay_keep_their_columns(documents):
    docs = documents(ROWS)
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    stay = [(row[0], row[4]) for row in plain(ROWS) if row[3]]
    digest = [(row["doc_id"], hashlib.sha256(re.sub("[ \t-\r]+", " ", row["text"] or "").encode()).hexdigest())
              for row in kept.collect()]
    assert sorted(digest, key=repr) == sorted(stay, key=repr)


def test_an_empty_table(documents):
    assert exact_groups(documents([])).count() == 0
    assert without_copies(documents([])).count() == 0


def test_no_python_in_the_plan(documents):
    plan = exact_groups(documents(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
