from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from llm_helpers import documents, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm.langid import UNKNOWN, identified, languages, learn_profiles


def plain_rank(text: str, size: int) -> list[int]:
    words = "".join(c if c.isalpha() and c != "ª" else " " for c in text.lower()).split()
    counts: Counter = Counter()
    for word in [words] if words else []:
        line = " " + " ".join(word) + " "
        for n in (1, 2, 3):
            for i in range(len(line) - n + 1):
                gram = line[i:i + n]
                if gram != " " and " " not in gram[1:-1]:
                    counts[sum(ord(c) << 21 * (n - 1 - j) for j, c in enumerate(gram))] += 1
    return [gram for gram, _ in sorted(counts.items(), key=lambda item: (-item[1], item[0]))][:size]


def test_distances_like_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    profiles = learn_profiles(docs)
    ranked = {}
    names = np.repeat(profiles.names, profiles.ends - profiles.starts)
    for column, name in enumerate(profiles.languages):
        own = profiles.language == column
        ranked[name] = {int(g): int(r) for g, r in zip(names[own], profiles.rank[own])}
    for row in docs.limit(40).collect():
        top = plain_rank(row["text"], profiles.size)
        apart = {name: sum(abs(ranks[g] - i) if g in ranks else profiles.size for i, g in enumerate(top))
                 for name, ranks in ranked.items()}
        best = min(sorted(apart), key=apart.get)
        assert profiles.predict(row["text"]) == (best, 1 - apart[best] / (profiles.size * len(top)), True)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = languages(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == docs.count()
    seen = found.where("held_out").join(docs, "doc_id").select("lang_pred", "lang").collect()
    assert sum(row["lang_pred"] == row["lang"] for row in seen) >= 0.98 * len(seen)


def test_edges(spark, documents):
    table = [(1, None), (2, ""), (3, "123 !?"), (4, "the"), (4, "les mots"), (None, "der und die"), (5, "a" * 100000),
             (6, "日本語 のテキスト"), (7, "the and that " * 30000)]
    docs = documents(table).withColumn("lang", F.when(F.col("doc_id") > 3, "en"))
    rows = languages(docs).collect()
    assert len(rows) == len(table) and all(0 <= row["score"] <= 1 for row in rows)
    assert {row["doc_id"] for row in rows if row["lang_pred"] == UNKNOWN} >= {1, 2, 3}
    kept = identified(docs)
    assert kept.columns == docs.columns
    assert not {1, 2, 3} & {row["doc_id"] for row in kept.collect()}
    none = documents(table).withColumn("lang", F.lit(None).cast("string"))
    assert {row["lang_pred"] for row in languages(none).collect()} == {UNKNOWN}
    assert languages(documents([]).withColumn("lang", F.lit("en"))).count() == 0


def test_texts_with_letters_stay_where_no_language_is_learnt(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "123 !?"), (4, "the"), (5, "日本語")]).withColumn("lang", F.lit(None).cast("string"))
    kept = identified(docs)
    assert kept.columns == docs.columns and sorted(row["doc_id"] for row in kept.collect()) == [4, 5]


def test_a_label_that_is_called_unknown_loses_no_rows(documents):
    table = [(i, "una lengua" if i % 2 else "der und die") for i in range(82)]
    docs = documents(table).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, UNKNOWN).when(F.col("doc_id") < 60, "es"))
    kept = identified(docs)
    assert kept.count() == 82 and kept.columns == docs.columns
    assert {row["lang"] for row in kept.where("doc_id >= 60 and doc_id % 2 = 1").collect()} == {"es"}


def test_rare_languages_are_learnt(documents):
    words = "uno dos tres cuatro cinco seis siete ocho nueve diez".split()
    table = [(i, " ".join(words[i % 7:] + words)) for i in range(40)]
    learnable = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 4 != 2)
    docs = documents([*table, (learnable, "the weather is rather wet"), (500, "whether the rather wet weather")]) \
        .withColumn("lang", F.when(F.col("doc_id") < 40, "es").when(F.col("doc_id") == learnable, "en"))
    found = {row["doc_id"]: row["lang_pred"] for row in languages(docs).collect()}
    assert found[500] == "en" and found[3] == "es"


def test_very_many_languages(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), "id").alias("lang"),
                                    F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij").alias("text"))
    found = languages(docs)
    assert found.join(docs, "doc_id").where("lang_pred = lang and not held_out").count() >= 2000
