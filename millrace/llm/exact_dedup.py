"""Exact deduplication by a tree merge of sorted digest runs (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import chosen_rows, dropped, shuffle_partitions, stored

FAN_IN = 2
COPIES_PER_PIECE = 100_000
DIGEST = ("sha", "size", "second")


def normalised(text: Column) -> Column:
    """The text with every run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_columns(text: Column) -> list[Column]:
    """SHA-256, length and a second hash of the normalised text; all three must agree."""
    whole = normalised(text)
    return [F.sha2(whole, 256).alias("sha"), F.octet_length(whole).alias("size"), F.xxhash64(whole).alias("second")]


def digest_runs(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    """Rows (run, sha, size, second, id, copies), sorted by digest within a run.

    The run follows from the id, so that a repeated task deals rows alike and a group that
    holds a third of all rows is spread over all runs.
    """
    rows = docs.select(F.col(id_col).alias("id"), *digest_columns(F.col(text_col))).withColumn("sha", F.unhex("sha"))
    run = F.pmod(F.xxhash64("id"), F.lit(runs)).cast("int")
    return rows.groupBy(run.alias("run"), *DIGEST, "id").agg(F.count("*").alias("copies")) \
        .sortWithinPartitions("run", *DIGEST, "id")


def merged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two sorted runs a key ``run`` as one: a merge join, in which a digest that both hold meets itself."""
    a, b = left.alias("a"), right.alias("b").hint("merge")
    same = [F.col(f"a.{name}") == F.col(f"b.{name}") for name in ("run", *DIGEST)]
    none = F.array().cast("array<int>")
    return a.join(b, same, "full_outer").select(
        *[F.coalesce(f"a.{name}", f"b.{name}").alias(name) for name in ("run", *DIGEST)],
        F.least("a.least", "b.least").alias("least"),
        (F.coalesce("a.total", F.lit(0)) + F.coalesce("b.total", F.lit(0))).alias("total"),
        F.concat(F.coalesce("a.holders", none), F.coalesce("b.holders", none)).alias("holders"))


def merge_rounds(level: DataFrame, leaves: int, fan_in: int) -> DataFrame:
    """All runs as one, run 0: (run, digest, least id, total rows, numbers of the runs that hold it).

    In round r the runs whose number is a multiple of ``fan_in`` ** r but not of ``fan_in`` ** (r + 1)
    go to the multiple below and are merged there. Each round is written; the one before goes.
    """
    step = 1
    while step < leaves:
        width = step * fan_in
        number = F.col("run") % width
        result = level.where(number == 0)
        for place in range(step, width, step):
            result = merged(result, level.where(number == place).withColumn("run", F.col("run") - place))
        before, level = level, stored(result, "digest-rounds")
        dropped(before)
        step = width
    return level


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, keep_id, group_size, kept, text_sha256.

    Rows whose normalised texts are equal form a group; the smallest id stays. Runs sorted by
    digest are merged in binomial rounds (``fan_in`` 2), each keeping one verified smallest id a
    digest and the numbers of the runs that hold it. The last run sends each of these runs the
    group's smallest id, so no task gathers more of a group than one run holds. Null texts are
    empty texts. Rows repeated under one id count in group_size and just one of them is kept. Null ids come after all others; if a group has
    only null ids, keep_id is null and one of its rows is kept. An empty table gives an
    empty result; other columns are not read.
    """
    leaves = shuffle_partitions(docs.sparkSession)
    runs = stored(digest_runs(docs, id_col, text_col, leaves), "digest-runs")
    own = runs.groupBy("run", *DIGEST).agg(F.min("id").alias("least"), F.sum("copies").alias("total"))
    leaf = stored(own.withColumn("holders", F.array("run")).sortWithinPartitions("run", *DIGEST), "digest-rounds")
    root = merge_rounds(leaf, leaves, fan_in)
    answers = root.select(F.explode("holders").alias("run"), *DIGEST, "least", "total")
    rows = runs.join(answers, ["run", *DIGEST])
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES_PER_PIECE)))
    left = F.least(F.lit(COPIES_PER_PIECE), F.col("copies") - F.col("piece") * COPIES_PER_PIECE)
    each = rows.withColumn("piece", piece) \
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left.cast("long"))))
    first = (F.col("piece") == 0) & (F.col("copy") == 1)
    return each.select(F.col("id").alias(id_col), F.col("least").alias("keep_id"), F.col("total").alias("group_size"),
                       (F.col("id").eqNullSafe(F.col("least")) & first).alias("kept"),
                       F.lower(F.hex("sha")).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with the columns of ``docs``."""
    groups = stored(exact_groups(docs, id_col, text_col)
                    .select(F.col(id_col).alias("k0"), F.col("text_sha256").alias("k1"), "kept"), "exact-groups")
    return chosen_rows(docs, [F.col(id_col), digest_columns(F.col(text_col))[0]], groups, groups.where("kept"))
