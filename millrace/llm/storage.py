"""Tables between the steps of an operator, and names that clash with no column."""

from __future__ import annotations

import uuid
from functools import reduce
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = "1000"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of a few MB, unless the session says how many rows to send."""
    if spark.conf.get(ARROW_ROWS, None) is None:
        spark.conf.set(ARROW_ROWS, ROWS_PER_BATCH)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the cluster's shared folder and read again.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before. The
    shuffle files of the write are dropped with its end.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_dir(spark, f"llm-{label}")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def dropped(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored`` that nothing reads any more, as what came of them is stored itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_paths.pop(table))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    if spark.sparkContext.master.startswith("local"):
        # Local workers find this package where the driver did; a cluster ships it with --py-files.
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused_name() -> str:
    """A column name that no input has."""
    return f"_{uuid.uuid4().hex}"


def chosen_rows(docs: DataFrame, keys: list[Column], every: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs``, with its columns, for each row of ``chosen``.

    ``keys`` are the keys of a row, ``every`` holds the keys of all rows (columns k0, k1, ...)
    and ``chosen`` distinct ones of them. Nulls are keys like others. Of rows with the same
    key that stays whose JSON sorts first (rows themselves have no order if they hold a map); only those rows are
    grouped, in a plan made if there are any.
    """
    names = [f"k{i}" for i in range(len(keys))]
    here = [unused_name() for _ in names]
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    named = docs.select(row.alias("row"), *[key.alias(name) for key, name in zip(keys, here)])
    same = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(here, names)])
    found = named.join(chosen.select(*names), same, "left_semi")
    repeated = stored(every.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*names), "repeated")
    if repeated.isEmpty():
        return found.select("row.*")
    folded = found.join(repeated, same, "left_semi").groupBy(*here).agg(F.min_by("row", F.to_json("row")).alias("row"))
    return found.join(repeated, same, "left_anti").select("row.*").unionByName(folded.select("row.*"))
