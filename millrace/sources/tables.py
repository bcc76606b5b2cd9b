"""Keyed tables: a Cassandra table, or a Parquet base with a folder of changes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.streaming.changelog import all_batches, batch_numbers, drop_folder, last_per_key
from millrace.streaming.manifests import commit, committed, names

CASSANDRA = "org.apache.spark.sql.cassandra"


def cassandra_settings(host: str, port: int = 9042) -> dict[str, str]:
    """Session settings of the Cassandra connector."""
    return {
        "spark.cassandra.connection.host": host,
        "spark.cassandra.connection.port": str(port),
        "spark.sql.extensions": "com.datastax.spark.connector.CassandraSparkExtensions",
    }


@dataclass(frozen=True)
class CassandraTable:
    """Table behind the Cassandra connector, whose append is an upsert by primary key."""

    keyspace: str
    table: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(CASSANDRA).options(keyspace=self.keyspace, table=self.table).load()

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.format(CASSANDRA).options(keyspace=self.keyspace, table=self.table) \
            .mode("append").save()


# Sub-folder of the changes that holds merged bases; Spark's readers pass over such names.
BASES = "_bases"
UPTO = "upto="


@dataclass(frozen=True)
class FileTable:
    """Rows of ``base`` overridden per key by the newest of ``changes``.

    ``changes`` has one folder per micro-batch of the one query that writes here; a
    repeated batch replaces its folder, so replays do not double. Every ``merge_every``
    batches the changes of finished batches are merged with the base into a new base, which
    names the last batch it holds; later reads take that base and the batches behind it.
    """

    base: str
    changes: str
    key: str
    schema: T.StructType
    merge_every: int = 100

    def _merged(self, spark: SparkSession) -> int:
        """The last batch that a merged base holds; -1 if there is none."""
        done = batch_numbers(spark, f"{self.changes}/{BASES}", UPTO)
        whole = [number for number in done if _finished(spark, self._base(number))]
        return whole[-1] if whole else -1

    def _base(self, upto: int) -> str:
        return self.base if upto < 0 else f"{self.changes}/{BASES}/{UPTO}{upto}"

    def read(self, spark: SparkSession) -> DataFrame:
        """The base rows as they are now. Build it anew per micro-batch to see appended rows."""
        return spark.read.schema(self.schema).parquet(self.base)

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Write one row per key; ``rows`` must hold each key once."""
        rows.select(self.schema.fieldNames()).write.mode("overwrite") \
            .parquet(f"{self.changes}/batch_id={batch_id}")
        if batch_id and batch_id % self.merge_every == 0:
            self.merge(rows.sparkSession, batch_id - 1)

    def merge(self, spark: SparkSession, upto: int) -> None:
        """Write a base with all batches up to ``upto``, which must be finished, and drop what it replaces.

        Rows that were appended to the first base since are taken in as well.
        """
        merged = self._merged(spark)
        if upto <= merged:
            return
        self._state(spark, merged, upto).write.mode("overwrite").parquet(self._base(upto))
        for number in batch_numbers(spark, self.changes):
            if number <= merged:
                drop_folder(spark, f"{self.changes}/batch_id={number}")
        for number in batch_numbers(spark, f"{self.changes}/{BASES}", UPTO):
            if number < merged:
                drop_folder(spark, self._base(number))

    def current(self, spark: SparkSession) -> DataFrame:
        """Base and changes merged: later batches win."""
        return self._state(spark, self._merged(spark), None)

    def _state(self, spark: SparkSession, merged: int, upto: int | None) -> DataFrame:
        base = spark.read.schema(self.schema).parquet(self._base(merged))
        if merged >= 0:
            later = self.read(spark).join(base.select(self.key), self.key, "left_anti")
            base = base.unionByName(later.select(base.columns))
        changes = all_batches(spark, self.changes, self.schema).where(F.col("batch_id") > merged)
        if upto is not None:
            changes = changes.where(F.col("batch_id") <= upto)
        # Reducing the changes alone spares the base, the larger part, an aggregation.
        newest = last_per_key(changes, [self.key]).withColumn("changed", F.lit(True))
        merged_rows = base.alias("base").join(newest.alias("newest"), self.key, "full")
        return merged_rows.select(self.key, *[
            F.when(F.col("changed"), F.col(f"newest.{name}")).otherwise(F.col(f"base.{name}")).alias(name)
            for name in self.schema.fieldNames() if name != self.key])


@dataclass(frozen=True)
class BucketedTable:
    """Rows by key in a fixed number of buckets, of which an upsert reads and writes those it touches.

    A batch writes new versions of its buckets beside the old ones, then a manifest that names the
    version of every bucket, put in place by one rename: readers see a batch whole or not at all. A
    repeated batch that was not decided writes its buckets again; one that was does nothing. Versions
    that neither of the two newest manifests names are dropped. The number of buckets is fixed with
    the first manifest; it should make a bucket about a file's size.
    """

    folder: str
    key: str
    schema: T.StructType
    buckets: int = 64

    def _bucket(self, rows: DataFrame) -> Column:
        return F.pmod(F.xxhash64(rows[self.key]), F.lit(self.buckets)).cast("int")

    def _manifest(self, batch_id: int) -> str:
        # A name that sorts by number, as the state of the table is its newest manifest.
        return f"{self.folder}/manifests/{batch_id + 1:020d}.json"

    def _versions(self, spark: SparkSession, before: int = 0) -> dict[int, int]:
        """{bucket: batch that wrote it}, by the newest manifest or one before it."""
        found = names(spark, f"{self.folder}/manifests")
        if len(found) <= before:
            return {}
        return {int(bucket): batch for bucket, batch in
                committed(spark, f"{self.folder}/manifests/{found[-1 - before]}").items()}

    def _place(self, bucket: int, batch_id: int) -> str:
        return f"{self.folder}/data/batch_id={batch_id}/bucket={bucket}"

    def _rows(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        if not versions:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[self._place(*version) for version in sorted(versions.items())])

    def load(self, rows: DataFrame) -> None:
        """Begin the table with rows, each key once; nothing if it has begun."""
        spark = rows.sparkSession
        if not names(spark, f"{self.folder}/manifests"):
            self._write(rows, -1, {})

    def _write(self, rows: DataFrame, batch_id: int, versions: dict[int, int]) -> None:
        spark, data = rows.sparkSession, f"{self.folder}/data/batch_id={batch_id}"
        chosen = rows.select(self.schema.fieldNames())
        # One task a bucket, so that it is one file.
        chosen.withColumn("bucket", self._bucket(chosen)).repartition("bucket") \
            .write.mode("overwrite").partitionBy("bucket").parquet(data)
        written = [int(name.removeprefix("bucket=")) for name in names(spark, data) if name.startswith("bucket=")]
        commit(spark, self._manifest(batch_id), {**versions, **dict.fromkeys(written, batch_id)})

    def _touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the rows' keys: at most as many numbers as there are buckets."""
        return [row[0] for row in rows.select(self._bucket(rows).alias("bucket")).distinct().collect()]

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows as they are now."""
        return self._rows(spark, self._versions(spark))

    current = read

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The rows of the buckets that the keys of ``rows`` fall into."""
        versions = self._versions(rows.sparkSession)
        return self._rows(rows.sparkSession, {bucket: versions[bucket] for bucket in self._touched(rows) if bucket in versions})

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Take over rows, which hold each key once; other buckets than theirs are neither read nor written."""
        spark = rows.sparkSession
        if committed(spark, self._manifest(batch_id)) is not None:
            return
        versions = self._versions(spark)
        before = self._rows(spark, {bucket: versions[bucket] for bucket in self._touched(rows) if bucket in versions})
        merged = before.join(rows.select(self.key), self.key, "left_anti").unionByName(rows.select(before.columns))
        self._write(merged, batch_id, versions)
        self._drop(spark)

    def _drop(self, spark: SparkSession) -> None:
        """Versions named only by the third newest manifest go, then manifests older than that."""
        newer = [self._versions(spark, before) for before in (0, 1)]
        for bucket, batch in self._versions(spark, 2).items():
            if all(versions.get(bucket) != batch for versions in newer):
                drop_folder(spark, self._place(bucket, batch))
        for name in names(spark, f"{self.folder}/manifests")[:-3]:
            drop_folder(spark, f"{self.folder}/manifests/{name}")


def _finished(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)
