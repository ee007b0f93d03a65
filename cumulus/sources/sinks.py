"""Sinks and table layout.

Written tables live under the shared folder (``scratch_path``) or a
catalog location; nothing is written to a machine-local temp folder on a
cluster. Parquet has no MERGE, so an upsert is "old minus new keys, plus
new", written as a new version folder (never read-and-overwrite one path
in a single plan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cumulus.operators.joins import input_bytes

#: Bytes of input that one written file or bucket should hold. A task sorts its
#: file's rows in memory, where they take 10 to 20 times their parquet bytes,
#: and a bucketed join holds a bucket of each table.
FILE_BYTES = 16 << 20


def file_count(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """How many files ``df`` makes at ``file_bytes`` each, from the bytes
    of its input; the session's shuffle width if these are unknown."""
    size = input_bytes(df)
    if size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // file_bytes))


def bucket_count(*tables: DataFrame, bucket_bytes: int = FILE_BYTES, least: int = 4) -> int:
    """K5: one number of buckets for tables that are to be joined: the power
    of two that brings the largest one to ``bucket_bytes`` a bucket or less."""
    n = max(file_count(t, bucket_bytes) for t in tables)
    return max(least, 1 << (n - 1).bit_length())


def placed(df: DataFrame, by: Sequence[str], files: int, spread: bool = True) -> DataFrame:
    """Rows dealt over ``files`` tasks by ranges of ``by``, with bounds
    taken from a sample, so that small values share a task. With ``spread``
    a heavy value takes as many tasks as its rows make; without it all rows
    of a value stay in one task, however many they are."""
    if not by:
        return df.repartition(files)
    if not spread:
        return df.repartitionByRange(files, *by)
    return df.withColumn("_salt", F.rand(17)).repartitionByRange(files, *by, "_salt").drop("_salt")


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K1: append rows."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """K2: replace only the partitions present in ``df`` (dynamic
    partition overwrite, set per write)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def upsert(old: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K3: ``ON CONFLICT (keys) DO UPDATE``: new rows replace old rows with
    the same key. One shuffle (anti join) on the key."""
    if old is None:
        return new
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Materialise one version of a table under ``base/v=<n>``."""
    path = f"{base.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def create_table_as(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """K4: CREATE TABLE ... AS SELECT."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, name: str, key: str | Sequence[str], buckets: int | None = None,
                   sort_cols: Sequence[str] | None = None, path: str | None = None) -> DataFrame:
    """K5: bucketed (and sorted) table: joins of two tables bucketed the
    same way on the key read without an Exchange (and without a Sort when
    ``sort_cols`` starts with the key). ``buckets`` comes from the table's
    bytes if it isn't given."""
    keys = [key] if isinstance(key, str) else list(key)
    buckets = buckets or bucket_count(df)
    w = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort_cols:
        w = w.sortBy(*sort_cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str],
                      sort_within: Sequence[str] = (), files: int | None = None) -> None:
    """K6: identity-partitioned table (one folder per value). Tasks are ranges
    of rows, so a value that holds most rows is written by many of them and
    many small values by one; their number comes from the input's bytes."""
    d = placed(df, partition_by, files or file_count(df))
    if sort_within:
        d = d.sortWithinPartitions(*partition_by, *sort_within)
    d.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_layout(df: DataFrame, path: str, files: int | None = None,
                 by: Sequence[str] = (), sort_within: Sequence[str] = (),
                 partition_by: Sequence[str] = (), spread: bool = True) -> None:
    """K7: one layout variant: placement by ranges of ``by`` (without, round
    robin over ``files``, or where the rows are read, which moves none), optional
    local sort (no global sort: ``sortWithinPartitions`` needs no shuffle of its
    own), optional folder partitioning (K6)."""
    d = placed(df, by, files or file_count(df), spread) if by or files else df.coalesce(file_count(df))
    if sort_within:
        d = d.sortWithinPartitions(*sort_within)
    w = d.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    """DROP TABLE IF EXISTS."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# ---------------------------------------------------------------- external
def jdbc_batch_writer(url: str, table: str, user: str | None = None,
                      password: str | None = None, driver: str = "org.postgresql.Driver"):
    """K8: ``foreachBatch`` function appending each micro-batch over JDBC.
    Needs the JDBC driver jar on the cluster; the options are the sink's
    whole configuration."""
    props = {"driver": driver}
    if user:
        props["user"] = user
    if password:
        props["password"] = password

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("append").jdbc(url, table, properties=props)
    return write


def kafka_json_sink(df: DataFrame, servers: str, topic: str, checkpoint: str,
                    key_col: str | None = None):
    """K9: stream rows as JSON values to a Kafka topic (needs the Kafka
    connector on the classpath). Returns the configured writer."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    cols = [value.alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return (df.select(*cols).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint))
