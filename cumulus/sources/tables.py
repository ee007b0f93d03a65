"""Batch scans.

Scans return lazy DataFrames; callers select the columns they need so
Catalyst prunes the parquet ReadSchema and pushes filters into the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from cumulus.operators.joins import numbered

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the driver's data set (S1 by path)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by name."""
    return spark.table(name)


def events_utc(events: DataFrame) -> DataFrame:
    """Events with ``ts`` as a session-zone TIMESTAMP (the files hold
    TIMESTAMP_NTZ, which watermarks reject) and ``event_date``."""
    return (events
            .withColumn("ts", F.col("ts").cast("timestamp"))
            .withColumn("event_date", F.to_date("ts")))


def snapshot(df: DataFrame, period_col: str, period) -> DataFrame:
    """One period of a cumulative table (partition pruning when the
    table is partitioned by ``period_col``)."""
    return df.filter(F.col(period_col) == F.lit(period))


def int_series(spark: SparkSession, start: int, end: int, name: str = "n") -> DataFrame:
    """Inclusive integer series, distributed by ``spark.range``."""
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias(name))


def date_series(spark: SparkSession, start: str, end: str, name: str = "d") -> DataFrame:
    """Inclusive daily date series."""
    return spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.to_date(F.lit(end)),
        F.expr("INTERVAL 1 DAY"))).alias(name))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred types (one extra pass; prefer an explicit schema)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_strings(spark: SparkSession, path: str, ts_col: str = "event_time") -> DataFrame:
    """S3: all-string CSV plus a derived ``event_date`` (day-truncated)."""
    df = spark.read.option("header", True).csv(path)
    return df.withColumn("event_date", F.date_trunc("day", F.col(ts_col).cast("timestamp")))


def read_typed(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """Typed scan with a nullability contract.

    Returns ``(good, bad)``: rows whose non-nullable fields are all present,
    and the rows that break the contract. Splitting keeps the job running
    on dirty input instead of failing the whole stage.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.format(fmt).load(path)
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return df, df.limit(0)
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Temp view so SQL text can read a DataFrame."""
    df.createOrReplaceTempView(name)
    return df


def file_stats(df: DataFrame) -> DataFrame:
    """File count and bytes behind a file-based DataFrame, computed
    on the executors from the hidden ``_metadata`` column."""
    files = df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size")).distinct()
    return files.agg(F.count("*").alias("n_files"),
                     F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("total_bytes"))


def file_footers(df: DataFrame, column: str) -> DataFrame:
    """One row per row group of the parquet files behind ``df``: file,
    row_group, rows, bytes and the column's least and largest value (null
    where the file has no statistics). The files are listed and their footers
    read by the executors, through pyarrow's file systems; no data page is
    read."""
    kind = to_arrow_type(df.schema[column].dataType)
    files = df.select(F.col("_metadata.file_path").alias("file")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(file)
                with system.open_input_file(path) as source:
                    meta = pq.ParquetFile(source).metadata
                at = next((i for i in range(meta.num_columns) if meta.schema.column(i).path == column), None)
                rows = []
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = group.column(at).statistics if at is not None else None
                    known = stats is not None and stats.has_min_max
                    rows.append((file, g, group.num_rows, group.total_byte_size, stats.min if known else None,
                                 stats.max if known else None))
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), kind, kind]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                    names=["file", "row_group", "rows", "bytes", "least", "largest"])

    told = df.schema[column].dataType.simpleString()
    return files.mapInArrow(run, f"file string, row_group int, rows bigint, bytes bigint, least {told}, largest {told}")


def rows_read_by_key(df: DataFrame, column: str) -> DataFrame:
    """How much a predicate ``column = value`` reads, over all values: n_keys,
    rows_needed (rows of a value, on average) and rows_read (rows of the row
    groups whose range takes the value in). Row groups without statistics are
    read for every value. Ranges become differences of ranks, by equi joins,
    as their ends are values of the column."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    ranked = numbered(values, ["v"], "at")
    footers = file_footers(df, column)
    lo, hi = ranked.select(F.col("v").alias("least"), F.col("at").alias("a")), ranked.select(
        F.col("v").alias("largest"), F.col("at").alias("b"))
    spans = footers.join(lo, "least", "left").join(hi, "largest", "left")
    total = values.agg(F.count("*").alias("n_keys"), F.sum("c").alias("n_rows"))
    read = spans.agg(F.sum(F.when(F.col("a").isNotNull(), F.col("rows") * (F.col("b") - F.col("a") + 1))).alias("r"),
                     F.sum(F.when(F.col("a").isNull(), F.col("rows"))).alias("always"))
    both = total.withColumn("_one", F.lit(1)).join(read.withColumn("_one", F.lit(1)), "_one")
    return both.select("n_keys", (F.col("n_rows") / F.col("n_keys")).alias("rows_needed"),
                       (F.coalesce("r", F.lit(0)) / F.col("n_keys") + F.coalesce("always", F.lit(0))).alias("rows_read"))
