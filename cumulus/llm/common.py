"""Helpers of the text operators: reading, scratch tables, graph components
and streaming over key-sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cumulus.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


#: Shuffle files go when the query that made them ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str, *parts: str, batch_bytes: int | None = None) -> DataFrame:
    """``df`` written to a new folder of the shared checkpoint root and read
    back: cuts lineage, survives lost executors, is computed once. As nothing
    reads its shuffles again, their files are freed with the write instead of
    when the driver's garbage collector gets to them; the session's settings are
    put back. ``parts`` names columns that become folders, ``batch_bytes``
    bounds the Arrow batches that the query's Python tasks get (the session's
    setting unless given), for rows so wide that its batches fill the memory."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    conf = {_CLEANUP: "true"} | ({_BATCH: str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").partitionBy(*parts).parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def released(df: DataFrame, part: str) -> None:
    """Deletes the files of one folder (``column=value``) of a table that
    ``stored`` wrote, once nothing will read them again, not even to make up
    for a lost executor."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.endswith(f"/{part}") and "/cumulus-work/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct ``row``, so that an operator's own
    names can't meet the input's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def unpacked(df: DataFrame, columns: list[str], *new: str) -> DataFrame:
    """The input's columns out of ``row``, those named in ``new`` replaced in
    place or added at the end."""
    return df.select(*[F.col(c) if c in new else F.col("row").getField(c).alias(c) for c in columns],
                     *[F.col(c) for c in new if c not in columns])


def wide(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` hash-partitioned by ``keys`` over the session's shuffle width."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """Connected components of an undirected edge list of ids, as rows
    (node, root) with root the smallest id reachable; every node of an edge
    is listed once. Alternates large-star and small-star contractions; each
    step is two aggregates and two joins on a node, no neighbour list is ever
    gathered, and a written table cuts the lineage. Null ids and loops are
    ignored; an empty edge list gives no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = stored(e, name)
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low2.select("u", F.col("m").alias("v"))))
        e = stored(small.where("u > v").distinct(), name)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """Rows of each run of equal ``keys`` in a stream sorted by them; holds
    one run at a time."""
    last, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            at = tuple(row[k] for k in keys)
            if held and at != last:
                yield held
                held = []
            last = at
            held.append(row)
    if held:
        yield held


def emit(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    """Rows (tuples in schema order) as one Arrow batch."""
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)
