"""Structured Streaming operators (A25, A26; T1-T10, S8, S9, K8).

Sources: a file stream over the events parquet (tests, bench) or Kafka
JSON (reader built here, needs the Kafka connector on the cluster).
Aggregations: event-time watermark, tumbling windows, session windows.
Sink: ``foreachBatch`` writing each micro-batch to its own epoch folder
(overwrite, so a replayed epoch after a failure rewrites the same folder:
exactly-once output with the checkpoint), and merge-on-read picking the
newest epoch's row per key. Update mode keeps the state bounded by the
watermark; a full-result (complete) mode is never used.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cumulus.session import scratch_path

WATERMARK = "15 seconds"
WINDOW = "5 minutes"
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Web-event JSON payload of the Kafka topic (one schema for producer and consumers).
WEB_EVENT_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("headers", T.StringType()),
    T.StructField("event_time", T.StringType()),
])


# ---------------------------------------------------------------- sources
def file_events_stream(spark: SparkSession, sf_dir: str, table: str = "events.parquet",
                       max_files: int | None = None) -> DataFrame:
    """Events as a stream (file source) from a table that is a folder of part
    files or one file; a table that does not exist fails here. ``ts`` is cast
    to a session-zone timestamp (watermarks reject TIMESTAMP_NTZ)."""
    path = f"{sf_dir.rstrip('/')}/{table}"
    files = spark.read.schema(EVENTS_SCHEMA).parquet(path).inputFiles()
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if len(files) == 1 and files[0].endswith(f"/{table}"):  # the source wants a folder to watch
        df = r.option("pathGlobFilter", table).parquet(sf_dir)
    else:
        df = r.parquet(path)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def kafka_reader(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", options: dict | None = None):
    """Kafka source reader (latest offsets by default; consumer
    offsets live in the query checkpoint). Credentials go in ``options``
    (``kafka.sasl.jaas.config`` etc.)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def parse_json_events(df: DataFrame, schema: T.StructType = WEB_EVENT_SCHEMA,
                      time_field: str = "event_time", pattern: str = ISO_MILLIS_Z) -> DataFrame:
    """Kafka ``value`` bytes -> typed columns, event time parsed
    with an explicit pattern (session zone UTC)."""
    parsed = df.select(F.from_json(F.col("value").cast("string"), schema).alias("v")).select("v.*")
    return parsed.withColumn("event_timestamp", F.to_timestamp(F.col(time_field), pattern))


def with_event_time(df: DataFrame, time_col: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Event-time watermark; rows older than it are dropped."""
    return df.withWatermark(time_col, delay)


# ---------------------------------------------------------------- aggregations
def tumbling_counts(df: DataFrame, time_col: str, keys: Sequence[str],
                    width: str = WINDOW) -> DataFrame:
    """Hits per tumbling window and keys; window start as a column."""
    g = df.groupBy(F.window(time_col, width).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("num_hits"))
    return g.select(F.col("w.start").alias("window_start"), *keys, "num_hits")


def sessionize(df: DataFrame, time_col: str, keys: Sequence[str], gap: str = WINDOW) -> DataFrame:
    """T4: session windows (a gap of exactly ``gap`` still merges)."""
    g = df.groupBy(F.session_window(time_col, gap).alias("s"), *keys).agg(
        F.count(F.lit(1)).alias("num_hits"))
    return g.select(F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    *keys, "num_hits")


def session_stats(sessions: DataFrame, by: Sequence[str] = ("host",),
                  hosts: Sequence[str] | None = None, host_like: str | None = None,
                  host_col: str = "host") -> DataFrame:
    """Mean events per session (and its rounded integer, rounding
    half up rather than truncating), session count, per ``by``; optionally
    only hosts in a list (IN) or matching a LIKE pattern."""
    if hosts is not None:
        sessions = sessions.filter(F.col(host_col).isin(list(hosts)))
    if host_like is not None:
        sessions = sessions.filter(F.col(host_col).like(host_like))
    return sessions.groupBy(*by).agg(
        F.avg("num_hits").alias("avg_hits_per_session"),
        F.round(F.avg("num_hits")).cast("long").alias("avg_hits_rounded"),
        F.count(F.lit(1)).alias("num_sessions"),
        F.max("num_hits").alias("max_hits"))


def session_stats_by_group(sessions: DataFrame, groups: dict) -> DataFrame:
    """T10 comparison: the same statistics for several host groups
    (label -> boolean column, e.g. an IN list or a LIKE pattern) in one
    pass; a session counts in every group it matches."""
    labels = F.array_compact(F.array(*[F.when(cond, F.lit(label)) for label, cond in groups.items()]))
    tagged = sessions.select(F.explode(labels).alias("host_group"), "num_hits")
    return session_stats(tagged, ["host_group"])


# ---------------------------------------------------------------- sinks
def epoch_writer(base: str):
    """K8-style ``foreachBatch`` function: each epoch overwrites its own
    folder, so a replay after failure is idempotent."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("_epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite") \
             .parquet(f"{base.rstrip('/')}/epoch={epoch_id}")
    return write


def read_latest(spark: SparkSession, base: str, keys: Sequence[str],
                schema: T.StructType | None = None, where: Column | None = None) -> DataFrame:
    """Merge-on-read of an epoch log: per key, the row of the newest epoch
    (a partial/final aggregate, no sort of whole keys) among those that
    ``where`` admits."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(base)
    if where is not None:
        df = df.where(where)
    rest = [c for c in df.columns if c not in keys and c not in ("_epoch", "epoch")]
    latest = df.groupBy(*keys).agg(F.max(F.struct(F.col("_epoch"), *[F.col(c) for c in rest])).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def compact_log(spark: SparkSession, base: str, keys: Sequence[str], target: str) -> str:
    """Fold an epoch log into one snapshot (newest row per key) written to
    ``target``; readers then read the snapshot plus later epochs. Keeps
    merge-on-read cost bounded on a long-running stream."""
    latest = read_latest(spark, base, keys)
    latest.withColumn("_epoch", F.lit(-1).cast("long")).write.mode("overwrite").parquet(target)
    return target


def read_all(spark: SparkSession, base: str) -> DataFrame:
    df = spark.read.parquet(base)
    return df.drop("_epoch", "epoch")


def run_to_log(df: DataFrame, mode: str, base: str | None = None, checkpoint: str | None = None,
               trigger: dict | None = None, name: str | None = None, wait: bool = True):
    """Start a streaming query writing epochs under ``base`` with its
    checkpoint under ``checkpoint`` (both in the shared folder by
    default). ``trigger`` defaults to availableNow (process what is there,
    then stop). Returns (query, base)."""
    spark = df.sparkSession
    base = base or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    w = (df.writeStream.outputMode(mode).foreachBatch(epoch_writer(base))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    q = w.start()
    if wait:
        q.awaitTermination()
    return q, base


def dropped_by_watermark(query) -> int:
    """Rows dropped as late, summed over the query's recent progress."""
    total = 0
    for p in query.recentProgress:
        for op in p.stateOperators or []:
            total += int(getattr(op, "numRowsDroppedByWatermark", 0) or 0)
    return total


def epoch_fanout(base: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]]):
    """A ``foreachBatch`` function that writes several outputs of one
    micro-batch, each to its own epoch folder, and then one commit for all.
    The batch is computed once and released; a replayed epoch overwrites its
    folders with the same rows; readers see an epoch of any output only once
    all outputs of it are written."""
    root = base.rstrip("/")

    def write(batch: DataFrame, epoch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, make in outputs.items():
                make(held).write.mode("overwrite").parquet(f"{root}/{name}/epoch={epoch_id}")
        finally:
            held.unpersist()
        held.sparkSession.range(1).select(F.lit(len(outputs)).alias("n_outputs")).coalesce(1) \
            .write.mode("overwrite").parquet(f"{root}/_commits/epoch={epoch_id}")
    return write


def run_fanout(df: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], base: str | None = None,
               checkpoint: str | None = None, trigger: dict | None = None, wait: bool = True):
    """One streaming query, one read of the source, several outputs.
    Returns (query, base)."""
    spark = df.sparkSession
    base = base or scratch_path(spark, "fanout-out")
    checkpoint = checkpoint or scratch_path(spark, "fanout-ckpt")
    q = (df.writeStream.foreachBatch(epoch_fanout(base, outputs)).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    if wait:
        q.awaitTermination()
    return q, base


def read_committed(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The rows of one output in committed epochs, with ``epoch``."""
    root = base.rstrip("/")
    done = spark.read.option("basePath", f"{root}/_commits").parquet(f"{root}/_commits/epoch=*").select("epoch").distinct()
    rows = spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}/epoch=*")
    return rows.join(done, "epoch", "left_semi")


def window_deltas(time_col: str, keys: Sequence[str], width: str = WINDOW) -> Callable[[DataFrame], DataFrame]:
    """What one batch adds to the counts per window and keys. Sums of
    deltas need no state, and a late event is one more delta, not a loss."""
    return lambda batch: tumbling_counts(batch, time_col, keys, width)


def summed_deltas(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counts so far from the deltas of all epochs."""
    return deltas.groupBy("window_start", *keys).agg(F.sum("num_hits").alias("num_hits"))


def two_outputs(df: DataFrame, time_col: str, keys_a: Sequence[str], keys_b: Sequence[str],
                width: str = WINDOW, delay: str = WATERMARK):
    """Two aggregations of one source as two queries (each keeps its
    own bounded state); returns the two streaming DataFrames."""
    src = with_event_time(df, time_col, delay)
    return tumbling_counts(src, time_col, keys_a, width), tumbling_counts(src, time_col, keys_b, width)
