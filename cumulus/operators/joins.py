"""Join helpers (J1-J16): bounded broadcast and distributed ordinal
positions.

A broadcast hint is only given to tables whose size the schema bounds (a
25-row nation dimension) or whose size in bytes, as the optimiser's statistics
have it, was checked against a limit. Every other join is left to the planner:
sizes in bytes and AQE choose between sort-merge, shuffled hash and broadcast
at run time, with skew split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulus.session import scratch_path

#: Largest dimension that a join may send to every executor, in bytes.
BROADCAST_LIMIT = 64 << 20

#: Bytes of input whose rows one task sorts and aggregates in memory.
TASK_BYTES = 4 << 20


class BroadcastTooLarge(ValueError):
    """A dimension is larger than what may be broadcast."""


def plan_bytes(df: DataFrame) -> int:
    """The size of ``df`` in bytes by the optimised plan's statistics (file
    sizes, columns read, and no more than that for filters)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int | None:
    """The bytes that ``df`` is computed from: the sizes of the scans in its
    plan (a join's own estimate is their product). None if one is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) if all(s < 1 << 62 for s in sizes) else None


def task_count(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """How many tasks ``df`` makes at ``task_bytes`` of its input each; the
    session's shuffle width if these are unknown."""
    size = input_bytes(df)
    if size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // task_bytes))


def broadcast_within(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint, or a refusal if it is larger than
    ``limit`` bytes."""
    size = plan_bytes(df)
    if size > limit:
        raise BroadcastTooLarge(f"{size} bytes are more than the {limit} that may be broadcast")
    return F.broadcast(df)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], limit: int = BROADCAST_LIMIT,
              how: str = "inner") -> DataFrame:
    """The fact joined to its dimensions (table, key), one after the
    other; a dimension within the limit is broadcast, so the fact isn't
    shuffled for it, a larger one is joined by whatever the planner picks."""
    for dim, key in dims:
        try:
            fact = fact.join(broadcast_within(dim, limit), key, how)
        except BroadcastTooLarge:
            fact = fact.join(dim, key, how)
    return fact


def bounded_dim(df: DataFrame) -> DataFrame:
    """Broadcast a dimension whose size is fixed by the schema (nation,
    region): no probe needed, the bound does not grow with the data."""
    return F.broadcast(df)


def _offsets(counts: DataFrame, keys: list[str], chunks: list[str], cols: list[str]) -> DataFrame:
    """Sums of ``cols`` over all earlier chunks of the key, as ``_off<col>``.
    Chunks are nested: each is summed over its siblings, and the offset of
    its parent, found the same way, is added."""
    *above, own = chunks
    w = Window.partitionBy(*keys, *above).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.select(*keys, *chunks, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_off{c}") for c in cols])
    if not above:
        return out
    parents = counts.groupBy(*keys, *above).agg(*[F.sum(c).alias(c) for c in cols])
    up = _offsets(parents, keys, above, cols).withColumnsRenamed({f"_off{c}": f"_up{c}" for c in cols})
    return out.join(up, [*keys, *above]).select(
        *keys, *chunks, *[(F.col(f"_off{c}") + F.col(f"_up{c}")).alias(f"_off{c}") for c in cols])


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              chunk: Sequence[Column], sums: dict[str, Column] | None = None,
              pos_col: str = "pos") -> DataFrame:
    """1-based position of each row within its key by ``order``, plus
    running sums, without a window over the whole key.

    ``chunk`` is a coarsening of ``order`` (monotone in it), e.g. the date
    and a bucket of the id. Positions are ``offset(chunk) + rank in chunk``:

    * per (key, chunk) counts/sums: a partial/final aggregate;
    * chunk offsets: a running window per level of ``chunk`` (the buckets
      of a day, then the days of a key), over counts only;
    * rank inside the chunk: a window over one chunk (bounded by design).

    So a key holding a third of all rows is still spread over many tasks.
    Row order within the key must be total (add a unique tie-break to
    ``order``). ``sums``: name -> numeric column, running inclusive sums.
    """
    ks = list(keys)
    sums = sums or {}
    chunk_names = [f"_c{i}" for i in range(len(chunk))]
    d = df.select("*", *[c.alias(n) for c, n in zip(chunk, chunk_names)],
                  *[v.alias(f"_v_{k}") for k, v in sums.items()])
    per_chunk = d.groupBy(*ks, *chunk_names).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in sums])
    offsets = _offsets(per_chunk, ks, chunk_names, ["_n", *[f"_s_{k}" for k in sums]])
    offsets = offsets.withColumnsRenamed({"_off_n": "_off", **{f"_off_s_{k}": f"_off_{k}" for k in sums}})
    wr = Window.partitionBy(*ks, *chunk_names).orderBy(*order)
    wrun = wr.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = d.select("*", F.row_number().over(wr).alias("_r"),
                     *[F.sum(f"_v_{k}").over(wrun).alias(f"_l_{k}") for k in sums])
    out = local.join(offsets, [*ks, *chunk_names], "inner")
    return out.select(
        *[c for c in df.columns],
        (F.col("_off") + F.col("_r")).alias(pos_col),
        *[(F.col(f"_off_{k}") + F.col(f"_l_{k}")).alias(k) for k in sums])


def numbered(df: DataFrame, order: Sequence[str], pos_col: str = "pos") -> DataFrame:
    """1-based position of each row by ``order`` over the whole table, without
    a task that sees all rows: sorted by range and written, numbered inside
    each range, and moved on by the counts of the ranges before (one row a
    range). Rows must differ in ``order``."""
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "numbered")
    df.repartitionByRange(width, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    held = spark.read.parquet(path)
    counts = held.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = held.withColumn("_r", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return own.join(offsets, "_range").select(*df.columns, (F.col("_off") + F.col("_r")).alias(pos_col))


def pair_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Typed pair join: one row per match holding the two whole rows
    as structs ``_1`` and ``_2`` (the DataFrame form of a Dataset joinWith)."""
    lk = [f"_lk{i}" for i in range(len(on))]
    rk = [f"_rk{i}" for i in range(len(on))]
    l2 = left.select(*[F.col(c).alias(k) for c, k in zip(on, lk)], F.struct(*left.columns).alias("_1"))
    r2 = right.select(*[F.col(c).alias(k) for c, k in zip(on, rk)], F.struct(*right.columns).alias("_2"))
    cond = None
    for a, b in zip(lk, rk):
        c = l2[a] == r2[b]
        cond = c if cond is None else (cond & c)
    return l2.join(r2, cond, how).select("_1", "_2")
