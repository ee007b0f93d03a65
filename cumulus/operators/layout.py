"""Join strategy and file-layout studies (A28 match stats, A29 layout
comparison, A30 cached device roll-up), plus plan inspection helpers.
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cumulus.operators.joins import star_join
from cumulus.session import scratch_path
from cumulus.sources import sinks
from cumulus.sources.tables import file_footers, file_stats, rows_read_by_key


# ---------------------------------------------------------------- plans
def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text: what ``DataFrame.explain(mode)`` prints."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def has_exchange(df: DataFrame) -> bool:
    return "Exchange" in plan_text(df, "simple")


def has_broadcast(df: DataFrame) -> bool:
    return "BroadcastHashJoin" in plan_text(df, "simple")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new scratch folder and read back, for several
    consumers."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- A28
def top1(df: DataFrame, key: str, count_name: str = "num") -> DataFrame:
    """O3: the most frequent ``key`` (ties: smallest key), as a top-1 report."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.desc(count_name), F.asc(key)).limit(1))


def avg_kills_per_game(details: DataFrame, match: str = "match_id",
                       player: str = "player_gamertag", kills: str = "player_total_kills") -> DataFrame:
    """Kills per (match, player), averaged over a player's matches."""
    per_match = details.groupBy(match, player).agg(F.sum(kills).alias("_k"))
    return per_match.groupBy(player).agg(F.avg("_k").alias("avg_kills_per_game"),
                                         F.count(F.lit(1)).alias("num_matches"))


def medal_map_top(joined: DataFrame, medals: DataFrame, classification: str,
                  medal: str = "medal_id", map_col: str = "mapid") -> DataFrame:
    """Map with the most medals of one classification. Whether the medal
    dimension is broadcast is left to the planner."""
    m = medals.filter(F.col("classification") == classification).select(medal)
    j = joined.join(m, medal, "left_semi")
    return top1(j, map_col, "num_medals")


def bucketed_join(spark: SparkSession, left: DataFrame, right: DataFrame, key: str,
                  buckets: int | None = None, db: str = "cumulus_layout",
                  location: str | None = None) -> DataFrame:
    """Write both sides bucketed and sorted by ``key`` into a
    namespace in the shared folder and join the tables back: the join
    reads co-partitioned buckets with no Exchange."""
    loc = location or scratch_path(spark, "warehouse")
    sinks.create_namespace(spark, db, loc)
    buckets = buckets or sinks.bucket_count(left, right)
    lt = sinks.write_bucketed(left, f"{db}.bucket_left", key, buckets, [key])
    rt = sinks.write_bucketed(right, f"{db}.bucket_right", key, buckets, [key])
    return lt.join(rt, key, "inner")


# ---------------------------------------------------------------- A29
def write_variants(spark: SparkSession, df: DataFrame, variants: Mapping[str, Mapping],
                   base: str | None = None) -> dict[str, DataFrame]:
    """The same rows under several layouts, each read back. A variant has the
    options of ``sinks.write_layout``; files come from the input's bytes."""
    root = base or scratch_path(spark, "layouts")
    for name, spec in variants.items():
        sinks.write_layout(df, f"{root}/{name}", **spec)
    return {name: spark.read.parquet(f"{root}/{name}") for name in variants}


def compare_layouts(spark: SparkSession, df: DataFrame, variants: Mapping[str, Mapping],
                    key: str, base: str | None = None) -> DataFrame:
    """Files, bytes, row groups and the rows that a predicate on ``key`` reads
    by the files' statistics, per variant."""
    rows = []
    for name, table in write_variants(spark, df, variants, base).items():
        groups = file_footers(table, key).agg(F.count("*").alias("n_row_groups"), F.sum("rows").alias("n_rows"))
        one = F.lit(1).alias("_one")
        rows.append(file_stats(table).select(one, "*").join(groups.select(one, "*"), "_one")
                    .join(rows_read_by_key(table, key).select(one, "*"), "_one")
                    .select(F.lit(name).alias("variant"), "n_files", "total_bytes", "n_row_groups", "n_rows", "n_keys",
                            "rows_needed", "rows_read"))
    return functools.reduce(DataFrame.unionByName, rows)


def layout_promises(spark: SparkSession, df: DataFrame, variants: Mapping[str, Mapping], key: str,
                    base: str | None = None) -> DataFrame:
    """What each variant promises about its files, checked on the files: rows
    that are smaller than the row before them in their file (null where no
    sort is promised) and keys that more than one file holds (null where
    spreading is allowed), beside the rows and distinct keys."""
    rows = []
    for name, table in write_variants(spark, df, variants, base).items():
        spec = variants[name]
        none, one = F.lit(None).cast("long"), F.lit(1).alias("_one")
        per_key = table.select(F.col(key).alias("k"), F.col("_metadata.file_path").alias("f")).groupBy("k").agg(
            F.count("*").alias("c"), F.count_distinct("f").alias("files"))
        held = list(spec.get("by", ())) == [key] and not spec.get("spread", True)
        split = F.coalesce(F.sum((F.col("files") > 1).cast("long")), F.lit(0)) if held else none
        keys = per_key.agg(F.sum("c").alias("n_rows"), F.count("*").alias("n_keys"), split.alias("split_keys"))
        if spec.get("sort_within"):
            keys = keys.select(one, "*").join(unsorted_rows(table, spec["sort_within"]).select(one, "*"), "_one")
        else:
            keys = keys.withColumn("unsorted_rows", none)
        rows.append(keys.select(F.lit(name).alias("variant"), "n_rows", "n_keys", "unsorted_rows", "split_keys"))
    return functools.reduce(DataFrame.unionByName, rows)


#: Types whose values Arrow orders as Spark does (floating ones but for NaN).
_ORDERED = (T.IntegralType, T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _ordered(table: DataFrame, order: Sequence[str]) -> list | None:
    """``order`` as columns that compare alike in Arrow and Spark, nulls first;
    None if a type has no such form."""
    out = []
    for name in order:
        c, kind = F.col(name), table.schema[name].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):  # NaN follows all others
            out += [F.isnan(c).cast("int"), F.when(~F.isnan(c), c)]
        elif isinstance(kind, T.BooleanType):
            out.append(c.cast("int"))
        elif isinstance(kind, _ORDERED) or kind == T.StringType():
            out.append(c)
        else:
            return None
    return out


def unsorted_rows(table: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of the files behind ``table`` that are smaller by ``order`` than
    the row before them in their file, as one row (unsorted_rows). Neighbours
    are compared where the files are read: a batch counts inside its stretches
    of one file and sends only their first and last rows on, which a window
    over the file compares with one another."""
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (file, row index, columns) as one row for each stretch of
        neighbours in a batch: file, first index, rows smaller than the one before
        them, the first and the last row's columns."""
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            f, i = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 1))
            cols = batch.columns[2:]
            new = np.r_[True, (f[1:] != f[:-1]) | (i[1:] != i[:-1] + 1)]
            wrong, same = np.zeros(n - 1, dtype=bool), np.ones(n - 1, dtype=bool)
            for c in cols:
                known = c.is_valid().to_numpy(zero_copy_only=False)
                a, b = c.slice(0, n - 1), c.slice(1)
                more, equal = (pc.fill_null(x, False).to_numpy(zero_copy_only=False) for x in (pc.greater(a, b), pc.equal(a, b)))
                wrong |= same & (more | known[:-1] & ~known[1:])
                same &= equal | ~known[:-1] & ~known[1:]
            starts = np.flatnonzero(new)
            ends = np.r_[starts[1:], n] - 1
            count = np.add.reduceat((np.r_[False, wrong] & ~new).astype(np.int64), starts)
            data = [pa.array(f[starts]), pa.array(i[starts]), pa.array(count), *[c.take(pa.array(x)) for x in (starts, ends) for c in cols]]
            names = [f"c{j}" for j in range(len(cols))]
            yield pa.RecordBatch.from_arrays(data, names=["f", "i", "n", *[f"first_{x}" for x in names], *[f"last_{x}" for x in names]])

    cols = _ordered(table, order)
    at = [F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")]
    if cols is None:
        rows = table.select(*at, F.lit(0).cast("long").alias("n"), F.struct(*order).alias("first"))
        rows = rows.withColumn("last", F.col("first"))
    else:
        read = table.select(*at, *[c.alias(f"c{j}") for j, c in enumerate(cols)])
        kinds = [(c, read.schema[c].dataType.simpleString()) for c in read.columns[2:]]
        schema = ", ".join(["f bigint, i bigint, n bigint", *[f"first_{c} {t}" for c, t in kinds], *[f"last_{c} {t}" for c, t in kinds]])
        first, last = ([f"{side}_{c}" for c, _ in kinds] for side in ("first", "last"))
        rows = read.mapInArrow(stretches, schema).select(
            "f", "i", "n", F.struct(*first).alias("first"), F.struct(*last).alias("last"))
    before = F.lag("last").over(Window.partitionBy("f").orderBy("i"))
    wrong = F.coalesce((before > F.col("first")).cast("long"), F.lit(0))
    return rows.select((F.col("n") + wrong).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unsorted_rows"))


# ---------------------------------------------------------------- A28 joined
def same_match_join(matches: DataFrame, details: DataFrame, medals: DataFrame, match: str = "match_id",
                    player: str = "player_gamertag") -> DataFrame:
    """Matches, details and medal rows, all bucketed by ``match``, joined
    without an Exchange at whatever bucket count and with no setting. The
    player is compared as a condition on the rows of one match: as a second
    join key it would ask for a partitioning by both."""
    first = matches.join(details, match)
    m = medals.withColumnRenamed(player, "_player")
    return first.join(m, (first[match] == m[match]) & (F.least(first[player], m["_player"]) == F.greatest(
        first[player], m["_player"]))).drop(m[match]).drop("_player")


def match_statistics(joined: DataFrame, maps: DataFrame, medals: DataFrame, classification: str) -> DataFrame:
    """The statistics over the joined match tables, one row each
    (statistic, key, value): the mean over (match, player) of the average
    kills, the most frequent playlist and map, and the map with most medals
    of one classification. ``maps`` (mapid, map_name) and ``medals``
    (medal_id, classification) join as dimensions of a star."""
    star = star_join(joined, [(maps, "mapid"), (medals, "medal_id")])
    counts = written(star.groupBy("playlist_id", "map_name", "classification").agg(F.count(F.lit(1)).alias("c")), "match-counts")
    per_game = joined.groupBy("match_id", "player_gamertag").agg(F.avg("player_total_kills").alias("k"))
    kills = per_game.agg(F.avg("k").alias("value")).select(
        F.lit("avg_kills_per_game").alias("statistic"), F.lit(None).cast("string").alias("key"), "value")

    def most(rows: DataFrame, key: str, name: str) -> DataFrame:
        best = rows.groupBy(key).agg(F.sum("c").alias("num")).orderBy(F.desc("num"), F.asc(key)).limit(1)
        return best.select(F.lit(name).alias("statistic"), F.col(key).cast("string").alias("key"),
                           F.col("num").cast("double").alias("value"))

    return kills.unionByName(most(counts, "playlist_id", "top_playlist")).unionByName(
        most(counts, "map_name", "top_map")).unionByName(
        most(counts.where(F.col("classification") == classification), "map_name", "top_medal_map"))


# ---------------------------------------------------------------- A30
@contextlib.contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once for all that is written inside the block
    (memory, then disk), and released at its end."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def rollup_outputs(events_agg: DataFrame, devices: DataFrame, user: str = "user_id", device: str = "device_id",
                   attr: str = "browser_type") -> DataFrame:
    """The three outputs over one aggregate as rows (output, device,
    attribute, user, max_event_counts, n): per user, per device, and the
    users of each device."""
    joined = events_agg.join(devices.select(device, attr), device, "inner")
    none = F.lit(None)
    kinds = {f.name: f.dataType for f in joined.schema}

    def rows(df: DataFrame, name: str, n) -> DataFrame:
        has = set(df.columns)
        keys = [F.col(c) if c in has else none.cast(kinds[c]).alias(c) for c in (device, attr, user)]
        return df.select(F.lit(name).alias("output"), *keys, "max_event_counts", n.cast("long").alias("n"))

    per_user = events_agg.groupBy(user).agg(F.max("event_counts").alias("max_event_counts"), F.count(device).alias("n"))
    per_device = joined.groupBy(device, attr).agg(F.max("event_counts").alias("max_event_counts"), F.count(user).alias("n"))
    pairs = joined.withColumnRenamed("event_counts", "max_event_counts")
    return rows(per_user, "user", F.col("n")).unionByName(rows(per_device, "device", F.col("n"))).unionByName(
        rows(pairs, "pair", F.lit(1)))


def events_aggregated(events: DataFrame, user: str = "user_id", device: str = "device_id",
                      host: str = "host") -> DataFrame:
    """Events per (user, device): count and sorted distinct hosts."""
    return events.groupBy(user, device).agg(
        F.count(F.lit(1)).alias("event_counts"),
        F.array_sort(F.collect_set(host)).alias("host_array"))


def user_device_rollup(events_agg: DataFrame, devices: DataFrame, user: str = "user_id",
                       device: str = "device_id", attr: str = "browser_type"):
    """The aggregate is joined back twice (J16): devices per user (max
    hits, sorted device list - bounded by the device dimension) and users
    per device (max hits, distinct user count; a list of every user of a
    device would grow with the data). Persist ``events_agg`` when both
    are computed in one job."""
    per_user = events_agg.groupBy(user).agg(
        F.max("event_counts").alias("max_event_counts"),
        F.array_sort(F.collect_set(device)).alias("devices"))
    per_device = (events_agg.join(devices.select(device, attr), device, "inner")
                  .groupBy(device, attr).agg(F.max("event_counts").alias("max_event_counts"),
                                             F.count_distinct(user).alias("num_users")))
    return per_user, per_device


def device_users(events_agg: DataFrame, devices: DataFrame, user: str = "user_id",
                 device: str = "device_id", attr: str = "browser_type") -> DataFrame:
    """Users per device as rows: one per (device, user) with its event count."""
    return (events_agg.join(devices.select(device, attr), device, "inner")
            .select(device, attr, user, "event_counts"))


def bucketed_tables(spark: SparkSession, tables: Mapping[str, tuple], buckets: int | None = None,
                    db: str | None = None, location: str | None = None) -> dict:
    """Write each ``name -> (df, key, sort_cols)`` bucketed by its
    key (one bucket count for all, from the largest table's bytes) into one
    namespace in the shared folder; returns the tables read back. Joins among
    them on the bucket key read co-partitioned buckets without an Exchange."""
    buckets = buckets or sinks.bucket_count(*[df for df, *_ in tables.values()])
    loc = location or scratch_path(spark, "warehouse")
    db = db or f"cumulus_layout_{uuid.uuid4().hex[:12]}"  # each build has tables of its own
    sinks.create_namespace(spark, db, loc)
    out = {}
    for name, (df, key, sort_cols) in tables.items():
        out[name] = sinks.write_bucketed(df, f"{db}.{name}", key, buckets, sort_cols)
    return out
