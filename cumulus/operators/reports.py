"""Period reports (A34), period validation (A35) and table contracts.

Windows in this module run over already-aggregated per-period rows
(one row per day/week/month), never over raw facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def period_report(df: DataFrame, date_col: str, grain: str,
                  measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate measures by ``date_trunc(grain)``; each measure also gets
    its change against the previous period (``<m>_growth``)."""
    p = F.to_date(F.date_trunc(grain, F.col(date_col))).alias("period_start")
    agg = df.groupBy(p).agg(*[v.alias(k) for k, v in measures.items()])
    w = Window.orderBy("period_start")  # one row per period
    return agg.select("period_start", *measures.keys(), *[
        F.try_divide(F.col(k).cast("double") - F.lag(k).over(w).cast("double"),
                     F.lag(k).over(w).cast("double")).alias(f"{k}_growth") for k in measures])


def validate_period(df: DataFrame, date_col: str, keys: Sequence[str], start: str,
                    end: str, trailing: int = 7) -> DataFrame:
    """Completeness and trend checks per day: rows, rows with a null key,
    duplicate keys, missing day, days outside the period (or without a date),
    change against the previous day and the ratio to the trailing ``trailing``-day mean."""
    d = df.select(F.to_date(F.col(date_col)).alias("day"), *keys)
    null_key = None
    for k in keys:
        c = F.col(k).isNull()
        null_key = c if null_key is None else (null_key | c)
    daily = d.groupBy("day").agg(F.count(F.lit(1)).alias("row_count"),
                                 F.count_if(null_key).alias("null_keys"),
                                 F.count_distinct(F.struct(*keys)).alias("_distinct"))
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))).alias("day"))
    spine = spine.withColumn("_due", F.lit(True))
    j = spine.join(daily, "day", "full_outer").na.fill(0, ["row_count", "null_keys", "_distinct"])
    w = Window.orderBy("day")  # one row per calendar day
    prev = F.lag("row_count").over(w)
    trail = F.avg("row_count").over(w.rowsBetween(-trailing, -1))
    return j.select(
        "day", "row_count", "null_keys",
        (F.col("row_count") - F.col("_distinct")).alias("duplicate_keys"),
        (F.col("row_count") == 0).alias("is_missing"),
        F.col("_due").isNull().alias("out_of_range"),
        F.try_divide(F.col("row_count").cast("double") - prev, prev.cast("double")).alias("pct_change_prev_day"),
        F.try_divide(F.col("row_count").cast("double"), trail).alias("ratio_to_trailing_avg"))


def cross_source_mismatch(a: DataFrame, b: DataFrame, keys: Sequence[str],
                          value: str) -> DataFrame:
    """Keys whose ``value`` differs between two sources (missing on one
    side counts as a difference): one full outer join on the keys."""
    j = (a.select(*keys, F.col(value).alias("value_a"))
         .join(b.select(*keys, F.col(value).alias("value_b")), list(keys), "full_outer"))
    return j.filter(~F.col("value_a").eqNullSafe(F.col("value_b")))


def contract_report(df: DataFrame, keys: Sequence[str], not_null: Sequence[str] = (),
                    domains: Mapping[str, Sequence] | None = None,
                    schema: T.StructType | None = None) -> DataFrame:
    """One row per check with its violation count, computed in one
    aggregation (plus one for key uniqueness). A schema mismatch raises."""
    if schema is not None:
        have = {f.name: f.dataType for f in df.schema.fields}
        for f in schema.fields:
            if f.name not in have or have[f.name] != f.dataType:
                raise ValueError(f"contract: column {f.name} {f.dataType} missing or mistyped")
    checks = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in not_null]
    for c, values in (domains or {}).items():
        checks.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))
                      .alias(f"domain:{c}"))
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *checks) if checks else df.agg(
        F.count(F.lit(1)).alias("_rows"))
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
           .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("unique:" + ",".join(keys))))
    names = [c for c in counts.columns if c != "_rows"]
    parts = [dup.select(F.lit(dup.columns[0]).alias("check"),
                        F.col(dup.columns[0]).cast("long").alias("violations"))]
    if names:
        stack = ", ".join(f"'{n}', `{n}`" for n in names)
        parts.insert(0, counts.selectExpr(f"stack({len(names)}, {stack}) AS (check, violations)")
                     .select("check", F.col("violations").cast("long").alias("violations")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_contract(df: DataFrame, keys: Sequence[str], not_null: Sequence[str] = (),
                    domains: Mapping[str, Sequence] | None = None) -> None:
    """K10 enforcement: raise when any check of :func:`contract_report`
    has violations (the report itself is a handful of rows)."""
    bad = [(r["check"], r["violations"]) for r in
           contract_report(df, keys, not_null, domains).filter(F.col("violations") > 0).collect()]
    if bad:
        raise ValueError(f"contract violated: {bad}")
