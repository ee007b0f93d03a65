"""Experiment assignment (A32) and read-out.

Assignment is a stable hash bucket: the first 32 bits of
md5(salt || user) modulo 1000, cut by cumulative weights. Read-out is one
aggregation per variant over per-user metrics. Sums are kept exact
(integer cents, decimal sums) so the statistics do not depend on the
summation order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 1000
# The three cells of each experiment (control + two tests).
DEFAULT_CELLS = [("control", 1.0), ("test_a", 1.0), ("test_b", 1.0)]


def hash_bucket(salt: str, user: Column, buckets: int = BUCKETS) -> Column:
    h = F.md5(F.concat(F.lit(salt), user.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % buckets)


def variant_of(user: Column, experiment: str, cells: Sequence[tuple[str, float]] = DEFAULT_CELLS,
               salt: str | None = None) -> Column:
    """The variant as a function of the user id: nothing is looked up."""
    total = float(sum(w for _, w in cells))
    bucket = hash_bucket(salt if salt is not None else experiment, user)
    expr, acc = None, 0.0
    for name, w in cells[:-1]:
        acc += w
        cut = int(round(acc / total * BUCKETS))
        expr = F.when(bucket < cut, name) if expr is None else expr.when(bucket < cut, name)
    return expr.otherwise(cells[-1][0]) if expr is not None else F.lit(cells[-1][0])


def assign_variant(users: DataFrame, user: str, experiment: str,
                   cells: Sequence[tuple[str, float]] = DEFAULT_CELLS,
                   salt: str | None = None) -> DataFrame:
    return users.select(user, F.lit(experiment).alias("experiment"),
                        hash_bucket(salt if salt is not None else experiment, F.col(user)).alias("bucket"),
                        variant_of(F.col(user), experiment, cells, salt).alias("variant"))


def experiment_readout(assign: DataFrame | Callable[[Column], Column], events: DataFrame, user: str = "user_id",
                       etype: str = "event_type", value: str = "value", time: str = "ts",
                       control: str = "control", view: str = "view", click: str = "click",
                       purchase: str = "purchase", search: str | None = None,
                       sessions: DataFrame | None = None) -> DataFrame:
    """Per variant: users, views, clicks, CTR, purchasers, conversion,
    repeat-purchase rate (purchasers with 2+ orders), retention (users
    active on 2+ days), orders, revenue, average order value, revenue per
    user; lift against control; two-proportion z (conversion) and Welch t
    (revenue/user). Search funnel (``search`` event type, default the view
    event): users who searched, share who purchased after their first
    search, and abandonment. ``sessions`` (user, session_start,
    session_end, gap-free duration in ``duration_us``) adds the mean session
    length in minutes. ``assign`` is a table of users and variants, which is
    joined, or the variant as a function of the user id, over the users that
    have events, which needs no join."""
    search = view if search is None else search
    per_user = events.groupBy(user).agg(
        F.min(F.when(F.col(etype) == search, F.col(time))).alias("_first_search"),
        F.max(F.when(F.col(etype) == purchase, F.col(time))).alias("_last_purchase"),
        F.count_distinct(F.to_date(F.col(time))).alias("_days"),
        F.count_if(F.col(etype) == view).alias("_views"),
        F.count_if(F.col(etype) == click).alias("_clicks"),
        F.count_if(F.col(etype) == purchase).alias("_orders"),
        F.sum(F.when(F.col(etype) == purchase, F.round(F.col(value) * 100).cast("long"))
              .otherwise(F.lit(0).cast("long"))).alias("_rev"))
    if callable(assign):
        u = per_user.withColumn("variant", assign(F.col(user)))
    else:
        u = assign.select(user, "variant").join(per_user, user, "left").na.fill(
            0, ["_days", "_views", "_clicks", "_orders", "_rev"])
    v = u.groupBy("variant").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("_views").alias("views"), F.sum("_clicks").alias("clicks"),
        F.count_if(F.col("_orders") > 0).alias("purchasers"),
        F.count_if(F.col("_orders") > 1).alias("_repeat"),
        F.count_if(F.col("_days") > 1).alias("_retained"),
        F.count_if(F.col("_first_search").isNotNull()).alias("searchers"),
        F.count_if(F.col("_first_search") < F.col("_last_purchase")).alias("_search_buyers"),
        F.sum("_orders").alias("orders"),
        F.sum("_rev").alias("revenue_cents"),
        F.sum(F.col("_rev").cast("decimal(38,0)") * F.col("_rev").cast("decimal(38,0)")).alias("_s2"))
    n = F.col("users").cast("double")
    s1 = F.col("revenue_cents").cast("double")
    v = v.select(
        "variant", "users", "views", "clicks", "purchasers", "orders", "revenue_cents", "searchers",
        F.try_divide(F.col("_search_buyers").cast("double"), F.col("searchers").cast("double"))
         .alias("search_to_purchase"),
        F.try_divide((F.col("searchers") - F.col("_search_buyers")).cast("double"),
                     F.col("searchers").cast("double")).alias("search_abandonment"),
        F.try_divide(F.col("clicks").cast("double"), F.col("views").cast("double")).alias("ctr"),
        (F.col("purchasers").cast("double") / n).alias("conversion"),
        F.try_divide(F.col("_repeat").cast("double"), F.col("purchasers").cast("double")).alias("repeat_purchase_rate"),
        (F.col("_retained").cast("double") / n).alias("retention_rate"),
        F.try_divide(s1, F.col("orders").cast("double") * 100.0).alias("avg_order_value"),
        (s1 / n).alias("_mean"),
        F.try_divide(F.col("_s2").cast("double") - s1 * s1 / n, n - 1.0).alias("_var"))
    whole = Window.partitionBy()  # a handful of variant rows
    ctl = lambda c: F.max(F.when(F.col("variant") == control, F.col(c))).over(whole)
    p1, p0 = F.col("conversion"), ctl("conversion")
    n1, n0 = n, ctl("users").cast("double")
    pooled = (F.col("purchasers").cast("double") + ctl("purchasers").cast("double")) / (n1 + n0)
    z = F.try_divide(p1 - p0, F.sqrt(pooled * (1.0 - pooled) * (1.0 / n1 + 1.0 / n0)))
    t = F.try_divide(F.col("_mean") - ctl("_mean"),
                     F.sqrt(F.col("_var") / n1 + ctl("_var") / n0))
    if sessions is not None:
        told = (sessions.withColumn("variant", assign(F.col(user))) if callable(assign)
                else sessions.join(assign.select(user, "variant"), user, "inner"))
        dur = (told.groupBy("variant").agg(
                   # exact integer sum, one division: independent of summation order
                   (F.sum("duration_us").cast("double") / F.count(F.lit(1)).cast("double")
                    / 60_000_000.0).alias("mean_session_minutes")))
        v = v.join(dur, "variant", "left")
    else:
        v = v.withColumn("mean_session_minutes", F.lit(None).cast("double"))
    return v.select(
        "variant", "users", "views", "clicks", "ctr", "purchasers", "conversion",
        "repeat_purchase_rate", "retention_rate", "searchers", "search_to_purchase",
        "search_abandonment", "mean_session_minutes", "orders",
        "revenue_cents", "avg_order_value", F.col("_mean").alias("revenue_per_user_cents"),
        (F.try_divide(p1, p0) - 1.0).alias("conversion_lift"),
        F.when(F.col("variant") == control, F.lit(None).cast("double")).otherwise(z).alias("z_conversion"),
        F.when(F.col("variant") == control, F.lit(None).cast("double")).otherwise(t).alias("t_revenue"))
