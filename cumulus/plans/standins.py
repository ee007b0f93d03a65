"""Stand-in inputs derived from the driver's tables.

The reference's domain tables (player seasons, game details, web events,
devices, matches) are absent; each is mapped onto a driver table here, as
lazy DataFrames, so every registered query reads the real tables and its
work grows with them. Mapping (see README):

* player seasons   -> orders per (customer, order year), customer attributes
* game details     -> lineitem (game = order, player = supplier, pts = quantity)
* games            -> orders (home team = customer's nation)
* teams            -> nation
* web events       -> events (host/url/step = event_type, ip from user_id)
* devices          -> customer x nation x region (segment, nation, region)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cumulus.functions.columns import cents
from cumulus.sources.tables import events_utc, table

# Fixed parameters of the stand-in queries.
SNAPSHOT_END = 2001          # last order year in the data
SNAPSHOT_PREV = 2000
EVENT_DAY = "2024-01-30"     # last event day in the data
EVENT_PREV_DAY = "2024-01-29"
EVENT_MONTH_START = "2024-01-01"


def _year_range(col: str, year: int | None):
    """Raw-column range for one year: pushed into the parquet scan (the
    derived ``year(col)`` is not)."""
    import datetime as dt
    if year is None:
        return F.lit(True)
    return ((F.col(col) >= F.lit(dt.datetime(year, 1, 1))) &
            (F.col(col) < F.lit(dt.datetime(year + 1, 1, 1))))


def _day_range(col: str, first: str | None, last: str | None):
    """Raw-column range for [first, last] days, pushable into the scan."""
    import datetime as dt
    cond = F.lit(True)
    if first is not None:
        cond = cond & (F.col(col) >= F.lit(dt.datetime.fromisoformat(first)))
    if last is not None:
        cond = cond & (F.col(col) < F.lit(dt.datetime.fromisoformat(last) + dt.timedelta(days=1)))
    return cond


def customer_years(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Player-season stand-in: one row per (customer, order year).

    gp = orders, pts = order value in units of 20,000 (exact: summed as
    integer cents), reb = finished orders, ast = urgent orders. Static
    attributes (segment, nation) come from ``customer``.
    """
    o = table(spark, sf_dir, "orders").filter(_year_range("o_orderdate", year))
    per_year = (o.groupBy(F.col("o_custkey").alias("c_custkey"),
                          F.year("o_orderdate").cast("int").alias("season"))
                .agg(F.count(F.lit(1)).alias("gp"),
                     (F.sum(cents("o_totalprice")).cast("double") / 2000000.0).alias("pts"),
                     F.count_if(F.col("o_orderstatus") == "F").alias("reb"),
                     F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("ast")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return per_year.join(c, "c_custkey", "inner")


def events(spark: SparkSession, sf_dir: str, first_day: str | None = None,
           last_day: str | None = None) -> DataFrame:
    """Web-event stand-in with a session-zone timestamp and event_date;
    an optional day range is applied on the raw column (pushed down)."""
    e = table(spark, sf_dir, "events")
    if first_day is not None or last_day is not None:
        e = e.filter(_day_range("ts", first_day, last_day))
    return events_utc(e)


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device dimension stand-in keyed by ``device_id`` = customer key:
    os_type = market segment, device_type = nation, browser_type = region."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region are fixed 25- and 5-row dimensions: broadcast is
    # bounded by the schema, not by the data volume.
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select(F.col("c_custkey").alias("device_id"),
                     F.col("c_mktsegment").alias("os_type"),
                     F.col("n_name").alias("device_type"),
                     F.col("r_name").alias("browser_type")))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game-detail stand-in: lineitem x supplier. game = order, player =
    supplier, team = supplier's nation, pts = quantity, start_position =
    line number. The comment carries the flag markers by return flag /
    line status (null otherwise); ``min`` is 'quantity:tax-cents'."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax",
        "l_returnflag", "l_linestatus")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey, "inner")
    comment = (F.when(F.col("l_returnflag") == "R", F.lit("DNP - returned"))
               .when(F.col("l_returnflag") == "A", F.lit("NWT - accepted"))
               .when(F.col("l_linestatus") == "O", F.lit("DND - open")))
    minutes = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(":"),
                       F.lpad(F.round(F.col("l_tax") * 100).cast("int").cast("string"), 2, "0"))
    return j.select(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player_id"),
                    F.col("s_nationkey").cast("long").alias("team_id"),
                    F.col("s_name").alias("player_name"),
                    F.col("l_linenumber").alias("start_position"),
                    comment.alias("comment"), minutes.alias("min"),
                    F.col("l_quantity").alias("pts"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game stand-in: orders, home team = the customer's nation."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderstatus", "o_orderpriority", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(F.col("o_orderkey").alias("game_id"),
                    F.to_date("o_orderdate").alias("game_date_est"),
                    F.year("o_orderdate").alias("season"),
                    F.col("c_nationkey").cast("long").alias("home_team_id"),
                    "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")


def scored_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with both scores: pts_home (points of the home team), the
    visitor (the other team with most points, ties to the smallest id) and
    its pts_away; a side without details has 0 points."""
    d = game_details(spark, sf_dir).groupBy("game_id", "team_id").agg(F.sum(F.col("pts").cast("long")).alias("pts"))
    g = games(spark, sf_dir)
    home = F.col("team_id") == F.col("home_team_id")
    scores = (d.join(g.select("game_id", "home_team_id"), "game_id").groupBy("game_id")
              .agg(F.sum(F.when(home, F.col("pts"))).alias("pts_home"),
                   F.min(F.when(~home, F.struct((-F.col("pts")).alias("less"), "team_id"))).alias("away")))
    return g.join(scores, "game_id", "left").select(
        *g.columns, F.coalesce("pts_home", F.lit(0)).alias("pts_home"),
        F.coalesce(-F.col("away.less"), F.lit(0)).alias("pts_away"),
        F.col("away.team_id").alias("visitor_team_id"))


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web-event stand-in with a referrer: the host of the page whose id is
    the event's ``props.k``; url = event_type. Events whose page does not
    exist keep a null referrer."""
    e = events(spark, sf_dir).select(
        "user_id", "event_type", "ts", "event_date",
        F.get_json_object("props", "$.k").cast("long").alias("_k"))
    p = table(spark, sf_dir, "pages").select(
        F.col("page_id"), F.try_parse_url(F.col("url"), F.lit("HOST")).alias("referrer"))
    j = e.join(p, e._k == p.page_id, "left")
    return j.select("user_id", F.col("event_type").alias("url"), "referrer", "ts", "event_date")


def page_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device dimension keyed by page id: browser_type = page host,
    os_type = URL scheme, device_type = first path segment."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    path = F.try_parse_url(F.col("url"), F.lit("PATH"))
    return p.select(F.col("page_id").alias("device_id"),
                    F.try_parse_url(F.col("url"), F.lit("HOST")).alias("browser_type"),
                    F.try_parse_url(F.col("url"), F.lit("PROTOCOL")).alias("os_type"),
                    F.split_part(path, F.lit("/"), F.lit(2)).alias("device_type"))


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with device_id = props.k and host = event_type."""
    e = events(spark, sf_dir)
    return e.select("event_id", "user_id",
                    F.get_json_object("props", "$.k").cast("long").alias("device_id"),
                    F.col("event_type").alias("host"), "ts")


# IPv4 stand-in: every user gets an address in 10.0.0.0/8 from its id.
IP_BASE = 167772160          # 10.0.0.0
IP_SPACE = 16777216          # 2^24
IP_MULT = 2654435761         # spreads consecutive ids over the space
GEO_STEP = IP_SPACE // 25    # one range per nation ...
GEO_WIDTH = 600000           # ... covering ~89% of its slice; the rest is unknown


def user_ip(user_col: str = "user_id"):
    from cumulus.operators.enrich import long_to_ip
    n = F.lit(IP_BASE) + (F.col(user_col) % IP_SPACE) * IP_MULT % IP_SPACE
    return long_to_ip(n)


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geo dimension stand-in: one IP range per nation, region as state."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    start = F.lit(IP_BASE) + F.col("n_nationkey").cast("long") * GEO_STEP
    return j.select(start.alias("ip_start"), (start + GEO_WIDTH - 1).alias("ip_end"),
                    F.col("n_name").alias("country"), F.col("r_name").alias("state"),
                    F.concat(F.lit("CITY_"), F.col("n_nationkey").cast("string")).alias("city"))


def actor_films(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Actor-film stand-in: actor = customer, film = order, year = order
    year, votes = line count proxy (priority digit), rating on a 0-10 scale
    from the order value (exact: integer cents / 5,000,000)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_totalprice", "o_orderpriority")
    o = o.filter(_year_range("o_orderdate", year))
    return o.select(F.col("o_custkey").alias("actorid"),
                    F.concat(F.lit("film_"), F.col("o_orderkey").cast("string")).alias("film"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("votes"),
                    (cents("o_totalprice").cast("double") / 5000000.0).alias("rating"),
                    cents("o_totalprice").alias("rating_cents"),
                    F.col("o_orderkey").alias("filmid"),
                    F.year("o_orderdate").cast("int").alias("year"))
