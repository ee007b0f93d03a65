"""Dimension enrichment (A27 geo enrichment, A31 events with devices).

The reference looks up each IP with a per-row HTTP call. Here the lookup
is a range join against a geo dimension, turned into an equi join: each
range is expanded to the /16 prefixes it covers, the event's IP prefix is
the join key and the range test is a residual filter. Spark's own
size statistics decide whether the dimension side is broadcast or the equi
join shuffles on the prefix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cumulus.functions.columns import col_

PREFIX_BITS = 16


def ip_to_long(ip) -> Column:
    """Dotted IPv4 text -> long; malformed text -> null."""
    parts = F.split(col_(ip), r"\.")
    octets = [F.get(parts, i).try_cast("long") for i in range(4)]
    ok = (F.size(parts) == 4)
    for o in octets:
        ok = ok & o.isNotNull() & (o >= 0) & (o <= 255)
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(ok, value)


def long_to_ip(n) -> Column:
    c = col_(n)
    return F.concat_ws(".", *[(F.shiftright(c, s) % 256).cast("string") for s in (24, 16, 8, 0)])


def enrich_geo(df: DataFrame, ip_col: str, geo: DataFrame, fields: Sequence[str],
               start: str = "ip_start", end: str = "ip_end", out: str = "geodata",
               prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """Add ``out`` = JSON of ``fields`` of the geo range containing the IP,
    ``'{}'`` when none does (unknown or malformed IP). Ranges must not
    overlap (one match per IP)."""
    g = geo.select(F.col(start).alias("_gs"), F.col(end).alias("_ge"),
                   *[F.col(f).alias(f"_g_{f}") for f in fields])
    g = g.withColumn("_pfx", F.explode(F.sequence(F.shiftright("_gs", prefix_bits),
                                                  F.shiftright("_ge", prefix_bits))))
    d = df.withColumn("_ipn", ip_to_long(ip_col)).withColumn("_pfx", F.shiftright("_ipn", prefix_bits))
    gb = g
    cond = ((d["_pfx"] == gb["_pfx"]) & (d["_ipn"] >= gb["_gs"]) & (d["_ipn"] <= gb["_ge"]))
    j = d.join(gb, cond, "left")
    geodata = F.when(F.col("_gs").isNull(), F.lit("{}")).otherwise(
        F.to_json(F.struct(*[F.col(f"_g_{f}").alias(f) for f in fields]), {"ignoreNullFields": "false"}))
    return j.select(*[d[c] for c in df.columns], geodata.alias(out))


def events_with_devices(events: DataFrame, devices: DataFrame, how: str = "inner",
                        device: str = "device_id", user: str = "user_id",
                        upper_cols: Sequence[str] = ("browser_type",)) -> DataFrame:
    """Keep events with non-null user and device ids, join the device
    attributes (``inner`` or ``left``), upper-case the named attributes."""
    e = events.filter(F.col(user).isNotNull() & F.col(device).isNotNull())
    j = e.join(devices, device, how)
    cols = [F.upper(F.col(c)).alias(c) if c in upper_cols else F.col(c) for c in j.columns]
    return j.select(*cols)
