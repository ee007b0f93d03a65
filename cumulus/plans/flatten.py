"""Output normalisation for registered queries: integral columns as
BIGINT, floats as DOUBLE, so the SQL oracle's schema lines up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = c.cast("timestamp")
        cols.append(c.alias(f.name))
    return df.select(*cols)
