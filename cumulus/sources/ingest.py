"""CSV ingest with a contract and a quarantine.

Text is read once, with an explicit schema and a column that keeps a line
that doesn't fit it (never with inferred types, which would read it twice and
follow the data). Each row gets the reasons why it breaks the contract; good
and rejected rows are written in the same pass, into two folders of one
table, so nothing is lost and a run over dirty files doesn't fail. What the
contract found is counted from the written table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: The line of a row that doesn't fit the schema.
RESCUED = "rescued"


@dataclass(frozen=True)
class Contract:
    """A schema, the columns that must have a value, and further rules: name
    of a reason -> condition (SQL) that a good row meets. A rule that is null
    for a row is not met."""
    schema: T.StructType
    required: tuple[str, ...] = ()
    rules: Mapping[str, str] = field(default_factory=dict)

    def reasons(self) -> Column:
        """What is wrong with a row, comma-joined; empty for a good one."""
        found = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in self.required]
        found += [F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(f"rule:{name}")) for name, rule in self.rules.items()]
        found.append(F.when(F.col(RESCUED).isNotNull(), F.lit("malformed")))
        return F.concat_ws(",", *found)


EVENT_CONTRACT = Contract(
    T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
                  T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                  T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
    required=("event_id", "ts", "user_id", "event_type"))


def read_rescued(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """The files' rows in the schema's columns; a field that doesn't fit is
    null, and its whole line is kept in ``rescued``."""
    told = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    options = {"header": "true", "escape": '"', "mode": "PERMISSIVE", **options}
    return spark.read.schema(told).option("columnNameOfCorruptRecord", RESCUED).options(**options).csv(path)


def ingest_csv(spark: SparkSession, path: str, contract: Contract, target: str, **options: str) -> DataFrame:
    """Reads the CSV files at ``path`` and writes all rows to the table at
    ``target``, in folders ``accepted=true`` and ``accepted=false``, with the
    reasons and the lines of rejected rows. Returns that table."""
    rows = read_rescued(spark, path, contract.schema, **options).withColumn("reasons", contract.reasons())
    rows.withColumn("accepted", F.col("reasons") == "").write.partitionBy("accepted").parquet(target)
    told = T.StructType([*contract.schema.fields, T.StructField(RESCUED, T.StringType()),
                         T.StructField("reasons", T.StringType()), T.StructField("accepted", T.BooleanType())])
    return spark.read.schema(told).parquet(target)


def accepted(ingested: DataFrame) -> DataFrame:
    """The good rows; the rejected ones' files aren't read."""
    return ingested.where("accepted").drop(RESCUED, "reasons", "accepted")


def reason_counts(ingested: DataFrame) -> DataFrame:
    """Rows by reason; a row counts under each of its reasons, good ones
    under ``accepted``."""
    reason = F.explode(F.split(F.when(F.col("reasons") == "", F.lit("accepted")).otherwise(F.col("reasons")), ","))
    return ingested.select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))
