"""Period loop for incremental operators.

Each period's output is written to the shared folder and read back as the
next period's input, so lineage stays one step deep and a lost executor
only recomputes the current period. The same path is never read and
overwritten in one plan: every period gets its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from cumulus.session import scratch_path


def run_periods(spark: SparkSession, step: Callable[[DataFrame | None, object], DataFrame],
                periods: Iterable, base: str | None = None,
                initial: DataFrame | None = None) -> tuple[DataFrame | None, list[str]]:
    """``step(prev, period) -> table at period``; ``prev`` is the table
    read back from the previous period's folder (``initial`` first).
    Returns the last table and the folders written."""
    root = base or scratch_path(spark, "periods")
    prev, paths = initial, []
    for i, p in enumerate(periods):
        out = step(prev, p)
        path = f"{root}/period={i:05d}"
        out.write.mode("overwrite").parquet(path)
        paths.append(path)
        prev = spark.read.parquet(path)
    return prev, paths


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's shared
    checkpoint folder (never a local checkpoint)."""
    return df.checkpoint(eager=True)
