"""Parquet table writers.

A writer never targets the directory its own input is read from: Spark deletes the target before
it reads the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(df: DataFrame, path: str) -> None:
    """Append; new columns are allowed and show up for readers that merge schemas."""
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the table, schema included."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, columns: Sequence[str], only_touched: bool = False
) -> None:
    """Replace a partitioned table, or with ``only_touched`` just the partitions present in ``df``.

    The rebalance hint lets adaptive execution gather each partition value into well-sized files
    and split a value that holds a large share of the rows over several tasks.
    """
    mode = "dynamic" if only_touched else "static"
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*columns)
        .parquet(path)
    )
