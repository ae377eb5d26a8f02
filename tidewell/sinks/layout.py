"""Partitioning, compaction, clustering and retention of stored tables."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewell.operators.ordered import number_line, quantile_cuts, range_bucket

# Days each layer keeps its rows.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": 730, "staging": 7}

DATE_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def write_partitioned(
    df: DataFrame,
    path: str,
    date_column: str,
    parts: Sequence[str] = ("year", "month"),
    max_records_per_file: int = 1_000_000,
) -> None:
    """Write partitioned by parts of a date, so that a filter on them prunes directories."""
    missing = {p: DATE_PARTS[p](date_column) for p in parts if p not in df.columns}
    (
        df.withColumns(missing)
        .hint("rebalance", *[F.col(p) for p in parts])
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*parts)
        .parquet(path)
    )


def compact(
    spark: SparkSession,
    source: str,
    destination: str,
    target_files: int | None = None,
    partition_columns: Sequence[str] = (),
) -> None:
    """Rewrite a table of many small files into a new directory.

    Without ``target_files`` adaptive execution sizes the files by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. ``partition_columns`` keeps the directories of a partitioned
    table; its files are then sized within them.
    """
    if source.rstrip("/") == destination.rstrip("/"):
        raise ValueError("compact writes a new directory, never the one it reads")
    df = spark.read.option("mergeSchema", True).parquet(source)
    if partition_columns:
        sized = df.hint("rebalance", *[F.col(c) for c in partition_columns])
    else:
        sized = df.repartition(target_files) if target_files else df.hint("rebalance")
    sized.write.mode("overwrite").partitionBy(*partition_columns).parquet(destination)


def zorder_cuts(df: DataFrame, columns: Sequence[str], bits: int = 6) -> dict[str, list]:
    """Split points that cut each column into ``2**bits`` buckets of about equal row counts.

    Numbers, dates and timestamps use approximate quantiles; text takes the least value of each of ``2**bits`` range
    partitions of all its rows. The cuts only steer the file layout.
    """
    numeric = [c for c in columns if not isinstance(df.schema[c].dataType, StringType)]
    cuts = quantile_cuts(df, {c: number_line(df, c) for c in numeric}, 2**bits)
    for name in set(columns) - set(numeric):
        values = df.select(name).where(F.col(name).isNotNull()).groupBy(name).count()
        # Partitions of values weigh by rows: a value stands once for each started share of the rows that it holds.
        share = max(1, df.count() // (64 * 2**bits))
        times = F.sequence(F.lit(1), F.ceil(F.col("count") / share).cast("int"))
        spread = values.select(name, F.explode(times)).repartitionByRange(2**bits, name)
        least = spread.groupBy(F.spark_partition_id().alias("_part")).agg(F.min(name).alias("_least"))
        cuts[name] = sorted({r["_least"] for r in least.collect()})[1:]
    return {name: cuts[name] for name in columns}


def zvalue(df: DataFrame, cuts: Mapping[str, Sequence], bits: int = 6) -> Column:
    """Interleave the bucket bits of the columns, first column in the lowest bit of each group."""
    width = len(cuts)
    z = F.lit(0).cast("bigint")
    for offset, (name, points) in enumerate(cuts.items()):
        text = isinstance(df.schema[name].dataType, StringType)
        bucket = range_bucket(F.col(name) if text else number_line(df, name), points).cast("bigint")
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(one, bit * width + offset))
    return z


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    files: int,
    bits: int = 6,
    cuts: Mapping[str, Sequence] | None = None,
    keep: str | None = None,
) -> DataFrame:
    """Cluster rows so that files and row groups cover small ranges of every listed column.

    The result is range-partitioned and sorted by the interleaved bucket number; write it right
    away. ``keep`` names a column that receives the number.
    """
    cuts = zorder_cuts(df, columns, bits) if cuts is None else cuts
    name = keep or "_zvalue"
    placed = df.withColumn(name, zvalue(df, cuts, bits))
    # Row columns after the number let the range partitioner split one crowded bucket.
    ranged = placed.repartitionByRange(files, name, *columns).sortWithinPartitions(name, *columns)
    return ranged if keep else ranged.drop(name)


def retain(df: DataFrame, column: str, days: int, as_of: datetime.date) -> DataFrame:
    """Rows at most ``days`` old on ``as_of``; rows without a date are kept."""
    first = F.lit(as_of - datetime.timedelta(days=days))
    return df.where(F.col(column).isNull() | (F.col(column) >= first))
