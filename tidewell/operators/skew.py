"""Diagnosing crowded keys and joining in spite of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.numbers import ratio
from tidewell.session import durable

# Thresholds of the diagnosis.
SKEW_RATIO = 10
BALANCE_RATIO = 3
HOT_SHARE = 0.05


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def diagnose(df: DataFrame, key: str, threshold: float = SKEW_RATIO) -> DataFrame:
    """One row: rows, distinct keys, largest and median group, their ratio, and a verdict.

    Group sizes are compressed to (size, frequency) pairs before the exact median.
    """
    sizes = key_counts(df, key).groupBy("n").agg(F.count(F.lit(1)).alias("keys"))
    stats = sizes.agg(
        F.coalesce(F.sum(F.col("n") * F.col("keys")), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("keys"), F.lit(0)).alias("unique_keys"),
        F.max("n").alias("max_count"),
        F.percentile("n", F.lit(0.5), F.col("keys")).alias("median_count"),
    )
    shown = ratio(F.col("max_count"), F.col("median_count"), 2)
    verdict = F.coalesce(F.col("max_count") > F.col("median_count") * F.lit(threshold), F.lit(False))
    return stats.withColumns({"skew_ratio": shown, "has_skew": verdict})


def top_keys(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent keys; ties go to the smaller key."""
    return key_counts(df, key).orderBy(F.desc("n"), F.asc_nulls_last(key)).limit(n)


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: never more than ``1 / share`` of them."""
    counts = key_counts(df, key)
    total = counts.agg(F.sum("n"))
    return counts.where(F.col("n") >= F.lit(share) * total.scalar())


def fits_broadcast(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 10 * 1024 * 1024) -> bool:
    """Measure a table: its rows and the sum of their text sizes, added up where the rows are.

    Meant for frames that are materialised anyway (``durable``); others are computed once more.
    """
    size = F.sum(F.length(F.to_json(F.struct(*[F.col(c) for c in df.columns]))))
    measured = df.agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).first()
    return measured["n"] <= max_rows and (measured["bytes"] or 0) <= max_bytes


def broadcast_join(large: DataFrame, small: DataFrame, key: str | Sequence[str], **limits: int) -> DataFrame:
    """Left join that broadcasts ``small`` after measuring it, and shuffles it otherwise."""
    columns = [key] if isinstance(key, str) else list(key)
    return large.join(F.broadcast(small) if fits_broadcast(small, **limits) else small, columns, "left")


def salted_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    factor: int = 10,
    hot: DataFrame | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Left join equal to ``large.join(small, key, "left")`` with crowded keys spread ``factor``-fold.

    Rows of hot keys on the large side get a salt, their partners on the small side one copy per
    salt. The salt hashes the row together with its input partition: a retried task salts its rows
    the same way, and identical rows still spread, because they come from many partitions. Rows
    without a key match nothing; they are salted too, so that they do not gather in one task.

    The broadcast of the hot keys is bounded: at most ``1 / share`` of them exist. A ``hot`` frame
    of the caller is joined without a hint.
    """
    if hot is None:
        flags = F.broadcast(hot_keys(large, key, share).select(key, F.lit(True).alias("_hot")))
    else:
        flags = hot.select(key).distinct().withColumn("_hot", F.lit(True))
    crowded = F.col("_hot").isNotNull() | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in large.columns], F.spark_partition_id()), F.lit(factor))
    salted = large.join(flags, [key], "left").select(
        *[F.col(c) for c in large.columns],
        F.when(crowded, spread).otherwise(F.lit(0)).cast("int").alias("_salt"),
    )
    salts = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(factor - 1))).otherwise(F.array(F.lit(0)))
    copies = small.join(flags, [key], "left").select(*[F.col(c) for c in small.columns], F.explode(salts).alias("_salt"))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def join_cells(left: DataFrame, right: DataFrame, key: str, target: int) -> DataFrame:
    """``key, _rows, _columns`` of every key that needs more than one cell of about ``target`` rows a side.

    Counts combine on the map side; the result has at most ``(rows of both sides) / target`` rows. A key that one
    side lacks needs no cells.
    """
    counted = lambda df, name: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    both = counted(left, "_left").join(counted(right, "_right"), [key])
    cells = lambda n: F.ceil(F.col(n) / F.lit(target)).cast("int")
    return both.select(key, cells("_left").alias("_rows"), cells("_right").alias("_columns")).where("_rows > 1 OR _columns > 1")


def grid_join(
    left: DataFrame, right: DataFrame, key: str, target: int = 1_000_000, how: str = "left", partial: Mapping[str, Column] | None = None
) -> DataFrame:
    """Join on ``key`` (``inner`` or ``left``) with keys that are crowded on both sides dealt to a grid of cells.

    A left row of a crowded key takes one row of the grid and is copied along its columns, a right row takes one column
    and is copied along its rows: every pair meets in exactly one cell, and a cell holds about ``target`` rows of each
    side. Copying is in proportion to the *other* side's size over ``target``, where salting one side copies the other
    whole. Rows are dealt by a hash of the row and its input partition, so a retried task deals them the same way.

    All pairs of a key grow with the product of its two sides. Who only aggregates the partners names the sums as ``partial``:
    the right rows of a cell are then aggregated before they meet, and a left row meets one row per column of its
    key, which holds these aggregates. What is left to the caller is to add them up.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"grid_join is inner or left, not {how!r}")
    cells = durable(join_cells(left, right, key, target))
    small = fits_broadcast(cells)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        marked = df.join(F.broadcast(cells) if small else cells, [key], "left")
        place = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id()), F.coalesce(F.col(own), F.lit(1)))
        copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        spread = marked.select(*[F.col(c) for c in df.columns], place.cast("int").alias(f"_at{own}"), copies.alias("_copies"), "_columns")
        return spread.withColumn(f"_at{other}", F.explode("_copies")).drop("_copies")

    ours = dealt(left, "_rows", "_columns").withColumnRenamed("_columns", "_crowded")
    theirs = dealt(right, "_columns", "_rows").drop("_columns")
    if partial is not None:
        theirs = theirs.groupBy(key, "_at_rows", "_at_columns").agg(*[value.alias(name) for name, value in partial.items()])
    theirs = theirs.withColumn("_met", F.lit(True))
    joined = ours.join(theirs, [key, "_at_rows", "_at_columns"], how)
    # A crowded left row has partners in some column of its row; in the others it is no row of the result.
    found = joined.where(F.col("_met").isNotNull() | F.coalesce(F.col("_crowded") <= 1, F.lit(True)))
    return found.drop("_at_rows", "_at_columns", "_crowded", "_met")


def repartitioned_join(large: DataFrame, small: DataFrame, key: str, partitions: int = 200) -> DataFrame:
    """Left join with both sides hashed to ``partitions`` first; for moderate skew only."""
    return large.repartition(partitions, key).join(small.repartition(partitions, key), [key], "left")


def partition_balance(df: DataFrame, threshold: float = BALANCE_RATIO) -> DataFrame:
    """One row about the rows per non-empty partition; ``balanced`` when max / mean is below ``threshold``."""
    sizes = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    stats = sizes.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("n").alias("total_records"),
        F.max("n").alias("max_rows"),
        F.min("n").alias("min_rows"),
    )
    mean = F.col("total_records") / F.col("partitions")
    return stats.withColumns({"avg_rows": mean, "balanced": F.col("max_rows") < mean * F.lit(threshold)})
