"""One ordered scan over a whole table: neighbours, running sums and ranks, however large a group is.

Rows are range-partitioned by (keys, order) and numbered along it. A row number of its own ends the order, so rows with
one key and one value, however many, are spread like any others. Work within a partition is a window over the
partition; what crosses from one partition to the next is one row per partition: its ends, and the sums of the key
that is open at its end. Those rows, as many as partitions, are ordered in one task and broadcast.

The layout survives filters: the next step on a filtered frame sees the rows that are left as neighbours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.session import stored

PART, AT = "_slot", "_at"


def laid_out(df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """``df`` with ``_at``, ascending along the keys and the order within them, and ``_slot``, the partition of the layout.

    ``parts`` is the number of partitions, by default that of shuffles. The layout is materialised.
    """
    count = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    along = [*[F.col(k) for k in keys], *order, F.col("_row")]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(count, *along).sortWithinPartitions(*along)
    return stored(ranged.withColumn(AT, F.monotonically_increasing_id()).drop("_row")).withColumn(PART, F.shiftright(AT, 33))


def _row(columns: Sequence[str]) -> Column:
    """Columns as a struct that is never NULL, also without columns."""
    return F.struct(F.lit(True).alias("_there"), *[F.col(c).alias(f"_{c}") for c in columns])


def _same(left: Column, right: Column, keys: Sequence[str]) -> Column:
    """Whether two rows (as of :func:`_row`) are there and have the same keys."""
    return reduce(Column.__and__, [left[f"_{k}"].eqNullSafe(right[f"_{k}"]) for k in keys], left.isNotNull() & right.isNotNull())


def with_neighbour(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str, ahead: bool = False, base: DataFrame | None = None
) -> DataFrame:
    """Struct ``name`` of the ``values`` in the previous (or, ``ahead``, the next) row of the same keys; NULL if there is none.

    ``base``, a cheaper frame with the same rows, may give the ends of the partitions.
    """
    step, pick = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    taken = _row([*keys, *[v for v in values if v not in keys]])
    edges = (df if base is None else base).groupBy(PART).agg(pick(taken, F.col(AT)).alias("_edge"))
    carried = edges.select(PART, step("_edge").over(W.orderBy(PART)).alias("_carried"))
    near = df.withColumn("_near", step(taken).over(W.partitionBy(PART).orderBy(AT))).join(F.broadcast(carried), [PART], "left")
    found = F.coalesce("_near", "_carried")
    value = F.struct(*[found[f"_{v}"].alias(v) for v in values])
    return near.withColumn(name, F.when(_same(found, _row(keys), keys), value)).drop("_near", "_carried")


def with_running(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Running sums within the keys, from their first row to the current one. ``df`` is read three times: for the keys at
    the ends of the partitions, for the sums of the key at the end of each, and for the rows."""
    own = _row(keys)
    ends = df.groupBy(PART).agg(F.min_by(own, F.col(AT)).alias("_first"), F.max_by(own, F.col(AT)).alias("_last"))
    at_end = {c: F.sum(F.when(_same(own, F.col("_last"), keys), v)) for c, v in sums.items()}
    pieces = df.join(F.broadcast(ends), [PART]).groupBy(PART, "_first", "_last")
    pieces = pieces.agg(*[F.coalesce(v, F.lit(0)).alias(f"_end_{c}") for c, v in at_end.items()])
    # A run of partitions in which one key stays open: a partition goes on with it if it holds that key alone.
    along = W.orderBy(PART)
    opened = pieces.withColumn("_open", F.lag("_last").over(along))
    goes_on = _same(F.col("_first"), F.col("_open"), keys)
    alone = _same(F.col("_first"), F.col("_last"), keys)
    runs = opened.withColumns({"_goes_on": goes_on, "_run": F.sum(F.when(goes_on & alone, 0).otherwise(1)).over(along)})
    so_far = {f"_sum_{c}": F.sum(f"_end_{c}").over(W.partitionBy("_run").orderBy(PART)) for c in sums}
    summed = runs.withColumns(so_far)
    carries = {f"_carry_{c}": F.when(F.col("_goes_on"), F.lag(f"_sum_{c}").over(along)) for c in sums}
    carried = summed.select(PART, "_first", *[v.alias(c) for c, v in carries.items()])
    inside = W.partitionBy(PART, *keys).orderBy(AT).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = df.withColumns({c: F.sum(v).over(inside) for c, v in sums.items()}).join(F.broadcast(carried), [PART])
    first = _same(_row(keys), F.col("_first"), keys)
    moved = {c: F.col(c) + F.when(first, F.coalesce(f"_carry_{c}", F.lit(0))).otherwise(F.lit(0)) for c in sums}
    return local.withColumns(moved).drop("_first", *carries)


def with_ranks(df: DataFrame, value: str, dense: str, above: str, parts: int | None = None) -> DataFrame:
    """Over the whole table, from the greatest value down (NULLs last): the dense rank, and the number of rows with a
    greater value.

    Ranks within a partition are moved by what lies before it: distinct values, and rows. A value that goes on from one
    partition to the next has one rank, and what is above it is what was above its first row.
    """
    placed = laid_out(df, [], [F.desc_nulls_last(value)], parts)
    down = W.partitionBy(PART).orderBy(F.desc_nulls_last(value))
    local = placed.withColumns({"_dense_here": F.dense_rank().over(down), "_rank_here": F.rank().over(down)})
    whole = F.struct(F.col(value).alias("v"))
    ends = local.groupBy(PART).agg(
        F.min_by(whole, F.col(AT)).alias("_first"), F.max_by(whole, F.col(AT)).alias("_last"),
        F.count(F.lit(1)).alias("_rows"), F.max("_dense_here").alias("_values"), F.max("_rank_here").alias("_last_rank"),
    )
    along, earlier = W.orderBy(PART), W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(along)), F.lit(False))
    opened = ends.withColumns({"_goes_on": goes_on, "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0))})
    shared = F.when(F.col("_goes_on"), 1).otherwise(0)
    # The last value of a partition began at its own rank there, unless all of the partition goes on from before.
    began = F.when(~(F.col("_goes_on") & (F.col("_values") == 1)), F.col("_before") + F.col("_last_rank") - 1)
    counted = opened.withColumns(
        {"_moved": F.coalesce(F.sum(F.col("_values") - shared).over(earlier), F.lit(0)) - shared, "_began": F.last(began, True).over(along)}
    )
    carried = counted.select(PART, "_moved", "_before", F.when(F.col("_goes_on"), F.lag("_began").over(along)).alias("_open"))
    joined = local.join(F.broadcast(carried), [PART])
    open_ = (F.col("_dense_here") == 1) & F.col("_open").isNotNull()
    found = {dense: F.col("_dense_here") + F.col("_moved"), above: F.when(open_, F.col("_open")).otherwise(F.col("_before") + F.col("_rank_here") - 1)}
    return joined.withColumns(found).drop("_dense_here", "_rank_here", "_moved", "_before", "_open", PART, AT)
