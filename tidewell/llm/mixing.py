"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every document of a source is expected ``target / source_size`` times. Documents stand in one order within their
source; the prefix sums of the expected copies, moved by one random offset, cross integers, and each crossing emits
the document once. In order of size, neighbours are alike, so the words taken stay within about one document of the
target, whatever the offset.

The order is a range partitioning over (source, size, id): a source that holds a third of all rows is spread over a
third of the partitions, and only one row per partition and source is summed up to place it.

Defined results: a null or empty text has size 0; a null source is a source of its own, last in order; a source
without words has target 0 and is not taken; equal rows are separate documents that get neighbouring places; an
empty table gives an empty table. Columns of the input other than those named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell import session
from tidewell.llm.common import word_count

# Weights of the sources in order of their names, repeating; shares are of all words.
WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MOST_COPIES = 2


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` with ``target``, one row per source.

    The total is dealt by weight; a source stops at ``MOST_COPIES`` times its size and its excess is dealt again.
    Sorted by size per weight, the stopped sources are a prefix, so running sums find them without rounds.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = sizes.withColumn("_w", F.element_at(weights, (F.row_number().over(named) - 1) % len(WEIGHTS) + 1))
    filling = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    cap = F.col("source_size") * MOST_COPIES
    before = F.coalesce(F.sum(cap).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum("_w").over(filling.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * F.lit(TOTAL_SHARE)
    stopped = (cap * from_here).cast("double") <= F.col("_w") * (total - before)
    flagged = weighed.select("*", total.alias("_total"), stopped.alias("_stopped"))
    left = F.col("_total") - F.coalesce(F.sum(F.when(F.col("_stopped"), cap)).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_stopped"), F.col("_w"))).over(everything)
    share = F.when(F.col("_stopped"), cap.cast("double")).otherwise(F.col("_w") * left / open_weight)
    return flagged.select("source", "source_size", share.alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The random offset of a source, in [0, 1): the same in every run with the same seed."""
    text = F.concat(F.lit(f"mix {seed} "), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def placed_copies(rows: DataFrame, seed: int = 42) -> DataFrame:
    """``doc_id, source, size`` with ``source_size, target, copies``."""
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("doc_id").asc_nulls_first()]
    placed = session.durable(
        rows.select("doc_id", "source", "size")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.monotonically_increasing_id().alias("_at"))
        .select("*", F.shiftright("_at", 33).alias("_part"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_group"))
    )
    pieces = placed.groupBy("_group", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "_group", "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    sums = placed.groupBy("_group").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    goals = targets(sums.drop("_group")).withColumn("_group", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = starts.join(
        goals.select("_group", "source_size", "target", rate.alias("_rate"), offset(F.col("source"), seed).alias("_offset")),
        "_group",
    )
    at = F.col("_at") + F.col("_shift")
    crossed = lambda n: F.floor(F.col("_rate") * n + F.col("_offset"))
    return placed.join(plan, ["_group", "_part"]).select(
        "doc_id", "source", "size", "source_size", "target", (crossed(at + 1) - crossed(at)).alias("copies")
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The documents, each as often as the mix takes it, with the columns they came with.

    Copies are found by id, source and size; of several rows with the same three, each takes the copies of one place.
    """
    same = ["_doc", "_source", "_size"]
    keyed = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), word_count(F.col("text")).alias("_size")
    )
    nth = Window.partitionBy(*same)
    keyed = keyed.withColumn("_nth", F.row_number().over(nth.orderBy(F.xxhash64("_row.text"))))
    taken = placed_copies(sized(docs), seed).select(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies"
    )
    taken = taken.withColumn("_nth", F.row_number().over(nth.orderBy("copies")))
    meets = [keyed[c].eqNullSafe(taken[c]) for c in (*same, "_nth")]
    return (
        keyed.join(taken.where("copies > 0"), meets)
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("_row.*")
    )


def op2_mix(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = placed_copies(sized(docs))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP2_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), sums AS (
    SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sums
), running AS (
    SELECT *,
        COALESCE(SUM(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        SUM(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS from_here,
        SUM(source_size) OVER () * 1.5::DOUBLE AS total
    FROM weighed WINDOW o AS (ORDER BY source_size / w, source NULLS LAST)
), flagged AS (
    SELECT *, (2 * source_size * from_here)::DOUBLE <= w * (total - before::DOUBLE) AS stopped FROM running
), goals AS (
    SELECT source, source_size,
        CASE WHEN stopped THEN (2 * source_size)::DOUBLE
        ELSE w * (total - COALESCE(SUM(CASE WHEN stopped THEN 2 * source_size END) OVER (), 0)::DOUBLE)
            / SUM(CASE WHEN NOT stopped THEN w END) OVER () END AS target,
        CAST('0x' || substr(md5('mix 42 ' || COALESCE('=' || source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS shift
    FROM flagged
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS place FROM sized
), rated AS (
    SELECT p.doc_id, p.size, g.source_size, g.target, p.place, g.shift,
        CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate
    FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
    CAST((floor(rate * place + shift) - floor(rate * (place - 1) + shift)) * size AS BIGINT) AS taken
FROM rated
"""
