"""Zone maps: least and greatest values per file, kept next to a table, that choose the files before a scan.

A table that is clustered inside its date partitions has files with narrow ranges. Parquet's own statistics lie in the
files, so a scan must open each of them to learn that it holds nothing; the zone map is one small table, and a file
it rules out is not even opened. It only ever rules files out: the filter itself is applied to what is read, and files
the map does not know are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sinks import layout, store

# The name hides the map from readers of the table.
ZONES = "_zones"


def write_clustered(
    df: DataFrame,
    path: str,
    date_column: str,
    columns: Sequence[str],
    parts: Sequence[str] = ("year", "month"),
    rows_per_file: int = 1_000_000,
    bits: int = 6,
    cuts: Mapping[str, Sequence] | None = None,
) -> None:
    """Write partitioned by parts of a date, with the rows of a partition in Z-order of ``columns``, and map the zones.

    Rows are range-partitioned by (date parts, Z-value, columns): a month with many rows gets many tasks, several small
    months share one. ``rows_per_file`` bounds the files.
    """
    cuts = layout.zorder_cuts(df, columns, bits) if cuts is None else cuts
    dated = df.withColumns({p: layout.DATE_PARTS[p](date_column) for p in parts if p not in df.columns})
    placed = dated.withColumn("_zvalue", layout.zvalue(dated, cuts, bits))
    order = [*parts, "_zvalue", *columns]
    tasks = max(1, -(-df.count() // rows_per_file))
    ranged = placed.repartitionByRange(int(tasks), *order).sortWithinPartitions(*order).drop("_zvalue")
    ranged.write.mode("overwrite").option("maxRecordsPerFile", 2 * rows_per_file).partitionBy(*parts).parquet(path)
    refresh(df.sparkSession, path, [date_column, *columns])


def _zones(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``file, rows`` and per column ``low_, high_, nulls_``: one aggregate that reads only these columns."""
    found: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        found += [F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*found)


def _name(path: Column) -> Column:
    """A file by its path below the table, spelled alike by listings and scans."""
    return F.url_decode(F.regexp_replace(path, "^file:/+", "/"))


def zones(spark: SparkSession, path: str) -> DataFrame | None:
    """The map of a table, None if there is none."""
    current = store.read_text(spark, f"{path}/{ZONES}/current")
    return spark.read.parquet(f"{path}/{ZONES}/{current}") if current else None


def refresh(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Map the files that the map does not know yet, and forget those that are gone."""
    listed = spark.read.parquet(path)
    files = spark.createDataFrame([(f,) for f in listed.inputFiles()], "file string")
    known = zones(spark, path)
    if known is not None and set(known.columns) >= {f"low_{c}" for c in columns}:
        here = files.select(_name(F.col("file")).alias("_name"))
        old = known.join(here, _name(F.col("file")) == F.col("_name"), "left_semi")
        fresh = files.join(known.select(_name(F.col("file")).alias("_name")), _name(F.col("file")) == F.col("_name"), "left_anti")
        # File names of the table; its listing is on the driver anyway.
        names = [r[0] for r in fresh.collect()]
        made = old if not names else old.unionByName(_zones(spark.read.option("basePath", path).schema(listed.schema).parquet(*names), columns))
    else:
        made = _zones(listed, columns)
    version = store.read_text(spark, f"{path}/{ZONES}/current") or "v0"
    following = f"v{int(version[1:]) + 1}"
    made.write.mode("overwrite").parquet(f"{path}/{ZONES}/{following}")
    store.delete(spark, f"{path}/{ZONES}/current")
    store.write_text(spark, f"{path}/{ZONES}/current", following)
    if version != "v0":
        store.delete(spark, f"{path}/{ZONES}/{version}")


def chosen(spark: SparkSession, path: str, bounds: Mapping[str, tuple[Any, Any]]) -> tuple[list[str], int]:
    """The files that may hold rows within ``bounds`` (``{column: (least, greatest)}``, either may be None), and the
    number of all files."""
    files = spark.read.parquet(path).inputFiles()
    known = zones(spark, path)
    if known is None:
        return files, len(files)
    inside = F.lit(True)
    for c, (low, high) in bounds.items():
        if f"low_{c}" in known.columns:
            inside = inside & (F.lit(True) if low is None else F.col(f"high_{c}") >= F.lit(low))
            inside = inside & (F.lit(True) if high is None else F.col(f"low_{c}") <= F.lit(high))
    listed = spark.createDataFrame([(f,) for f in files], "path string").withColumn("_name", _name(F.col("path")))
    # A file without a zone is kept; one without any value of a bounded column has NULL bounds and goes.
    judged = listed.join(known.select(_name(F.col("file")).alias("_name"), F.coalesce(inside, F.lit(False)).alias("_in")), ["_name"], "left")
    return [r[0] for r in judged.where(F.coalesce("_in", F.lit(True))).select("path").collect()], len(files)


def read_between(spark: SparkSession, path: str, bounds: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """The rows within ``bounds``, read from the files that may hold any."""
    files, _ = chosen(spark, path, bounds)
    schema = spark.read.parquet(path).schema
    rows = spark.read.option("basePath", path).schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (low, high) in bounds.items():
        if low is not None:
            rows = rows.where(F.col(c) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(c) <= F.lit(high))
    return rows
