"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import session

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read again.

    Like a checkpoint it cuts the lineage and outlives executors, but columns are compressed and can be pruned.
    """
    path = session.scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As :func:`written`, in as many buckets by ``key`` as shuffles have partitions: what is grouped by it later is not dealt again."""
    spark = df.sparkSession
    path, table = session.scratch_dir(spark, name), f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.bucketBy(shuffle_partitions(spark), key).option("compression", "zstd").option("path", path).saveAsTable(table)
    made = spark.table(table)
    # Only the name goes: the files lie outside of the warehouse.
    spark.sql(f"DROP TABLE {table}")
    return made


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one slice hold about ``limit`` bytes; one longer text stays whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def release() -> None:
    """Hand memory that is not in use back to the system. A worker that waits for its next task would keep the most it ever
    had, next to the workers that run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(task: Task) -> Task:
    """``task`` over the batches of a partition, with its memory given back at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            release()

    return run
