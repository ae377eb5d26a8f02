"""CSV, JSON and Parquet readers with fixed, inferred or merged schemas."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt_record"


# A schema is a StructType or its DDL text.
Schema = StructType | str


def _with_corrupt(schema: Schema) -> Schema:
    if isinstance(schema, str):
        return f"{schema}, {CORRUPT} string"
    return StructType(list(schema.fields)).add(CORRUPT, StringType())


def read_csv(spark: SparkSession, path: str, schema: Schema | None = None, **options: Any) -> DataFrame:
    """CSV with a header.

    With a schema, rows that do not fit keep their text in ``_corrupt_record`` instead of being
    lost. Without one the types are inferred, which reads the file twice.
    """
    reader = spark.read.option("header", True).options(**options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return (
        reader.option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(_with_corrupt(schema))
        .csv(path)
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    multi_line: bool = False,
    **options: Any,
) -> DataFrame:
    """JSON lines (splittable, the default) or one JSON document per file (``multi_line``)."""
    reader = spark.read.option("multiLine", multi_line).options(**options)
    if schema is None:
        return reader.json(path)
    return (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(_with_corrupt(schema))
        .json(path)
    )


def stream_files(spark: SparkSession, path: str, kind: str, schema: Schema, **options: Any) -> DataFrame:
    """New files of a folder as a stream: ``csv`` with a header, or ``json`` (lines, unless ``multiLine`` is set).

    As with the batch readers, rows that do not fit keep their text in ``_corrupt_record``.
    """
    own = {"header": True, "enforceSchema": False} if kind == "csv" else {}
    reader = spark.readStream.format(kind).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(**(own | options)).schema(_with_corrupt(schema)).load(path)


RESCUED = "_rescued_data"


def parse_json(lines: DataFrame, schema: Schema, column: str = "value") -> DataFrame:
    """JSON text parsed against a known schema, with what does not fit kept instead of lost.

    Fields that the schema does not have, and fields whose value does not parse as the column's type (which is then
    NULL), are kept as a JSON object of their texts in ``_rescued_data``; text that is no JSON object is kept in
    ``_corrupt_record``. Other columns of ``lines`` stay, unless the schema has their names.
    """
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = F.col(column)
    # A JSON object starts with a brace; from_json takes anything else for an empty one.
    fields = F.when(F.trim(text).startswith("{"), F.from_json(text, "map<string,string>"))
    parsed = lines.select(
        *[c for c in lines.columns if c != column and c not in kinds.names],
        text.alias("_text"), fields.alias("_fields"), F.from_json(text, kinds).alias("_parsed"),
    )
    unfit = {name: F.col("_parsed")[name].isNull() for name in kinds.names}
    known = F.array(*[F.lit(n) for n in kinds.names]) if kinds.names else F.array().cast("array<string>")
    missed = F.array(*[F.when(empty, F.lit(n)) for n, empty in unfit.items()]) if unfit else F.array().cast("array<string>")
    kept = F.map_filter("_fields", lambda k, v: v.isNotNull() & (~F.array_contains(known, k) | F.array_contains(F.col("_missed"), k)))
    rescued = parsed.withColumn("_missed", F.array_compact(missed))
    others = [c for c in parsed.columns if c not in ("_text", "_fields", "_parsed")]
    return rescued.select(
        *others,
        *[F.col("_parsed")[name].alias(name) for name in kinds.names],
        F.when(F.size(kept) > 0, F.to_json(kept)).alias(RESCUED),
        F.when(F.col("_fields").isNull() & F.col("_text").isNotNull(), F.col("_text")).alias(CORRUPT),
    )


def read_parquet(
    spark: SparkSession, path: str, schema: Schema | None = None, merge_schema: bool = False
) -> DataFrame:
    """Parquet; ``merge_schema`` unites the columns of files written at different times."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def bad_rows(df: DataFrame) -> DataFrame:
    """One row: records read, records that did not fit the schema, values present per column.

    The per-column counts are more than information: a scan parses only the columns a query
    needs, and a record is corrupt only if a needed column is.
    """
    columns = [c for c in df.columns if c != CORRUPT]
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count(CORRUPT).alias("corrupt_records"),
        *[F.count(c).alias(f"{c}_present") for c in columns],
    )


def _origin(df: DataFrame):
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return F.input_file_name()
    return F.col("_metadata.file_path")


def with_audit(df: DataFrame, batch_id: str = "manual") -> DataFrame:
    """Add ingestion time, source file and batch id; call it right after the reader."""
    return df.select(
        "*",
        F.current_timestamp().alias("_ingestion_timestamp"),
        _origin(df).alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
    )


def with_constants(df: DataFrame, constants: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})
