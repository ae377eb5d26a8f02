"""Named queries: each runs an operator over the given tables, most with a SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]


def reported(df: DataFrame) -> DataFrame:
    """Presentation types: decimals as double, timestamps without zone."""
    shown = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, TimestampType):
            value = value.cast("timestamp_ntz")
        shown.append(value.alias(field.name))
    return df.select(*shown)


class Registry:
    """Collects queries and their SQL by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            key = name or query.__name__
            if key in self.queries:
                raise ValueError(f"duplicate query {key}")
            self.queries[key] = lambda spark, folder: reported(query(spark, folder))
            if sql is not None:
                self.oracles[key] = sql
            return query

        return register

    def merge(self, other: Registry) -> None:
        if shared := self.queries.keys() & other.queries.keys():
            raise ValueError(f"duplicate queries {sorted(shared)}")
        self.queries |= other.queries
        self.oracles |= other.oracles
