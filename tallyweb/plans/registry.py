"""The registry that query modules fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Stands in for "now" wherever a query depends on the time.
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if name == "events" else df


def rows(spark: SparkSession, schema: str, *values: tuple) -> DataFrame:
    return spark.createDataFrame(list(values), schema)


def sql_values(*values: tuple) -> str:
    """VALUES for DuckDB."""
    text = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in values)


def stamp(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
