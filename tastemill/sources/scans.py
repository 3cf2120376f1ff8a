"""Input tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastemill.schema import BOOK_MAP_DDL, INTERACTIONS_DDL, USER_MAP_DDL

CSV_SCHEMAS = {
    "interactions": INTERACTIONS_DDL,
    "users": USER_MAP_DDL,
    "books": BOOK_MAP_DDL,
}


def read_csv(spark: SparkSession, which: str, path: str) -> DataFrame:
    """One of the CSV inputs: a header line, a fixed schema, no inference pass."""
    if which not in CSV_SCHEMAS:
        raise ValueError(f"which must be one of {sorted(CSV_SCHEMAS)}, got {which!r}")
    return spark.read.csv(path, header=True, schema=CSV_SCHEMAS[which])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def view_sql(df: DataFrame, name: str, query: str) -> DataFrame:
    """Run SQL over a frame under a view name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(query)
