"""CSV and Parquet scans. A missing path surfaces as Spark's own PATH_NOT_FOUND, naming the path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillroll.sources import schemas


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan a CSV with a header and declared types; no inference pass over the data.

    Quotes inside a quoted field are doubled, as in RFC 4180; Spark's default
    escape would split such a field at the next comma.
    """
    return spark.read.csv(path, schema=schema, header=True, escape='"', dateFormat="yyyy-MM-dd")


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TRANSACTIONS)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ARTICLES)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMERS)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scan a CSV of unknown types. Costs one more pass; meant for inspecting deliveries only."""
    return spark.read.csv(path, header=True, inferSchema=True, escape='"')


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one cleaned table of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")
