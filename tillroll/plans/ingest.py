"""Raw CSV deliveries to cleaned Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillroll.operators import quality
from tillroll.plans import cleaning
from tillroll.sources import readers, schemas, writers


class RawTable(NamedTuple):
    file: str
    schema: StructType
    clean: Callable[[DataFrame], DataFrame]
    numbers: Sequence[str]
    codes: Sequence[str]
    relative_error: float


#: Customer columns that questions read: they stay, even where a delivery has one value for all customers.
QUESTION_COLUMNS = ["club_member_status", "fashion_news_frequency", "age"]

# The delivered file names and the columns profiled in each.
RAW_TABLES: Mapping[str, RawTable] = {
    "transactions": RawTable("transactions_train.csv", schemas.TRANSACTIONS, cleaning.clean_transactions,
                             ["price"], ["sales_channel_id"], 0.01),
    "articles": RawTable("articles.csv", schemas.ARTICLES, cleaning.clean_articles, [], [], 0.01),
    "customers": RawTable("customers.csv", schemas.CUSTOMERS,
                          partial(cleaning.clean_customers, keep=QUESTION_COLUMNS), ["FN", "Active", "age"], [], 0.05),
}


def read_raw(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    table = RAW_TABLES[name]
    return readers.read_csv(spark, f"{raw_dir.rstrip('/')}/{table.file}", table.schema)


def verify(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Whether each delivered file loads, with inferred types, and its size."""
    folder = raw_dir.rstrip("/")

    def loader(file: str) -> Callable[[], DataFrame]:
        return lambda: readers.read_inferred_csv(spark, f"{folder}/{file}")

    return quality.verify_datasets(spark, {name: loader(t.file) for name, t in RAW_TABLES.items()})


def profiles(raw: DataFrame, name: str, approx: bool = False) -> dict[str, DataFrame]:
    """Profile frames of one raw table; each is lazy and costs one pass when used.

    ``approx`` counts the distinct values of columns by sketches.
    """
    table = RAW_TABLES[name]
    reports = {
        "load_check": quality.load_check(raw),
        "describe": quality.describe_columns(raw),
        "columns": quality.profile_columns(raw, approx=approx, nan_is_missing=True),
        "nulls": quality.null_counts(raw, nan_is_missing=True),
        "duplicates": quality.duplicate_count(raw),
    }
    if table.numbers:
        reports["numbers"] = quality.numeric_profile(raw, table.numbers, table.relative_error)
    for code in table.codes:
        reports[f"{code}_distribution"] = quality.code_distribution(raw, code)
        reports[f"{code}_summary"] = quality.code_summary(raw, code)
    return reports


def ingest(spark: SparkSession, raw_dir: str, processed_dir: str,
           partition_transactions_by: Sequence[str] = ()) -> DataFrame:
    """Clean and write all tables; return rows read, kept and removed per table.

    The counts are observed while the table is written, so they cost no pass. Customers keep ``QUESTION_COLUMNS``;
    rows that lack one of them are removed and counted as such, all of them if a delivery leaves it empty.
    """
    report = []
    for name, table in RAW_TABLES.items():
        raw, read = quality.observed(read_raw(spark, raw_dir, name), f"{name}_read")
        clean, kept = quality.observed(table.clean(raw), f"{name}_kept")
        partitions = partition_transactions_by if name == "transactions" else ()
        writers.write_table(clean, processed_dir, name, partitions)
        before, after = read.get["rows"], kept.get["rows"]
        report.append((name, before, after, before - after))
    return spark.createDataFrame(
        report, "dataset string, before_rows bigint, after_rows bigint, removed_rows bigint")
