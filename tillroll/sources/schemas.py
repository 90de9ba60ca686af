"""Declared column types of the three raw tables."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

# The raw files' columns. Identifiers are text because leading zeros count.
TRANSACTIONS = StructType([
    StructField("t_dat", DateType()),
    StructField("customer_id", StringType()),
    StructField("article_id", StringType()),
    StructField("price", DoubleType()),
    StructField("sales_channel_id", IntegerType()),
])

CUSTOMERS = StructType([
    StructField("customer_id", StringType()),
    StructField("FN", DoubleType()),
    StructField("Active", DoubleType()),
    StructField("club_member_status", StringType()),
    StructField("fashion_news_frequency", StringType()),
    StructField("age", IntegerType()),
    StructField("postal_code", StringType()),
])

ARTICLES = StructType([
    StructField("article_id", StringType()),
    StructField("product_code", IntegerType()),
    StructField("prod_name", StringType()),
    StructField("product_type_no", IntegerType()),
    StructField("product_type_name", StringType()),
    StructField("product_group_name", StringType()),
    StructField("graphical_appearance_no", IntegerType()),
    StructField("graphical_appearance_name", StringType()),
    StructField("colour_group_code", IntegerType()),
    StructField("colour_group_name", StringType()),
    StructField("perceived_colour_value_id", IntegerType()),
    StructField("perceived_colour_value_name", StringType()),
    StructField("perceived_colour_master_id", IntegerType()),
    StructField("perceived_colour_master_name", StringType()),
    StructField("department_no", IntegerType()),
    StructField("department_name", StringType()),
    StructField("index_code", StringType()),
    StructField("index_name", StringType()),
    StructField("index_group_no", IntegerType()),
    StructField("index_group_name", StringType()),
    StructField("section_no", IntegerType()),
    StructField("section_name", StringType()),
    StructField("garment_group_no", IntegerType()),
    StructField("garment_group_name", StringType()),
    StructField("detail_desc", StringType()),
])

# An article without one of these is unusable.
REQUIRED_ARTICLE_COLUMNS = [
    "article_id", "prod_name", "product_type_name", "product_group_name",
    "department_name", "index_name", "section_name", "garment_group_name",
]


_KINDS = {"text": StringType(), "int": IntegerType(), "double": DoubleType(), "date": DateType()}


def columns_of(schema: StructType, kind: str) -> list[str]:
    return [field.name for field in schema if field.dataType == _KINDS[kind]]
