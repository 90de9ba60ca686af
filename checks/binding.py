"""The three-table retail model as views over the driver's tables, in Spark.

``checks.oracle.BINDING`` states the same views in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillroll.operators.lookups import join_in_parts

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


# Column types of the bound tables: a declared schema saves the footer-reading job of each scan.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}

# Exact two-place decimal by way of whole cents: a direct cast of a double formats it as text first.
PRICE = "CAST(CAST(rint(l_extendedprice * 100) AS BIGINT) AS DECIMAL(14,0)) * 0.01BD"


class Retail:
    """Lazy views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.folder = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def sales(self) -> DataFrame:
        """Line items with the day and customer of their order."""
        joined = join_in_parts(self.table("lineitem"), self.table("orders"), "l_orderkey", "o_orderkey")
        return joined.selectExpr(
            "CAST(o_orderdate AS DATE) AS t_dat",
            "o_custkey AS customer_id",
            "l_partkey AS article_id",
            f"{PRICE} AS price",
            "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS sales_channel_id",
        )

    @cached_property
    def orders(self) -> DataFrame:
        """One row per order, for questions where items of one order would swamp the answer."""
        return self.table("orders").selectExpr(
            "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS t_dat")

    @cached_property
    def articles(self) -> DataFrame:
        first, second = "split(p_name, ' ')[0]", "split(p_name, ' ')[1]"
        return self.table("part").selectExpr(
            "p_partkey AS article_id",
            "p_name AS prod_name",
            f"{first} AS colour_group_name",
            f"{second} AS graphical_appearance_name",
            f"{second} AS product_type_name",
            "lower(p_type) AS index_group_name",
            "lower(p_type) AS index_name",
            "nullif(p_brand, 'Brand#4') AS department_name",
            "p_brand AS section_name",
            "CAST(p_size % 5 AS STRING) AS garment_group_name",
            f"{second} AS product_group_name",
            f"nullif({first}, 'cold') AS perceived_colour_value_name",
            f"{first} AS perceived_colour_master_name",
            "p_brand AS detail_desc",
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS customer_id",
            "CAST(c_nationkey AS STRING) AS postal_code",
            "CAST(floor((c_acctbal + 1000) / 150) AS INT) AS age",
            "CASE c_mktsegment WHEN 'BUILDING' THEN 'ACTIVE' WHEN 'MACHINERY' THEN 'PRE-CREATE'"
            " ELSE 'LEFT CLUB' END AS club_member_status",
            "CASE c_nationkey % 3 WHEN 0 THEN ' Regularly ' WHEN 1 THEN 'Monthly' ELSE 'NONE' END"
            " AS fashion_news_frequency",
        )

    @cached_property
    def raw_transactions(self) -> DataFrame:
        """Purchases as delivered text, some without a readable price or a customer."""
        joined = join_in_parts(self.table("lineitem"), self.table("orders"), "l_orderkey", "o_orderkey")
        price = F.expr(PRICE).cast("string")
        return joined.select(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("t_dat"),
            F.when(F.col("l_linenumber") != 7, F.col("o_custkey").cast("string")).alias("customer_id"),
            F.lpad(F.col("l_partkey").cast("string"), 10, "0").alias("article_id"),
            F.when(F.col("l_discount") == 0, "n/a").otherwise(price).alias("price"),
            F.col("l_linenumber").cast("string").alias("sales_channel_id"),
        )

    @cached_property
    def raw_articles(self) -> DataFrame:
        """Article rows with conflicting copies (one per line item), untidy text and missing fields."""
        joined = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        words = F.split("p_name", " ")
        return joined.select(
            F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("article_id"),
            F.concat(F.lit(" "), F.upper("p_name")).alias("prod_name"),
            F.col("p_type").alias("product_type_name"),
            words[1].alias("product_group_name"),
            F.nullif(F.col("p_brand"), F.lit("Brand#4")).alias("department_name"),
            F.col("p_type").alias("index_name"),
            F.col("p_brand").alias("section_name"),
            F.lit("Group A").alias("garment_group_name"),
            F.nullif(F.concat_ws(" ", "l_returnflag", "l_linestatus"), F.lit("N O")).alias("detail_desc"),
            F.col("l_suppkey").cast("string").alias("product_code"),
            F.col("l_linenumber").alias("section_no"),
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        """Customers with text numbers, a constant flag and missing news flags."""
        return self.table("customer").select(
            F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("customer_id"),
            F.when(F.col("c_nationkey") % 4 != 0, "1.0").alias("FN"),
            F.lit("1.0").alias("Active"),
            F.col("c_mktsegment").alias("club_member_status"),
            F.when(F.col("c_nationkey") != 7, (F.col("c_nationkey") + 20).cast("double").cast("string")).alias("age"),
            F.lit("00xyz").alias("postal_code"),
        )

    @cached_property
    def holey_parts(self) -> DataFrame:
        """Parts with NULLs in a text, an integer and a float column, and a constant."""
        return self.table("part").select(
            "p_partkey", "p_type", F.nullif(F.col("p_brand"), F.lit("Brand#4")).alias("p_brand"),
            F.when(F.col("p_size") > 5, F.col("p_size")).alias("p_size"),
            F.when(F.col("p_size") > 3, F.when(F.col("p_size") < 9, F.lit(float("nan")))
                   .otherwise(F.col("p_retailprice"))).alias("p_retailprice"),
            F.lit("EUR").alias("currency"),
        )


def plain_numbers(df: DataFrame, places: dict[str, int] | None = None) -> DataFrame:
    """Decimals as double, and the named columns rounded, for comparison across engines."""
    decimals = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, DecimalType)}
    rounded = {c: F.round(F.col(c).cast("double"), n) for c, n in (places or {}).items()}
    changes = {**decimals, **rounded}
    return df.withColumns(changes) if changes else df
