"""Product hierarchy and departments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import labels, metrics
from tillroll.functions.predicates import equals_text
from tillroll.operators import series, shaping
from tillroll.operators.lookups import Lookup, largest, row_count, summarise
from tillroll.operators.ranking import top_n_per_group


def articles_per_group(articles: DataFrame) -> DataFrame:
    return (
        articles.groupBy("index_group_name").agg(F.count_distinct("article_id").alias("unique_articles"))
        .orderBy(F.desc("unique_articles"), "index_group_name")
    )


def _sales_by(sales: DataFrame, articles: DataFrame, attribute: str) -> DataFrame:
    cells = summarise(sales, [attribute], [row_count("sales_count")],
                      [Lookup(articles.select("article_id", attribute), "article_id")])
    return cells.orderBy(F.desc("sales_count"), attribute)


def department_sales(sales: DataFrame, articles: DataFrame, index_name: str = "ladieswear") -> DataFrame:
    return _sales_by(sales, articles.filter(F.col("index_name") == index_name), "department_name")


def priciest_per_group(sales: DataFrame, articles: DataFrame, product_type: str = "trousers",
                       n: int = 3) -> DataFrame:
    """Articles with the ``n`` highest peak prices per garment group, ties kept; unsold articles drop out."""
    chosen = articles.filter(F.col("product_type_name") == product_type)
    peaks = summarise(sales, ["article_id"], [largest("price", "max_price")],
                      [Lookup(chosen.select("article_id"), "article_id", "left_semi")])
    priced = chosen.select("article_id", "garment_group_name", "prod_name").join(peaks, "article_id")
    return (
        top_n_per_group(priced, ["garment_group_name"], [F.desc("max_price")], n, "price_rank", ties=True)
        .select("garment_group_name", "prod_name", "article_id", "max_price", "price_rank")
        .orderBy("garment_group_name", "price_rank", "article_id")
    )


def section_shares(sales: DataFrame, articles: DataFrame, index_group: str = "baby/children") -> DataFrame:
    """Purchases of each section of one index group and its share."""
    chosen = articles.filter(equals_text("index_group_name", index_group, trim=False))
    cells = _sales_by(sales, chosen, "section_name")
    return (
        shaping.with_total(cells, "sales_count", "total_sales")
        .withColumn("sales_share_pct", metrics.share_pct("sales_count", "total_sales"))
        .orderBy(F.desc("sales_count"), "section_name")
    )


def type_sales_by_group(sales: DataFrame, articles: DataFrame, product_type: str = "sweater") -> DataFrame:
    return _sales_by(sales, articles.filter(F.col("product_type_name") == product_type), "index_group_name")


def department_rank_movement(sales: DataFrame, articles: DataFrame) -> DataFrame:
    """Monthly rank of each department and the places won since its last month with sales."""
    monthly = sales.select("article_id", labels.month_start("t_dat").alias("month_start"))
    cells = summarise(monthly, ["month_start", "department_name"], [row_count("monthly_sales")],
                      [Lookup(articles.select("article_id", "department_name"), "article_id")])
    labelled = cells.select(labels.year_month("month_start").alias("year_month"), "department_name",
                            "monthly_sales")
    return series.with_rank_movement(
        labelled, "year_month", "department_name", "monthly_sales", "dept_rank", "prev_rank", "rank_change",
    ).orderBy("year_month", "dept_rank", "department_name")
