"""Shaping of question results for drawing. Inputs are results, a few thousand rows at most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import labels, metrics
from tillroll.functions.predicates import is_observed
from tillroll.operators import shaping
from tillroll.operators.ranking import keep_top_keys, top_n


def gap_buckets(gaps: DataFrame) -> DataFrame:
    """Retention gaps in seven fixed buckets, empty ones included, with their share."""
    names = [name for _, _, name in labels.GAP_BUCKETS]
    buckets = shaping.filled_buckets(gaps, labels.gap_bucket("days_between"), names, "customers_count",
                                     "bucket_label")
    shared = shaping.with_total(buckets, "customers_count", "_total").withColumn(
        "customers_share_pct", metrics.share_pct("customers_count", "_total"))
    return shared.orderBy("bucket_order").select("bucket_label", "customers_count", "customers_share_pct")


def channel_shares(revenue: DataFrame, channels: Sequence[str] = ("Store", "Online")) -> DataFrame:
    """Share of each named channel in the revenue those channels make together, by index group."""
    group = labels.title_case(F.coalesce("index_group_name", F.lit("Unknown"))).alias("index_group_name")
    grid = shaping.pivot_sum(revenue, group, "channel_name", "total_revenue", channels)
    return shaping.row_shares(grid, channels).orderBy(*[F.desc(c) for c in reversed(channels)])


def department_channel_matrix(departments: DataFrame, channels: Sequence[str] | None = None) -> DataFrame:
    """One column per channel, largest department first."""
    grid = shaping.pivot_sum(departments, "department_name", "channel_name", "purchase_count", channels)
    row_sum = sum((F.col(c) for c in grid.columns[1:]), F.lit(0).cast("long"))  # without any channel for an empty table
    return grid.orderBy(row_sum.desc(), "department_name")


def section_pareto(sections: DataFrame, n: int = 5) -> DataFrame:
    """The largest sections and their cumulative share of those shown."""
    named = sections.select(
        labels.title_case(F.coalesce("section_name", F.lit("unknown"))).alias("section_name"), "sales_count")
    order = [F.desc("sales_count"), F.asc("section_name")]
    return shaping.pareto(named, "sales_count", order, n, "cumulative_pct").orderBy(*order)


def category_shares(groups: DataFrame) -> DataFrame:
    """Share of each category, rounded for display."""
    named = groups.select(
        labels.title_case(F.coalesce("index_group_name", F.lit("unknown"))).alias("index_group_name"),
        "sales_count")
    return (
        shaping.with_total(named, "sales_count", "_total")
        .select("index_group_name", "sales_count",
                metrics.rounded_share_pct("sales_count", "_total").alias("share_pct"))
        .orderBy(F.desc("sales_count"), "index_group_name")
    )


def best_rank_series(ranks: DataFrame, n: int = 10) -> DataFrame:
    """Rank series of the departments with the best mean rank."""
    named = ranks.withColumn(
        "department_name", labels.title_case(F.coalesce("department_name", F.lit("unknown"))))
    order = [F.asc("weight"), F.asc("department_name")]
    return (
        keep_top_keys(named, "department_name", order, n, F.avg("dept_rank"))
        .select("department_name", "year_month", "dept_rank")
        .orderBy("department_name", "year_month")
    )


def observed_colours(colours: DataFrame) -> DataFrame:
    """Colour categories with at least one article."""
    return colours.filter(is_observed("perceived_colour_value_name", "article_count")).orderBy(
        F.desc("article_count"), "perceived_colour_value_name")


def ranked_colours(colours: DataFrame) -> DataFrame:
    """Colours numbered by purchases, with an area-true relative size."""
    order = [F.desc("purchase_count"), F.asc("colour_group_name")]
    return colours.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        labels.title_case("colour_group_name").alias("colour_group_name"), "purchase_count",
        metrics.relative_size("purchase_count", F.max("purchase_count").over(Window.partitionBy()))
        .alias("relative_size"),
    ).orderBy("rank")


def revenue_waterfall(changes: DataFrame) -> DataFrame:
    """Floating bars: each month starts where the last one ended. The first month stands on zero."""
    height = F.coalesce("revenue_delta", "monthly_revenue")
    first = F.row_number().over(Window.orderBy("month_start")) == 1
    return changes.select(
        "month_start", labels.year_month("month_start").alias("month_label"), "monthly_revenue",
        F.coalesce("previous_month_revenue", F.lit(0)).alias("bar_base"), height.alias("bar_height"),
        F.when(first, "start").when(height >= 0, "up").otherwise("down").alias("bar_kind"),
    ).orderBy("month_start")


def weekday_matrix(segments: DataFrame, statuses: Sequence[str] = ("ACTIVE", "PRE-CREATE")) -> DataFrame:
    """Weekday shares with one column per member status."""
    grid = shaping.pivot_sum(segments, "day_of_week", "club_member_status", "segment_day_share_pct", statuses)
    return grid.withColumn("weekday", labels.weekday_short("day_of_week")).orderBy("day_of_week")


def weekly_labels(weekly: DataFrame) -> DataFrame:
    return weekly.select(labels.year_week("year", "week").alias("year_week"), "transactions_count").orderBy(
        "year_week")


def top_seasonal_groups(seasonal: DataFrame, n: int = 12) -> DataFrame:
    """Product groups that gain most in winter."""
    order = [F.desc("sales_spike"), F.asc("product_group_name")]
    return top_n(seasonal.select("product_group_name", "summer_sales", "winter_sales", "sales_spike"), order, n)


def growth_signs(growth: DataFrame) -> DataFrame:
    """Months with a defined growth and its direction."""
    return growth.filter(F.col("growth_rate_pct").isNotNull()).select(
        labels.year_month("month_start").alias("month_label"), "growth_rate_pct",
        (F.col("growth_rate_pct") >= 0).alias("is_growth"),
    ).orderBy("month_label")


def quartile_labels(quartiles: DataFrame) -> DataFrame:
    label = labels.joined_label("Q%d (Rank %d)", ["spend_quartile", "spend_quartile"])
    return quartiles.select(label.alias("spend_quartile_label"), "average_age").orderBy("spend_quartile_label")


def top_departments(departments: DataFrame, n: int = 15) -> DataFrame:
    """The departments with most purchases, named for display."""
    order = [F.desc("sales_count"), F.asc("department_name")]
    named = departments.withColumn(
        "department_name", labels.title_case(F.coalesce("department_name", F.lit("unknown"))))
    return top_n(named, order, n)
