"""Time-series dynamics and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import labels, metrics
from tillroll.operators import series, shaping
from tillroll.operators.lookups import Lookup, row_count, summarise
from tillroll.operators.ranking import top_n


def weekly_dynamics(sales: DataFrame, iso_year: bool = False) -> DataFrame:
    """Purchases per week against the preceding week and the same week of the preceding year.

    The default pairs the calendar year with the ISO week, so the last days of
    December can count into week 1 of the *same* year; ``iso_year`` uses the ISO
    week year instead. "Preceding" means the preceding row.
    """
    year = F.extract(F.lit("YEAROFWEEK"), F.col("t_dat")).cast("int") if iso_year else F.year("t_dat")
    count = [row_count("transactions_count")]
    weekly = series.roll_up(series.by_day(sales, "t_dat", count),
                            {"year": year, "week": F.weekofyear("t_dat")}, count)
    wow = series.with_change(weekly, "transactions_count", ["year", "week"], "prev_week_transactions",
                             "wow_change_pct", positive_base=True)
    yoy = series.with_change(wow, "transactions_count", ["year"], "prev_year_transactions",
                             "yoy_change_pct", by=["week"], positive_base=True)
    return yoy.select("year", "week", "transactions_count", "prev_week_transactions",
                      "prev_year_transactions", "wow_change_pct", "yoy_change_pct").orderBy("year", "week")


def seasonal_spike(sales: DataFrame, articles: DataFrame) -> DataFrame:
    """Winter against summer purchases by product group."""
    seasonal = sales.select("article_id", labels.season("t_dat").alias("season")).filter(
        F.col("season").isNotNull())
    cells = summarise(seasonal, ["product_group_name", "season"], [row_count("sales")],
                      [Lookup(articles.select("article_id", "product_group_name"), "article_id")])
    grid = shaping.pivot_sum(cells, "product_group_name", "season", "sales", ["Winter", "Summer"])
    return (
        grid.withColumnsRenamed({"Winter": "winter_sales", "Summer": "summer_sales"})
        .withColumns({
            "sales_spike": metrics.delta("winter_sales", "summer_sales"),
            "seasonal_delta_pct": metrics.seasonal_delta_pct("winter_sales", "summer_sales"),
            "seasonality_index": metrics.seasonality_index("winter_sales", "summer_sales"),
        })
        .orderBy(F.desc("sales_spike"), "product_group_name")
    )


def retention_gaps(sales: DataFrame) -> DataFrame:
    """Customers by days between their first and second purchased item."""
    gaps = series.first_gap_days(sales, "customer_id", "t_dat", "days_between")
    return shaping.histogram(gaps, F.col("days_between"), "days_between", "customers_count").orderBy(
        "days_between")


def peak_days(sales: DataFrame, n: int = 10) -> DataFrame:
    """The busiest days within the context of their month. The "revenue" columns count purchases."""
    daily = (
        sales.filter(F.col("t_dat").isNotNull())
        .groupBy("t_dat").agg(F.count(F.lit(1)).alias("daily_revenue"))
        .withColumn("month_start", labels.month_start("t_dat"))
    )
    month = Window.partitionBy("month_start")
    in_context = daily.withColumns({
        "monthly_revenue": F.sum("daily_revenue").over(month),
        "monthly_median_daily": F.percentile_approx("daily_revenue", 0.5).over(month),
        "_mean": F.avg("daily_revenue").over(month),
        "_deviation": F.stddev_pop("daily_revenue").over(month),
    })
    ranked = top_n(in_context, [F.desc("daily_revenue"), F.asc("t_dat")], n, "peak_rank")
    return ranked.select(
        "month_start", "t_dat", "daily_revenue", "monthly_revenue", "monthly_median_daily",
        metrics.share("daily_revenue", "monthly_revenue").alias("monthly_share"),
        metrics.intensity("daily_revenue", "monthly_median_daily").alias("peak_intensity_ratio"),
        metrics.z_score("daily_revenue", "_mean", "_deviation").alias("z_score"),
        "peak_rank",
    ).orderBy("peak_rank")


def rolling_activity(sales: DataFrame, customers: DataFrame, ages: tuple[int, int] = (30, 40),
                     days: int = 7) -> DataFrame:
    """Daily purchases of an age range with a moving average, its band and outliers."""
    in_range = customers.filter(F.col("age").between(*ages)).select("customer_id")
    daily = summarise(sales, ["t_dat"], [row_count("purchases_count")], [Lookup(in_range, "customer_id")])
    return series.with_rolling_band(
        daily, "purchases_count", "t_dat", days, "rolling_avg_7d", "rolling_std_7d",
        "upper_band_2sigma", "lower_band_2sigma", "is_outlier",
    ).orderBy("t_dat")


def weekday_segments(sales: DataFrame, customers: DataFrame,
                     statuses: tuple[str, ...] = ("ACTIVE", "PRE-CREATE")) -> DataFrame:
    """Purchases by weekday and member status: share within the status, index against all statuses."""
    members = customers.filter(F.col("club_member_status").isin(*statuses)).select(
        "customer_id", "club_member_status")
    by_day = sales.select("customer_id", F.dayofweek("t_dat").alias("day_of_week"))
    cells = summarise(by_day, ["club_member_status", "day_of_week"], [row_count("purchases_count")],
                      [Lookup(members, "customer_id")])
    peers = F.avg("purchases_count").over(Window.partitionBy("day_of_week"))
    return (
        shaping.with_total(cells, "purchases_count", "segment_total_purchases", ["club_member_status"])
        .withColumns({
            "segment_day_share_pct": metrics.share_pct("purchases_count", "segment_total_purchases"),
            "weekday_index100": metrics.index_to_100("purchases_count", peers),
        })
        .orderBy("club_member_status", "day_of_week")
    )
