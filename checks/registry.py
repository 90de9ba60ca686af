"""The registered queries: each one binds a library call to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.binding import TABLES, Retail, plain_numbers
from tillroll.operators import quality
from tillroll.operators.durable import scratch_path
from tillroll.plans import charts, cleaning, customers, design, products, revenue, timeline
from tillroll.sources import readers, schemas, writers

YEAR = 1997
CHANNELS = ["Store", "Online", "Channel 3"]
KEYWORDS = ("hot", "gizmo")


def _q01(t): return customers.age_histogram(t.customers)
def _q02(t): return customers.purchases_by_news(t.sales, t.customers)
def _q03(t): return customers.top_postal_codes(t.customers)
def _q04(t): return customers.spend_quantiles(t.sales, t.customers)
def _q05(t): return customers.youth_departments(t.sales, t.customers, t.articles)
def _q06(t): return customers.new_customers(t.sales)
def _q07(t): return timeline.weekly_dynamics(t.sales)
def _q07_iso(t): return timeline.weekly_dynamics(t.sales, iso_year=True)
def _q08(t): return timeline.seasonal_spike(t.sales, t.articles)
def _q09(t): return timeline.retention_gaps(t.sales)
def _q09_orders(t): return timeline.retention_gaps(t.orders)
def _q10(t): return timeline.peak_days(t.sales)
def _q11(t): return timeline.rolling_activity(t.sales, t.customers)
def _q12(t): return timeline.weekday_segments(t.sales, t.customers)
def _q13(t): return revenue.revenue_by_group_and_channel(t.sales, t.articles)
def _q14(t): return revenue.weekday_price_rank(t.sales, above=2000)
def _q15(t): return revenue.top_product_share(t.sales, t.articles, year=YEAR)
def _q16(t): return revenue.monthly_growth(t.sales)
def _q17(t): return revenue.news_reader_check(t.sales, t.customers)
def _q18(t): return revenue.running_revenue(t.sales, year=YEAR)
def _q19(t): return products.articles_per_group(t.articles)
def _q20(t): return products.department_sales(t.sales, t.articles, index_name="promo")
def _q21(t): return products.priciest_per_group(t.sales, t.articles, product_type="gear")
def _q22(t): return products.section_shares(t.sales, t.articles, index_group="large")
def _q23(t): return products.type_sales_by_group(t.sales, t.articles, product_type="widget")
def _q24(t): return products.department_rank_movement(t.sales, t.articles)
def _q25(t): return design.assortment_by_colour_value(t.articles)
def _q26(t): return design.top_pattern_colours(t.sales, t.articles, pattern="ring", n=5)
def _q27(t): return design.colour_daily_average(t.sales, t.articles, colour="blue")
def _q28(t): return design.top_pattern_per_channel(t.sales, t.articles)
def _q29(t): return design.keyword_check_by_channel(t.sales, t.articles, keywords=KEYWORDS)
def _q30(t): return design.colour_monthly_change(t.sales, t.articles, master_colour="red")


def _csv_round_trip(df: DataFrame, label: str, read) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.csv(path, header=True, escape='"')
    return read(df.sparkSession, path)


def _csv_articles(t: Retail) -> DataFrame:
    """Articles in the declared layout, with quotes and commas in the description."""
    wide = t.articles.withColumns({
        "article_id": F.lpad(F.col("article_id").cast("string"), 10, "0"),
        "detail_desc": F.concat(F.lit('a "'), F.col("prod_name"), F.lit('", '), F.col("section_name")),
        "product_code": F.col("article_id").cast("int"),
    })
    known = {f.name: F.col(f.name) if f.name in wide.columns else F.lit(None).cast(f.dataType)
             for f in schemas.ARTICLES}
    laid_out = wide.select(*[known[f.name].alias(f.name) for f in schemas.ARTICLES])
    back = _csv_round_trip(laid_out, "articles-csv", readers.read_articles)
    return back.select("article_id", "product_code", "prod_name", "department_name", "detail_desc")


def _csv_customers(t: Retail) -> DataFrame:
    laid_out = t.customers.select(
        F.lpad(F.col("customer_id").cast("string"), 6, "0").alias("customer_id"),
        F.when(F.col("age") > 30, 1.0).alias("FN"), F.lit(1.0).alias("Active"),
        "club_member_status", F.trim("fashion_news_frequency").alias("fashion_news_frequency"),
        "age", "postal_code")
    return _csv_round_trip(laid_out, "customers-csv", readers.read_customers)


def _inferred_csv(t: Retail) -> DataFrame:
    path = scratch_path(t.spark, "parts-csv")
    t.table("part").write.csv(path, header=True)
    return quality.verify_datasets(t.spark, {
        "part": lambda: readers.read_inferred_csv(t.spark, path),
        "absent": lambda: readers.read_inferred_csv(t.spark, path + "-absent"),
    }).withColumn("error", F.col("error").isNotNull())


def _parquet_sink(t: Retail) -> DataFrame:
    folder = scratch_path(t.spark, "tables")
    dated = quality.date_features(t.sales, "t_dat")
    writers.write_table(dated, folder, "transactions", partition_by=["year"])
    back = readers.read_table(t.spark, folder, "transactions")
    return back.select("t_dat", "customer_id", "article_id", "price", "sales_channel_id", "year", "month",
                       "day_of_week")


def _bundle(t: Retail) -> DataFrame:
    """Publish Q13 and read its CSV back."""
    folder = scratch_path(t.spark, "published")
    done = writers.publish(_q13(t), "q13", folder, "Revenue by group and channel")
    return t.spark.read.csv(done.csv_path, header=True, schema=(
        "index_group_name string, sales_channel_id int, channel_name string, total_revenue decimal(28,2)"))


def _dedupe_input(t: Retail) -> DataFrame:
    return t.table("lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")


def _observed_counts(t: Retail) -> DataFrame:
    """Rows read and kept, counted while the kept ones are written."""
    raw, read = quality.observed(t.articles, "articles_read")
    complete = quality.require_columns(raw, ["department_name", "perceived_colour_value_name"])
    kept_rows, kept = quality.observed(complete, "articles_kept")
    writers.write_table(kept_rows, scratch_path(t.spark, "observed"), "articles")
    before, after = read.get["rows"], kept.get["rows"]
    return t.spark.createDataFrame([(before, after, before - after)],
                                   "before_rows bigint, after_rows bigint, removed_rows bigint")


def _sketched_profile(t: Retail) -> DataFrame:
    """The profile at its default error; the quartiles as whether their rank is within it."""
    prices = t.table("orders").select("o_totalprice")
    profile = quality.numeric_profile(prices, ["o_totalprice"])
    errors = quality.rank_errors(prices, profile, "o_totalprice").first()
    within = [F.lit(errors[f"{name}_error"] <= 0.01).alias(f"{name}_within") for name in quality.QUARTILES]
    return profile.select("column", "minimum", "maximum", "mean", "stddev", *within)


def _sketches_by_year(t: Retail) -> DataFrame:
    """The profile of lineitem from sketches kept for each year of deliveries, and whether it is as near as promised."""
    items, path = t.table("lineitem"), scratch_path(t.spark, "sketches")
    years = items.agg(F.min(F.year("l_shipdate")), F.max(F.year("l_shipdate"))).first()
    for year in range(years[0], years[1] + 1):
        quality.append_sketches(items.filter(F.year("l_shipdate") == year), path)
    quality.append_sketches(items.filter(F.col("l_shipdate").isNull()), path)
    kept = quality.sketched_profile(t.spark.read.parquet(path))
    exact = quality.profile_columns(items).select("column", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= quality.SKETCH_ERROR * F.col("exact")
    return kept.join(exact, "column").select("column", "n_missing", "verdict", near.alias("within"))


def _clean_counts(t: Retail) -> DataFrame:
    complete = F.col("department_name").isNotNull() & F.col("perceived_colour_value_name").isNotNull()
    return quality.removal_report(t.articles, complete)


Query = Callable[[Retail], DataFrame]

# name -> (query, columns to round before a comparison across engines)
_QUERIES: dict[str, tuple[Query, dict[str, int]]] = {
    "q01_age_histogram": (_q01, {}),
    "q02_purchases_by_news": (_q02, {}),
    "q03_top_postal_codes": (_q03, {}),
    "q04_spend_quartiles": (_q04, {}),
    "q05_youth_departments": (_q05, {}),
    "q06_new_customers": (_q06, {}),
    "q07_weekly_dynamics": (_q07, {"wow_change_pct": 6, "yoy_change_pct": 6}),
    "q07_weekly_dynamics_iso_year": (_q07_iso, {"wow_change_pct": 6, "yoy_change_pct": 6}),
    "q08_seasonal_spike": (_q08, {"seasonal_delta_pct": 6, "seasonality_index": 6}),
    "q09_retention_gaps": (_q09, {}),
    "q09_retention_gaps_by_order": (_q09_orders, {}),
    "q10_peak_days": (_q10, {"monthly_share": 6, "peak_intensity_ratio": 6, "z_score": 6}),
    "q11_rolling_activity": (_q11, {"rolling_avg_7d": 6, "rolling_std_7d": 6, "upper_band_2sigma": 6,
                                    "lower_band_2sigma": 6}),
    "q12_weekday_segments": (_q12, {"segment_day_share_pct": 6, "weekday_index100": 6}),
    "q13_revenue_by_group_channel": (_q13, {}),
    "q14_weekday_price_rank": (_q14, {"avg_revenue": 6}),
    "q15_top_product_share": (_q15, {"revenue_share_pct": 6}),
    "q16_monthly_growth": (_q16, {"growth_rate_pct": 6}),
    "q17_news_reader_check": (_q17, {"avg_check_value": 6}),
    "q18_running_revenue": (_q18, {}),
    "q19_articles_per_group": (_q19, {}),
    "q20_department_sales": (_q20, {}),
    "q21_priciest_per_group": (_q21, {}),
    "q22_section_shares": (_q22, {"sales_share_pct": 6}),
    "q23_type_sales_by_group": (_q23, {}),
    "q24_department_rank_movement": (_q24, {}),
    "q25_assortment_by_colour_value": (_q25, {}),
    "q26_top_pattern_colours": (_q26, {}),
    "q27_colour_daily_average": (_q27, {"rolling_30d_avg": 6}),
    "q28_top_pattern_per_channel": (_q28, {}),
    "q29_keyword_check_by_channel": (_q29, {"avg_price": 6}),
    "q30_monthly_change_filtered": (_q30, {"growth_rate_pct": 6}),
    "v01_gap_buckets": (lambda t: charts.gap_buckets(_q09(t)), {"customers_share_pct": 6}),
    "v01_gap_buckets_by_order": (lambda t: charts.gap_buckets(_q09_orders(t)), {"customers_share_pct": 6}),
    "v02_channel_shares": (lambda t: charts.channel_shares(_q13(t)), {"Store": 6, "Online": 6}),
    "v03_department_channel_matrix": (
        lambda t: charts.department_channel_matrix(_q05(t), CHANNELS), {}),
    "v04_section_pareto": (lambda t: charts.section_pareto(_q22(t)), {"cumulative_pct": 6}),
    "v05_category_shares": (
        lambda t: charts.category_shares(products._sales_by(t.sales, t.articles, "index_group_name")), {}),
    "v06_best_rank_series": (lambda t: charts.best_rank_series(_q24(t)), {}),
    "v07_observed_colours": (lambda t: charts.observed_colours(_q25(t)), {}),
    "v08_ranked_colours": (lambda t: charts.ranked_colours(_q26(t)), {"relative_size": 6}),
    "v09_revenue_waterfall": (lambda t: charts.revenue_waterfall(_q30(t)), {}),
    "v10_weekday_matrix": (lambda t: charts.weekday_matrix(_q12(t)), {"ACTIVE": 6, "PRE-CREATE": 6}),
    "v11_weekly_labels": (lambda t: charts.weekly_labels(_q07(t)), {}),
    "v11_top_seasonal_groups": (lambda t: charts.top_seasonal_groups(_q08(t), n=5), {}),
    "v12_growth_signs": (lambda t: charts.growth_signs(_q16(t)), {"growth_rate_pct": 6}),
    "v13_quartile_label": (lambda t: charts.quartile_labels(_q04(t)), {}),
    "v14_top_departments": (lambda t: charts.top_departments(_q20(t)), {}),
    "load_check": (lambda t: quality.load_check(t.table("lineitem")), {}),
    "dataset_inventory": (lambda t: quality.inventory({n: t.table(n) for n in TABLES}), {}),
    "verify_inferred_csv": (_inferred_csv, {}),
    "describe_columns": (
        lambda t: quality.describe_columns(t.table("part").select("p_partkey", "p_brand", "p_size")),
        {"mean": 6, "stddev": 6}),
    "numeric_profile": (
        lambda t: quality.exact_numeric_profile(t.table("orders"), ["o_totalprice"]), {"mean": 4, "stddev": 4}),
    "numeric_profile_sketch": (_sketched_profile, {"mean": 4, "stddev": 4}),
    "code_distribution": (lambda t: quality.code_distribution(t.sales, "sales_channel_id"), {}),
    "code_summary": (lambda t: quality.code_summary(t.sales, "sales_channel_id"), {"mean_code": 6}),
    "profile_columns": (
        lambda t: quality.profile_columns(t.holey_parts, keep=["p_partkey"]), {"missing_pct": 6}),
    "profile_columns_nan_aware": (
        lambda t: quality.profile_columns(t.holey_parts, nan_is_missing=True), {"missing_pct": 6}),
    "profile_purchases": (lambda t: quality.profile_columns(t.table("lineitem")), {"missing_pct": 6}),
    "profile_sketches": (_sketches_by_year, {}),
    "null_counts": (lambda t: quality.null_counts(t.articles), {}),
    "duplicate_count": (
        lambda t: quality.duplicate_count(t.table("lineitem").select("l_partkey", "l_suppkey")), {}),
    "dedupe_by_key": (lambda t: quality.dedupe_by_key(_dedupe_input(t), "l_partkey"), {}),
    "dedupe_by_columns": (
        lambda t: t.table("lineitem").select("l_partkey", "l_returnflag").dropDuplicates(), {}),
    "drop_null_rows": (lambda t: quality.drop_null_rows(t.articles), {}),
    "require_columns": (
        lambda t: quality.require_columns(t.articles, ["department_name", "prod_name", "not_there"]), {}),
    "drop_constant_columns": (
        lambda t: quality.drop_constant_columns(
            t.table("orders").withColumns({"currency": F.lit("EUR"), "note": F.lit(None).cast("string"),
                                           "unit": F.lit(1)}), keep=["unit"]), {}),
    "normalize_text": (
        lambda t: quality.normalise_text(t.table("part").select("p_partkey", "p_brand", "p_type"),
                                         ["p_brand", "p_type", "not_there"]), {}),
    "date_features": (
        lambda t: quality.date_features(t.orders, "t_dat"), {}),
    "observed_clean_counts": (_observed_counts, {}),
    "removal_report": (_clean_counts, {}),
    "clean_transactions": (lambda t: cleaning.clean_transactions(t.raw_transactions), {}),
    "clean_articles": (lambda t: cleaning.clean_articles(t.raw_articles), {}),
    "clean_customers": (lambda t: cleaning.clean_customers(t.raw_customers), {}),
    "csv_source_transactions": (
        lambda t: _csv_round_trip(t.sales, "sales-csv", readers.read_transactions), {}),
    "csv_source_articles": (_csv_articles, {}),
    "csv_source_customers": (_csv_customers, {}),
    "parquet_sink_partitioned": (_parquet_sink, {}),
    "publish_bundle": (_bundle, {}),
}


def _bind(query: Query, places: dict[str, int]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain_numbers(query(Retail(spark, sf_dir)), places)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(query, places) for name, (query, places) in _QUERIES.items()}
