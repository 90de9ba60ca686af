from pyspark.sql import functions as F

from tests.conftest import SALES, day, rows
from tillroll.plans import charts, timeline


def test_weekly_counts_cover_all_rows(sales):
    weekly = timeline.weekly_dynamics(sales)
    assert weekly.agg(F.sum("transactions_count")).first()[0] == 7
    assert weekly.columns == ["year", "week", "transactions_count", "prev_week_transactions",
                              "prev_year_transactions", "wow_change_pct", "yoy_change_pct"]


def test_week_year_boundary(spark):
    late_december = spark.createDataFrame([(day("2019-12-30"), "c", "a", 1.0, 1)], SALES)
    assert rows(timeline.weekly_dynamics(late_december).select("year", "week")) == [(2019, 1)]
    assert rows(timeline.weekly_dynamics(late_december, iso_year=True).select("year", "week")) == [(2020, 1)]


def test_weekly_change_compares_with_the_previous_row(spark):
    dates = ["2018-01-10", "2019-01-09", "2019-01-10", "2019-01-23", "2019-01-24", "2019-01-24"]
    weekly = timeline.weekly_dynamics(spark.createDataFrame([(day(d), "c", "a", 1.0, 1) for d in dates], SALES))
    assert rows(weekly) == [
        (2018, 2, 1, None, None, None, None),
        (2019, 2, 2, 1, 1, 100.0, 100.0),
        (2019, 4, 3, 2, None, 50.0, None),  # week 3 is missing
    ]


def test_seasonal_spike(sales, articles, join_mode):
    result = {r["product_group_name"]: r for r in timeline.seasonal_spike(sales, articles).collect()}
    assert timeline.seasonal_spike(sales, articles).first()["product_group_name"] == "Shoes"
    shoes, wool, headwear = result["Shoes"], result["Wool"], result["Headwear"]
    assert (shoes["winter_sales"], shoes["summer_sales"], shoes["sales_spike"]) == (2, 0, 2)  # September is neither
    assert (shoes["seasonal_delta_pct"], shoes["seasonality_index"]) == (100.0, 100.0)
    assert (wool["sales_spike"], wool["seasonal_delta_pct"], wool["seasonality_index"]) == (0, 0.0, 50.0)
    assert (headwear["winter_sales"], headwear["sales_spike"]) == (0, -2)


def test_retention_gaps(sales):
    assert rows(timeline.retention_gaps(sales)) == [(0, 1), (1, 1)]  # eve bought once


def test_same_day_items_are_a_gap_of_zero(spark):
    data = [(day("2020-01-01"), "c", "a", 1.0, 1)] * 2 + [(day("2020-05-01"), "c", "a", 1.0, 1)]
    assert rows(timeline.retention_gaps(spark.createDataFrame(data, SALES))) == [(0, 1)]


def test_gap_buckets_keep_the_total_and_empty_buckets(spark):
    counts = {0: 7, 4: 3, 7: 2, 8: 5, 31: 1, 90: 4, 181: 6, 365: 1}  # both ends of several buckets
    gaps = spark.createDataFrame(list(counts.items()), "days_between int, customers_count bigint")
    result = rows(charts.gap_buckets(gaps))
    assert [r[:2] for r in result] == [
        ("0 days (same day)", 7), ("1-7 days", 5), ("8-30 days", 5), ("31-90 days", 5),
        ("91-180 days", 0), ("181-365 days", 7), ("366+ days", 0)]
    assert abs(sum(r[2] for r in result) - 100) < 1e-9


def test_gap_buckets_of_nothing(spark):
    assert rows(charts.gap_buckets(spark.createDataFrame([], "days_between int, customers_count bigint"))) == []


def test_peak_days_break_ties_by_date(spark):
    data = [(day(f"2019-03-{d:02}"), "c", "a", 1.0, 1) for d in range(1, 13) for _ in range(2 if d > 10 else 1)]
    peaks = timeline.peak_days(spark.createDataFrame(data, SALES), n=4)
    assert [(r["t_dat"].day, r["daily_revenue"], r["peak_rank"]) for r in peaks.collect()] == [
        (11, 2, 1), (12, 2, 2), (1, 1, 3), (2, 1, 4)]
    first = peaks.first()
    assert (first["monthly_revenue"], first["monthly_median_daily"], first["peak_intensity_ratio"]) == (14, 1, 2.0)
    assert first["monthly_share"] == 2 / 14


def test_peak_day_without_variation_scores_zero(spark):
    data = [(day("2019-03-01"), "c", "a", 1.0, 1), (None, "c", "a", 1.0, 1)]
    assert [r["z_score"] for r in timeline.peak_days(spark.createDataFrame(data, SALES)).collect()] == [0.0]


def test_rolling_activity(sales, customers, join_mode):
    result = timeline.rolling_activity(sales, customers).collect()
    assert [r["purchases_count"] for r in result] == [2, 1, 1, 1, 1]  # eve is 67
    assert all(not r["is_outlier"] for r in result)
    assert [r["lower_band_2sigma"] for r in result][:3] == [2.0, 1.0, 1.0]


def test_band_needs_more_than_five_days_to_flag(spark, customers):
    def flags(quiet_days):
        data = [(day(f"2019-03-{d:02}"), "mia", "a", 1.0, 1) for d in range(1, quiet_days + 1)]
        data += [(day(f"2019-03-{quiet_days + 1:02}"), "mia", "a", 1.0, 1)] * 50
        return [r["is_outlier"] for r in timeline.rolling_activity(
            spark.createDataFrame(data, SALES), customers).collect()]

    assert flags(4) == [False] * 5  # exactly two deviations
    assert flags(6) == [False] * 6 + [True]


def test_band_frame_is_calendar_days(spark, customers):
    data = [(day("2019-03-01"), "mia", "a", 1.0, 1)] * 8 + [(day("2019-03-08"), "mia", "a", 1.0, 1)] * 2
    result = timeline.rolling_activity(spark.createDataFrame(data, SALES), customers).collect()
    assert [r["rolling_avg_7d"] for r in result] == [8.0, 2.0]


def test_weekday_segments(sales, customers, join_mode):
    result = timeline.weekday_segments(sales, customers)
    shares = dict(rows(result.groupBy("club_member_status").agg(F.sum("segment_day_share_pct"))))
    assert set(shares) == {"ACTIVE", "PRE-CREATE"}
    assert all(abs(s - 100) < 1e-9 for s in shares.values())
    matrix = charts.weekday_matrix(result)
    assert matrix.columns == ["day_of_week", "ACTIVE", "PRE-CREATE", "weekday"]
    assert {r["weekday"] for r in matrix.collect()} <= {"Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"}


def test_weekday_segments_match_status_exactly(spark, sales):
    members = spark.createDataFrame([("mia", 1, "active"), ("tom", 1, "ACTIVE")],
                                    "customer_id string, age int, club_member_status string")
    assert timeline.weekday_segments(sales, members).agg(F.sum("purchases_count")).first()[0] == 3


def test_weekly_label_pads_the_week(spark):
    weekly = spark.createDataFrame([(2019, 5, 7)], "year int, week int, transactions_count bigint")
    assert rows(charts.weekly_labels(weekly)) == [("2019-W05", 7)]
