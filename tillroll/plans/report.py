"""The catalogue of questions, and publishing of their answers."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import charts, customers, design, products, revenue, timeline
from tillroll.sources import readers, writers

Frame = Callable[..., DataFrame]


class Question(NamedTuple):
    """A question over named tables, and the shape its answer is drawn in (None: as it is)."""

    topic: str
    title: str
    tables: tuple[str, ...]
    answer: Frame
    chart: Callable[[DataFrame], DataFrame] | None = None


S, A, C = "transactions", "articles", "customers"

QUESTIONS: dict[str, Question] = {
    "age_histogram": Question("customers", "Age of active members", (C,), customers.age_histogram),
    "purchases_by_news": Question("customers", "Mean purchases by fashion news", (S, C),
                                  customers.purchases_by_news),
    "top_postal_codes": Question("customers", "Postal codes with most active members", (C,),
                                 customers.top_postal_codes),
    "spend_quartiles": Question("customers", "Age by spending quartile", (S, C), customers.spend_quantiles,
                                charts.quartile_labels),
    "youth_departments": Question("customers", "Departments customers under 25 buy from", (S, C, A),
                                  customers.youth_departments, charts.department_channel_matrix),
    "new_customers": Question("customers", "New customers per month", (S,), customers.new_customers),
    "weekly_dynamics": Question("timeline", "Weekly purchases", (S,), timeline.weekly_dynamics,
                                charts.weekly_labels),
    "seasonal_spike": Question("timeline", "Winter against summer by product group", (S, A),
                               timeline.seasonal_spike, charts.top_seasonal_groups),
    "retention_gaps": Question("timeline", "Days between first and second purchase", (S,),
                               timeline.retention_gaps, charts.gap_buckets),
    "peak_days": Question("timeline", "Busiest days and their month", (S,), timeline.peak_days),
    "rolling_activity": Question("timeline", "Seven-day activity at age 30 to 40", (S, C),
                                 timeline.rolling_activity),
    "weekday_segments": Question("timeline", "Weekdays by member status", (S, C), timeline.weekday_segments,
                                 charts.weekday_matrix),
    "revenue_by_group": Question("revenue", "Revenue by index group and channel", (S, A),
                                 revenue.revenue_by_group_and_channel, charts.channel_shares),
    "weekday_price": Question("revenue", "Weekdays by mean price", (S,), revenue.weekday_price_rank),
    "top_product_share": Question("revenue", "Top products against the rest", (S, A),
                                  revenue.top_product_share),
    "monthly_growth": Question("revenue", "Monthly revenue growth", (S,), revenue.monthly_growth,
                               charts.growth_signs),
    "news_reader_check": Question("revenue", "Average check of regular news readers", (S, C),
                                  revenue.news_reader_check),
    "running_revenue": Question("revenue", "Running revenue by channel", (S,), revenue.running_revenue),
    "articles_per_group": Question("products", "Articles per index group", (A,), products.articles_per_group),
    "department_sales": Question("products", "Departments of one index by purchases", (S, A),
                                 products.department_sales, charts.top_departments),
    "priciest": Question("products", "Highest prices per garment group", (S, A), products.priciest_per_group),
    "section_shares": Question("products", "Section shares of one index group", (S, A),
                               products.section_shares, charts.section_pareto),
    "type_sales": Question("products", "One product type by index group", (S, A),
                           products.type_sales_by_group, charts.category_shares),
    "department_ranks": Question("products", "Monthly department ranks", (S, A),
                                 products.department_rank_movement, charts.best_rank_series),
    "colour_values": Question("design", "Assortment by perceived colour value", (A,),
                              design.assortment_by_colour_value, charts.observed_colours),
    "pattern_colours": Question("design", "Most bought colours of one pattern", (S, A),
                                design.top_pattern_colours, charts.ranked_colours),
    "colour_daily": Question("design", "Daily purchases of one colour", (S, A), design.colour_daily_average),
    "channel_patterns": Question("design", "Most bought pattern per channel", (S, A),
                                 design.top_pattern_per_channel),
    "keyword_check": Question("design", "Average check of keyword articles", (S, A),
                              design.keyword_check_by_channel),
    "colour_growth": Question("design", "Monthly revenue of one master colour", (S, A),
                              design.colour_monthly_change, charts.revenue_waterfall),
}


def answer(spark: SparkSession, processed_dir: str, name: str, **parameters) -> DataFrame:
    """The lazy answer to one question over the cleaned tables."""
    question = QUESTIONS[name]
    frames = [readers.read_table(spark, processed_dir, table) for table in question.tables]
    return partial(question.answer, *frames)(**parameters)


def publish_answers(spark: SparkSession, processed_dir: str, out_dir: str,
                    topics: Iterable[str] = ()) -> list[writers.Published]:
    """Publish all questions, or those of some topics, one folder per topic; a failure does not stop the others."""
    wanted = set(topics) or {q.topic for q in QUESTIONS.values()}
    published, failures = [], []
    for name, question in QUESTIONS.items():
        if question.topic not in wanted:
            continue
        try:
            published.append(writers.publish(answer(spark, processed_dir, name), name,
                                             f"{out_dir.rstrip('/')}/{question.topic}", question.title, question.chart))
        except Exception as error:  # the others are published first, then all failures are raised
            error.add_note(f"while publishing {name}")
            failures.append(error)
    if failures:
        raise ExceptionGroup("questions that could not be published", failures)
    return published
