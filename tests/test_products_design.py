from pyspark.sql import functions as F

from tests.conftest import SALES, day, rows
from tillroll.plans import charts, design, products


def _sales(spark, pairs):
    """(article, price, channel, date) tuples."""
    return spark.createDataFrame([(day(d), "c", a, p, ch) for a, p, ch, d in pairs], SALES)


def _articles(spark, data, columns):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in ["article_id", *columns.split()]))


def test_articles_per_group(spark):
    goods = _articles(spark, [("1", "men"), ("2", "men"), ("2", "men"), ("3", None)], "index_group_name")
    assert rows(products.articles_per_group(goods)) == [("men", 2), (None, 1)]


def test_department_sales(spark, join_mode):
    goods = _articles(spark, [("1", "d1", "ladieswear"), ("2", None, "ladieswear"), ("3", "d1", "men")],
                      "department_name index_name")
    frame = _sales(spark, [("1", 1.0, 1, "2019-01-01")] * 2 + [("2", 1.0, 1, "2019-01-01")] * 3
                   + [("3", 1.0, 1, "2019-01-01")])
    result = products.department_sales(frame, goods)
    assert rows(result) == [(None, 3), ("d1", 2)]
    assert rows(charts.top_departments(result, n=1)) == [("Unknown", 3)]


def test_priciest_keeps_ties_and_drops_unsold(spark, join_mode):
    goods = _articles(spark, [(a, "g", f"n{a}", "trousers") for a in "abcdef"] + [("x", "g", "nx", "dress")],
                      "garment_group_name prod_name product_type_name")
    prices = {"a": 9.0, "b": 9.0, "c": 8.0, "d": 7.0, "e": 6.0, "x": 99.0}
    frame = _sales(spark, [(a, p, 1, "2019-01-01") for a, p in prices.items()] + [("a", 1.0, 1, "2019-01-02")])
    assert [(r[2], r[3], r[4]) for r in rows(products.priciest_per_group(frame, goods))] == [
        ("a", 9.0, 1), ("b", 9.0, 1), ("c", 8.0, 2), ("d", 7.0, 3)]


def test_section_shares_and_pareto(spark, join_mode):
    goods = _articles(spark, [(str(i), f"s{i}", "Baby/Children") for i in range(7)], "section_name index_group_name")
    frame = _sales(spark, [(str(i), 1.0, 1, "2019-01-01") for i in range(7) for _ in range(i + 1)])
    result = products.section_shares(frame, goods)
    assert result.count() == 7
    assert abs(result.agg(F.sum("sales_share_pct")).first()[0] - 100) < 1e-9
    top = rows(charts.section_pareto(result))
    assert [r[0] for r in top] == ["S6", "S5", "S4", "S3", "S2"]
    assert top[0][2] == 7 / 25 * 100 and top[-1][2] == 100.0


def test_category_shares_round_half_to_even(spark):
    groups = spark.createDataFrame([("a", 49), ("b", 351)], "index_group_name string, sales_count bigint")
    assert rows(charts.category_shares(groups)) == [("B", 351, 87.8), ("A", 49, 12.2)]  # 87.75 and 12.25


def test_department_rank_movement(spark, join_mode):
    goods = _articles(spark, [("1", "d1"), ("2", "d2")], "department_name")
    frame = _sales(spark, [("1", 1.0, 1, "2019-01-01"), ("2", 1.0, 1, "2019-01-01"),  # tie
                           ("2", 1.0, 1, "2019-02-01"),
                           ("1", 1.0, 1, "2019-03-01"), ("2", 1.0, 1, "2019-03-01"), ("2", 1.0, 1, "2019-03-02")])
    result = products.department_rank_movement(frame, goods)
    assert rows(result) == [
        ("2019-01", "d1", 1, 1, None, None), ("2019-01", "d2", 1, 1, None, None),
        ("2019-02", "d2", 1, 1, 1, 0),
        ("2019-03", "d2", 2, 1, 1, 0), ("2019-03", "d1", 1, 2, 1, -1)]
    assert {r[0] for r in rows(charts.best_rank_series(result, n=1))} == {"D2"}


def test_assortment_by_colour_value(spark):
    goods = _articles(spark, [("1", "dark"), ("2", None), ("3", None)], "perceived_colour_value_name")
    result = design.assortment_by_colour_value(goods)
    assert rows(result) == [("Unknown", 2), ("dark", 1)]
    zero = result.unionAll(spark.createDataFrame([("undefined", 0), ("bright", 0)], result.schema))
    assert rows(charts.observed_colours(zero)) == [("Unknown", 2), ("dark", 1)]


def test_top_pattern_colours(spark, join_mode):
    goods = _articles(spark, [("1", " Stripe", "red"), ("1", "stripe", "red"), ("2", "stripe", None),
                              ("3", "solid", "red"), ("4", "stripe", "blue")],
                      "graphical_appearance_name colour_group_name")
    frame = _sales(spark, [("1", 1.0, 1, "2019-01-01"), ("2", 1.0, 1, "2019-01-01"), ("2", 1.0, 1, "2019-01-01"),
                           ("3", 1.0, 1, "2019-01-01"), ("4", 1.0, 1, "2019-01-01")])
    assert rows(design.top_pattern_colours(frame, goods)) == [("Unknown", 2), ("blue", 1), ("red", 1)]
    sized = rows(charts.ranked_colours(design.top_pattern_colours(frame, goods, n=2)))
    assert sized == [(1, "Unknown", 2, 1.0), (2, "Blue", 1, 0.5 ** 0.5)]


def test_colour_average_counts_rows_not_days(spark, join_mode):
    goods = _articles(spark, [("1", "Black "), ("2", "red")], "colour_group_name")
    frame = _sales(spark, [("1", 1.0, 1, "2019-01-01")] * 3 + [("1", 1.0, 1, "2019-12-31")]
                   + [("2", 1.0, 1, "2019-06-01")])
    assert rows(design.colour_daily_average(frame, goods)) == [
        (day("2019-01-01"), 3, 3.0), (day("2019-12-31"), 1, 2.0)]
    assert rows(design.colour_daily_average(frame, goods, rows=1))[1][2] == 1.0


def test_top_pattern_per_channel(spark, join_mode):
    goods = _articles(spark, [("1", "solid"), ("2", "dots"), ("3", None)], "graphical_appearance_name")
    frame = _sales(spark, [("1", 1.0, 1, "2019-01-01"), ("2", 1.0, 1, "2019-01-01"),
                           ("3", 1.0, 2, "2019-01-01")])
    assert rows(design.top_pattern_per_channel(frame, goods)) == [
        (1, "Store", "dots", 1, 1), (2, "Online", "Unknown", 1, 1)]


def test_keyword_check(spark, join_mode):
    goods = _articles(spark, [("1", "Floral print", None, None), ("2", None, "sunFLOWER tee", None),
                              ("3", None, None, "no match"), ("4", None, None, None), ("1", None, "flower", None)],
                      "graphical_appearance_name prod_name detail_desc")
    frame = _sales(spark, [("1", 1.0, 1, "2019-01-01"), ("2", 3.0, 1, "2019-01-01"), ("3", 50.0, 1, "2019-01-01"),
                           ("4", 50.0, 2, "2019-01-01")])
    assert rows(design.keyword_check_by_channel(frame, goods)) == [(1, "Store", 2.0, 2)]


def test_colour_monthly_change_and_waterfall(spark, join_mode):
    goods = _articles(spark, [("1", "RED"), ("2", "blue")], "perceived_colour_master_name")
    frame = _sales(spark, [("1", 2.0, 1, "2019-01-01"), ("1", 1.0, 1, "2019-02-01"), ("2", 9.0, 1, "2019-02-01"),
                           ("1", 4.0, 1, "2019-03-01")])
    result = design.colour_monthly_change(frame, goods)
    assert [r[1:] for r in rows(result)] == [
        (2.0, None, None, None), (1.0, 2.0, -1.0, -50.0), (4.0, 1.0, 3.0, 300.0)]
    assert [r[3:] for r in rows(charts.revenue_waterfall(result))] == [
        (0.0, 2.0, "start"), (2.0, -1.0, "down"), (1.0, 3.0, "up")]
