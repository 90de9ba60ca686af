import pytest
from pyspark.sql import functions as F

from tests.conftest import SALES, day, rows
from tillroll.operators import ranking
from tillroll.operators.ranking import quantile_groups
from tillroll.plans import charts, customers

MEMBERS = "customer_id string, age int, club_member_status string, postal_code string, fashion_news_frequency string"


@pytest.fixture
def members(spark):
    return spark.createDataFrame([
        ("c1", 22, "Active", "p1", " Regularly "),
        ("c2", 29, "ACTIVE", "p2", "REGULARLY"),
        ("c3", 5, "active", "p2", "NONE"),
        ("c4", None, "ACTIVE", "p1", "None"),
        ("c5", 40, "LEFT", "p3", None),
    ], MEMBERS)


def test_age_histogram(members):
    assert rows(customers.age_histogram(members)) == [("20-24", 1), ("25-29", 1), ("5-9", 1)]  # text order


def test_purchases_by_news_ignores_customers_without_purchases(spark, members, join_mode):
    bought = [(day("2020-01-01"), c, "a", 1.0, 1) for c in ["c1"] * 4 + ["c3"] * 1 + ["c5"] * 9 + ["cX"]]
    result = customers.purchases_by_news(spark.createDataFrame(bought, SALES), members)
    assert sorted(rows(result)) == [("NONE", 1.0), ("REGULARLY", 4.0)]


def test_repeated_customers_repeat_their_purchases(spark, members, join_mode):
    twice = members.unionAll(members.filter("customer_id = 'c1'"))
    bought = [(day("2020-01-01"), c, "a", 2.0, 1) for c in ["c1", "c1", "c3"]]
    frame = spark.createDataFrame(bought, SALES)
    assert sorted(rows(customers.purchases_by_news(frame, twice))) == [("NONE", 1.0), ("REGULARLY", 4.0)]


def test_top_postal_codes_break_ties(members):
    assert rows(customers.top_postal_codes(members)) == [("p1", 2, 1), ("p2", 2, 2)]
    assert rows(customers.top_postal_codes(members, n=1)) == [("p1", 2, 1)]


@pytest.mark.parametrize("size", [0, 1, 3, 4, 9, 10, 11, 1003])
def test_quantile_groups_equal_ntile(spark, size):
    frame = spark.range(size).select("id", (F.col("id") % 7).alias("value"))
    grouped = quantile_groups(frame, {"value": "desc", "id": "asc"}, 4, "grp")
    frame.createOrReplaceTempView("quantile_input")
    expected = spark.sql("SELECT id, value, ntile(4) OVER (ORDER BY value DESC, id) AS grp FROM quantile_input")
    assert sorted(rows(grouped)) == sorted(rows(expected))
    assert grouped.schema["grp"].dataType == expected.schema["grp"].dataType


def test_quantile_groups_split_one_hot_value(spark):
    frame = spark.range(5000).select("id", F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("value"))
    grouped = quantile_groups(frame, {"value": "desc", "id": "asc"}, 4, "grp")
    assert sorted(rows(grouped.groupBy("grp").count())) == [(1, 1250), (2, 1250), (3, 1250), (4, 1250)]
    assert grouped.filter("grp = 1").agg(F.min("id")).first()[0] == 0  # 1000 large ones, then ids 0..249
    assert grouped.filter("grp = 1 AND value = 1").agg(F.max("id")).first()[0] == 249


@pytest.fixture
def narrow_ranges(monkeypatch):
    """Samples and ranges so small that a few thousand rows take several rounds."""
    monkeypatch.setattr(ranking, "PIVOT_ROWS", 32)
    monkeypatch.setattr(ranking, "PIVOT_STEPS", (0, 1, 2, 8))
    monkeypatch.setattr(ranking, "RANGE_ROWS", 20)


@pytest.mark.parametrize("size, groups", [(40, 4), (2000, 4), (5003, 7)])
def test_cuts_found_in_several_rounds_equal_ntile(spark, narrow_ranges, size, groups):
    value = F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 11 == 0, F.lit(None)).when(
        F.col("id") % 13 == 0, F.lit(float("nan"))).otherwise(F.pmod(F.xxhash64("id"), F.lit(97)) / 7 - 3)
    frame = spark.range(size).select(value.alias("value"), F.concat(F.lit("k"), "id").alias("id"))
    for way, sql in (("desc", "DESC"), ("asc", "ASC")):
        grouped = ranking.quantile_groups(frame, {"value": way, "id": "asc"}, groups, "grp")
        frame.createOrReplaceTempView("quantile_input")
        expected = spark.sql(f"SELECT *, ntile({groups}) OVER (ORDER BY value {sql}, id) AS grp FROM quantile_input")
        assert sorted(map(repr, rows(grouped))) == sorted(map(repr, rows(expected)))


def test_equal_rows_are_divided_between_groups(spark, narrow_ranges):
    """A third of the rows are equal in every column; ntile may give any of them to a group, but not more or less."""
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 10).alias("value"))
    grouped = ranking.quantile_groups(frame, {"value": "asc"}, 9, "grp")
    frame.createOrReplaceTempView("quantile_input")
    expected = spark.sql("SELECT value, ntile(9) OVER (ORDER BY value) AS grp FROM quantile_input")
    assert sorted(rows(grouped)) == sorted(rows(expected))


def test_rows_at_finds_any_place(spark, narrow_ranges):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert [(c.row["v"], c.first, c.same) for c in ranking.rows_at(frame, {"v": "desc"}, [0, 500, 999, 5000])] == [
        (999, 0, 1), (499, 500, 1), (0, 999, 1)]
    assert ranking.rows_at(frame.limit(0), {"v": "asc"}, [0]) == []


def test_spend_quantiles(spark, members, join_mode):
    bought = [(day("2020-01-01"), c, "a", p, 1)
              for c, p in [("c1", 5.0), ("c1", 5.0), ("c2", 7.0), ("c3", 1.0), ("c4", 99.0)]]
    result = rows(customers.spend_quantiles(spark.createDataFrame(bought, SALES), members))
    assert result == [(1, 22.0, 1), (2, 29.0, 1), (3, 5.0, 1)]  # c4 has no age
    labelled = charts.quartile_labels(customers.spend_quantiles(spark.createDataFrame(bought, SALES), members))
    assert labelled.first()["spend_quartile_label"] == "Q1 (Rank 1)"


def test_youth_departments(spark, members, join_mode):
    goods = spark.createDataFrame([("a", "d1"), ("b", None), ("c", "d3")],
                                  "article_id string, department_name string")
    bought = [(day("2020-01-01"), c, a, 1.0, ch) for c, a, ch in [
        ("c1", "a", 1), ("c1", "a", 2), ("c3", "b", 7), ("c3", "c", 1), ("c2", "c", 1), ("c4", "c", 1)]]
    frame = spark.createDataFrame(bought, SALES)
    result = customers.youth_departments(frame, members, goods, n=2)
    assert rows(result) == [("Unknown", "Channel 7", 1), ("d1", "Online", 1), ("d1", "Store", 1)]
    assert rows(charts.department_channel_matrix(result, ["Store", "Online", "Channel 7"])) == [
        ("d1", 1, 1, 0), ("Unknown", 0, 0, 1)]
    assert set(charts.department_channel_matrix(result).columns) == {
        "department_name", "Store", "Online", "Channel 7"}


def test_new_customers(spark):
    bought = [(day(d), c, "a", 1.0, 1) for d, c in [
        ("2020-01-31", "c1"), ("2020-03-01", "c1"), ("2020-03-05", "c2"), ("2020-03-05", "c2"), ("2020-03-09", "c3")]]
    assert rows(customers.new_customers(spark.createDataFrame(bought, SALES))) == [
        (day("2020-01-01"), 1, 1), (day("2020-03-01"), 2, 3)]
