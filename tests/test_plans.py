"""Physical plans and skew: what would hurt at scale must not come back."""

import re

import pytest
from pyspark.sql import functions as F

from checks.binding import Retail
from checks.registry import queries
from tests.conftest import rows
from tillroll.operators import lookups
from tillroll.operators.lookups import (
    Lookup, fits_broadcast, measured_bytes, row_count, summarise, total,
)
from tillroll.plans import customers, design, products, revenue, timeline
from tillroll.sources.writers import plan_text

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()
EAGER = {"publish_bundle", "parquet_sink_partitioned", "verify_inferred_csv"}


def physical(df) -> str:
    return plan_text(df).split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER and "csv" not in n])
def test_no_cross_join_no_python_no_forced_repartition(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "REPARTITION_BY"):
        assert unwanted not in plan


def test_scan_reads_only_used_columns(spark):
    plan = physical(QUERIES["q13_revenue_by_group_channel"](spark, SF_DIR))
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    assert "l_shipdate" not in plan and "o_totalprice" not in plan


def test_year_reaches_the_scan(spark):
    plan = physical(QUERIES["q18_running_revenue"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1997-01-01T00:00\)", plan)


def test_broadcast_dimension_leaves_the_fact_table_unshuffled(spark):
    retail = Retail(spark, SF_DIR)
    fact = retail.table("lineitem").selectExpr("l_partkey AS article_id", "1 AS price", "1 AS sales_channel_id")
    plan = physical(revenue.revenue_by_group_and_channel(fact, retail.articles))
    assert plan.count("Exchange hashpartitioning") == 1  # the partial aggregates
    assert "Exchange hashpartitioning(article_id" not in plan


def test_large_dimension_is_joined_after_partial_aggregation(spark, no_broadcast):
    retail = Retail(spark, SF_DIR)
    assert not fits_broadcast(retail.articles, retail.sales)
    fact = retail.table("lineitem").selectExpr("l_partkey AS article_id", "1 AS price", "1 AS sales_channel_id")
    plan = physical(revenue.revenue_by_group_and_channel(fact, retail.articles))
    join = plan.index("SortMergeJoin")
    # Below the join (further down the text) the fact side is aggregated before its first shuffle.
    below = plan[join:]
    assert below.index("HashAggregate") < below.index("l_partkey")
    assert below.count("partial_sum") == 1


def test_first_purchases_are_limited_before_the_shuffle(spark):
    plan = physical(QUERIES["q09_retention_gaps"](spark, SF_DIR))
    assert plan.index("WindowGroupLimit [customer_id") < plan.index("Exchange hashpartitioning(customer_id")
    assert plan.count("WindowGroupLimit") == 2  # after and before the exchange


def test_group_leaders_are_limited_before_the_shuffle(spark):
    assert physical(QUERIES["q21_priciest_per_group"](spark, SF_DIR)).count("WindowGroupLimit") == 2


def test_top_n_is_a_take_ordered(spark):
    for name in ("q03_top_postal_codes", "q10_peak_days", "q26_top_pattern_colours"):
        assert "TakeOrderedAndProject" in physical(QUERIES[name](spark, SF_DIR))


def test_quartiles_never_sort_customers_in_one_task(spark):
    plan = physical(QUERIES["q04_spend_quartiles"](spark, SF_DIR))
    assert "ntile" not in plan
    assert "SinglePartition" not in plan and "Window" not in plan
    assert "rangepartitioning" not in plan.split("spend_quartile")[-1]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all purchases by one customer of one article, on one day and channel."""
    hot = F.col("id") % 3 == 0
    spread = F.xxhash64("id")
    return spark.range(60_000).select(
        F.when(hot, F.lit("2019-06-15").cast("date"))
        .otherwise(F.date_add(F.lit("2019-01-01").cast("date"), F.pmod(spread, F.lit(365)).cast("int")))
        .alias("t_dat"),
        F.when(hot, "c0").otherwise(F.concat(F.lit("c"), F.pmod(spread, F.lit(997)))).alias("customer_id"),
        F.when(hot, "a0").otherwise(F.concat(F.lit("a"), F.pmod(spread, F.lit(211)))).alias("article_id"),
        F.pmod(spread, F.lit(64)).cast("double").alias("price"),
        F.when(hot, 1).otherwise(F.pmod(spread, F.lit(3)).cast("int") + 1).alias("sales_channel_id"),
    )


@pytest.fixture(scope="module")
def dimensions(spark):
    n = F.col("id")
    goods = spark.range(211).select(
        F.concat(F.lit("a"), n).alias("article_id"), F.concat(F.lit("d"), n % 7).alias("department_name"),
        F.concat(F.lit("g"), n % 4).alias("index_group_name"), F.concat(F.lit("n"), n % 50).alias("prod_name"),
        F.concat(F.lit("p"), n % 5).alias("product_group_name"),
        F.when(n % 2 == 0, "trousers").otherwise("top").alias("product_type_name"),
        F.concat(F.lit("gg"), n % 3).alias("garment_group_name"),
        F.when(n % 4 == 0, "black").otherwise("red").alias("colour_group_name"))
    people = spark.range(997).select(
        F.concat(F.lit("c"), n).alias("customer_id"), (n % 60).cast("int").alias("age"),
        F.when(n % 2 == 0, "ACTIVE").otherwise("PRE-CREATE").alias("club_member_status"),
        F.when(n % 3 == 0, "Regularly").otherwise("NONE").alias("fashion_news_frequency"))
    return goods, people


def _answers(sales, goods, people):
    return {
        "youth": customers.youth_departments(sales, people, goods),
        "news": customers.purchases_by_news(sales, people),
        "spend": customers.spend_quantiles(sales, people),
        "seasons": timeline.seasonal_spike(sales, goods),
        "rolling": timeline.rolling_activity(sales, people),
        "weekdays": timeline.weekday_segments(sales, people),
        "groups": revenue.revenue_by_group_and_channel(sales, goods),
        "leaders": revenue.top_product_share(sales, goods),
        "check": revenue.news_reader_check(sales, people),
        "priciest": products.priciest_per_group(sales, goods),
        "ranks": products.department_rank_movement(sales, goods),
        "black": design.colour_daily_average(sales, goods),
    }


def test_both_join_plans_agree_on_skewed_data(spark, skewed, dimensions):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    direct = {name: sorted(rows(df), key=str) for name, df in _answers(skewed, *dimensions).items()}
    spark.conf.set(threshold, "-1")
    try:
        folded = {name: sorted(rows(df), key=str) for name, df in _answers(skewed, *dimensions).items()}
    finally:
        spark.conf.set(threshold, before)
    assert direct == folded


def test_skewed_answers_equal_brute_force(skewed, dimensions, join_mode):
    goods, people = dimensions
    fact = skewed.toPandas()
    joined = fact.merge(goods.toPandas(), on="article_id")
    expected = joined.groupby(["index_group_name", "sales_channel_id"])["price"].sum().to_dict()
    result = revenue.revenue_by_group_and_channel(skewed, goods).collect()
    assert {(r[0], r[1]): r[3] for r in result} == expected

    first_days = fact.groupby("customer_id")["t_dat"].apply(lambda d: sorted(d)[:2])
    gaps = first_days[first_days.map(len) == 2].map(lambda d: (d[1] - d[0]).days).value_counts().to_dict()
    assert dict(rows(timeline.retention_gaps(skewed))) == gaps

    readers = people.filter("fashion_news_frequency = 'Regularly'").toPandas()
    bought = fact[fact["customer_id"].isin(readers["customer_id"])]
    assert rows(revenue.news_reader_check(skewed, people))[0][:3] == (
        bought["price"].sum() / len(bought), len(bought), bought["customer_id"].nunique())


def test_hot_keys_reach_the_join_folded(spark, no_broadcast, skewed, dimensions):
    goods, people = dimensions
    tables = [Lookup(goods.select("article_id", "department_name"), "article_id"),
              Lookup(people.select("customer_id"), "customer_id", "left_semi")]
    result = summarise(skewed, ["department_name"], [row_count("n"), total("price", "v")], tables)
    result.collect()
    plan = physical(result).split("== Initial Plan ==")[0]
    assert plan.count("partial_count(1)") == 1 and plan.count("SortMergeJoin") == 2  # the sketch shares the exchange
    assert re.search(r"SortMergeJoin \[article_id#\d+, _salt", plan)  # one article, many customers
    joined = skewed.join(goods, "article_id").join(people, "customer_id", "left_semi")
    expected = joined.groupBy("department_name").agg(F.count(F.lit(1)), F.sum("price"))
    assert sorted(rows(result)) == sorted(rows(expected))


def test_only_heavy_keys_of_a_dimension_are_repeated(spark, no_broadcast, skewed, monkeypatch):
    """10,000 articles, one of them with a third of the folded rows: the copies are those of the heavy keys."""
    goods = spark.range(10_000).select(F.concat(F.lit("a"), "id").alias("article_id"), (F.col("id") % 7).alias("kind"))
    fact = skewed.select(F.when(F.pmod(F.xxhash64("customer_id"), F.lit(3)) == 0, "a0").otherwise(F.col("article_id"))
                         .alias("article_id"), "customer_id")
    folded = fact.groupBy("article_id", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    measures = [row_count("n")]
    heavy = [r[0] for r in lookups._heavy_keys(folded, "article_id", measures).collect()]
    assert "a0" in heavy and len(heavy) <= lookups.HEAVY_KEYS
    copies = lookups._salted_join(folded, Lookup(goods, "article_id"), ["customer_id"], measures)
    assert copies.count() == folded.join(goods, "article_id").count()
    generated = re.findall(r"number of output rows: ([\d,]+)", _metrics(copies, "Generate"))
    assert generated and all(int(n.replace(",", "")) <= 10_000 + lookups.HEAVY_KEYS * lookups.SALTS for n in generated)


def _metrics(df, operator):
    """The metrics of the nodes of one kind after ``df`` was run to its end."""
    plan = df._jdf.queryExecution().executedPlan()
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    found, stack = [], [plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan]
    while stack:
        node = stack.pop()
        if node.nodeName() == operator:
            found.append(f"number of output rows: {node.metrics().apply('numOutputRows').value()}")
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
    return "\n".join(found)


def test_measuring_stops_at_the_limit(spark, tmp_path):
    """A million rows in 40 files: a few thousand of them tell that it is too large."""
    spark.range(0, 1_000_000, 1, 40).select(F.col("id"), F.repeat(F.lit("x"), 84).alias("t")).write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    fits, read = lookups.measure(big, 200_000)
    assert not fits and read < 10_000  # 100 bytes a row: 2,000 rows make the limit
    few = big.filter("id < 1000")
    assert lookups.measure(few, 100_000) == (True, 1000)
    assert not lookups.measure(few, 99_999).fits
    assert lookups.measure(big.limit(0), 10) == (True, 0)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "qv" and n not in EAGER and not n.startswith("q04")])
def test_facts_are_scanned_once(spark, name, threshold):
    """Two branches over one aggregate must share its exchange."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        frame = QUERIES[name](spark, SF_DIR)
        frame.collect()
        final = physical(frame).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)
    for first_column in ("l_", "o_"):
        assert final.count(f"FileScan parquet [{first_column}") <= 1


def test_mid_sized_dimension_is_measured(spark, tmp_path, skewed, dimensions):
    """A filter Spark cannot size: the estimate is too large to broadcast, the measured rows are not."""
    _, people = dimensions
    skewed.write.parquet(str(tmp_path / "sales"))
    people.write.parquet(str(tmp_path / "people"))
    fact, people = spark.read.parquet(str(tmp_path / "sales")), spark.read.parquet(str(tmp_path / "people"))
    readers = people.filter("age BETWEEN 30 AND 31").select("customer_id")
    assert measured_bytes(readers) == readers.selectExpr("sum(8 + octet_length(customer_id))").first()[0]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        assert not fits_broadcast(readers, people)  # measuring would cost as much as the join
        assert fits_broadcast(readers, fact)
        assert not fits_broadcast(people, fact)
        few = timeline.rolling_activity(fact, people, ages=(30, 31))
        assert "SortMergeJoin" not in physical(few)
        many = timeline.rolling_activity(fact, people, ages=(0, 59))
        assert "SortMergeJoin" in physical(many)
        answers = rows(few), rows(many)
    finally:
        spark.conf.set(key, before)
    assert answers == (rows(timeline.rolling_activity(fact, people, ages=(30, 31))),
                       rows(timeline.rolling_activity(fact, people, ages=(0, 59))))


def test_rows_that_compress_well_are_measured_too(spark, tmp_path, skewed):
    """The files hold a few kilobytes; in memory the repeated text exceeds the limit."""
    spark.range(20_000).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.repeat(F.lit("x"), 1_000).alias("note")
                               ).write.parquet(str(tmp_path / "notes"))
    notes = spark.read.parquet(str(tmp_path / "notes"))
    assert not fits_broadcast(notes, skewed)
    assert fits_broadcast(notes.select("customer_id"), skewed)


def test_tasks_of_the_order_join_keep_their_size(spark, no_broadcast, monkeypatch):
    sold = lambda: Retail(spark, SF_DIR).sales
    plain = lookups._estimate(Retail(spark, SF_DIR).table("lineitem"))
    before = rows(sold().groupBy("sales_channel_id").agg(F.sum("price"), F.count("customer_id")).orderBy("sales_channel_id"))
    for parts in (9, 27):  # tables of three times the size in tasks of one size
        monkeypatch.setattr(lookups, "TASK_BYTES", -(-plain // parts))
        plan = sold().select("article_id")._jdf.queryExecution().executedPlan().toString()
        dealt = -(-plain // lookups.TASK_BYTES)
        assert all(re.search(rf"hashpartitioning\({key}#\d+L, {dealt}\)", plan) for key in ("l_orderkey", "o_orderkey"))
        assert plan.count("Exchange") == 2 and dealt > parts / 2
        after = rows(sold().groupBy("sales_channel_id").agg(F.sum("price"), F.count("customer_id")).orderBy("sales_channel_id"))
        assert after == before
