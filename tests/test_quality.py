import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, rows
from tillroll.operators import quality
from tillroll.plans import cleaning
from tillroll.sources import schemas
from tillroll.sources.writers import plan_text


def test_profile_counts_null_as_a_value(spark):
    frame = spark.createDataFrame([("a", None, 1, 1), ("a", None, None, 2)], "k string, n string, i int, core int")
    result = {r["column"]: r for r in quality.profile_columns(frame, keep=["core"]).collect()}
    assert {c: r["n_distinct"] for c, r in result.items()} == {"k": 1, "n": 1, "i": 2, "core": 2}
    assert {c: r["verdict"] for c, r in result.items()} == {
        "k": "drop (constant)", "n": "drop (constant)", "i": "keep", "core": "keep (core)"}
    assert result["i"]["missing_pct"] == 50.0


def test_profile_of_nothing(spark):
    frame = spark.createDataFrame([], "k string")
    assert rows(quality.profile_columns(frame)) == [("k", 0, 0, 0.0, "keep")]


def test_approximate_profile(spark):
    result = rows(quality.profile_columns(spark.range(1000).selectExpr("id", "id % 3 AS g"), approx=True))
    assert result[1][1] == 3 and abs(result[0][1] - 1000) < 100


def test_bitmaps_count_as_a_distinct_count(spark):
    frame = spark.sql("""
        SELECT id * 1000003 % 977 - 400 AS dense, id * 7919 * 1000000007 AS far, CAST(id % 3 AS tinyint) AS small,
               id % 2 = 0 AS flag, CAST(id % 50 / 4 AS decimal(9, 2)) AS price, date_add(DATE'1969-11-01', CAST(id % 120 AS int)) AS day,
               timestamp_micros(id % 300 - 150) AS moment, IF(id % 5 = 0, NULL, id % 70) AS half, CAST(NULL AS int) AS none,
               CAST(id % 9 AS string) AS text, IF(id % 2 = 0, 9223372036854775807, -9223372036854775807 - 1) AS ends
        FROM range(5000)""")
    found = {r["column"]: (r["n_distinct"], r["n_missing"]) for r in quality.profile_columns(frame).collect()}
    plain = frame.agg(*[F.struct((F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias("d"),
                                 F.count_if(F.col(c).isNull()).alias("m")).alias(c) for c in frame.columns]).first()
    assert found == {c: tuple(plain[c]) for c in frame.columns} and list(found) == frame.columns
    assert rows(quality.profile_columns(frame.select("day", "text").limit(0))) == [
        ("day", 0, 0, 0.0, "keep"), ("text", 0, 0, 0.0, "keep")]


def test_bitmaps_leave_a_task_as_words(spark):
    words = quality.bitmap_words(spark.range(64_000).select("id", (F.col("id") * 64).alias("far")), ["id", "far"])
    assert sorted(rows(words.groupBy("at").count())) == [(0, 1000), (1, 64_000)]
    assert "SortAggregate" not in words._jdf.queryExecution().toString()


def test_sketches_of_parts_add_up(spark, tmp_path):
    frame = spark.sql("SELECT id AS n, CAST(id % 7 AS double) AS d, CAST(id % 1000 AS string) AS s, 1 AS one, "
                      "IF(id % 4 = 0, NULL, DATE'2020-01-01') AS day FROM range(20000)")
    for part in (frame.filter("n < 9000"), frame.filter("n >= 6000 AND n < 9000"), frame.filter("n >= 9000"), frame.limit(0)):
        quality.append_sketches(part, str(tmp_path / "sketches"))
    found = {r["column"]: r for r in quality.sketched_profile(spark.read.parquet(str(tmp_path / "sketches")), keep=["n"]).collect()}
    assert abs(found["n"]["n_distinct"] - 20000) < 1000 and abs(found["s"]["n_distinct"] - 1000) < 50
    assert [found[c]["n_distinct"] for c in ("d", "one", "day")] == [7, 1, 2]
    assert found["day"]["n_missing"] == 5750 and found["one"]["verdict"].startswith("drop") and found["n"]["verdict"] == "keep (core)"


def test_nan_counts_as_missing_only_in_floats(spark):
    frame = spark.createDataFrame([(math.nan, "x"), (None, None), (1.0, "y")], "d double, s string")
    assert rows(quality.null_counts(frame)) == [("d", 1), ("s", 1)]
    assert rows(quality.null_counts(frame, nan_is_missing=True)) == [("d", 2), ("s", 1)]


def test_constant_columns_agree_with_the_profile(spark):
    frame = spark.createDataFrame(
        [(1, None, 1.0, "a", 5, None), (1, None, math.nan, "a", None, None)],
        "one int, empty string, nan double, text string, half int, kept int")
    profiled = [r["column"] for r in quality.profile_columns(frame, keep=["kept"]).collect()
                if r["verdict"].startswith("drop")]
    assert quality.constant_columns(frame, keep=["kept"]) == profiled == ["one", "empty", "text"]
    assert quality.drop_constant_columns(frame, keep=["kept"]).columns == ["nan", "half", "kept"]
    assert quality.constant_columns(frame.limit(0)) == []


def test_numeric_profile(spark):
    frame = spark.range(1, 102).select(F.col("id").cast("double").alias("x"))
    (row,) = quality.numeric_profile(frame, ["x"], relative_error=0.001).collect()
    assert tuple(row)[:7] == ("x", 1.0, 26.0, 51.0, 76.0, 101.0, 51.0)
    assert rows(quality.numeric_profile(frame.limit(0), ["x"])) == [("x",) + (None,) * 7]


def test_describe_columns(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 3), (None, None)], "s string, n int")
    assert rows(quality.describe_columns(frame)) == [
        ("s", 2, None, None, "a", "b"), ("n", 2, 2.0, math.sqrt(2), "1", "3")]


def test_exact_quartiles(spark):
    frame = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"), F.lit(None).cast("double").alias("none"))
    exact, none = quality.exact_numeric_profile(frame, ["x", "none"]).collect()
    assert tuple(exact)[:5] == ("x", 0.0, 249.0, 499.0, 749.0) and exact["maximum"] == 999.0
    assert tuple(none) == ("none",) + (None,) * 7
    assert rows(quality.exact_numeric_profile(frame.limit(0), ["x"])) == [("x",) + (None,) * 7]


def test_sketched_quartiles_are_within_their_error(spark):
    frame = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("x"))
    profile = quality.numeric_profile(frame, ["x"])
    (errors,) = quality.rank_errors(frame, profile, "x").collect()
    assert errors["column"] == "x" and all(0 <= e <= 0.01 for e in errors[1:])
    (exact,) = quality.rank_errors(frame, quality.exact_numeric_profile(frame, ["x"]), "x").collect()
    assert tuple(exact) == ("x", 0.0, 0.0, 0.0)


def test_code_reports(spark):
    frame = spark.createDataFrame([(2,), (1,), (2,)], "code int")
    assert rows(quality.code_distribution(frame, "code")) == [(1, 1), (2, 2)]
    assert rows(quality.code_summary(frame, "code")) == [(5 / 3, 2)]


def test_load_check_and_sample(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert rows(quality.load_check(frame)) == [("n", 1, "int", True, 2), ("s", 2, "string", True, 2)]
    assert quality.sample_rows(frame, 1).count() == 1


def test_duplicates_are_counted(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "n int, s string")
    assert rows(quality.duplicate_count(frame)) == [(2,)]
    assert rows(quality.duplicate_count(frame.limit(0))) == [(0,)]


def test_dedupe_compares_numbers_as_text(spark):
    frame = spark.createDataFrame([("k", 9, None), ("k", 10, "z"), ("k", 10, None), (None, 1, "x")],
                                  "id string, n int, s string")
    assert sorted(rows(quality.dedupe_by_key(frame, "id")), key=str) == [("k", 10, None), (None, 1, "x")]
    assert rows(quality.dedupe_by_key(frame.select("id").filter("id = 'k'"), "id")) == [("k",)]


def test_dedupe_orders_columns_by_name(spark):
    frame = spark.createDataFrame([("k", "1", "b"), ("k", "2", "a")], "id string, z string, a string")
    assert rows(quality.dedupe_by_key(frame, "id")) == [("k", "2", "a")]


def _brute_dedupe(data, key):
    """The smallest row of each key by the texts of the other columns in name order, NULL before an empty text."""
    others = sorted(c for c in data[0] if c != key) if data else []
    best = {}
    for row in data:
        rank = ["" if row[c] is None else str(row[c]) for c in others], [(row[c] is not None, row[c] or 0) if not
                isinstance(row[c], str) else (True, 0) for c in others]
        if row[key] not in best or rank < best[row[key]][0]:
            best[row[key]] = rank, tuple(row.values())
    return sorted((r for _, r in best.values()), key=str)


@pytest.mark.parametrize("repeated", [0, 7, 900])
def test_only_repeated_keys_are_compared(spark, repeated):
    data = [{"key": f"k{i}" if i else None, "s": None if i % 5 == 0 else f"t{i % 3}", "n": i} for i in range(1000)]
    data += [{"key": f"k{i}" if i else None, "s": "" if i % 2 else None, "n": 10 * i} for i in range(repeated)]
    frame = spark.createDataFrame([tuple(r.values()) for r in data], "key string, s string, n int")
    result = quality.dedupe_by_key(frame, "key")
    assert sorted(rows(result), key=str) == _brute_dedupe(data, "key")
    plan = plan_text(result).split("== Physical Plan ==")[1]
    if repeated == 0:
        assert "Sort" not in plan and "Exchange" not in plan  # the table as it is
    elif repeated == 7:
        alone = plan[:plan.index("LeftSemi")]
        assert "LeftAnti" in alone and "SortAggregate" in alone[alone.index("LeftAnti"):]
        assert "Sort" not in alone[:alone.index("LeftAnti")] and plan.count("SortMergeJoin") == 0
    else:
        assert "LeftAnti" not in plan


def test_repeated_keys_beyond_the_broadcast_limit_take_the_plain_way(spark, no_broadcast):
    frame = spark.range(100).select((F.col("id") % 95).alias("key"), F.col("id").alias("n"))
    result = quality.dedupe_by_key(frame, "key")
    assert "LeftAnti" not in plan_text(result) and result.count() == 95


def test_dedupe_of_one_hot_key(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id")
    result = quality.dedupe_by_key(frame, "key")
    assert result.count() == 20_001
    assert result.filter("key = 'hot'").first()["id"] == 0


def test_required_and_complete_rows(spark):
    frame = spark.createDataFrame([("a", None), (None, 1.0), ("b", math.nan), ("c", 1.0)], "s string, d double")
    assert quality.require_columns(frame, ["s", "not_there"]).count() == 3
    assert quality.require_columns(frame, ["not_there"]).count() == 4
    assert rows(quality.drop_null_rows(frame)) == [("c", 1.0)]
    assert rows(quality.removal_report(frame, F.col("s").isNotNull())) == [(4, 3, 1)]


def test_observed_counts_come_with_the_action(spark):
    frame, watch = quality.observed(spark.range(10), "ten")
    frame.filter("id > 5").collect()
    assert watch.get["rows"] == 10


def test_verify_reports_failures_as_rows(spark, tmp_path):
    result = quality.verify_datasets(spark, {
        "good": lambda: spark.range(3), "bad": lambda: spark.read.parquet(str(tmp_path / "absent"))})
    good, bad = result.collect()
    assert tuple(good) == ("good", 3, 1, True, None)
    assert (bad["ok"], bad["n_rows"]) == (False, None) and "absent" in bad["error"]


TRANSACTION_DDL = "t_dat date, customer_id string, article_id string, price double, sales_channel_id int"


def test_clean_transactions(spark):
    d = day("2021-07-04")
    data = [(d, "a", "0001", 0.05, 1), (d, "a", "0001", 0.05, 1), (d, "b", "0002", 0.03, 1),
            (d, "b", "0002", 0.03, 2), (d, None, "0002", 0.03, 1), (d, "c", "0002", None, 1),
            (None, "c", "0002", 0.03, 1)]
    clean = cleaning.clean_transactions(spark.createDataFrame(data, TRANSACTION_DDL))
    assert clean.count() == 4  # equal rows are separate purchases
    assert clean.columns == cleaning.TRANSACTION_CORE
    first = clean.first()
    assert (first["year"], first["month"], first["day_of_week"]) == (2021, 7, 1)
    assert cleaning.clean_transactions(clean.select(*schemas.TRANSACTIONS.fieldNames())).count() == 4


def test_constant_core_columns_stay_but_extra_ones_go(spark):
    frame = spark.createDataFrame([(day("2021-07-04"), "a", "1", 0.5, 1, "x")], TRANSACTION_DDL + ", extra string")
    assert cleaning.clean_transactions(frame).columns == cleaning.TRANSACTION_CORE


def test_unreadable_text_becomes_null(spark):
    raw = spark.createDataFrame([("2021-07-04", "a", "1", "n/a", "1"), ("oops", "a", "1", "0.5", "1"),
                                 ("2021-07-04", "a", "1", "0.5", "1")],
                                "t_dat string, customer_id string, article_id string, price string,"
                                " sales_channel_id string")
    assert cleaning.cast_transactions(raw).filter("price IS NULL OR t_dat IS NULL").count() == 2
    assert cleaning.clean_transactions(raw).count() == 1


ARTICLE_DDL = ("article_id string, prod_name string, product_type_name string, product_group_name string,"
               " department_name string, index_name string, section_name string, garment_group_name string,"
               " detail_desc string, product_code int")


def _article(key, name="Rain COAT ", code=42):
    return (key, name, "PARKA", "Outerwear", "Weatherproof", "Hikers", "Trails", "Shells", "TAPED Seams", code)


def test_clean_articles(spark):
    data = [_article("0042-b", name="Wax Jacket"), _article("0042-b", name="Anorak", code=43),
            _article("0042-c", None), _article("0042-a"), _article("0042-a")]
    clean = cleaning.clean_articles(spark.createDataFrame(data, ARTICLE_DDL))
    kept = {r["article_id"]: r for r in clean.collect()}
    assert set(kept) == {"0042-a", "0042-b"}
    assert (kept["0042-b"]["prod_name"], kept["0042-b"]["product_code"]) == ("anorak", 43)
    assert kept["0042-a"]["prod_name"] == "rain coat"
    assert kept["0042-a"]["detail_desc"] == "taped seams"
    assert clean.columns == [c.split()[0] for c in ARTICLE_DDL.split(", ")]
    assert sorted(rows(cleaning.clean_articles(clean))) == sorted(rows(clean))


CUSTOMER_DDL = ("customer_id string, FN string, Active string, club_member_status string,"
                " fashion_news_frequency string, age string, postal_code string")


def test_clean_customers(spark):
    data = [("1", "1.0", "1.0", "ACTIVE", "NONE", "22.0", "p"), ("1", "1.0", "1.0", "ACTIVE", "NONE", "22.0", "p"),
            ("2", None, None, "LEFT", "NONE", "30", "p"), ("3", "1.0", "1.0", "LEFT", "NONE", "old", "p")]
    clean = cleaning.clean_customers(spark.createDataFrame(data, CUSTOMER_DDL))
    assert "fashion_news_frequency" not in clean.columns and "postal_code" in clean.columns
    assert dict(clean.dtypes)["age"] == "int" and dict(clean.dtypes)["FN"] == "double"
    assert clean.count() == 2
    kept = cleaning.clean_customers(spark.createDataFrame(data, CUSTOMER_DDL), keep=["fashion_news_frequency"])
    assert "fashion_news_frequency" in kept.columns


def test_an_all_null_column_does_not_empty_the_table(spark):
    frame = spark.createDataFrame([("1", 20, None), ("2", 30, None)], "customer_id string, age int, FN double")
    assert cleaning.clean_customers(frame).count() == 2


@pytest.mark.parametrize("schema, width, ids", [
    (schemas.TRANSACTIONS, 5, {"customer_id", "article_id"}), (schemas.ARTICLES, 25, {"article_id"}),
    (schemas.CUSTOMERS, 7, {"customer_id", "postal_code"})])
def test_schemas(schema, width, ids):
    assert len(schema) == width and all(f.nullable for f in schema)
    assert ids <= set(schemas.columns_of(schema, "text"))
