import datetime

import pytest

from checks.compare import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    spark = session(4, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(shared),
                          "spark.driver.memory": "4g"})
    yield spark
    spark.stop()


@pytest.fixture
def no_broadcast(spark):
    """Every dimension counts as too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture(params=["broadcast", "shuffled"])
def join_mode(request, spark):
    """Run a test with the dimensions broadcast, and again with pre-aggregation and shuffled joins."""
    if request.param == "shuffled":
        request.getfixturevalue("no_broadcast")
    return request.param


def day(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


SALES = "t_dat date, customer_id string, article_id string, price double, sales_channel_id int"


@pytest.fixture
def sales(spark):
    return spark.createDataFrame([
        (day("2020-02-03"), "mia", "boot", 1.10, 2),
        (day("2020-02-03"), "mia", "scarf", 0.25, 2),
        (day("2020-06-20"), "mia", "scarf", 0.25, 1),
        (day("2020-07-15"), "tom", "hat", 0.40, 1),
        (day("2020-07-16"), "tom", "hat", 0.35, 1),
        (day("2020-09-01"), "tom", "boot", 1.20, 2),
        (day("2020-12-24"), "eve", "boot", 1.00, 1),
    ], SALES)


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(
        [("boot", "Shoes"), ("scarf", "Wool"), ("hat", "Headwear")], "article_id string, product_group_name string")


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [("mia", 31, "ACTIVE"), ("tom", 33, "PRE-CREATE"), ("eve", 67, "ACTIVE")],
        "customer_id string, age int, club_member_status string")


def rows(df):
    return [tuple(r) for r in df.collect()]
