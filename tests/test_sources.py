import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import main
from tests.conftest import rows
from tillroll.operators import durable
from tillroll.plans import ingest, report
from tillroll.sources import readers, writers

TRANSACTIONS_CSV = """t_dat,customer_id,article_id,price,sales_channel_id
2019-04-09,007,0042,0.5,1
2019-05-30,007,0042,0.25,1
2019-05-30,007,0042,0.25,1
2019-09-12,k9,0077,2.0,1
2019-09-13,k9,0077,,2
"""
ARTICLES_CSV = """article_id,product_code,prod_name,product_type_no,product_type_name,product_group_name,\
graphical_appearance_no,graphical_appearance_name,colour_group_code,colour_group_name,perceived_colour_value_id,\
perceived_colour_value_name,perceived_colour_master_id,perceived_colour_master_name,department_no,department_name,\
index_code,index_name,index_group_no,index_group_name,section_no,section_name,garment_group_no,garment_group_name,\
detail_desc
0042,42,Rain coat,7,Parka,Outerwear,3,Plain,20,Moss,2,Muted,6,Green,501,Weatherproof,H,\
Hikers,8,Outdoor,61,Trails,33,Shells,"Taped ""dry"" seams, hood"
0077,77,Camp mug,9,Mug,Gear,3,Plain,21,Tin,1,Pale,7,Grey,502,Kitchen,K,\
Campers,8,Outdoor,62,Camp,34,Cookware,Holds half a litre
"""
CUSTOMERS_CSV = """customer_id,FN,Active,club_member_status,fashion_news_frequency,age,postal_code
007,1.0,1.0,LEFT CLUB,Monthly,41,z-90
k9,0.0,0.0,ACTIVE,NONE,63,z-91
q4,,0.0,ACTIVE,Regularly,19,z-90
"""


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "transactions_train.csv").write_text(TRANSACTIONS_CSV)
    (folder / "articles.csv").write_text(ARTICLES_CSV)
    (folder / "customers.csv").write_text(CUSTOMERS_CSV)
    return str(folder)


@pytest.fixture(scope="module")
def processed_dir(spark, raw_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("processed"))
    counts = rows(ingest.ingest(spark, raw_dir, folder, partition_transactions_by=["year"]))
    assert counts == [("transactions", 5, 4, 1), ("articles", 2, 2, 0), ("customers", 3, 2, 1)]
    return folder


def test_ingest_keeps_constant_columns_that_questions_read(spark, raw_dir, tmp_path):
    for file in ("transactions_train.csv", "articles.csv"):
        (tmp_path / file).write_text(open(f"{raw_dir}/{file}").read())
    same = CUSTOMERS_CSV.replace("LEFT CLUB", "ACTIVE").replace("q4,,0.0", "q4,0.0,0.0")
    (tmp_path / "customers.csv").write_text(same.replace("z-91", "z-90"))
    ingest.ingest(spark, str(tmp_path), str(tmp_path / "out"))
    kept = readers.read_table(spark, str(tmp_path / "out"), "customers")
    assert set(ingest.QUESTION_COLUMNS) <= set(kept.columns)
    assert {r["club_member_status"] for r in kept.collect()} == {"ACTIVE"} and kept.count() == 3
    assert report.answer(spark, str(tmp_path / "out"), "age_histogram").count() > 0


def test_csv_types_and_leading_zeros(spark, raw_dir):
    frame = readers.read_transactions(spark, f"{raw_dir}/transactions_train.csv")
    assert frame.dtypes == [("t_dat", "date"), ("customer_id", "string"), ("article_id", "string"),
                            ("price", "double"), ("sales_channel_id", "int")]
    first = frame.orderBy("t_dat").first()
    assert (first["customer_id"], first["article_id"], str(first["t_dat"])) == ("007", "0042", "2019-04-09")
    customer = readers.read_customers(spark, f"{raw_dir}/customers.csv").filter("age = 41").first()
    assert (customer["customer_id"], customer["postal_code"]) == ("007", "z-90")


def test_quoted_text_with_quotes_and_commas(spark, raw_dir):
    first = readers.read_articles(spark, f"{raw_dir}/articles.csv").filter("product_code = 42").first()
    assert first["detail_desc"] == 'Taped "dry" seams, hood'


def test_missing_table_names_its_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="no_such_table"):
        readers.read_table(spark, str(tmp_path), "no_such_table")


def test_verify(spark, raw_dir, tmp_path):
    assert [r["ok"] for r in ingest.verify(spark, raw_dir).collect()] == [True] * 3
    assert [r["ok"] for r in ingest.verify(spark, str(tmp_path)).collect()] == [False] * 3


def test_profiles(spark, raw_dir):
    frames = {name: ingest.profiles(ingest.read_raw(spark, raw_dir, name), name) for name in ingest.RAW_TABLES}
    assert {"numbers", "sales_channel_id_distribution", "columns"} <= set(frames["transactions"])
    assert all(f.count() > 0 for reports in frames.values() for f in reports.values())
    assert dict(rows(frames["customers"]["nulls"]))["FN"] == 1
    raw = ingest.read_raw(spark, raw_dir, "customers")
    assert ingest.profiles(raw, "customers", approx=True)["columns"].count() == len(raw.columns)


def test_partitioned_table_is_pruned(spark, processed_dir):
    frame = report.answer(spark, processed_dir, "running_revenue", year=2019)
    plan = writers.plan_text(frame)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "PushedFilters: [IsNotNull(t_dat), GreaterThanOrEqual(t_dat,2019-01-01)" in plan


def test_every_question_is_published(spark, processed_dir, tmp_path):
    done = report.publish_answers(spark, processed_dir, str(tmp_path))
    assert [d.name for d in done] == list(report.QUESTIONS) and len(done) == 30
    by_name = {d.name: d for d in done}
    back = spark.read.csv(by_name["revenue_by_group"].csv_path, header=True, inferSchema=True)
    assert abs(back.agg(F.sum("total_revenue")).first()[0] - (0.5 + 2 * 0.25 + 2.0)) < 1e-9
    assert by_name["retention_gaps"].chart_path is not None
    titles = spark.read.text(by_name["peak_days"].plan_path).filter("value LIKE '%Winter against%'")
    assert titles.count() == 1


def test_publish_writes_results_of_any_size(spark, tmp_path):
    rows = spark.range(12_000).selectExpr("id", """CASE WHEN id % 3 > 0 THEN concat('a "b", c ', id) END AS name""")
    done = writers.publish(rows, "big", str(tmp_path))
    back = readers.read_csv(spark, done.csv_path, "id long, name string")
    assert done.row_count == 12_000 and sorted(back.collect()) == sorted(rows.collect())
    assert sorted(readers.read_inferred_csv(spark, done.csv_path).collect())[1].name == 'a "b", c 1'
    with pytest.raises(ValueError, match="'big' exceeds 5000 rows"):
        writers.bounded_pandas(done.frame, "big")


def test_result_csv_is_one_file_with_header(spark, tmp_path):
    path = writers.write_result_csv(spark.range(100).repartition(4), str(tmp_path), "r")
    parts = list((tmp_path / "r").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[0] == "id"
    writers.write_result_csv(spark.range(3), str(tmp_path), "r")
    assert spark.read.csv(path, header=True).count() == 3


def test_flags_become_numbers(spark):
    assert rows(writers.flags_to_int(spark.sql("SELECT true AS f, 'x' AS s, CAST(NULL AS BOOLEAN) AS g"))) == [
        (1, "x", None)]


def test_command_line(spark, raw_dir, processed_dir, tmp_path, capsys):
    main.run(spark, main.parse(["verify", raw_dir]))
    main.run(spark, main.parse(["report", processed_dir, str(tmp_path), "--topic", "revenue"]))
    printed = capsys.readouterr().out
    assert "transactions" in printed and "running_revenue" in printed and "peak_days" not in printed


def test_shared_folder_is_the_named_one(spark):
    assert durable.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    frame = durable.materialise(spark.range(3), "three")
    assert frame.count() == 3
    assert spark.conf.get("spark.checkpoint.dir") in json.dumps(frame.inputFiles())
