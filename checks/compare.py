"""Side-by-side run of registered queries and their oracles.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.binding import TABLES

SF_DIR = "/root/testdata/sf0.01"


def session(cores: int | str = 8, **conf: str) -> SparkSession:
    settings = {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false", "spark.python.sql.dataFrameDebugging.enabled": "false", **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tillroll")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return _rows(df.columns, df.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(ours, theirs) -> str | None:
    """What differs between two results, None when every value is identical."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    left, right = ours[1] - theirs[1], theirs[1] - ours[1]
    if left or right:
        return (f"{sum(ours[1].values())} vs {sum(theirs[1].values())} rows, "
                f"only ours {list(left)[:3]}, only theirs {list(right)[:3]}")
    return None


def main(argv: list[str]) -> int:
    from checks.oracle import oracle_sql
    from checks.registry import queries

    sf_dir = argv[0] if argv else SF_DIR
    wanted = argv[1:]
    spark, con, oracles = session(), duck(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            ours = spark_rows(query(spark, sf_dir))
            verdict = difference(ours, duck_rows(con, oracles[name])) if name in oracles else "no oracle"
        except Exception as failure:
            verdict = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name} {time.perf_counter() - start:.2f}s"
              + (f" {sum(ours[1].values())} rows" if verdict is None else f"\n    {verdict}"), flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
