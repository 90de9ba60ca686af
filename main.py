"""Command line of the retail tables: verify, clean and report.

    spark-submit main.py verify RAW_DIR
    spark-submit main.py clean RAW_DIR PROCESSED_DIR [--partition-by year]
    spark-submit main.py profile RAW_DIR OUT_DIR
    spark-submit main.py report PROCESSED_DIR OUT_DIR [--topic revenue ...]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillroll.plans import ingest, report
from tillroll.sources import writers

TOPICS = sorted({question.topic for question in report.QUESTIONS.values()})


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Retail sales analytics on Spark")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, folders in {"verify": ["raw"], "clean": ["raw", "processed"], "profile": ["raw", "out"],
                          "report": ["processed", "out"]}.items():
        command = commands.add_parser(name)
        for folder in folders:
            command.add_argument(folder)
    commands.choices["clean"].add_argument("--partition-by", nargs="*", default=[])
    commands.choices["profile"].add_argument("--approx", action="store_true")
    commands.choices["report"].add_argument("--topic", nargs="*", default=[], choices=TOPICS)
    return parser.parse_args(argv)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.command == "verify":
        ingest.verify(spark, options.raw).show(truncate=False)
    elif options.command == "clean":
        ingest.ingest(spark, options.raw, options.processed, options.partition_by).show()
    elif options.command == "profile":
        for table in ingest.RAW_TABLES:
            raw = ingest.read_raw(spark, options.raw, table)
            for name, frame in ingest.profiles(raw, table, options.approx).items():
                writers.write_result_csv(frame, f"{options.out.rstrip('/')}/{table}", name)
    else:
        for done in report.publish_answers(spark, options.processed, options.out, options.topic):
            print(f"{done.name}: {done.row_count} rows, {done.csv_path}")


if __name__ == "__main__":
    session = (SparkSession.builder.appName("tillroll").config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    try:
        run(session, parse())
    finally:
        session.stop()
