"""Sinks: cleaned tables, single-file results, plan reports and the bundle of all three."""

from __future__ import annotations

import io
from collections.abc import Callable, Sequence
from contextlib import redirect_stdout
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

MAX_RESULT_ROWS = 5_000


def write_table(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite one cleaned Parquet table.

    With ``partition_by`` the rows are rebalanced on those columns first: few
    files per partition, and AQE splits a partition that holds most of the rows.
    """
    path = f"{folder.rstrip('/')}/{name}"
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def bounded_pandas(df: DataFrame, name: str, max_rows: int = MAX_RESULT_ROWS) -> pd.DataFrame:
    """Bring a small result to the driver; refuse a bigger one after at most ``max_rows + 1`` rows."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"result '{name}' exceeds {max_rows} rows; keep it distributed")
    return rows


def write_result_csv(df: DataFrame, folder: str, name: str, single: bool = True) -> str:
    """Overwrite a result as CSV with headers, as one part file if ``single``. Quotes are doubled, as readers expect."""
    path = f"{folder.rstrip('/')}/{name}"
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, header=True, escape='"')
    return path


def plan_text(df: DataFrame) -> str:
    """All four plan stages of ``df`` as text."""
    captured = io.StringIO()
    with redirect_stdout(captured):
        df.explain(extended=True)
    return captured.getvalue().strip()


def append_plan_report(df: DataFrame, folder: str, title: str) -> str:
    """Append a titled plan to a report, written by Spark so that any file system works."""
    rule = "=" * 80
    entry = f"{rule}\n{title}\n{rule}\n{plan_text(df)}\n"
    df.sparkSession.createDataFrame([(entry,)], "value string").coalesce(1).write.mode("append").text(folder)
    return folder


def flags_to_int(df: DataFrame) -> DataFrame:
    """Boolean columns as 0/1, in place."""
    flags = [f.name for f in df.schema if isinstance(f.dataType, BooleanType)]
    return df.withColumns({name: F.col(name).cast("int") for name in flags}) if flags else df


@dataclass(frozen=True)
class Published:
    """Paths of one published result, its number of rows, and the frame ready for drawing, flags as numbers."""

    name: str
    csv_path: str
    plan_path: str
    row_count: int
    frame: DataFrame
    chart_path: str | None = None


def publish(df: DataFrame, name: str, folder: str, title: str | None = None,
            chart: Callable[[DataFrame], DataFrame] | None = None,
            single_rows: int = MAX_RESULT_ROWS) -> Published:
    """Write plan report and CSV of one result of any size, and of its chart shape if there is one.

    The result is computed once and counted; up to ``single_rows`` rows go into one part file, more stay
    in as many as they have. Nothing is collected: ``bounded_pandas`` of the frame does that on request.
    """
    folder = folder.rstrip("/")
    plan_path = append_plan_report(df, f"{folder}/plans", title or name)
    kept = df.persist()
    try:
        count = kept.count()
        csv_path = write_result_csv(kept, f"{folder}/csv", name, count <= single_rows)
        if chart is None:
            return Published(name, csv_path, plan_path, count, flags_to_int(df))
        chart_path = write_result_csv(chart(kept), f"{folder}/charts", name, count <= single_rows)
        return Published(name, csv_path, plan_path, count, flags_to_int(chart(df)), chart_path)
    finally:
        kept.unpersist()
