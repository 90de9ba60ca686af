"""Histograms, pivots, Pareto lists and shares of aggregated results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import metrics


def histogram(df: DataFrame, by: Column, name: str, count: str) -> DataFrame:
    return df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias(count))


def filled_buckets(df: DataFrame, bucket: Column, labels: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum ``value`` per bucket with one row for *every* label, in label order; empty input gives no row.

    One aggregation with a conditional sum per label, then unpivoted: no join
    against a label table and no row that can go missing.
    """
    sums = df.select(bucket.alias("_bucket"), value).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.coalesce(F.sum(F.when(F.col("_bucket") == label, F.col(value))), F.lit(0)).alias(f"_{i}")
          for i, label in enumerate(labels)],
    )
    entries = F.array(*[
        F.struct(F.lit(i).alias("bucket_order"), F.lit(label).alias(name), F.col(f"_{i}").alias(value))
        for i, label in enumerate(labels)
    ])
    return sums.filter("_rows > 0").select(F.inline(entries))


def pivot_sum(df: DataFrame, by: str | Column, across: str, value: str,
              columns: Sequence[str] | None = None) -> DataFrame:
    """One column per value of ``across``, 0 where nothing was seen.

    Naming the columns saves the job that would look for them.
    """
    grid = df.groupBy(by).pivot(across, list(columns) if columns else None).agg(F.sum(value))
    numeric = [c for c in grid.columns[1:]]
    return grid.na.fill(0, numeric)


def with_total(df: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Attach the group total (or grand total) of an aggregated result to each of its rows."""
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*by)))


def row_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each of ``columns`` as a fraction of their row sum, 0 for an empty row."""
    row_sum = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    shared = {c: metrics.share(c, row_sum) for c in columns}
    return df.select(*[shared.get(c, F.col(c)).alias(c) for c in df.columns])


def pareto(df: DataFrame, value: str, order: Sequence[Column], n: int, name: str) -> DataFrame:
    """The ``n`` largest rows and their cumulative percentage among those ``n``."""
    best = df.orderBy(*order).limit(n)
    so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return best.withColumn(name, metrics.share_pct(F.sum(value).over(so_far),
                                                   F.sum(value).over(Window.partitionBy())))
