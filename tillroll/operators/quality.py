"""Profiling and cleaning operators. Profiles are one aggregation over the input, returned as rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, NumericType,
                               StringType, StructType, TimestampType)

from tillroll.functions import metrics
from tillroll.functions.predicates import is_missing
from tillroll.operators.durable import materialise
from tillroll.operators.lookups import broadcast_limit, measure
from tillroll.operators.ranking import rows_at

# Verdicts of the column profile.
KEEP, KEEP_CORE, DROP = "keep", "keep (core)", "drop (constant)"

# Share of rows under repeated keys up to which only they are compared; beyond it two reads would not pay.
CONTESTED_SHARE = 0.25


def _floats(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))}


def _numbers(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema if isinstance(f.dataType, NumericType)}


def _missing(df: DataFrame, column: str, nan_is_missing: bool) -> Column:
    return is_missing(column, nan_is_missing and column in _floats(df))


def _per_column(df: DataFrame, columns: Sequence[str], shared: Mapping[str, Column],
                facts: Callable[[str], Mapping[str, Column]]) -> DataFrame:
    """Aggregate all columns in one pass, then turn the single row into a row per column."""
    fields = {c: {name: f"_{i}_{name}" for name in facts(c)} for i, c in enumerate(columns)}
    aggregates = [value.alias(fields[c][name]) for c in columns for name, value in facts(c).items()]
    one_row = df.agg(*[v.alias(k) for k, v in shared.items()], *aggregates)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(flat).alias(name) for name, flat in fields[c].items()])
        for c in columns
    ])
    return one_row.select(*shared, F.inline(entries)).select("column", *fields[columns[0]], *shared)


def load_check(df: DataFrame) -> DataFrame:
    """Declared schema with the row count: position, column, type, nullable, n_rows."""
    fields = list(df.schema)
    return _per_column(
        df, df.columns, {"n_rows": F.count(F.lit(1))},
        lambda c: {"position": F.lit(df.columns.index(c) + 1),
                   "type": F.lit(fields[df.columns.index(c)].dataType.simpleString()),
                   "nullable": F.lit(fields[df.columns.index(c)].nullable)},
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column; the extremes as text."""
    numbers = _numbers(df)

    def facts(c: str) -> dict[str, Column]:
        value = F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")
        return {"n_values": F.count(c), "mean": F.avg(value), "stddev": F.stddev_samp(value),
                "minimum": F.min(c).cast("string"), "maximum": F.max(c).cast("string")}

    return _per_column(df, list(columns or df.columns), {}, facts)


# Names and shares of the quartiles.
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def numeric_profile(df: DataFrame, columns: Sequence[str], relative_error: float = 0.01) -> DataFrame:
    """Quartiles within a relative rank error, exact extremes, mean and sample deviation.

    One pass; a column's summary holds some multiple of ``1 / relative_error`` values, however many rows there are.
    For quartiles without an error take ``exact_numeric_profile``, not a tiny error. An empty input gives NULLs.
    """
    accuracy = round(1 / relative_error)

    def facts(c: str) -> dict[str, Column]:
        value = F.col(c).cast("double")
        quartile = {name: F.percentile_approx(value, p, accuracy) for name, p in QUARTILES.items()}
        return {"minimum": F.min(value), **quartile, "maximum": F.max(value),
                "mean": F.avg(value), "stddev": F.stddev_samp(value)}

    return _per_column(df, columns, {}, facts)


def exact_numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``numeric_profile`` with exact quartiles: the smallest value with at least that share of the values up to it.

    The columns are written once and the quartiles selected by ``ranking.rows_at``: some counting passes over one
    column each and no summary that grows. Looks for the quartiles when called. An empty input gives NULLs.
    """
    stored = materialise(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "profile")
    rows = stored.agg(*[F.count(c).alias(c) for c in columns]).first()
    found = {}
    for c in columns:
        places = [max(math.ceil(p * rows[c]) - 1, 0) for p in QUARTILES.values()]
        cuts = rows_at(stored.select(c).filter(F.col(c).isNotNull()), {c: "asc"}, places) if rows[c] else []
        found[c] = dict(zip(QUARTILES, [cut.row[c] for cut in cuts] or [None] * 3))

    def facts(c: str) -> dict[str, Column]:
        # max() makes an aggregate of the constant and gives NULL for an empty input
        quartile = {name: F.max(F.lit(found[c][name]).cast("double")) for name in QUARTILES}
        return {"minimum": F.min(c), **quartile, "maximum": F.max(c), "mean": F.avg(c), "stddev": F.stddev_samp(c)}

    return _per_column(stored, columns, {}, facts)


def rank_errors(df: DataFrame, profile: DataFrame, column: str) -> DataFrame:
    """How far the quartiles of ``profile`` are off, as a share of the rows with a value: 0 where exact. One row.

    A value takes all ranks of the rows that equal it; the error is the distance of the wanted share to those. The
    profile's row is read when called.
    """
    quartiles = profile.filter(F.col("column") == column).first()
    value = F.col(column).cast("double")

    def share(test: Column) -> Column:
        return F.try_divide(F.count_if(test), F.count(value))

    errors = [F.greatest(share(value < quartiles[name]) - p, p - share(value <= quartiles[name]), F.lit(0.0))
              .alias(f"{name}_error") for name, p in QUARTILES.items()]
    return df.agg(F.lit(column).alias("column"), *errors)


def code_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per code, ordered by code."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(column)


def code_summary(df: DataFrame, column: str) -> DataFrame:
    """Mean and number of distinct codes, one row."""
    return df.agg(F.avg(F.col(column).cast("double")).alias("mean_code"),
                  F.count_distinct(column).alias("n_codes"))


def _whole(df: DataFrame, column: str) -> Column | None:
    """The column's values one for one as longs; None for a type that has more than those."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (IntegralType, BooleanType)):
        return value.cast("long")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return (value * F.lit(Decimal(10) ** kind.scale)).cast("long")
    return None


# Values that one word of a bitmap marks.
WORD_BITS = 6


def bitmap_words(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bitmaps of the values of whole-number ``columns``, 64 to a word: column's place, word, marks and rows.

    Marks are folded by ``bit_or`` within the task, so that sixty-four neighbouring values leave it as one row. A
    bitmap holds words that have a mark only; scattered values cost a row each, as a plain distinct count would.
    NULLs are the word NULL. Bitmaps of several parts merge by ``bit_or``.
    """
    def entry(at: int, value: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63)).cast("int"))
        return F.struct(F.lit(at).alias("at"), F.shiftright(value, WORD_BITS).alias("word"), bit.alias("bit"))

    entries = F.array(*[entry(i, _whole(df, c)) for i, c in enumerate(columns)])
    return df.select(F.inline(entries)).groupBy("at", "word").agg(
        F.bit_or("bit").alias("marks"), F.count(F.lit(1)).alias("n"))


def _column_facts(df: DataFrame, approx: bool, nan_is_missing: bool) -> DataFrame:
    """Per column its distinct values, whether NULL is one, missing values, and the rows."""
    whole = [] if approx else [c for c in df.columns if _whole(df, c) is not None]
    others = [c for c in df.columns if c not in whole]
    distinct = F.approx_count_distinct if approx else F.count_distinct
    found = []
    if others:
        found.append(_per_column(df, others, {"n_rows": F.count(F.lit(1))}, lambda c: {
            "n_values": distinct(c), "has_null": F.max(F.col(c).isNull().cast("int")),
            "n_missing": F.count_if(_missing(df, c, nan_is_missing))}))
    if whole:
        null = F.col("word").isNull()

        def total(test: Column, value: Column) -> Column:
            return F.coalesce(F.sum(F.when(test, value)), F.lit(0).cast("long"))

        def facts(c: str) -> dict[str, Column]:
            own = F.col("at") == whole.index(c)
            return {"n_values": total(own & ~null, F.bit_count("marks")), "has_null": F.max(F.when(own, null.cast("int"))),
                    "n_missing": total(own & null, F.col("n"))}

        found.append(_per_column(bitmap_words(df, whole), whole, {"n_rows": total(F.col("at") == 0, F.col("n"))}, facts))
    if len(found) == 1:
        return found[0]
    place = F.array_position(F.array(*[F.lit(c) for c in df.columns]), F.col("column"))
    return found[0].unionByName(found[1]).orderBy(place)


def _verdicts(facts: DataFrame, keep: Sequence[str]) -> DataFrame:
    protected = F.col("column").isin(*keep) if keep else F.lit(False)
    constant = F.col("n_distinct") == 1
    return (
        facts.withColumn("n_distinct", F.col("n_values") + F.coalesce("has_null", F.lit(0)))
        .select("column", "n_distinct", "n_missing",
                metrics.share_pct("n_missing", "n_rows").alias("missing_pct"),
                F.when(protected, KEEP_CORE).when(constant, DROP).otherwise(KEEP).alias("verdict"))
    )


def profile_columns(df: DataFrame, keep: Sequence[str] = (), approx: bool = False,
                    nan_is_missing: bool = False) -> DataFrame:
    """Distinct values (NULL is one), missing values, their percentage and a verdict per column.

    Whole numbers, dates, timestamps and flags are counted exactly by ``bitmap_words``, other types by a distinct
    count that repeats each row once per such column within the task; each column is read once. ``approx`` uses
    sketches instead, for wide or huge tables; ``append_sketches`` keeps those with the table.
    """
    return _verdicts(_column_facts(df, approx, nan_is_missing), keep)


# The logarithm of a sketch's registers, and the error promised, three times its standard one of 0.016.
SKETCH_LOG, SKETCH_ERROR = 12, 0.05


def column_sketches(df: DataFrame, nan_is_missing: bool = False) -> DataFrame:
    """Per column its rows, missing values and a sketch of its distinct values, some kilobytes whatever the input.

    Sketches of the parts of a table add up to that of the table: see ``sketched_profile``. One pass.
    """
    def plain(c: str) -> Column:
        kind, whole = df.schema[c].dataType, _whole(df, c)
        if whole is not None:
            return whole
        if isinstance(kind, (FloatType, DoubleType)):
            return (F.col(c) + F.lit(0.0)).cast("string")  # one zero
        return F.col(c) if isinstance(kind, (StringType, BinaryType)) else F.col(c).cast("string")

    return _per_column(df, df.columns, {"n_rows": F.count(F.lit(1))}, lambda c: {
        "sketch": F.hll_sketch_agg(plain(c), F.lit(SKETCH_LOG)), "has_null": F.max(F.col(c).isNull().cast("int")),
        "n_missing": F.count_if(_missing(df, c, nan_is_missing))})


def append_sketches(df: DataFrame, path: str, nan_is_missing: bool = False) -> None:
    """Adds the sketches of a delivery to those kept beside its table at ``path``."""
    column_sketches(df, nan_is_missing).coalesce(1).write.mode("append").parquet(path)


def sketched_profile(sketches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``profile_columns`` of a table from the sketches of its parts, without reading a row of it.

    Missing values are exact; distinct values are within ``SKETCH_ERROR``, nearly always, and exact where few.
    """
    merged = sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"), F.max("has_null").alias("has_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_values"))
    return _verdicts(merged, keep)


def constant_columns(df: DataFrame, keep: Sequence[str] = ()) -> list[str]:
    """Columns with one distinct value, counting NULL as a value. Runs one job.

    A column is constant when it is all NULL, or has no NULL and equal extremes;
    that needs no distinct count.
    """
    columns = [c for c in df.columns if c not in keep]
    if not columns:
        return []
    facts = df.agg(*[
        F.when(F.count(c) == 0, F.count(F.lit(1)) > 0)
        .otherwise((F.count(c) == F.count(F.lit(1))) & (F.min(c) == F.max(c))).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]).first()
    return [c for i, c in enumerate(columns) if facts[f"_{i}"]]


def drop_constant_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*constant_columns(df, keep))


def null_counts(df: DataFrame, nan_is_missing: bool = False) -> DataFrame:
    return _per_column(df, df.columns, {},
                       lambda c: {"n_missing": F.count_if(_missing(df, c, nan_is_missing))})


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Rows complete in every column (NaN counts as missing)."""
    return df.dropna()


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows complete in those of ``required`` that exist."""
    present = [c for c in required if c in df.columns]
    return df.dropna(subset=present) if present else df


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows, as one row."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def _smallest_rows(df: DataFrame, key: str, others: Sequence[str]) -> DataFrame:
    """One row per key by a minimum over structs, folded within the task before the shuffle.

    A text column travels once: its text orders the rows, and a flag tells NULL from an empty text.
    """
    texts = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{i}") for i, c in enumerate(others)]
    values = [(F.col(c).isNotNull() if c in texts else F.col(c)).alias(f"_{i}") for i, c in enumerate(others)]
    best = df.groupBy(key).agg(F.min(F.struct(F.struct(*as_text).alias("text"), F.struct(*values).alias("value")))
                               .alias("best"))

    def back(c: str) -> Column:
        text, value = (F.col(f"best.{part}._{others.index(c)}") for part in ("text", "value"))
        return F.when(value, text).alias(c) if c in texts else value.alias(c)

    return best.select(*[F.col(key) if c == key else back(c) for c in df.columns])


def dedupe_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by all other columns as text, taken in name order.

    NULL compares as empty text (and goes before one), numbers compare as text. The rows of each key are counted
    first, which shuffles hashed keys only. Where few rows share their key, only those are compared; all others pass
    as they are, without a sort or a shuffle, and so does the whole table if no key is repeated. The repeated keys
    are broadcast, which ``measure`` has to allow. Otherwise the minimum is taken over all rows; it is folded within
    the task, so the copies of a hot key are never brought together.
    """
    others = sorted(c for c in df.columns if c != key)
    if not others:
        return df.dropDuplicates([key])
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = F.col("_rows") > 1
    rows, shared = keys.agg(F.sum("_rows"), F.sum(F.when(repeated, F.col("_rows")))).first()
    if not shared:
        return df
    listed = keys.filter(repeated).select(F.col(key).alias("_key"))
    if shared > rows * CONTESTED_SHARE or not measure(listed, broadcast_limit(df)).fits:
        return _smallest_rows(df, key, others)
    listed = F.broadcast(materialise(listed, "repeated-keys"))
    alone = df.join(listed, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    contested = df.join(listed, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return alone.unionByName(_smallest_rows(contested, key, others))


def removal_report(before: DataFrame, keep: Column) -> DataFrame:
    """Rows before, kept and removed by a row filter, in one pass and one row."""
    return before.agg(
        F.count(F.lit(1)).alias("before_rows"), F.count_if(keep).alias("after_rows"),
    ).withColumn("removed_rows", F.col("before_rows") - F.col("after_rows"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while the frame is written anyway; read ``.get`` afterwards."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def inventory(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table: one lazy count per table, unioned."""
    parts = [
        df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"),
               F.lit(len(df.columns)).alias("n_cols"))
        for name, df in frames.items()
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined


_VERIFICATION = "dataset string, n_rows bigint, n_cols int, ok boolean, error string"


def verify_datasets(spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Load and count each dataset; a failure becomes a row with ``ok = false`` and its message.

    Counting is separate per dataset, so that one broken delivery hides no other.
    """
    rows = []
    for name, load in loaders.items():
        try:
            df = load()
            rows.append((name, df.count(), len(df.columns), True, None))
        except Exception as failure:  # any failure to load is a finding, not a crash
            rows.append((name, None, None, False, str(failure).splitlines()[0]))
    return spark.createDataFrame(rows, _VERIFICATION)


def _number(column: str, kind: str) -> Column:
    """Lenient number cast: unreadable text becomes NULL, ``"22.0"`` is a valid integer."""
    value = F.col(column).try_cast("double")
    return value if kind == "double" else value.try_cast(kind)


def cast_numbers(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: _number(c, kind) for c in present})


def normalise_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim and lower-case those of ``columns`` that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.lower(F.trim(c)) for c in present})


def date_features(df: DataFrame, date: str) -> DataFrame:
    """Add ``year``, ``month`` and ``day_of_week`` (1 = Sunday)."""
    return df.withColumns({"year": F.year(date), "month": F.month(date), "day_of_week": F.dayofweek(date)})


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Leniently cast the columns a schema knows and leave the others alone."""
    kinds = {f.name: f.dataType.simpleString() for f in schema if f.name in df.columns}
    casts = {c: _number(c, kind) if kind in ("int", "double") else F.col(c).try_cast(kind)
             for c, kind in kinds.items()}
    return df.withColumns(casts)
