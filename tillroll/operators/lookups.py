"""Aggregation of a fact table by attributes that live on dimension tables.

``summarise`` picks between two exact plans, per dimension:

* the dimension is measured to be small enough to broadcast: join first,
  map-side, then aggregate. The fact table is never shuffled, only its
  partial aggregates.
* otherwise: aggregate the fact table by the join key first, then join. Partial
  aggregation folds a hot key into one row per task *before* the shuffle, so a
  key with a third of all rows is no heavier than any other. With several large
  dimensions the joins before the last one are salted as well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


class Measure(NamedTuple):
    """An aggregate that can be taken in two steps."""

    name: str
    over_rows: Column
    over_partials: Callable[[str], Column]


def row_count(name: str) -> Measure:
    return Measure(name, F.count(F.lit(1)), lambda c: F.coalesce(F.sum(c), F.lit(0)))


def value_count(column: str, name: str) -> Measure:
    """Rows with a value in ``column``; the denominator of its mean."""
    return Measure(name, F.count(column), lambda c: F.coalesce(F.sum(c), F.lit(0)))


def total(column: str, name: str) -> Measure:
    return Measure(name, F.sum(column), F.sum)


def largest(column: str, name: str) -> Measure:
    return Measure(name, F.max(column), F.max)


def smallest(column: str, name: str) -> Measure:
    return Measure(name, F.min(column), F.min)


class Lookup(NamedTuple):
    """A dimension restricted to its key and the attributes in use.

    ``left_semi`` only filters; ``inner`` adds attributes and, like any join,
    repeats a fact row for each matching dimension row.
    """

    frame: DataFrame
    key: str
    how: str = "inner"


# A scan above the broadcast limit has to be this much smaller than that of the fact table to be measured.
MEASURING_RATIO = 10

# Rows of a large dimension are repeated for so many salts, but only those of at most so many heavy keys, which
# a sketch that follows so many keys names.
SALTS, HEAVY_KEYS, TRACKED_KEYS = 32, 128, 1024


def _estimate(df: DataFrame) -> int:
    """Spark's size estimate of a frame in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _width(df: DataFrame) -> Column:
    """Bytes of a row's values: the length of text and binary columns, eight more for each column."""
    sized = (StringType, BinaryType)
    text = [f.name for f in df.schema if isinstance(f.dataType, sized)]
    width = F.lit(8 * len(df.columns)) + sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0))
    return width.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values. Runs one job over all rows."""
    return df.agg(F.sum(_width(df))).first()[0] or 0


class Measured(NamedTuple):
    """Whether a frame is within a limit, and the rows that were read to know."""

    fits: bool
    rows_read: int


def measure(df: DataFrame, limit: int) -> Measured:
    """Whether the values of ``df`` take at most ``limit`` bytes, reading little more than ``limit`` bytes of rows.

    A row counts as one unit for each smallest row that its bytes would hold. The units are taken partition by
    partition (Spark starts with one and goes on with more), so a large frame is given up after its first ones.
    Nothing but empty rows comes to the driver. Below the limit every row was read and the bytes are exact.
    """
    unit = 8 * max(len(df.columns), 1)
    most = limit // unit + 1
    watch = Observation()
    counted = df.select(_width(df).alias("_width")).observe(
        watch, F.sum("_width").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    units = counted.select(F.explode(F.array_repeat(F.lit(True), F.floor(F.col("_width") / unit).cast("int"))))
    taken = units.select().limit(most)._jdf.collectAsList().size()
    seen = watch.get
    return Measured(taken < most and (seen["bytes"] or 0) <= limit, seen["rows"])


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes; 0 if nothing may be broadcast."""
    try:
        return max(int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()), 0)
    except AttributeError:  # a Connect session shows no such thing: take the plans that need none
        return 0


def fits_broadcast(df: DataFrame, fact: DataFrame) -> bool:
    """Whether ``df``, measured, is small enough to be broadcast to the tasks that read ``fact``.

    Spark's estimate is taken from compressed files and knows nothing of what a filter keeps, so it never decides
    for a broadcast. It only tells whether measuring is cheap: a selective filter has to be run over the whole scan
    to know what it keeps, which must be within the limit or small beside the scan of ``fact``.
    """
    limit = broadcast_limit(df)
    if not limit:
        return False
    size = _estimate(df)
    cheap = size <= limit or size * MEASURING_RATIO <= _estimate(fact)
    return cheap and measure(df, limit).fits


# Bytes of the larger table, as Spark estimates them from its files, that one task of a shuffled join is to take.
TASK_BYTES = 8 << 20


def join_in_parts(fact: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Inner join on ``key`` and ``other_key`` whose tasks stay of one size as the tables grow.

    A session has a fixed number of shuffle partitions, so the rows that a task sorts, and those that an aggregate
    behind the join folds there, would grow with the tables. Tables that fit that number, or of which ``other`` may be
    broadcast, are left to Spark. Larger ones are dealt by key into more partitions. AQE splits none of those, so
    ``key`` should have no value with a task's share of rows, such as an order.
    """
    size = _estimate(other)
    parts = -(-max(_estimate(fact), size) // TASK_BYTES)
    if size > broadcast_limit(other) and parts > int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        fact, other = fact.repartition(parts, key), other.repartition(parts, other_key)
    return fact.join(other, F.col(key) == F.col(other_key))


def summarise(fact: DataFrame, by: Sequence[str], measures: Sequence[Measure],
              lookups: Sequence[Lookup] = ()) -> DataFrame:
    """Group ``fact`` by ``by`` (own columns or attributes of ``lookups``) and take ``measures``."""
    wide, deferred = fact, []
    for lookup in lookups:
        if fits_broadcast(lookup.frame, fact):
            wide = wide.join(F.broadcast(lookup.frame), lookup.key, lookup.how)
        else:
            deferred.append(lookup)
    if not deferred:
        return wide.groupBy(*by).agg(*[m.over_rows.alias(m.name) for m in measures])

    own = [c for c in by if c in wide.columns]
    keys = dict.fromkeys([*(lookup.key for lookup in deferred), *own])
    # Rows without a key meet no dimension. Said here, every branch over the folded rows has the same filters.
    for lookup in deferred:
        wide = wide.filter(F.col(lookup.key).isNotNull())
    folded = wide.groupBy(*keys).agg(*[m.over_rows.alias(m.name) for m in measures])
    *earlier, last = deferred
    for position, lookup in enumerate(earlier):
        later_keys = [later.key for later in deferred[position + 1:]]
        folded = _salted_join(folded, lookup, later_keys, measures)
        folded = merge(folded, [c for c in folded.columns if c in {*by, *later_keys}], measures)
    return merge(folded.join(last.frame, last.key, last.how), by, measures)


def merge(folded: DataFrame, by: Sequence[str | Column], measures: Sequence[Measure]) -> DataFrame:
    """Combine rows that were aggregated already."""
    return folded.groupBy(*by).agg(*[m.over_partials(m.name).alias(m.name) for m in measures])


def _heavy_keys(folded: DataFrame, key: str, measures: Sequence[Measure]) -> DataFrame:
    """At most ``HEAVY_KEYS`` values of ``key``, among them each that holds a large share of the rows.

    They come from a mergeable sketch of fixed size. It decides which rows are spread, never the result. The sketch
    reads the measures as well, only so that it asks for the same columns as the join and both share one exchange.
    """
    value = F.when(F.hash(*[m.name for m in measures]) != 0, F.col(key))
    top = folded.agg(F.call_function("approx_top_k", value, F.lit(HEAVY_KEYS), F.lit(TRACKED_KEYS)).alias("top"))
    items = top.select(F.explode("top").alias("top")).select(F.col("top.item").alias(key))
    return items.filter(F.col(key).isNotNull()).select(key, F.lit(SALTS - 1).alias("_last_salt"))


def _salted_join(fact: DataFrame, lookup: Lookup, spread: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Join the rows of a heavy key in ``SALTS`` places, by their values in ``spread``; all others as usual.

    Rows folded by several keys may still be many for a hot one of them. A dimension row of a heavy key is repeated
    once per salt, any other is not, and each fact row has one salt, so every pair meets exactly once.
    """
    heavy = F.broadcast(_heavy_keys(fact, lookup.key, measures))  # bounded by HEAVY_KEYS
    last = F.coalesce("_last_salt", F.lit(0))
    salt = F.pmod(F.xxhash64(*spread), last + 1).cast("int").alias("_salt")
    salts = F.explode(F.sequence(F.lit(0), last)).alias("_salt")
    salted = fact.join(heavy, lookup.key, "left").select(*fact.columns, salt)
    copies = lookup.frame.join(heavy, lookup.key, "left").select(*lookup.frame.columns, salts)
    return salted.join(copies, [lookup.key, "_salt"], lookup.how).drop("_salt")
