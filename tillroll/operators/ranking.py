"""Top-n, ranks and quantile groups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tillroll.operators.durable import materialise

# monotonically_increasing_id keeps the record number in its lower 33 bits.
_RECORD_BITS = 33

# Rows sampled to choose pivots, how far from the wanted place they are taken, and the largest range of rows that one
# task sorts to find the place.
PIVOT_ROWS, PIVOT_STEPS = 4096, (0, 8, 32, 128)
RANGE_ROWS = 250_000


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows in ``order`` (which must be total), optionally numbered.

    The limit comes first: each task offers ``n`` rows at most, so the numbering
    window never holds more than ``n``.
    """
    best = df.orderBy(*order).limit(n)
    return best if rank is None else best.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str,
                    ties: bool = False) -> DataFrame:
    """The first ``n`` rows of each group; with ``ties`` the first ``n`` distinct values, ties kept.

    Spark limits each group within the task before the shuffle, so a hot group
    sends only its leaders.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    number = F.dense_rank() if ties else F.row_number()
    return df.withColumn(rank, number.over(window)).filter(F.col(rank) <= n)


def keep_top_keys(df: DataFrame, key: str, order: Sequence[Column], n: int, weight: Column) -> DataFrame:
    """Rows of the ``n`` best keys by an aggregate called ``weight``.

    The key list is ``n`` rows by construction, so it is broadcast. The join is
    inner, not semi: Catalyst would push a semi join below the aggregation that
    made ``df``, and both sides could no longer share one scan of the facts.
    """
    best = top_n(df.groupBy(key).agg(weight.alias("weight")), order, n).select(key)
    return df.join(F.broadcast(best), key)


class Cut(NamedTuple):
    """A row of a table, by its values in the order columns: ``first`` rows come before it, ``same`` equal it."""

    row: Row
    first: int
    same: int


def _before(df: DataFrame, order: Mapping[str, str], row: Row) -> Column:
    """Whether a row comes before ``row`` in ``order``; NULLs come first upwards and last downwards, as in Spark."""
    found = F.lit(False)
    for name, way in reversed(order.items()):
        value, at = F.col(name), F.lit(row[name]).cast(df.schema[name].dataType)
        if way == "asc":
            earlier = F.lit(False) if row[name] is None else value.isNull() | F.coalesce(value < at, F.lit(False))
        else:
            earlier = value.isNotNull() if row[name] is None else F.coalesce(value > at, F.lit(False))
        found = earlier | (value.eqNullSafe(at) & found)
    return found


def _equals(df: DataFrame, order: Mapping[str, str], row: Row) -> Column:
    alike = [F.col(c).eqNullSafe(F.lit(row[c]).cast(df.schema[c].dataType)) for c in order]
    return reduce(Column.__and__, alike)


def _sort(order: Mapping[str, str]) -> list[Column]:
    return [F.col(c).asc() if way == "asc" else F.col(c).desc() for c, way in order.items()]


def _values(cut: Cut, order: Mapping[str, str]) -> str:
    return repr([cut.row[c] for c in order])


def rows_at(df: DataFrame, order: Mapping[str, str], positions: Sequence[int]) -> list[Cut]:
    """The rows at zero-based ``positions`` of ``df`` sorted by ``order`` (column -> ``asc`` or ``desc``), without a sort.

    Exact selection: rows of a range of the order are sampled for pivots around the wanted place, one aggregation
    counts the rows before and at each pivot, and the range between two pivots that holds the place goes on, about a
    fiftieth of the one before. A range of at most ``RANGE_ROWS`` rows is sorted by one task. The sample decides how
    many rounds it takes, never the result; a row that fills a range by itself is a pivot with its own count, so ties
    never stop the narrowing. The driver sees ``PIVOT_ROWS`` rows or so at a time.

    ``df`` is read in every round and must give the same rows each time: pass a stored table.
    """
    sort, frame = _sort(order), df.select(*order)
    size, found, seed = frame.count(), {}, 0
    #: (row that the range follows, row that it ends before, rows before it, rows in it) -> wanted places
    open_ranges = {(None, None, 0, size): sorted({p for p in positions if 0 <= p < size})}
    while open_ranges:
        (after, until, start, count), places = open_ranges.popitem()
        if not places:
            continue
        inside = frame
        if after is not None:
            inside = inside.filter(~(_before(df, order, after) | _equals(df, order, after)))
        if until is not None:
            inside = inside.filter(_before(df, order, until))
        if count <= RANGE_ROWS:
            line = Window.orderBy(*sort)
            placed = inside.select("*", (F.row_number().over(line) - 1).alias("_place"),
                                   (F.rank().over(line) - 1).alias("_first"),
                                   F.count(F.lit(1)).over(line.rangeBetween(0, 0)).alias("_same"))
            for row in placed.filter(F.col("_place").isin([p - start for p in places])).collect():
                found[start + row["_place"]] = Cut(row, start + row["_first"], row["_same"])
            continue
        seed += 1
        sample = inside.sample(min(1.0, PIVOT_ROWS / count), seed).orderBy(*sort).collect()
        if not sample:
            open_ranges[after, until, start, count] = places
            continue
        wanted = [(p - start) * len(sample) // count for p in places]
        chosen = sorted({min(max(at + side * step, 0), len(sample) - 1) for at in wanted for step in PIVOT_STEPS
                         for side in (1, -1)})
        pivots = [next(alike) for _, alike in groupby((sample[i] for i in chosen), key=repr)]  # NaN equals itself there
        counted = inside.agg(*[F.count_if(test(df, order, row)).alias(f"{name}{i}") for i, row in enumerate(pivots)
                               for name, test in (("before", _before), ("same", _equals))]).first()
        cuts = [Cut(row, start + counted[f"before{i}"], counted[f"same{i}"]) for i, row in enumerate(pivots)]
        for place in places:
            at = next((c for c in cuts if c.first <= place < c.first + c.same), None)
            if at is not None:
                found[place] = at
                continue
            below = [c for c in cuts if c.first + c.same <= place]
            above = [c for c in cuts if c.first > place]
            begin = below[-1].first + below[-1].same if below else start
            end = above[0].first if above else start + count
            part = (below[-1].row if below else after, above[0].row if above else until, begin, end - begin)
            open_ranges.setdefault(part, []).append(place)
    return [found[p] for p in positions if p in found]


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Numbers the rows of ``df`` from 0 in any order, without a sort.

    Rows are numbered within their partition while they are written; the rows of each partition (one count each,
    broadcast) make the numbers gapless.
    """
    mark = F.monotonically_increasing_id()
    placed = materialise(
        df.withColumn("_mark", mark)
          .select(*df.columns, F.shiftright("_mark", _RECORD_BITS).alias("_part"),
                  F.col("_mark").bitwiseAND(F.lit((1 << _RECORD_BITS) - 1)).alias("_record")),
        "numbered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(offsets), "_part")
    return joined.withColumn(name, F.col("_before") + F.col("_record")).drop("_part", "_record", "_before")


def quantile_groups(df: DataFrame, order: Mapping[str, str], n: int, group: str) -> DataFrame:
    """``ntile(n)`` over ``order`` (column -> ``asc`` or ``desc``), for inputs of any size.

    With ``q, r = divmod(rows, n)`` the first ``r`` groups hold ``q + 1`` rows, the others ``q``. Only the first rows
    of the groups are looked for (``rows_at``); a row's group is the number of those at or before it, which is one
    expression. Rows equal in all order columns may fall into two groups, in which any of them may be; only those
    are numbered. The rows are written once, since sums of doubles could differ when they are made again.
    """
    df = materialise(df, "ordered")
    quotient, surplus = divmod(df.count(), n)
    starts = [s for s in (i * quotient + min(i, surplus) for i in range(1, n)) if s < quotient * n + surplus]
    cuts = list(zip(starts, rows_at(df, order, starts)))
    split = {_values(cut, order): cut for start, cut in cuts if start > cut.first}

    def number(reached: Callable[[int, Cut], Column]) -> Column:
        return reduce(Column.__add__, [reached(*c).cast("int") for c in cuts], F.lit(1)).cast("int").alias(group)

    whole = df
    for cut in split.values():
        whole = whole.filter(~_equals(df, order, cut.row))
    grouped = whole.select("*", number(lambda start, cut: ~_before(df, order, cut.row)))
    for own in split.values():
        tied = numbered(df.filter(_equals(df, order, own.row)), "_nth")

        def reached(start: int, cut: Cut, own: Cut = own) -> Column:
            if _values(cut, order) == _values(own, order):
                return F.lit(own.first) + F.col("_nth") >= start
            return F.lit(cut.first < own.first)

        grouped = grouped.union(tied.select(*df.columns, number(reached)))
    return grouped
