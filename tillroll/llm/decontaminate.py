"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m characters and a region of a document that is at most k edits from it share at least
``m - q + 1 - k * q`` q-grams, all on diagonals (place in the document less place in the item) that differ by at
most k. Places of a document whose q-grams are in any item are counted first, over stretches as long as an item;
where enough lie together, hits are counted in overlapping bands of diagonals for each item, and regions that meet
the bound are verified by alignment inside their band. Long items count by any stretch of ``SPAN`` characters, so
that a passage of an item is found as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillroll.llm.common import new_path, ragged, slices

#: q-grams of eight characters; stretches of 100 characters; six edits in a hundred characters.
Q, SPAN, EDITS = 8, 100, 0.06
#: Benchmark text of one pass over the documents: bounds the index that is sent to every task.
BLOCK_CHARS = 8 << 20
HASH_BITS = 22
#: Tasks that write the benchmark's blocks.
MAX_WRITERS = 200


def normalize(text: str | None) -> str:
    """Lower case, white space of any length as one space."""
    return " ".join((text or "").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray) -> np.ndarray:
    """The q-gram from each place on as one number: the low bytes of its characters. May collide, never misses."""
    low = points.astype(np.uint64) & np.uint64(0xFF)
    n = len(points) - Q + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(Q):
        out |= low[k: k + len(out)] << np.uint64(8 * k)
    return out


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)


class Index:
    """Items whose stretches have the same length, their q-grams and where those are."""

    def __init__(self, items: list[tuple[int, np.ndarray]], span: int):
        self.items, self.span = items, span
        self.edits = {n: int(EDITS * min(len(p), SPAN)) for n, (_, p) in enumerate(items)}
        self.shared = {n: min(len(p), SPAN) - Q + 1 - self.edits[n] * Q for n, (_, p) in enumerate(items)}
        grams = [_grams(p) for _, p in items]
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        joined = np.concatenate(grams)
        order = np.argsort(joined, kind="stable")
        self.grams, first, self.count = np.unique(joined[order], return_index=True, return_counts=True)
        self.first, self.owner, self.place = first, owner[order], place[order]
        self.present = np.zeros(1 << HASH_BITS, bool)
        self.present[_cells(self.grams)] = True
        longest = max(min(len(p), SPAN) for _, p in items)
        self.reach = longest - Q + 1 + int(EDITS * longest)
        self.least = max(1, min(self.shared.values()))

    def dense(self, grams: np.ndarray) -> np.ndarray:
        """Places with a q-gram of some item, in stretches that have enough of them for some item."""
        at = np.flatnonzero(self.present[_cells(grams)])
        n = self.least
        if len(at) < n:
            return at[:0]
        near = np.flatnonzero(at[n - 1:] - at[: len(at) - n + 1] < self.reach)
        edge = np.zeros(len(at) + 1, np.int64)
        np.add.at(edge, near, 1)
        np.subtract.at(edge, near + n, 1)
        at = at[np.cumsum(edge)[:-1] > 0]
        found = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        return at[self.grams[found] == grams[at]]


def build(items: list[tuple[int, str | None]]) -> list[Index]:
    """Indexes of the items, by the power of two of their stretch length; items under ``Q`` characters have none."""
    classes: dict[int, list] = {}
    for item_id, text in items:
        points = _points(normalize(text))
        if len(points) >= Q:
            classes.setdefault(min(len(points), SPAN).bit_length() if len(points) < SPAN else 0, []).append((item_id, points))
    return [Index(x, k) for k, x in sorted(classes.items())]


def banded_distance(pattern: np.ndarray, text: np.ndarray, offset: int, half: int, limit: int) -> int:
    """Edit distance of ``pattern`` and the best stretch of ``text``, on diagonals ``offset`` - half .. + half.

    Stops above ``limit``. A row of the band is one numpy step; insertions are a running minimum.
    """
    width = 2 * half + 1
    ramp, big = np.arange(width), limit + len(pattern) + len(text) + 1
    at = offset - half + ramp
    row = np.where((at >= 0) & (at <= len(text)), 0, big)
    for i, c in enumerate(pattern):
        at = offset - half + i + ramp  # the character that a step along the diagonal reads
        inside = (at >= 0) & (at < len(text))
        same = inside & (text[np.clip(at, 0, len(text) - 1)] == c) if len(text) else inside
        step = np.where(inside, row + ~same, big)
        gone = np.append(row[1:], big) + 1
        row = np.minimum(step, gone)
        row = np.minimum.accumulate(row - ramp) + ramp
        row[(at + 1 < 0) | (at + 1 > len(text))] = big
        if row.min() > limit:
            return limit + 1
    return int(row.min())


def _stretches(places: np.ndarray, full: np.ndarray, last: int, span: int, length: int, group: np.ndarray) -> Iterator[tuple[int, int]]:
    """Starts of the stretches of an item that hold a window of places ``k`` .. ``k + last``, and ``k``: first where
    the windows begin, then those before, since edits may have taken the q-grams from a stretch's start on."""
    tried = set()
    for early in (False, True):
        for k in full.tolist():
            top = min(int(places[k]), length - span)
            for first in range(top - 1, max(0, int(places[k + last]) - (span - Q)) - 1, -1) if early else [top]:
                if (first, int(group[k])) not in tried:
                    tried.add((first, int(group[k])))
                    yield first, k


def matches(index: Index, points: np.ndarray, grams: np.ndarray) -> dict[int, tuple[int, int, int]]:
    """Items of ``index`` found in one document: item -> (place, length, edits) of the first verified region."""
    at = index.dense(grams)
    if not len(at):
        return {}
    found = np.searchsorted(index.grams, grams[at])
    count = index.count[found]
    entry = ragged(index.first[found], count)
    doc_place, owner, place = np.repeat(at, count), index.owner[entry], index.place[entry]
    diagonal = doc_place - place
    out: dict[int, tuple[int, int, int]] = {}
    order = np.argsort(owner, kind="stable")
    bounds = np.flatnonzero(np.diff(owner[order], prepend=-1, append=-1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        rows = order[a:b]
        n = int(owner[rows[0]])
        edits, shared = index.edits[n], index.shared[n]
        if len(rows) < shared:
            continue
        item_id, item = index.items[n]
        span, step = min(len(item), SPAN), edits + 1
        band = diagonal[rows] // step
        rows, group = np.concatenate([rows, rows]), np.concatenate([band, band - 1])  # a band is two steps wide
        sort = np.lexsort((place[rows], group))
        group, places = group[sort], place[rows][sort]
        new = np.ones(len(sort), bool)
        new[1:] = (group[1:] != group[:-1]) | (places[1:] != places[:-1])
        group, places = group[new], places[new]
        last = shared - 1
        full = np.flatnonzero((group[last:] == group[: max(0, len(group) - last)])
                              & (places[last:] - places[: max(0, len(places) - last)] <= span - Q))
        for first, k in _stretches(places, full, last, span, len(item), group):
            offset = first + (int(group[k]) + 1) * step
            got = banded_distance(item[first: first + span], points, offset, step + edits, edits)
            if got <= edits:
                out[item_id] = (max(0, offset), span, got)
                break
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and item found in it: ids, ``place`` and ``length`` of a region near enough, ``edits``.

    Places count characters of the normalised text. The benchmark is written to the shared folder in blocks of about
    ``BLOCK_CHARS`` characters when called, and a task searches its documents for one block, which it reads and
    indexes itself: neither the driver nor a task ever holds more of the benchmark than a block. Whole texts are
    searched. NULL, empty and very short texts (under ``Q`` characters, on either side) match nothing; an item under
    ``SPAN`` characters has to be there as a whole. Rows that repeat a document's id, and rows without one, each give
    their own matches. An item is what id and text make it: rows that repeat both count once, items that only share
    an id give a row each, and a NULL item id gives NULL. The items' ids are called ``item_id``; documents' ids that
    have the name of another column of the result are called ``doc_id``.
    """
    spark = docs.sparkSession
    own = "doc_id" if id_col in ("item_id", "place", "length", "edits") else id_col
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("__text"))
    schema = StructType([StructField(own, docs.schema[id_col].dataType), items.schema["item_id"],
                         *(StructField(c, LongType()) for c in ("place", "length", "edits"))])
    out = None
    for block in write_blocks(items.where(F.col("__text").isNotNull())):
        found = docs.select(F.col(id_col).alias(own), F.col(text_col).cast("string").alias("__text")).mapInArrow(
            _search(block, schema.names), schema)
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], schema) if out is None else out


def write_blocks(items: DataFrame) -> list[str]:
    """Writes ``items`` (``item_id``, ``__text``) to folders of about ``BLOCK_CHARS`` characters; rows are dealt by a
    hash of both columns, so copies of one text spread as well."""
    spark = items.sparkSession
    size = items.agg(F.coalesce(F.sum(F.char_length("__text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-size // BLOCK_CHARS)
    if not blocks:
        return []
    folder = new_path(spark, "benchmark")
    block = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "__text"), F.lit(blocks))
    items.dropDuplicates().withColumn("block", block).repartition(int(min(blocks, MAX_WRITERS)), "block").write.partitionBy("block").parquet(folder)
    return [f"{folder}/block={k}" for k in range(blocks)]


#: The block that this worker searched last, with its indexes and the ids of each distinct text.
_last: list = [None, [], []]


def _block(folder: str) -> tuple[list[Index], list[pa.Array]]:
    """Indexes of the distinct texts of a block, and the item ids of each; read once by a worker for tasks in a row."""
    if _last[0] != folder:
        _last[:] = [None, [], []]
        system, path = pafs.FileSystem.from_uri(folder)
        files = [f.path for f in system.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
        tables = [pq.ParquetFile(system.open_input_file(f)).read() for f in sorted(files)]
        places, texts, ids = {}, [], []
        for table in tables:
            for row, text in enumerate(table.column("__text").to_pylist()):
                at = places.setdefault(text, len(places))
                if at == len(texts):
                    texts.append(text)
                    ids.append([])
                ids[at].append(table.column("item_id")[row].as_py())
        kind = tables[0].schema.field("item_id").type if tables else pa.int64()
        _last[:] = [folder, build(list(enumerate(texts))), [pa.array(x, kind) for x in ids]]
    return _last[1], _last[2]


def _search(block: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes, ids = _block(block)
        for batch in batches:
            for rows in slices(batch, "__text"):
                owners, found, items = [], [], []
                for row, text in enumerate(rows.column("__text").to_pylist()):
                    points = _points(normalize(text))
                    if len(points) < Q:
                        continue
                    grams = _grams(points)
                    for index in indexes:
                        for at, where in matches(index, points, grams).items():
                            owners += [row] * len(ids[at])
                            found += [where] * len(ids[at])
                            items.append(ids[at])
                if items:
                    columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
                    yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(owners, pa.int64())),
                                                      pa.concat_arrays(items), *columns], names=names)

    return run


def op3_qgram_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
