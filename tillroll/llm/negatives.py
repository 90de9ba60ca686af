"""Hard negatives by an exact search in a GNAT-style multiway hyperplane tree.

Scores are integer inner products. With M at least the largest squared length, a vector x gets one more coordinate
sqrt(M - |x|^2) and a query q a zero: then d(q, x)^2 = M + |q|^2 - 2 <q, x>, so a window of scores is an annulus of
distances around the query, and the triangle inequality may cut.

An inner node of the tree has a few split points; a vector belongs to the nearest one, which divides space by
hyperplanes. For each pair of split points the node stores the range of distances from the one to the vectors under
the other, over all rows. A query with distance d to a split point can meet vectors of its annulus [a, b] under another
one only if their range meets [d - b, d + b] and reaches a - d; otherwise that subtree is eliminated. What is left are
leaves, whose vectors are compared exactly in blocks.

The tree's split points come from a bounded sample, every row is in a leaf, and all leaves that are not eliminated are
searched: the sample decides how much is compared, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import binary_array, keep, ragged

#: Rows that the tree is fitted on; split points of a node; sample rows at which a node becomes a leaf.
SAMPLE_ROWS, WAYS, LEAF_SAMPLE = 4096, 8, 24
#: Vectors and queries that are compared in one group.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Relative error that distances are given: cuts stay right whatever rounding does.
MARGIN = 1e-9


class Task(NamedTuple):
    """What is mined: every ``anchors``-th id with its ``positives``; ``negatives`` in low..high percent of their score."""

    anchors: int = 100
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


class Node(NamedTuple):
    """``points``: split points, one a row. ``children``: node numbers, or -1 - leaf. ``low``, ``high``: range of the
    distances from split point i to the vectors under child j."""

    points: np.ndarray
    children: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _matrix(vectors: Sequence[bytes], width: int) -> np.ndarray:
    """Integer vectors as float64 rows, shorter ones filled with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        values = np.frombuffer(v, "<i8")
        out[i, : len(values)] = values
    return out


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices of integers."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(queries.shape[1], 1)
    if most < 2 ** 53:  # sums of products are exact in float64
        return (queries @ rows.T).astype(np.int64)
    return queries.astype(np.int64) @ rows.astype(np.int64).T


def _lifted(rows: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([rows, np.sqrt(np.maximum(most - (rows * rows).sum(axis=1), 0))[:, None]])


def _distances(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    square = (points * points).sum(axis=1)[:, None] + (rows * rows).sum(axis=1)[None] - 2 * points @ rows.T
    return np.sqrt(np.maximum(square, 0))


def build_tree(sample: np.ndarray) -> list[Node]:
    """Split points by farthest-first traversal, recursively; the ranges are still to be filled. ``sample`` is lifted."""
    nodes: list[Node] = []
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        chosen = [0]
        nearest = _distances(rows[:1], rows)[0] if len(rows) else np.zeros(0)
        while len(chosen) < WAYS and len(rows) > LEAF_SAMPLE and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _distances(rows[chosen[-1:]], rows)[0])
        if len(chosen) < 2:
            leaves += 1
            return -leaves
        points = rows[chosen]
        owner = _distances(points, rows).argmin(axis=0)
        number = len(nodes)
        nodes.append(None)
        children = np.array([grow(rows[owner == i]) for i in range(len(points))])
        shape = (len(points), len(points))
        nodes[number] = Node(points, children, np.full(shape, np.inf), np.full(shape, -np.inf))
        return number

    if len(sample) == 0 or grow(sample) < 0:  # no two different vectors: one leaf
        return []
    return nodes


def route(tree: list[Node], rows: np.ndarray) -> np.ndarray:
    """The leaf (from 1) of each lifted vector. Widens the ranges of ``tree`` on the way."""
    leaf = np.ones(len(rows), np.int64)
    stack = [(0, np.arange(len(rows)))] if tree else []
    while stack:
        number, at = stack.pop()
        node = tree[number]
        distances = _distances(node.points, rows[at])
        owner = distances.argmin(axis=0)
        for j, child in enumerate(node.children):
            own = owner == j
            if not own.any():
                continue
            node.low[:, j] = np.minimum(node.low[:, j], distances[:, own].min(axis=1))
            node.high[:, j] = np.maximum(node.high[:, j], distances[:, own].max(axis=1))
            if child < 0:
                leaf[at[own]] = -child
            else:
                stack.append((int(child), at[own]))
    return leaf


def reachable(tree: list[Node], queries: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) pairs that are not eliminated for annuli ``near`` .. ``far`` around lifted queries."""
    if not tree:
        return np.arange(len(queries)), np.ones(len(queries), np.int64)
    found_query, found_leaf = [], []
    stack = [(0, np.arange(len(queries)))]
    while stack:
        number, at = stack.pop()
        node = tree[number]
        own = _distances(node.points, queries[at]).T[:, :, None]  # query, split point, (child)
        room = MARGIN * (1 + own + far[at][:, None, None])
        meets = (node.low[None] <= own + far[at][:, None, None] + room) & (
            node.high[None] >= own - far[at][:, None, None] - room) & (
            own + node.high[None] >= near[at][:, None, None] - room)
        open_child = meets.all(axis=1) & (node.low <= node.high).all(axis=0)[None]  # no range: nothing is there
        for j, child in enumerate(node.children):
            here = at[open_child[:, j]]
            if not len(here):
                continue
            if child < 0:
                found_query.append(here)
                found_leaf.append(np.full(len(here), -child))
            else:
                stack.append((int(child), here))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_query]), np.concatenate([none, *found_leaf])


class Fit(NamedTuple):
    """What goes to tasks, bounded by the sample: the tree, the sample with its labels and ids, the vectors' width, M."""

    tree: list[Node]
    sample: np.ndarray
    sample_labels: np.ndarray
    sample_ids: list[np.ndarray]
    width: int
    most: float


class Index(NamedTuple):
    """``rows``: distinct (vector, label) with their leaf and first ids, stored."""

    rows: DataFrame
    fit: Fit


def prepared(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """``id``, ``label`` and ``vector`` (little-endian 64-bit integers floor(256 * x)) of the rows that take part.

    Rows without an id, label or vector, or with a NULL, NaN or infinite component, take no part. Every
    ``relabel_every``-th id gets the next label. Rows that repeat id, label and vector are one.
    """
    parts = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                      F.col(vector_col).cast("array<double>").alias("values"))
    bad = F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    parts = parts.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("values").isNotNull() & ~bad)
    shifted = F.when(F.col("id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    parts = parts.select("id", shifted.alias("label"), "values")

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("values")
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            whole = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * 256).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), binary_array(whole, 8 * sizes)],
                                             names=["id", "label", "vector"])

    return parts.mapInArrow(integers, "id long, label long, vector binary").dropDuplicates(["id", "label", "vector"])


def index(rows: DataFrame, task: Task = Task()) -> Index:
    """Fits the tree and puts every row in its leaf.

    Rows of one vector and label are one entry with their first ids, as many as a result can name: ties go to smaller
    ids, so the others are never in one. A vector that a third of the rows share is one entry.
    """
    first = max(task.positives + 1, task.negatives)
    order = Window.partitionBy("vector", "label").orderBy("id")
    named = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= first)
    entries = keep(named.groupBy("vector", "label").agg(F.sort_array(F.collect_list("id")).alias("ids")), "gnat-entries")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            width = max(map(len, vectors), default=0) // 8
            data = _matrix(vectors, width)
            most = float((data * data).sum(axis=1).max(initial=0))
            yield pa.RecordBatch.from_arrays([pa.array([width], pa.int64()), pa.array([most])], names=["width", "most"])

    bounds = entries.select("vector").mapInArrow(sizes, "width long, most double").agg(F.max("width"), F.max("most")).first()
    width, most = int(bounds[0] or 0), float(bounds[1] or 0.0) * (1 + MARGIN)
    picked = entries.orderBy(F.xxhash64("vector", "label"), "vector", "label").limit(SAMPLE_ROWS).toArrow()
    sample = _matrix(picked.column("vector").to_pylist(), width)
    tree = build_tree(_lifted(sample, most))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = route(tree, _lifted(_matrix(batch.column("vector").to_pylist(), width), most))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vector", "label", "ids", "leaf"])

    placed = keep(entries.mapInArrow(place, "vector binary, label long, ids array<bigint>, leaf long"), "gnat-leaves")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Node(n.points, n.children, np.full_like(n.low, np.inf), np.full_like(n.high, -np.inf)) for n in tree]
        for batch in batches:
            route(own, _lifted(_matrix(batch.column("vector").to_pylist(), width), most))
        rows = [(k, i, j, n.low[i, j], n.high[i, j]) for k, n in enumerate(own) for i in range(len(n.points))
                for j in range(len(n.points)) if n.low[i, j] <= n.high[i, j]]
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.int32()] * 3 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["node", "point", "child", "low", "high"])

    if tree:
        seen = placed.select("vector").mapInArrow(ranges, "node int, point int, child int, low double, high double")
        seen = seen.groupBy("node", "point", "child").agg(F.min("low"), F.max("high"))
        for k, i, j, low, high in seen.collect():  # WAYS^2 for each node of the sample's tree
            tree[k].low[i, j], tree[k].high[i, j] = low, high
    ids = [np.array(x, np.int64) for x in picked.column("ids").to_pylist()]
    return Index(placed, Fit(tree, sample, picked.column("label").to_numpy(), ids, width, most))


def _top(score: np.ndarray, ids: list[np.ndarray], k: int) -> list[tuple[int, int]]:
    """The first ``k`` (score, id) of entries with their scores and ids, by score downwards, then by id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.nonzero(score >= least)[0]
    else:
        at = np.arange(len(score))
    pairs = sorted((-int(score[i]), int(x)) for i in at for x in ids[i][:k])
    return [(-s, x) for s, x in pairs[:k]]


def _annuli(fit: Fit, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and farthest distance of vectors with scores ``low`` .. ``high``."""
    around = fit.most + (queries * queries).sum(axis=1)
    near, far = (np.sqrt(np.maximum(around - 2 * s, 0)) for s in (high, low))
    slack = np.sqrt(MARGIN * (around + 2 * np.abs(np.where(np.isfinite(low), low, 0)) + 1))
    return np.maximum(near - slack, 0), far + slack


def search(idx: Index, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The first ``k`` ids of each query's window: columns of ``queries``' ``query``, with ``score`` and ``id``.

    ``queries`` has ``query`` (a key), ``vector``, ``label``, ``low`` and ``high`` (scores, or NULL for no limit).
    ``same_label`` says whether rows of the query's label or all others count. The k-th best of the fitted sample, whose
    rows are rows of the index, raises the lower limit before the descent. Queries and the entries of a leaf meet in
    blocks of fixed size; each block gives ``k`` rows of a query at most.
    """
    fit = idx.fit
    schema = "query long, label long, vector binary, low double, high double, leaf long"

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = np.array([len(x) for x in fit.sample_ids], np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_QUERIES):
                part = batch.slice(at, BLOCK_QUERIES)
                data = _matrix(part.column("vector").to_pylist(), fit.width)
                label = part.column("label").to_numpy()
                low = part.column("low").fill_null(-np.inf).to_numpy(zero_copy_only=False).copy()
                high = part.column("high").fill_null(np.inf).to_numpy(zero_copy_only=False)
                found = scores(data, fit.sample)
                counts = ((label[:, None] == fit.sample_labels[None]) == same_label) & (found >= low[:, None]) & (
                    found <= high[:, None])
                for i in range(len(data)):
                    score, number = found[i][counts[i]], members[counts[i]]
                    order = np.argsort(-score, kind="stable")
                    enough = np.searchsorted(np.cumsum(number[order]), k)
                    if enough < len(order):
                        low[i] = max(low[i], score[order[enough]])
                near, far = _annuli(fit, data, low, high)
                lifted = np.hstack([data, np.zeros((len(data), 1))])
                query, leaf = reachable(fit.tree, lifted, near, far)
                rows = part.take(pa.array(query))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("query"), rows.column("label"), rows.column("vector"), pa.array(low[query]),
                     pa.array(high[query]), pa.array(leaf)], names=["query", "label", "vector", "low", "high", "leaf"])

    limits = queries.select("query", "label", "vector", F.col("low").cast("double").alias("low"),
                            F.col("high").cast("double").alias("high"))
    visits = keep(limits.mapInArrow(descend, schema), "gnat-visits")
    rows_in = {r[0]: r[1] for r in idx.rows.groupBy("leaf").count().collect()}  # leaves are bounded by the sample
    visits_of = {r[0]: r[1] for r in visits.groupBy("leaf").count().collect()}
    spark = queries.sparkSession
    cut = spark.createDataFrame([(leaf, -(-rows_in.get(leaf, 1) // BLOCK_ROWS), -(-n // BLOCK_QUERIES))
                                 for leaf, n in visits_of.items()], "leaf long, row_blocks int, query_blocks int")
    cut = F.broadcast(cut)  # one row for each leaf

    def blocks(df: DataFrame, own: str, other: str, key: list[str]) -> DataFrame:
        """Each row in its own block, once for each block of the other side."""
        mine = F.pmod(F.xxhash64(*key), F.col(own)).cast("int").alias(own[:-1])
        return df.join(cut, "leaf").select(*df.columns, mine, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1]))

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            data = _matrix(right.column("vector").to_pylist(), fit.width)
            labels, ids = right.column("label").to_numpy(), [np.array(x, np.int64) for x in right.column("ids").to_pylist()]
            asked, own = _matrix(left.column("vector").to_pylist(), fit.width), left.column("label").to_numpy()
            low, high, names = (left.column(c).to_numpy() for c in ("low", "high", "query"))
            for at in range(0, len(asked), 256):
                found = scores(asked[at: at + 256], data)
                for i in range(len(found)):
                    q = at + i
                    ok = np.nonzero(((labels == own[q]) == same_label) & (found[i] >= low[q]) & (found[i] <= high[q]))[0]
                    out += [(names[q], s, x) for s, x in _top(found[i][ok], [ids[o] for o in ok], k)]
        columns = list(zip(*out)) if out else [()] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "score", "id"])

    place = ["leaf", "row_block", "query_block"]
    asked = blocks(visits, "query_blocks", "row_blocks", ["query"]).groupBy(*place)
    there = blocks(idx.rows, "row_blocks", "query_blocks", ["vector", "label"]).groupBy(*place)
    found = asked.cogroup(there).applyInArrow(compare, "query long, score long, id long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k)


def mine(df: DataFrame, task: Task = Task(), id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Anchors are rows whose id is divisible by ``task.anchors``. An anchor's positives are its first other rows of the
    same label; its negatives are the first rows of other labels with low * positive <= 100 * negative <= high *
    positive. Scores go downwards, ties to smaller ids. See ``prepared`` for rows that take no part. Vectors of
    different lengths meet as if the shorter had zeros. Rows that share an id but not vector or label are rows of
    their own; none of them is its own positive. An anchor without a positive or a positive without a negative
    gives no row; neither does an empty table. Other columns are left out, whatever their names.

    The inner products must fit 64 bits. Anchors of one vector and label are one query, as are equal positive scores.
    """
    rows = keep(prepared(df, id_col, vector_col, label_col, relabel_every, labels), "gnat-rows")
    idx = index(rows, task)
    anchors = keep(rows.where(F.col("id") % task.anchors == 0), "gnat-anchors")
    asked = keep(anchors.select("vector", "label").distinct().withColumn("query", F.monotonically_increasing_id()), "gnat-queries")
    anchors = anchors.join(asked, ["vector", "label"]).select(F.col("id").alias("anchor_id"), "query")
    free = F.lit(None).cast("double")
    same = search(idx, asked.select("*", free.alias("low"), free.alias("high")), task.positives + 1, True)
    same = keep(same.select("query", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"), "nth"), "gnat-same")
    others = anchors.join(same, "query").where(F.col("anchor_id") != F.col("positive_id"))
    nth = F.row_number().over(Window.partitionBy("anchor_id", "query").orderBy("nth"))
    positives = others.withColumn("__nth", nth).where(F.col("__nth") <= task.positives).drop("__nth", "nth")

    windows = same.select("query", "positive_score").distinct().join(asked, "query")
    score = F.col("positive_score")
    low, high = (F.lit(p).cast("decimal(20,0)") * score.cast("decimal(20,0)") / 100 for p in (task.low, task.high))
    windows = keep(windows.select("vector", "label", F.col("query").alias("asked"), "positive_score",
                                  F.ceil(low).cast("double").alias("low"), F.floor(high).cast("double").alias("high"))
                   .where("low <= high").withColumn("query", F.monotonically_increasing_id()), "gnat-windows")
    found = search(idx, windows, task.negatives, False)
    found = keep(found.join(windows.select("query", "asked", "positive_score"), "query").select(
        F.col("asked").alias("query"), "positive_score", F.col("nth").alias("rank"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score")), "gnat-found")
    return positives.join(found, ["query", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


OP13_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.id AS anchor, a.label AS own, b.id, b.label, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
  SELECT anchor, own, id AS positive, score AS p FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
), negatives AS (
  SELECT q.anchor, q.positive, s.id, q.p, s.score,
         row_number() OVER (PARTITION BY q.anchor, q.positive ORDER BY s.score DESC, s.id) AS rank
  FROM positives q JOIN scored s ON s.anchor = q.anchor AND s.label <> q.own
   AND 30 * q.p <= 100 * s.score AND 100 * s.score <= 90 * q.p
)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank, id AS negative_id,
       p AS positive_score, score AS negative_score
FROM negatives WHERE rank <= 10
"""
