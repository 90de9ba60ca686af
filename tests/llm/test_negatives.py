"""Hard negatives against comparing all pairs."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from tillroll.llm import negatives
from tillroll.llm.registry import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors=100):
    kept = set()
    for i, vector, label in rows:
        if None not in (i, vector, label) and all(x is not None and math.isfinite(x) for x in vector):
            kept.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = set()
    for anchor, label, vector in kept:
        if anchor % anchors:
            continue
        order = sorted((-sum(a * b for a, b in zip(vector, v)), i, other) for i, other, v in kept)
        same = [(i, -s) for s, i, other in order if other == label and i != anchor][:5]
        for positive, p in same:
            found = [(i, -s) for s, i, other in order if other != label and 30 * p <= -100 * s <= 90 * p][:10]
            out |= {(anchor, positive, rank + 1, i, p, s) for rank, (i, s) in enumerate(found)}
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_all_pairs(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pydict()
    expected = brute(list(zip(table["vec_id"], table["embedding"], table["label"])))
    assert expected and rows_of(queries()["op13_hard_negatives"](spark, f"/root/testdata/{sf}")) == expected


@pytest.fixture
def small(monkeypatch):
    """A deep tree and blocks of a few rows."""
    for name, value in {"SAMPLE_ROWS": 200, "WAYS": 4, "LEAF_SAMPLE": 6, "BLOCK_ROWS": 32, "BLOCK_QUERIES": 8}.items():
        monkeypatch.setattr(negatives, name, value)


def clustered(n, width=6, seed=2):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    return [(i, [c + rnd.gauss(0, 0.15) for c in rnd.choice(centres)], rnd.randint(0, 9)) for i in range(n)]


def test_odd_rows(spark, small):
    """NULLs, NaN and infinite components, other widths, no components, negative scores, repeated rows and ids, ties."""
    rows = clustered(600)
    rows += [(700, None, 1), (701, [1.0, None], 1), (702, [math.nan, 1.0], 1), (703, [math.inf], 1), (None, [1.0], 1),
             (800, [1.0] * 6, None), (900, [], 3), (901, [0.5], 3), (1000, [0.25] * 9, 4), (1001, [0.25] * 9, 4),
             (1100, [-1.0] * 6, 5), (1101, [1.0] * 6, 5), (1102, [0.9] * 6, 6)]
    rows += rows[:40] + [(100, [2.0] * 6, 2), (100, [2.0] * 6, 2), (200, [2.0] * 6, 3)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", score int, query string").repartition(4)
    expected = brute(rows)
    assert expected and rows_of(negatives.mine(df)) == expected
    assert negatives.mine(df.limit(0)).count() == 0


def test_one_vector_of_a_third_of_the_rows(spark, small):
    rows = [(i, [0.5, 0.5, 0.1] if i % 3 == 0 else v[:3], label) for i, v, label in clustered(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    expected = brute(rows)
    assert expected and rows_of(negatives.mine(df)) == expected


def test_the_tree_eliminates_leaves(spark, small):
    idx = negatives.index(negatives.prepared(spark.createDataFrame(clustered(800), SCHEMA)))
    leaves = idx.rows.select("leaf").distinct().count()
    assert leaves > 12
    vectors = negatives._matrix([r[0] for r in idx.rows.select("vector").limit(50).collect()], idx.fit.width)
    own = (vectors * vectors).sum(axis=1)
    near, far = negatives._annuli(idx.fit, vectors, 0.9 * own, 2 * own)
    queries_, _ = negatives.reachable(idx.fit.tree, np.hstack([vectors, np.zeros((len(vectors), 1))]), near, far)
    assert 50 <= len(queries_) < 0.5 * 50 * leaves


def test_scores_are_exact_beyond_float64():
    a = np.array([[2.0 ** 30 + 1, 3.0]])
    assert negatives.scores(a, a)[0, 0] == (2 ** 30 + 1) ** 2 + 9
