"""Phrase collocations against counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tillroll.llm import collocations
from tillroll.llm.registry import queries

SF_DIR = "/root/testdata/sf0.01"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, most=2000):
    counts = defaultdict(lambda: {k: Counter() for k in range(1, 6)})
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                counts["und" if lang is None else lang][k].update(zip(*[words[i:] for i in range(k)]))
    out = []
    for lang, c in counts.items():
        n = sum(c[1].values())
        candidates = {p: a for k in range(2, 6) for p, a in c[k].items() if a >= least}
        inside = {p[i: i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                  if 100 * a >= 100 * candidates.get(p[i: i + k], a + 1)}
        found = []
        for p, a in candidates.items():
            if p not in inside:
                s, _, left, right = min((1000 * a * n // (c[k][p[:k]] * c[len(p) - k][p[k:]]), k, c[k][p[:k]],
                                         c[len(p) - k][p[k:]]) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s)
                for i, (s, a, p, left, right) in enumerate(sorted(found)[:most])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_WORDS", 3000)


def test_query_equals_counting(spark):
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["lang", "text"]).to_pydict()
    found = rows_of(queries()["op12_phrase_collocations"](spark, SF_DIR))
    assert found and found == brute(list(zip(table["lang"], table["text"])), 100)


def test_many_shards_and_short_phrases(spark, small_shards):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["lang", "text"]).to_pydict()
    rows = list(zip(table["lang"], table["text"]))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert collocations.shards(df).count() >= 16
    assert rows_of(collocations.collocations(df, least=5)) == brute(rows, 5)
    assert rows_of(collocations.collocations(df, least=5, most=3)) == brute(rows, 5, 3)


def test_odd_texts(spark, monkeypatch):
    """Shards so small that some have words but no phrase; overlaps, repeats, separators, odd spaces, NULLs and ties."""
    monkeypatch.setattr(collocations, "SHARD_WORDS", 6)
    rows = [(None, "a a a a a a"), ("und", "A a\ta"), ("en", None), ("en", ""), ("en", " \t .,;:!? \n\r\x0b\x0c"),
            ("en", "x y. x y, x y; x\ny"), ("en", "x y x y \u0085 \u0085 É é"), ("en", "x y x y x y"),
            ("en", "one two three four five six seven"), ("en", "one two three four five six seven"), ("de", "allein"),
            ("en", "x y x y x y"), ("en", "." * 50 + "q w" * 3), ("fr", "le la " * 40), (None, "a a a a a a")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, n int, phrase string").repartition(3)
    for least in (1, 2, 3):
        assert rows_of(collocations.collocations(df, least=least)) == brute(rows, least)
    assert collocations.collocations(df.limit(0), least=1).count() == 0


def test_transform_steps_count_phrases():
    rnd = random.Random(4)
    text = np.array([0, *(rnd.choice([0, 1, 1, 2, 3]) for _ in range(300)), 0], np.int64)
    forward, backward = collocations.transform(text), collocations.transform(text[::-1])
    size = np.bincount(text, minlength=4)
    first = np.cumsum(size)[:-1]
    level = [((i + 1,), f, f, s) for i, (f, s) in enumerate(zip(first, size[1:]))]
    for length in range(2, 6):
        prefix, suffix, starts, backs, sizes = collocations.both_ways(
            forward, backward, *(np.array([x[i] for x in level]) for i in (1, 2, 3)))
        new = []
        for p, s, f, b, n in zip(prefix, suffix, starts, backs, sizes):
            assert level[p][0][1:] == level[s][0][:-1]
            new.append(((*level[p][0], level[s][0][-1]), f, b, n))
        level = new
        found = Counter(w for w in zip(*[text[i:].tolist() for i in range(length)]) if 0 not in w)
        assert {w: n for w, _, _, n in level} == found


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000_007
    df = spark.createDataFrame([(big, 3 * big, big - 1, 2 * big + 5)], "a long, n long, l long, r long")
    found = df.select(collocations.score("a", "n", df["l"], df["r"])).first()[0]
    assert found == 1000 * big * 3 * big // ((big - 1) * (2 * big + 5))


def test_blocks_keep_their_numbers():
    columns = [np.array([0, 1, -1, 2 ** 62]), np.arange(4)]
    assert (collocations._unpack(collocations._pack(columns), 2) == np.stack(columns)).all()
    assert collocations._unpack(collocations._pack([np.zeros(0, np.int64)] * 3), 3).shape == (3, 0)
