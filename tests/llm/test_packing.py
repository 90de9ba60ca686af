"""Best-fit packing against brute force and the tokenizers library."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tillroll.llm import packing
from tillroll.llm.registry import queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


def fewest(items, capacity):
    """The least number of bins, by trying everything."""
    least, items = len(items), sorted(items, reverse=True)

    def go(at, rooms):
        nonlocal least
        if len(rooms) >= least:
            return
        if at == len(items):
            least = len(rooms)
            return
        for room in {r for r in rooms if r >= items[at]}:
            rest = list(rooms)
            rest[rest.index(room)] -= items[at]
            go(at + 1, rest)
        go(at + 1, [*rooms, capacity - items[at]])

    go(0, [])
    return least


@pytest.mark.parametrize("seed", range(60))
def test_small_packings_are_optimal(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([20, 50, 100])
    items = [rnd.randint(1 if seed % 2 else capacity // 5, capacity - 1) for _ in range(rnd.randint(0, 10))]
    counts = np.bincount(items, minlength=capacity + 1) if items else np.zeros(capacity + 1, np.int64)
    found = packing.complete(counts)
    packed = np.zeros(capacity + 1, np.int64)
    for lengths, times, bins in found:
        assert np.dot(lengths, times) <= capacity
        packed[list(lengths)] += np.array(times) * bins
    assert (packed == counts).all()
    assert packing.lower_bound(counts) <= fewest(items, capacity) == packing.bins(found) <= packing.bins(packing.best_fit(counts))


def test_completion_beats_best_fit():
    """Best fit puts 6 + 4 into a bin of 10 only by luck; here it takes one bin more than needed."""
    counts = np.bincount([5, 4, 4, 3, 3, 3, 2, 2, 2, 2], minlength=11)
    assert packing.bins(packing.complete(counts)) == 3
    rnd, better = random.Random(5), 0
    for _ in range(300):
        counts = np.bincount([rnd.randint(20, 60) for _ in range(12)], minlength=101)
        better += packing.bins(packing.complete(counts)) < packing.bins(packing.best_fit(counts))
    assert better > 0


def test_dominated_completions_are_left_out():
    counts = np.bincount([6, 5, 3, 2, 2, 1], minlength=11)
    assert packing.completions(counts, 6, 6) == [(6,)]  # all others fit into the 6
    assert packing.completions(np.bincount([4, 3, 2], minlength=11), 6, 0) == [(4, 2)]
    assert packing.completions(counts, 0, 0) == [()]


def test_a_million_lengths_pack_at_once():
    rng = np.random.default_rng(1)
    counts = np.append(np.bincount(rng.integers(1, 2048, 1_000_000), minlength=2048), 0)
    found = packing.complete(counts, nodes=5)
    assert packing.bins(found) <= packing.lower_bound(counts) * 1.001 and len(found) < 20_000


def test_every_entry_is_rebuilt_by_its_merges():
    """Then merging by rank gives what merging by pairs gives."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    vocabulary = json.load(open(VOCABULARY, encoding="utf-8"))["model"]["vocab"]
    assert all([t.id for t in tokenizer.model.tokenize(word)] == [n] for word, n in vocabulary.items())


def test_ids_are_those_of_the_library():
    encode, tokenizer = packing.encoder(VOCABULARY, public_tokenizers.PATTERN), Tokenizer.from_file(VOCABULARY)
    rnd = random.Random(3)
    texts = ["".join(chr(rnd.choice([rnd.randint(9, 0x2FFF), rnd.randint(0xE000, 0x10FFFF), rnd.randint(9, 127)]))
                     for _ in range(40)) for _ in range(500)]
    texts += ["", "a <|endoftext|> b<|endoftext|>", " " * 3000 + "x", "\u0085 　 ᠎", "ab" * 5000, "don't 12,5"]
    for text in texts:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, documents, capacity):
    """All pieces are there once, in their documents' order, and sequences are gapless."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = []
    for doc_id, text in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at, piece, size = 0, 0, len(ids) % capacity or capacity
        while at < len(ids):
            expected.append((doc_id, piece, at, size, zlib.crc32(np.array(ids[at: at + size], "<u4").tobytes())))
            at, piece, size = at + size, piece + 1, capacity
    assert sorted(map(repr, (r[:5] for r in rows))) == sorted(map(repr, expected))
    sequences = defaultdict(list)
    for *_, length, _, sequence, offset in rows:
        sequences[sequence].append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r[3] for r in rows) // capacity)


def test_query_packs_the_whole_table(spark):
    rows = [tuple(r) for r in queries()["op11_best_fit_packing"](spark, SF_DIR).collect()]
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    used, least = check(rows, list(zip(table["doc_id"], table["text"])), packing.CAPACITY)
    assert used <= least + 1


def test_odd_rows(spark):
    """NULL and empty texts, repeated rows and ids, rows without an id, a text of many pieces, clashing columns."""
    documents = [(1, None), (1, None), (2, ""), (None, "a b c"), (None, "a b c"), (3, "word " * 300), (4, "x y z w v u t"),
                 (5, "one two three four five six seven")]
    df = spark.createDataFrame([(i, t, 7, "s") for i, t in documents], "doc_id long, text string, piece int, sequence_id string")
    pieces = packing.pack(df.repartition(3), VOCABULARY, public_tokenizers.PATTERN, capacity=8)
    rows = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids), r.sequence_id, r.offset) for r in pieces.collect()]
    used, least = check(rows, documents, 8)
    assert used == least
    sequences = packing.sequences(pieces).collect()
    assert len(sequences) == used and all(len(s.ids) == 4 * s.length <= 32 for s in sequences)
    assert sum(s.length for s in sequences) == sum(r[3] for r in rows)
    empty = packing.pack(df.limit(0), VOCABULARY, public_tokenizers.PATTERN)
    assert empty.count() == 0 and empty.columns == pieces.columns


def test_parts_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTS", 2)
    documents = [(i, "word " * (i % 13)) for i in range(200)]
    pieces = packing.pack(spark.createDataFrame(documents, "doc_id long, text string").repartition(7), VOCABULARY,
                          public_tokenizers.PATTERN, capacity=16)
    rows = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids), r.sequence_id, r.offset) for r in pieces.collect()]
    check(rows, documents, 16)
