"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, hashed into buckets, so an unseen misspelling shares
most vectors with the word it stands for. A window of words is the mean of its words, and a softmax over it gives
the probability of the label. A text's score is that of its most toxic stretch of at most a window, padded, among all
stretches of the whole text: a phrase counts alike wherever it stands, and no words around it lower the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ragged, starts, with_columns, words

GRAMS, BUCKETS, DIM, WINDOW = (3, 4, 5), 1 << 16, 8, 8
#: Bounds of the training sample: labelled documents of each class, and the longest text that trains (texts are
#: never cut, since a label need not hold for a part).
SAMPLE_DOCS, SAMPLE_CHARS = 2500, 6000
WARM, ROUNDS, BATCH, RATE, SCALE, EPSILON = 2, 25, 256, 0.02, 8.0, 1e-4
THRESHOLD = 0.7


def grams(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, and how many each has. Words are lower-cased and marked at both ends."""
    marked = [f"<{w}>" for w in pc.utf8_lower(pa.array(distinct, pa.string())).to_pylist()]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    begin = starts(sizes)[:-1]
    counts = [np.maximum(sizes - n + 1, 1 if n == GRAMS[0] else 0) for n in GRAMS]
    total = sum(counts)
    out = np.zeros(int(total.sum()), np.int64)
    used = np.zeros(len(marked), np.int64)
    codes = np.concatenate([codes, np.zeros(max(GRAMS), np.uint64)])
    for n, count in zip(GRAMS, counts):
        at = ragged(begin, count)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h ^ codes[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out[ragged(starts(total)[:-1] + used, count)] = (h >> np.uint64(20)) % np.uint64(BUCKETS)
        used = used + count
    return out, total


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _worst(weights: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and summed weight of each text's heaviest stretch of 1 to ``WINDOW`` words, first of equals.

    ``weights`` has a number for each word of all texts in turn. A text without words has an empty stretch of weight 0.
    """
    sums = np.concatenate([[0], np.cumsum(weights)])
    end = np.repeat(starts(counts)[1:], counts)
    start = np.arange(len(end))
    best, length = np.full(len(end), -np.inf), np.ones(len(end), np.int64)
    for k in range(1, WINDOW + 1):
        last = np.minimum(start + k, end)
        here = sums[last] - sums[start]
        better = here > best
        best[better], length[better] = here[better], (last - start)[better]
    first, size, top = starts(counts)[:-1], np.zeros(len(counts), np.int64), np.zeros(len(counts))
    some = counts > 0
    if some.any():
        top[some] = np.maximum.reduceat(best, first[some])
        equal = np.flatnonzero(best == np.repeat(top, counts))
        first[some] = equal[np.searchsorted(equal, first[some])]
        size[some] = length[first[some]]
    return first, size, top


def train(texts: list[str], labels: list[int], seed: int = 11) -> dict | None:
    """Fits bucket vectors and softmax together by Adam; None unless both classes are there.

    The first ``WARM`` passes take windows side by side, from a random start on, with their document's label. The
    ``ROUNDS`` after them take each document's most toxic stretch at that time, as ``score`` does, since most windows
    of a toxic text are clean.
    """
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    codes, counts, distinct = words(pa.array(texts, pa.string()))
    bucket, sizes = grams(distinct.to_pylist())
    begin = starts(sizes)[:-1]
    labels = np.array(labels)
    p = {"E": rng.normal(0, 0.3, (BUCKETS, DIM)), "V": rng.normal(0, 0.3, (DIM, 2)), "b": np.zeros(2)}
    m, v, step = {k: 0 * x for k, x in p.items()}, {k: 0 * x for k, x in p.items()}, 0
    for turn in range(WARM + ROUNDS):
        if turn < WARM:
            shift = rng.integers(1, WINDOW + 1, size=len(counts))  # words of the first window
            per_doc = np.where(counts > shift, 1 - (-(counts - shift) // WINDOW), 1)
            doc = np.repeat(np.arange(len(counts)), per_doc)
            first = ragged(np.zeros(len(counts), np.int64), per_doc) * WINDOW + (shift - WINDOW)[doc]
            last = np.minimum(first + WINDOW, counts[doc])
            first = np.maximum(first, 0)
            first, length, y = starts(counts)[doc] + first, last - first, labels[doc]
        else:
            each = np.add.reduceat((p["E"] @ (p["V"][:, 1] - p["V"][:, 0]))[bucket], begin) / sizes
            first, length, _ = _worst(each[codes], counts)
            y = labels
        for rows in np.array_split(rng.permutation(len(first)), max(1, len(first) // BATCH)):
            owner = np.repeat(np.arange(len(rows)), length[rows])
            word, at = np.unique(codes[ragged(first[rows], length[rows])], return_inverse=True)
            gram = bucket[ragged(begin[word], sizes[word])]
            of_word = np.repeat(np.arange(len(word)), sizes[word])
            share = (1 / sizes[word])[of_word]
            vectors = _sums(of_word, p["E"][gram] * share[:, None], len(word))
            bag = _sums(owner, vectors[at], len(rows)) * (SCALE / WINDOW)
            d = _softmax(bag @ p["V"] + p["b"])
            d[np.arange(len(rows)), y[rows]] -= 1
            d /= len(rows)
            back = (d @ p["V"].T) * (SCALE / WINDOW)
            to_word = _sums(at, back[owner], len(word))
            g = {"V": bag.T @ d, "b": d.sum(axis=0), "E": _sums(gram, to_word[of_word] * share[:, None], BUCKETS)}
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + EPSILON)
    side = p["V"][:, 1] - p["V"][:, 0]
    return {"gram": p["E"] @ side * SCALE, "bias": float(p["b"][1] - p["b"][0])}


def _sums(owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, rows[:, k], n) for k in range(rows.shape[1])], axis=1)


def score(model: dict | None, texts: pa.Array) -> list:
    """The probability of the label in each text's most toxic stretch, padded to a window's length."""
    if model is None:
        return [np.zeros(len(texts))]
    codes, counts, distinct = words(texts)
    bucket, sizes = grams(distinct.to_pylist())
    each = np.add.reduceat(model["gram"][bucket], starts(sizes)[:-1]) / sizes if len(sizes) else np.zeros(0)
    worst = _worst(each[codes], counts)[2] / WINDOW
    return [1 / (1 + np.exp(-np.clip(worst + model["bias"], -60, 60)))]


def rate(docs: DataFrame, model: dict | None, text_col: str = "text", keep_columns: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1) to each row, from the whole text alone.

    NULL and empty texts get the score of a window without words; every score is 0 if ``model`` is None (labels of
    one class only, or none).
    """
    return with_columns(docs, text_col, "score double", lambda t: score(model, t), keep_columns)


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """At most ``SAMPLE_DOCS`` labelled documents of each class, whole texts of at most ``SAMPLE_CHARS`` characters.

    The labels with the smallest hashes are taken first; they are few, so they are sent to the documents. Those whose
    text is NULL or longer do not train.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~_held_out()).select("doc_id", "toxic")
    chosen = [usable.where(F.col("toxic") == k).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
              for k in (0, 1)]
    rows = docs.where(F.char_length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    rows = rows.select("toxic", "text", F.xxhash64("doc_id", "text").alias("h"))
    rows = rows.orderBy("h", "toxic").limit(2 * SAMPLE_DOCS).collect()
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def _held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def op6_subword_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(*training_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held = docs.select("doc_id", "text", _held_out().alias("held_out"))
    scored = rate(held, model, keep_columns=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
