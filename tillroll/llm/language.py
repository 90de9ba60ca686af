"""Language ID: a byte convolutional network, trained here in numpy on labelled text.

Bytes of a fixed-length window are embedded, convolved with filters of several widths, max-pooled over the window
and passed to a softmax. A text is cut into windows that overlap by one byte less than the widest filter, so that
every place of the whole text is seen; its probabilities are the windows' means, weighted by their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import ragged, starts, with_columns

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4), 16, 8
WIDEST = max(WIDTHS)
STRIDE = WINDOW - WIDEST + 1
PAD = 256
#: Bounds of the training sample: documents of a language, windows of a document, characters of a window.
SAMPLE_DOCS, SAMPLE_WINDOWS, SALTS = 400, 4, 64
EPOCHS, BATCH, RATE = 4, 64, 0.01
UNKNOWN = "und"
#: The pipeline keeps a document whose language is known with at least this score.
MIN_SCORE = 0.35


def training_windows(docs: DataFrame, text_col: str, label_col: str, key_col: str) -> list[tuple[str, str]]:
    """At most ``SAMPLE_DOCS`` documents of each language, ``SAMPLE_WINDOWS`` windows of each, spread over the text.

    The sample is the smallest hashes of ``key_col``, cut inside each task before the shuffle; the number of
    languages times a constant bounds what the driver gets. Rows without text or label are not used.
    """
    text = F.col(text_col)
    room = F.greatest(F.char_length(text) - WINDOW, F.lit(0))
    cuts = [F.substring(text, (room * k / (SAMPLE_WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW))
            for k in range(SAMPLE_WINDOWS)]
    rows = docs.where(text.isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"), F.array_distinct(F.array(*cuts)).alias("cuts"),
        F.xxhash64(key_col, text_col).alias("h"))
    for key in (["label", F.pmod("h", F.lit(SALTS))], ["label"]):  # first in parts, so that no label is one task's
        first = F.row_number().over(W.partitionBy(*key).orderBy("h"))
        rows = rows.withColumn("n", first).where(F.col("n") <= SAMPLE_DOCS)
    found = rows.select("label", F.explode("cuts").alias("cut")).collect()
    return sorted((r["label"], r["cut"]) for r in found)


def _conv_input(windows: np.ndarray, embedding: np.ndarray) -> np.ndarray:
    """(windows, places, bytes of the widest filter x DIM): what each place's filters see."""
    x = embedding[np.pad(windows, ((0, 0), (0, WIDEST - 1)), constant_values=PAD)]
    shape = (x.shape[0], windows.shape[1], WIDEST * DIM)
    return np.lib.stride_tricks.as_strided(x, shape, (x.strides[0], x.strides[1], x.strides[2]))


def _kernel_mask() -> np.ndarray:
    """Which weights of the joint kernel (bytes x DIM, filters) a filter of its width has."""
    mask = np.zeros((WIDEST, DIM, len(WIDTHS) * FILTERS), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width, :, k * FILTERS: (k + 1) * FILTERS] = 1
    return mask.reshape(WIDEST * DIM, -1)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(sample: list[tuple[str, str]], seed: int = 7) -> dict | None:
    """Fits the network by Adam; None without any example. The same sample gives the same weights."""
    if not sample:
        return None
    rng = np.random.default_rng(seed)
    names = sorted({label for label, _ in sample})
    index = {name: k for k, name in enumerate(names)}
    data = [text.encode()[:WINDOW] for _, text in sample]
    labels = np.array([index[label] for label, _ in sample])
    x = np.full((len(data), WINDOW), PAD, np.int16)
    for row, value in zip(x, data):
        row[: len(value)] = np.frombuffer(value, np.uint8)
    p = {"E": rng.normal(0, 0.5, (PAD + 1, DIM)), "K": rng.normal(0, 0.2, (WIDEST * DIM, len(WIDTHS) * FILTERS)),
         "c": np.zeros(len(WIDTHS) * FILTERS), "V": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))),
         "b": np.zeros(len(names))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    mask, p["E"][PAD] = _kernel_mask(), 0
    p["K"] *= mask
    first, second, step = {k: 0 * v for k, v in p.items()}, {k: 0 * v for k, v in p.items()}, 0
    weight = (len(labels) / np.maximum(np.bincount(labels), 1) / len(names)).astype(np.float32)
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            windows, y = x[rows].copy(), labels[rows]
            short = rng.random(len(rows)) < 0.3  # short texts are seen in training too
            for r in np.flatnonzero(short):
                windows[r, rng.integers(8, WINDOW):] = PAD
            seen = _conv_input(windows, p["E"])
            z = np.maximum(seen.reshape(-1, WIDEST * DIM) @ p["K"] + p["c"], 0).reshape(len(rows), WINDOW, -1)
            best = z.argmax(axis=1)
            pooled = np.take_along_axis(z, best[:, None, :], 1)[:, 0]
            d = _softmax(pooled @ p["V"] + p["b"])
            d[np.arange(len(rows)), y] -= 1
            d *= (weight[y] / len(rows))[:, None]
            g = {"V": pooled.T @ d, "b": d.sum(axis=0)}
            dz = (d @ p["V"].T) * (pooled > 0)
            patch = seen[np.arange(len(rows))[:, None], best]
            g["K"] = np.einsum("nf,nfk->kf", dz, patch) * mask
            g["c"] = dz.sum(axis=0)
            places = np.pad(windows, ((0, 0), (0, WIDEST - 1)), constant_values=PAD)
            byte = places[np.arange(len(rows))[:, None, None], best[:, :, None] + np.arange(WIDEST)].reshape(-1)
            de = np.einsum("nf,kf->nfk", dz, p["K"]).reshape(-1, DIM)
            g["E"] = np.stack([np.bincount(byte, de[:, k], PAD + 1) for k in range(DIM)], axis=1)
            g["E"][PAD] = 0
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                p[k] = (p[k] - RATE * (first[k] / (1 - 0.9 ** step))
                        / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
    return {"names": names, **p}


def window_probabilities(model: dict, windows: np.ndarray, step: int = 128) -> np.ndarray:
    """Softmax of each window; ``step`` windows at a time, so that the places stay in cache."""
    out = [np.zeros((0, len(model["names"])), np.float32)]
    for at in range(0, len(windows), step):
        part = windows[at: at + step]
        seen = _conv_input(part, model["E"]).reshape(-1, WIDEST * DIM)
        pooled = (seen @ model["K"]).reshape(len(part), WINDOW, -1).max(axis=1)
        out.append(_softmax(np.maximum(pooled + model["c"], 0) @ model["V"] + model["b"]))
    return np.concatenate(out)


def predict(model: dict | None, texts: pa.Array) -> list:
    """Language and score of each text."""
    values = texts.to_pylist()
    spoken = np.array([v is not None and regex.search(r"\p{L}", v) is not None for v in values], bool)
    if model is None or not spoken.any():
        return [[UNKNOWN] * len(values), np.zeros(len(values))]
    data = np.frombuffer("".join(v for v, s in zip(values, spoken) if s).encode(), np.uint8).astype(np.int16)
    sizes = pc.binary_length(texts.filter(pa.array(spoken))).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.maximum(1, -(-(sizes - WIDEST + 1) // STRIDE))
    doc = np.repeat(np.arange(len(sizes)), counts)
    begin = starts(sizes)[:-1]
    first = begin[doc] + ragged(np.zeros(len(sizes), np.int64), counts) * STRIDE
    ends = (begin + sizes)[doc]
    means = np.zeros((len(sizes), len(model["names"])))
    for at in range(0, len(first), 4096):
        place = first[at: at + 4096, None] + np.arange(WINDOW)
        inside = place < ends[at: at + 4096, None]
        windows = np.where(inside, data[np.where(inside, place, 0)], PAD)
        weighted = window_probabilities(model, windows) * inside.sum(axis=1)[:, None]
        np.add.at(means, doc[at: at + 4096], weighted)
    means /= means.sum(axis=1, keepdims=True)
    best = means.argmax(axis=1)
    names, scores = np.full(len(values), UNKNOWN, object), np.zeros(len(values))
    names[spoken] = np.array(model["names"], object)[best]
    scores[spoken] = means[np.arange(len(best)), best]
    return [names.tolist(), scores]


def identify(docs: DataFrame, model: dict | None, text_col: str = "text",
             keep_columns: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to each row, from the whole text alone.

    A text that is NULL, empty or without a letter is ``und`` with score 0; so is every text if ``model`` is None
    (no labelled rows). Ties go to the language that sorts first.
    """
    return with_columns(docs, text_col, "lang_pred string, score double", lambda t: predict(model, t), keep_columns)


def _held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame) -> dict | None:
    return train(training_windows(docs.where(~_held_out()), "text", "lang", "doc_id"))


def op5_language_cnn(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = docs.select("doc_id", "text", _held_out().alias("held_out"))
    return identify(held, fit(docs), keep_columns=["doc_id", "held_out"])
