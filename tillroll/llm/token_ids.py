"""Token ids as files: ids ranked by frequency, in whole bytes, with the byte counts in a stream of their own.

File format, a folder of two Parquet data sets:

* ``ranks``: ``rank``, ``token_id``, ``n``; rank 0 is the most frequent id of the corpus.
* ``docs``: one row a document in ascending id order, over files and inside them: ``part`` and ``first`` (its
  part and the ids before it there), ``doc_id``, ``n_tokens``, ``control`` and ``data``. ``control`` has two bits
  an id, four ids a byte, low bits first: the bytes of the id's rank less one. ``data`` has those bytes,
  little-endian, without gaps.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm.common import binary_array, keep, new_path, ragged, slices, starts, with_columns, words

END_ID = 1
#: Distinct words that a Python worker remembers with their ids, in each of two generations (and a slice's more).
CACHE_WORDS = 300_000
#: Text of one slice: a distinct word of a slice is looked up once.
SLICE_BYTES = 16 << 20
#: Of every control byte, the lengths of its four ids.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


class WordEncoder:
    """Ids of single words, as the tokenizers library gives them; remembers the last ``CACHE_WORDS`` words or more.

    The memory has two generations. A full one becomes the older one, whose words come back when they are met again,
    so that frequent words are never forgotten and rare ones are dropped.

    Words of Latin letters, digits and signs alone (code points below U+0250, where normal forms and classes are
    settled) are lower-cased and split here, and only their distinct pieces go to the library's model, which is
    several times faster than a call for each word. Any other word takes the library's whole way. So do words that
    hold an added token, unless ``added_as_text``: the library then reads such a token as plain characters.
    """

    PLAIN = regex.compile("[^\x85\xa0\u0250-\U0010ffff]*")
    #: Fixed value: the split of the tokenizer file.
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    #: Byte-level models name a byte that does not print by the code points from 256 on.
    NAMES = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(SHOWN)))}

    def __init__(self, tokenizer_json: str, width: str, added_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores already
        self.tokenizer, self.width = Tokenizer.from_str(tokenizer_json), width
        self.tokenizer.encode_special_tokens = added_as_text
        self.model = self.tokenizer.model
        whole = json.loads(tokenizer_json)
        added = [] if added_as_text else [t["content"] for t in whole.get("added_tokens", [])]
        if any(regex.search(r"\s", t) for t in added):
            raise ValueError("an added token with white space is not part of a word")
        self.added = regex.compile("|".join(map(regex.escape, added)) or "(?!)", regex.IGNORECASE).search
        own = whole.get("pre_tokenizer") or {}
        patterns = [x.get("pattern", {}).get("Regex") for x in own.get("pretokenizers", [])]
        self.fast = self.PIECES.pattern in patterns
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}

    def encode(self, distinct: list[str]) -> list[bytes]:
        known, older, fresh = self.known, self.older, []
        for word in distinct:
            if word not in known:
                ids = older.get(word)
                if ids is None:
                    fresh.append(word)
                else:
                    known[word] = ids
        plain, find, piece, held = self.PLAIN.fullmatch, self.PIECES.findall, self._piece, self.added
        some_held = held(" ".join(fresh)) is not None
        other = []
        for word in fresh:
            if self.fast and (word.isascii() or plain(word)) and not (some_held and held(word)):
                low = word.lower()
                if low.isalpha():
                    known[word] = piece(low)
                elif low[:-1].isalpha() and not low[-1].isalnum():
                    known[word] = piece(low[:-1]) + piece(low[-1])
                else:
                    known[word] = b"".join([piece(p) for p in find(low)])
            else:
                other.append(word)
        for at in range(0, len(other), 10_000):
            chunk = other[at: at + 10_000]
            for word, e in zip(chunk, self.tokenizer.encode_batch_fast(chunk, add_special_tokens=False)):
                known[word] = np.array(e.ids, self.width).tobytes()
        found = [known[w] for w in distinct]
        if len(known) > CACHE_WORDS:
            self.known, self.older = {}, known
        if len(self.pieces) > CACHE_WORDS:
            self.pieces, self.older_pieces = {}, self.pieces
        return found

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.older_pieces.get(piece)
            if ids is None:
                name = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.NAMES)
                ids = np.fromiter((t.id for t in self.model.tokenize(name)), self.width).tobytes()
            self.pieces[piece] = ids
        return ids


@lru_cache(maxsize=2)
def worker_encoder(tokenizer_json: str, width: str) -> WordEncoder:
    """The encoder of a Python worker, which the tasks that it runs one after the other share."""
    return WordEncoder(tokenizer_json, width, added_as_text=False)


def tokenize(docs: DataFrame, tokenizer_json: str, text_col: str, keep_columns: list[str]) -> tuple[DataFrame, str]:
    """Adds ``ids``: the ids of each whole text as little-endian integers of 2 bytes (4 for large vocabularies).

    White space never is part of a token of this tokenizer, so a text's ids are those of its words in turn; each
    distinct word of a slice is encoded once. ``END_ID`` closes every document; a NULL or empty text has only that.
    """
    width = "<u2" if Tokenizer.from_str(tokenizer_json).get_vocab_size() <= 1 << 16 else "<u4"
    item = np.dtype(width).itemsize

    def encode(texts: pa.Array) -> list:
        codes, counts, distinct = words(texts)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), " ")[0].as_py()
        table = worker_encoder(tokenizer_json, width).encode(joined.split(" ") if joined else [])
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // item
        flat = np.frombuffer(b"".join(table), width)
        per_word = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        ids = flat[ragged(starts(sizes)[:-1][codes], per_word)] if len(codes) else np.zeros(0, width)
        ends = starts(per_word)[starts(counts)[1:]]
        with_end = np.insert(ids, ends, END_ID).astype(width)
        sizes = np.diff(np.concatenate([[0], ends])) + 1
        return [binary_array(with_end, sizes * item)]

    return with_columns(docs, text_col, "ids binary", encode, keep_columns, SLICE_BYTES), width


def _joined(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All items of a binary array as one array, and the length of each."""
    data = b"".join(column.to_pylist())
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(data, dtype), sizes // np.dtype(dtype).itemsize


def rank_ids(tokens: DataFrame, width: str) -> DataFrame:
    """``rank``, ``token_id`` and ``n`` of every id in ``tokens.ids``, as many rows as the vocabulary uses."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "ids"):
                found = np.bincount(_joined(part.column("ids"), width)[0], minlength=len(total))
                found[: len(total)] += total
                total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token_id", "n"])

    counts = tokens.select("ids").mapInArrow(count, "token_id long, n long").groupBy("token_id").agg(
        F.sum("n").alias("n"))
    rank = F.row_number().over(W.orderBy(F.col("n").desc(), "token_id")) - 1
    return counts.select(rank.cast("long").alias("rank"), "token_id", "n")


def code_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Control and data bytes of each document; ``counts`` are the ids of each."""
    lengths = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    groups = -(-counts // 4)
    padded = np.zeros(4 * int(groups.sum()), np.uint8)
    padded[ragged(4 * starts(groups)[:-1], counts)] = lengths - 1
    control = padded[0::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    return binary_array(control, groups), binary_array(data, np.diff(starts(lengths)[starts(counts)]))


def decode_ranks(control: pa.Array, stream: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The ranks of all documents in turn, by lookup of each control byte's four lengths; bytes read of ``stream``."""
    bits, groups = _joined(control, "u1")
    lengths = LENGTHS[bits].reshape(-1)[ragged(4 * starts(groups)[:-1], counts)]
    at = starts(lengths)
    used, at = int(at[-1]), at[:-1]
    stream = np.concatenate([stream[:used], np.zeros(3, np.uint8)]).astype(np.uint32)
    ranks = stream[at]
    for k in range(1, int(lengths.max(initial=1))):
        ranks |= stream[at + k] << np.uint32(8 * k)
    return ranks & MASKS[lengths], used


def write_ids(docs: DataFrame, path: str, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text and writes the files. Rows without an id come first; rows that repeat an id stay apart.

    Ids are kept once in the shared folder: they are counted, then sorted by document, then coded where they lie.
    The ranks are one row for each id of the vocabulary, which bounds what the driver and each task hold.
    """
    spark = docs.sparkSession
    tokens, width = tokenize(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col), tokenizer_json,
                             text_col, ["doc_id"])
    tokens = keep(tokens, "token-ids")
    rank_ids(tokens, width).coalesce(1).write.parquet(f"{path}/ranks")
    ranked = spark.read.parquet(f"{path}/ranks").select("rank", "token_id").toPandas()
    rank_of = np.zeros(int(ranked["token_id"].max() if len(ranked) else 0) + 1, np.uint32)
    rank_of[ranked["token_id"].to_numpy()] = ranked["rank"].to_numpy()
    names = ["part", "first", "doc_id", "n_tokens", "control", "data"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "ids"):
                ids, counts = _joined(rows.column("ids"), width)
                first = before + starts(counts)
                before = int(first[-1])
                control, data = code_ranks(rank_of[ids], counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), part)), pa.array(first[:-1]), rows.column("doc_id"),
                     pa.array(counts), control, data], names=names)

    ordered = tokens.repartitionByRange("doc_id", F.crc32("ids")).sortWithinPartitions("doc_id", F.crc32("ids"))
    coded = ordered.mapInArrow(code, "part long, first long, doc_id long, n_tokens long, control binary, data binary")
    coded.write.option("compression", "zstd").parquet(f"{path}/docs")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Reads the files back: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` (4 bytes each).

    What lies before each part is summed over parts, one row for each file; that small table is broadcast.
    """
    ranked = spark.read.parquet(f"{path}/ranks").select("rank", "token_id").toPandas()
    token_of = np.zeros(len(ranked), np.uint32)
    token_of[ranked["rank"].to_numpy()] = ranked["token_id"].to_numpy()
    docs = spark.read.parquet(f"{path}/docs")
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    bases = docs.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("base"))
    names = ["doc_id", "start", "n_tokens", "ids"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "data", 2 << 20):
                counts = rows.column("n_tokens").to_numpy()
                ids = token_of[decode_ranks(rows.column("control"), _joined(rows.column("data"), "u1")[0], counts)[0]]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("start"), pa.array(counts),
                     binary_array(ids.astype("<u4"), 4 * counts)], names=names)

    placed = docs.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "control", "data")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def op4_token_ids(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    path = new_path(spark, "token-files")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_json)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
