"""Byte-level BPE by a global shuffle of distinct words, and decoding by the token-byte table.

Texts are cut into blocks of documents. A block's pre-tokens are exploded with their positions: the distinct ones
as rows, the positions as numbers of them, most frequent first, in the byte coding of ``token_ids``. Distinct words
of all blocks are shuffled by word and each is encoded once; their ids go back to their blocks, where documents
are put together again by position. A frequent word is one row a block, so no key is hot.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from tillroll.llm.common import binary_array, new_path, ragged, slices, starts
from tillroll.llm.token_ids import _joined, code_ranks, decode_ranks

#: Text of a block. Larger blocks repeat fewer words; a task holds one.
BLOCK_BYTES = 28 << 20
INDEX_BITS = 22
#: Bits for the blocks of one input partition; what is left numbers two million partitions. Spark takes 100,000 buckets.
BLOCK_BITS, MOST_BUCKETS = 20, 50_000
#: Pre-tokens whose ids are put together at once.
RUN_TOKENS = 1 << 20
#: White space as Unicode has it; no pre-token goes from other text into it, so texts can be cut before each run.
SPACE = "\t-\r \x85\xa0  -     　"
UNIT = regex.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _dictionary(parts: list[pa.DictionaryArray]) -> tuple[np.ndarray, pa.Array]:
    """Codes into the distinct values of all parts, and those values."""
    joined = pa.concat_arrays([p.dictionary for p in parts]).dictionary_encode()
    place = joined.indices.to_numpy(zero_copy_only=False)
    begin = starts(np.array([len(p.dictionary) for p in parts]))
    codes = [place[b + p.indices.to_numpy(zero_copy_only=False)] for b, p in zip(begin, parts)]
    return np.concatenate(codes), joined.dictionary


def pre_tokens(texts: pa.RecordBatch, pattern: regex.Pattern) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Pre-tokens of the column ``__text``: number of each, pre-tokens of each document, distinct ones by frequency.

    Texts are cut into runs of white space with what follows; only distinct runs are matched with the pattern.
    """
    parts, lengths = [], []
    for part in slices(texts, "__text"):
        units = [UNIT.findall(t) if t else [] for t in part.column("__text").to_pylist()]
        lengths += map(len, units)
        parts.append(pa.array(itertools.chain.from_iterable(units), pa.string()).dictionary_encode())
    codes, units = _dictionary(parts)
    pieces = [pattern.findall(u) for u in units.to_pylist()]
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    coded = pa.array(itertools.chain.from_iterable(pieces), pa.string()).dictionary_encode()
    del pieces
    piece_of = coded.indices.to_numpy(zero_copy_only=False)
    per_unit = sizes[codes]
    tokens = piece_of[ragged(starts(sizes)[:-1][codes], per_unit)]
    counts = np.diff(starts(per_unit)[starts(np.array(lengths, np.int64))])
    by_name = pc.sort_indices(coded.dictionary).to_numpy()  # words of one frequency in order compress better
    seen = np.bincount(tokens, minlength=len(coded.dictionary))
    order = by_name[np.argsort(-seen[by_name], kind="stable")]
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    return rank[tokens], counts, coded.dictionary.take(pa.array(order))


def _blocks(docs: DataFrame, text_col: str, kept: list[str], pattern: str) -> DataFrame:
    """One row a block, written to the shared folder in buckets of ``block``."""
    doc = StructType([docs.schema[c] for c in kept])
    schema = StructType([
        StructField("block", LongType()), StructField("docs", ArrayType(doc)), StructField("counts", ArrayType(LongType())),
        StructField("control", BinaryType()), StructField("data", BinaryType()), StructField("words", ArrayType(StringType()))])
    arrow = to_arrow_schema(schema)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, number = regex.compile(pattern), TaskContext.get().partitionId() << BLOCK_BITS
        end = number + (1 << BLOCK_BITS)
        for batch in batches:
            for rows in slices(batch, "__text", BLOCK_BYTES):
                tokens, counts, distinct = pre_tokens(rows, compiled)
                if len(distinct) >> INDEX_BITS:
                    raise ValueError(f"one text has more than {1 << INDEX_BITS} distinct words")
                control, data = code_ranks(tokens, counts)
                columns = [rows.column(c) for c in kept]
                records = pa.StructArray.from_arrays(columns, fields=list(arrow.field("docs").type.value_type))
                whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                merged = [pa.array([b"".join(x.to_pylist())], pa.binary()) for x in (control, data)]
                arrays = [pa.array([number]), whole(records), whole(pa.array(counts)), *merged, whole(distinct)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, arrow)], schema=arrow)
                number += 1
                if number == end:
                    raise ValueError(f"one partition has {1 << BLOCK_BITS} blocks: use smaller input splits")
                del tokens, control, data, merged, arrays
                pa.default_memory_pool().release_unused()  # two workers and the JVM share the executor's memory

    source = docs.select(*kept, F.col(text_col).cast("string").alias("__text"))
    spark = docs.sparkSession
    path = new_path(spark, "bpe_blocks")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = min(max(1, source.rdd.getNumPartitions()), MOST_BUCKETS)
    source.mapInArrow(split, schema).write.option("path", path).option("compression", "zstd").bucketBy(
        buckets, "block").format("parquet").saveAsTable(table)
    blocks = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay; the plan knows their buckets
    return blocks


class TokenBytes:
    """The token-byte table: a row for each id of the vocabulary, which bounds it."""

    def __init__(self, ranks: dict[bytes, int]):
        by_rank = sorted((rank, token) for token, rank in ranks.items())
        self.sizes = np.zeros(by_rank[-1][0] + 1 if by_rank else 1, np.int64)
        self.sizes[[r for r, _ in by_rank]] = [len(t) for _, t in by_rank]
        self.bytes, self.begin = np.frombuffer(b"".join(t for _, t in by_rank), np.uint8), starts(self.sizes)[:-1]

    def join(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each document; ``counts`` are its ids."""
        sizes = self.sizes[ids]
        return binary_array(self.bytes[ragged(self.begin[ids], sizes)], np.diff(starts(sizes)[starts(counts)]))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text",
           keep_columns: list[str] | None = None, with_decoded: bool = False) -> DataFrame:
    """Adds ``ids``: the ids of each whole text, 4 bytes each, little-endian; the text itself is not kept.

    ``with_decoded`` adds what ``decode`` makes of the ids, by the same join, without passing them on to it.

    Each match of ``pattern`` is encoded by itself, without special tokens. A NULL or empty text has no ids (empty
    binary). Rows are told apart by their place, so repeated ids and repeated rows come back as often as they went
    in. A column ``ids`` of ``docs`` is replaced.
    """
    kept = [c for c in (docs.columns if keep_columns is None else keep_columns) if c not in (text_col, "ids", "decoded")]
    blocks = _blocks(docs, text_col, kept, pattern)
    width = "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        last: dict[str, bytes] = {}
        for batch in batches:
            coded = batch.column("word").dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            table = [last.get(w) or np.array(encoding.encode_ordinary(w), width).tobytes() for w in distinct]
            last = {distinct[-1]: table[-1]} if distinct else last
            ids = pa.array(table, pa.binary()).take(coded.indices)
            yield pa.RecordBatch.from_arrays([batch.column("place"), ids], names=["place", "word_ids"])

    places = blocks.select("block", F.posexplode("words").alias("at", "word")).select(
        "word", (F.shiftleft("block", INDEX_BITS) + F.col("at")).alias("place"))
    coded = places.repartition("word").sortWithinPartitions("word").mapInArrow(
        encode_words, "place long, word_ids binary")
    at = F.col("place").bitwiseAND(F.lit((1 << INDEX_BITS) - 1)).cast("int")
    coded = coded.select(F.shiftright("place", INDEX_BITS).alias("block"), at.alias("at"), "word_ids")
    made_here = [StructField(c, BinaryType()) for c in ("ids", "decoded")[: 1 + with_decoded]]
    schema = StructType([*(docs.schema[c] for c in kept), *made_here])
    names = schema.names
    token_bytes = TokenBytes(ranks) if with_decoded else None

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("at").to_numpy())
        flat, sizes = _joined(right.column("word_ids").take(pa.array(order)).combine_chunks(), width)
        made, begin = [], starts(sizes)[:-1]
        for row in range(left.num_rows):
            counts = left.column("counts").combine_chunks()[row].values.to_numpy(zero_copy_only=False)
            records = left.column("docs").combine_chunks()[row].values
            bits, stream = (_joined(left.column(c).combine_chunks().slice(row, 1), "u1")[0] for c in ("control", "data"))
            groups, ends = -(-counts // 4), starts(counts)
            group_ends, at, first = starts(groups), 0, 0
            while first < len(counts):  # a run of documents at a time
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + RUN_TOKENS)) - 1)
                control = binary_array(bits[group_ends[first]: group_ends[last]], groups[first:last])
                tokens, used = decode_ranks(control, stream[at:], counts[first:last])
                at += used
                per_token = sizes[tokens]
                ids = flat[ragged(begin[tokens], per_token)].astype("<u4")
                per_doc = np.diff(starts(per_token)[ends[first: last + 1] - ends[first]])
                columns = [*records.slice(first, last - first).flatten(), binary_array(ids, 4 * per_doc)]
                if token_bytes:
                    columns.append(token_bytes.join(ids, per_doc))
                made.append(pa.Table.from_arrays(columns, names=names))
                first = last
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(made) if made else pa.table({n: [] for n in names})

    return blocks.drop("words").groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(assemble, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int], keep_columns: list[str] | None = None) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``, by a map-side join of each id with the token-byte table.

    The table has a row for each id of the vocabulary, which bounds it. NULL ids give NULL.
    """
    kept = [c for c in (encoded.columns if keep_columns is None else keep_columns) if c != "decoded"]
    table = TokenBytes(ranks)
    schema = StructType([*(encoded.schema[c] for c in kept), StructField("decoded", BinaryType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "__ids"):
                column = rows.column("__ids")
                ids, counts = _joined(column.fill_null(b""), "<u4")
                made = table.join(ids, counts)
                if column.null_count:
                    made = pa.array([None if gone else x for x, gone in zip(made.to_pylist(), column.is_null().to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), made], names=names)

    return encoded.select(*kept, F.col("ids").alias("__ids")).mapInArrow(run, schema)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    encoded = encode(docs, ranks, pattern, keep_columns=["doc_id"], with_decoded=True)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return digests(docs, load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
