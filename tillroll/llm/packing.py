"""Best-fit packing of documents into sequences of a fixed number of tokens, by bin completion.

A document longer than a sequence is cut into full pieces, each a sequence of its own, and a rest that comes first.
What is left to pack are the rests, of which only the lengths matter: their histogram has at most one row for each
length below the capacity, whatever the number of documents. Branch and bound runs on that histogram on the driver;
equal fillings are taken many bins at a time. Documents find their places in it by their rank among those of their
length, so no sort, window over documents or shuffle of ids is needed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tillroll.llm.common import binary_array, keep, new_path, ragged, slices, starts

CAPACITY, END = 2048, 0
#: Nodes of the search, and fillings that are tried around one largest document.
NODES, FILLINGS = 400, 24
#: Input partitions whose offsets (one for each length) are broadcast together.
PARTS = 512
#: Bits for the full pieces of one input partition in their sequence ids.
PIECE_BITS = 36


class Filling(NamedTuple):
    """``bins`` equal sequences, each with ``times`` documents of each of ``lengths``."""

    lengths: tuple[int, ...]
    times: tuple[int, ...]
    bins: int


def bins(fillings: Sequence[Filling]) -> int:
    return sum(f.bins for f in fillings)


def lower_bound(counts: np.ndarray) -> int:
    """Fewest sequences that ``counts[length]`` documents can need: by total length, and with long ones apart.

    ``len(counts) - 1`` is the capacity. For each k, documents above capacity - k are alone with what is shorter
    than k, those above half are alone among themselves, and what is left of their room takes the middle ones.
    """
    capacity = len(counts) - 1
    lengths = np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * lengths)
    half = capacity // 2
    k = np.arange(half + 1)
    long = number[capacity] - number[capacity - k]
    upper = number[capacity - k] - number[half]
    room = upper * capacity - (total[capacity - k] - total[half])
    middle = total[half] - np.where(k > 0, total[np.maximum(k - 1, 0)], 0)
    extra = np.maximum(0, -((room - middle) // capacity))
    return int(max((long + upper + extra).max(), -(-int(total[capacity]) // capacity)))


def best_fit(counts: np.ndarray) -> list[Filling]:
    """Best-fit decreasing: each document goes where it leaves least room, the longest first.

    Sequences with equal contents are one entry, so the work goes by lengths, not by documents.
    """
    capacity = len(counts) - 1
    open_bins: dict[int, list[tuple[tuple, tuple, int]]] = {}

    def put(room: int, lengths: tuple, times: tuple, number: int) -> None:
        open_bins.setdefault(room, []).append((lengths, times, number))

    for length in np.nonzero(counts)[0][::-1].tolist():
        left = int(counts[length])
        for room in sorted(r for r in open_bins if r >= length):
            waiting = open_bins.pop(room)
            while waiting and left:
                lengths, times, number = waiting.pop()
                each = room // length
                full = min(number, left // each)
                if full:
                    put(room - each * length, (*lengths, length), (*times, each), full)
                left, number = left - full * each, number - full
                if number and left:  # fewer than fill one
                    put(room - left * length, (*lengths, length), (*times, left), 1)
                    left, number = 0, number - 1
                if number:
                    put(room, lengths, times, number)
            if waiting:
                open_bins.setdefault(room, []).extend(waiting)
            if not left:
                break
        if left:
            each = capacity // length
            if left // each:
                put(capacity - each * length, (length,), (each,), left // each)
            if left % each:
                put(capacity - left % each * length, (length,), (left % each,), 1)
    return [Filling(*entry) for entries in open_bins.values() for entry in entries]


def _fits_into(items: tuple[int, ...], rooms: tuple[int, ...]) -> bool:
    """Whether ``items`` can be packed into bins as large as ``rooms``."""
    if not items:
        return True
    tried = set()
    for i, room in enumerate(rooms):
        if room >= items[0] and room not in tried:
            tried.add(room)
            if _fits_into(items[1:], (*rooms[:i], room - items[0], *rooms[i + 1:])):
                return True
    return False


def completions(counts: np.ndarray, room: int, slack: int, most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated sets of documents for ``room`` that waste at most ``slack``, those that waste least first.

    A set is dominated if it fits, packed, into the documents of another. Sets to which something could be added are
    dominated by what adding gives, so only full ones are listed; at most ``most``, longest documents first.
    """
    lengths = [x for x in np.nonzero(counts)[0][::-1].tolist() if x <= room]
    found: list[tuple[int, ...]] = []
    steps = 0

    def extend(at: int, left: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps
        steps += 1
        if len(found) >= most or steps > 40 * most:
            return
        while at < len(lengths) and (lengths[at] > left or counts[lengths[at]] <= chosen.count(lengths[at])):
            at += 1
        if at == len(lengths):
            # what was passed over on purpose may still fit: then a fuller set is listed elsewhere
            if left <= slack and not any(x <= left and counts[x] > chosen.count(x) for x in lengths):
                found.append(chosen)
            return
        extend(at, left - lengths[at], (*chosen, lengths[at]))
        extend(at + 1, left, chosen)

    extend(0, room, ())
    found.sort(key=lambda items: (room - sum(items), len(items)))
    kept: list[tuple[int, ...]] = []
    for items in found:
        if not any(sum(other) >= sum(items) and other != items and len(other) <= len(items) and _fits_into(items, other)
                   for other in kept):
            kept.append(items)
    return kept


def complete(counts: np.ndarray, nodes: int = NODES) -> list[Filling]:
    """Packs ``counts[length]`` documents into sequences of ``len(counts) - 1`` tokens, as few as the search finds.

    Bin completion: at each node the longest document left gets one of its undominated fillings, in as many equal
    bins as there are documents for, or in one. Nodes whose lower bound reaches the incumbent are cut, and so are
    fillings that waste more than the incumbent leaves to waste. Each node is also finished by best fit, which gives
    the incumbents. The search ends when an incumbent meets the lower bound, which proves it, or after ``nodes``.
    """
    counts = np.asarray(counts, np.int64)
    capacity, sizes = len(counts) - 1, np.arange(len(counts))
    best, least = best_fit(counts), lower_bound(counts)
    stack: list[tuple[np.ndarray, int, tuple]] = [(counts, 0, ())]
    while stack and nodes and bins(best) > least:
        nodes -= 1
        left, used, path = stack.pop()
        if used + lower_bound(left) >= bins(best):
            continue
        rest = best_fit(left)
        if used + bins(rest) < bins(best):
            best = [*_unwound(path), *rest]
        if not left.any():
            continue
        longest = int(np.nonzero(left)[0][-1])
        others = left.copy()
        others[longest] -= 1
        slack = (bins(best) - 1 - used) * capacity - int((left * sizes).sum())
        branches = []
        for items in completions(others, capacity - longest, slack):
            lengths, times = np.unique((longest, *items), return_counts=True)
            most = int((left[lengths] // times).min())
            for number in sorted({most, 1}, reverse=True):
                after = left.copy()
                after[lengths] -= times * number
                filling = Filling(tuple(lengths.tolist()), tuple(times.tolist()), number)
                branches.append((after, used + number, (filling, path)))
        stack += branches[::-1]
    return best


def _unwound(path: tuple) -> list[Filling]:
    out = []
    while path:
        filling, path = path
        out.append(filling)
    return out


class Places(NamedTuple):
    """Where documents of a length go by their rank: runs of ranks, ascending by ``length << 48 | first rank``."""

    keys: np.ndarray
    first: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def places(fillings: Sequence[Filling]) -> Places:
    """One run of ranks for each length of each filling. The driver holds those, a few for each length."""
    rows, taken, sequence = [], {}, 0
    for lengths, times, number in fillings:
        offset = 0
        for length, each in zip(lengths, times):
            first = taken.get(length, 0)
            taken[length] = first + each * number
            rows.append((length << 48 | first, first, each, sequence, offset))
            offset += length * each
        sequence += number
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Places(*(np.ascontiguousarray(table[:, i]) for i in range(5)))


def _byte_values() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones are themselves, the others follow
    from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """Encodes a text as the tokenizers library does with the file at ``path``, ``add_special_tokens=False``.

    The file is byte-level BPE in which each entry is rebuilt by its own merges (a test asserts it of the vocabulary
    in use), so merging by rank gives the same ids several times as fast. A text that the fast way refuses (an
    endless run of white space) takes the library's.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    values = _byte_values()
    ranks = {bytes(values[c] for c in word): n for word, n in spec["model"]["vocab"].items() if word not in added}
    fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    whole = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as failure:  # the library's panics are no Exceptions
            if isinstance(failure, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def _encoded(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, capacity: int, end: int) -> DataFrame:
    """Ids of each document with the end id, and its rank among the rests of one length in its input partition."""
    new = StructType.fromDDL("__ids binary, __length long, __rest int, __rank long, __full long, __part int")
    schema = StructType([docs.schema[id_col], *new.fields])
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path, pattern), TaskContext.get().partitionId()
        seen, full = np.zeros(capacity, np.int64), 0
        for batch in batches:
            for rows in slices(batch, "__text"):
                ids = [np.append(encode(t or ""), np.uint32(end)) for t in rows.column("__text").to_pylist()]
                lengths = np.array([len(x) for x in ids], np.int64)
                rest = lengths % capacity
                order = np.argsort(rest, kind="stable")
                ordered = rest[order]
                rank = np.empty(len(rest), np.int64)
                rank[order] = np.arange(len(rest)) - np.searchsorted(ordered, ordered) + seen[ordered]
                seen += np.bincount(rest, minlength=capacity)
                before = full + starts(lengths // capacity)
                full = int(before[-1])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(id_col).cast(id_type), binary_array(np.concatenate(ids).astype("<u4"), 4 * lengths),
                     pa.array(lengths), pa.array(rest.astype(np.int32)), pa.array(rank), pa.array(before[:-1]),
                     pa.array(np.full(len(rest), part, np.int32))], names=schema.names)

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end: int = END, nodes: int = NODES) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` tokens.

    Columns: ``id_col``, ``piece`` (from 0), ``start`` (the document's ids before it), ``length``, ``ids`` (unsigned
    32-bit, little endian), ``sequence_id``, ``offset`` (gapless from 0 in each sequence). Other columns of ``docs``
    are left out, whatever their names. A NULL or empty text is the end id alone. Rows are packed as they are:
    repeated rows, equal texts and rows without an id each get their own place. An empty table gives no rows.
    Pieces of one document may lie in any sequences; which of several documents of one length goes where is open.
    """
    spark = docs.sparkSession
    path_of_ids = new_path(spark, "packing-ids")
    encoded = _encoded(docs, path, pattern, id_col, text_col, capacity, end)
    (encoded.withColumn("__block", F.floor(F.col("__part") / PARTS).cast("int"))
     .write.partitionBy("__block").option("compression", "zstd").parquet(path_of_ids))
    ids = spark.read.schema(StructType([*encoded.schema.fields, *StructType.fromDDL("__block int").fields])).parquet(path_of_ids)

    counted = ids.where("__rest > 0").groupBy("__block", "__part", "__rest").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("__rest").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = keep(counted.withColumn("__base", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-bases")
    counts = np.zeros(capacity + 1, np.int64)
    for rest, n in bases.groupBy("__rest").agg(F.sum("n")).collect():  # fewer rows than capacity
        counts[rest] = n
    fillings = complete(counts, nodes)
    blocks = [r[0] for r in bases.select("__block").union(ids.select("__block")).distinct().collect()]  # one for PARTS parts
    placed = _placed(spark.createDataFrame([], ids.schema).withColumn("__base", F.lit(0).cast("long")),
                     id_col, capacity, places(fillings), bins(fillings))
    parts = []
    for block in sorted(blocks):
        own = bases.where(F.col("__block") == block).select("__part", "__rest", "__base")  # at most PARTS x capacity rows
        joined = ids.where(F.col("__block") == block).join(F.broadcast(own), ["__part", "__rest"], "left")
        parts.append(_placed(joined.select(*ids.columns, "__base"), id_col, capacity, places(fillings), bins(fillings)))
    return reduce(DataFrame.union, parts) if parts else placed


def _placed(rows: DataFrame, id_col: str, capacity: int, runs: Places, packed: int) -> DataFrame:
    schema = StructType([rows.schema[id_col], *StructType.fromDDL(
        "piece int, start long, length long, ids binary, sequence_id long, offset long").fields])
    id_type = to_arrow_type(rows.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__ids"):
                def column(name: str) -> np.ndarray:
                    return part.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

                length, rest = column("__length"), column("__rest")
                rank = column("__rank") + column("__base")
                first = np.where(rest > 0, rest, capacity)
                pieces = 1 + (length - first) // capacity
                owner = np.repeat(np.arange(len(length)), pieces)
                piece = ragged(np.zeros(len(length), np.int64), pieces).astype(np.int64)
                own_length = np.where(piece == 0, first[owner], capacity)
                start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
                # full pieces: a sequence for each, after those of the packing
                number = column("__full")[owner] + piece - (rest > 0)[owner]
                sequence = packed + (column("__part")[owner] << PIECE_BITS) + number
                offset = np.zeros(len(owner), np.int64)
                loose = np.nonzero((piece == 0) & (rest > 0)[owner])[0]
                if len(loose):
                    of = owner[loose]
                    at = np.searchsorted(runs.keys, rest[of] << 48 | rank[of], "right") - 1
                    nth = rank[of] - runs.first[at]
                    sequence[loose] = runs.sequence[at] + nth // runs.times[at]
                    offset[loose] = runs.offset[at] + nth % runs.times[at] * rest[of]
                data = b"".join(part.column("__ids").to_pylist())  # pieces follow one another as the documents do
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col).take(pa.array(owner)).cast(id_type), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(own_length), binary_array(data, 4 * own_length), pa.array(sequence),
                     pa.array(offset)], names=schema.names)

    return rows.mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``length`` and ``ids``, the pieces' ids in order of their offsets.

    One shuffle of the ids; a sequence has at most as many pieces as tokens, so no group is large.
    """
    listed = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return listed.select("sequence_id", joined.alias("ids")).select(
        "sequence_id", (F.octet_length("ids") / 4).cast("long").alias("length"), "ids")


def op11_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
