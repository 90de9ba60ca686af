"""Helpers shared by the operators: tables in the shared folder, lookups of hot keys, words of Arrow columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Text of one slice of a batch. Bounds what a task holds beside the batch itself.
SLICE_BYTES = 4 << 20
#: Keys that ``lookup`` treats as hot: a table of this many rows is broadcast whatever the input size.
HOT_KEYS = 1000
#: Bits of the table by which ``maybe_among`` tells keys apart, in words of 64; broadcast whatever the input size.
KEY_BITS = 1 << 24


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master may leave it unset; it then gets a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage is cut, and lost executors lose nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.kept_path = path
    return kept


def forget(*kept: DataFrame) -> None:
    """Deletes tables that ``keep`` wrote and that no plan needs any more: what was made of them is written itself."""
    for df in kept:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.kept_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def lookup(left: DataFrame, groups: DataFrame, key: str, weight: str, spread: Column) -> DataFrame:
    """Left-joins ``groups`` (one row for each value of ``key``) to ``left``; equals a plain left join on ``key``.

    The ``HOT_KEYS`` groups with the largest ``weight`` (their number of rows in ``left``) are broadcast; that
    table is bounded. Their rows go on under a key made of ``spread``, so any other key that the shuffled join
    meets has at most one row in ``HOT_KEYS`` of all. A NULL key finds nothing. ``key`` is a string column.
    """
    values = [c for c in groups.columns if c not in (key, weight)]
    hot = groups.orderBy(F.col(weight).desc(), key).limit(HOT_KEYS)
    hot = hot.select(F.col(key).alias("__hot_key"), F.struct(*values).alias("__hot"))
    cold = groups.select(F.col(key).alias("__cold_key"), F.struct(*values).alias("__cold"))
    left = left.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left").drop("__hot_key")
    own = F.when(F.col("__hot").isNull() & F.col(key).isNotNull(), F.col(key))
    left = left.withColumn("__own_key", F.coalesce(own, F.concat(F.lit("\x00"), spread.cast("string"), F.lit("\x00"))))
    joined = left.join(cold, F.col("__own_key") == F.col("__cold_key"), "left")
    found = [F.coalesce(F.col("__hot")[v], F.col("__cold")[v]).alias(v) for v in values]
    return joined.select(*[c for c in left.columns if not c.startswith("__hot") and c != "__own_key"], *found)


def maybe_among(df: DataFrame, wanted: DataFrame, keys: list[str], name: str = "maybe") -> DataFrame:
    """Adds ``name``: true for every row whose ``keys`` are among ``wanted`` and for few others. Shuffles no row of ``df``.

    A key sets one of ``KEY_BITS`` bits; these are broadcast as words. Only rows so marked need a join with ``wanted``.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(KEY_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = wanted.select(F.shiftright(place, 6).alias("__word"), bit.alias("__bit"))
    words = words.groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    found = df.withColumn("__word", F.shiftright(place, 6)).join(F.broadcast(words), "__word", "left")
    marked = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return found.select(*df.columns, marked.alias(name))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows whose ``column`` has about ``limit`` bytes; one row may have more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        below = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, below + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: (index into the distinct words, words of each text, distinct words).

    A NULL text has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    empty = ~full.to_numpy(zero_copy_only=False)
    if empty.any():
        owner = np.repeat(np.arange(len(counts)), counts)
        counts -= np.bincount(owner[empty], minlength=len(counts))
        flat = flat.filter(full)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts, coded.dictionary


def starts(counts: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums, with the total at the end."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])


def ragged(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices ``begin[i], begin[i] + 1, ...`` (``counts[i]`` of them) of all i, one after the other."""
    total = int(counts.sum())
    small = total < 1 << 31 and int(begin.max(initial=0)) < 1 << 31
    kind = np.int32 if small else np.int64
    shift = np.repeat((begin - (np.cumsum(counts) - counts)).astype(kind), counts)
    shift += np.arange(total, dtype=kind)
    return shift


def text_bytes(value: str | None) -> bytes:
    return b"" if value is None else value.encode()


def binary_array(data: bytes | np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array whose items are ``counts[i]`` bytes each of ``data``."""
    data = np.ascontiguousarray(data).view(np.uint8).tobytes() if isinstance(data, np.ndarray) else data
    offsets = starts(counts).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def with_columns(df: DataFrame, text_col: str, fields: str, compute, keep_columns: list[str] | None = None,
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Adds the columns ``fields`` (DDL) that ``compute`` makes from a slice of ``text_col``.

    ``compute`` takes an Arrow string array, NULLs included, and returns one Arrow array for each field. Columns of
    ``df`` that have the name of a new one are replaced. Nothing but a batch and a slice is held by a task.
    """
    new = StructType.fromDDL(fields)
    kept = [c for c in (df.columns if keep_columns is None else keep_columns) if c not in new.names]
    schema = StructType([df.schema[c] for c in kept] + new.fields)
    types = [to_arrow_type(f.dataType) for f in new.fields]
    names = [*kept, *new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", slice_bytes):
                made = compute(part.column("__text"))
                made = [pa.array(x, type=t) if not isinstance(x, pa.Array) else x.cast(t) for x, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], names=names)

    return df.select(*kept, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
