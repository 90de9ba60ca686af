"""Phrase collocations from FM-indexes over word ids, one index for each shard of the corpus.

A shard holds about ``SHARD_WORDS`` words of texts of one language as a sequence of word ids, 0 between pieces. Its
index is bidirectional: the Burrows-Wheeler transforms of the sequence and of its reverse. A phrase is an interval of
each. One backward step in the reverse transform finds all words that follow it, one in the other all words that
precede it; each step gives the intervals and so the counts of the longer phrases.

Counts of a shard say nothing about the corpus, so phrases are lengthened one word at a time and summed across shards
in between: a phrase goes on only if the corpus has it ``least`` times. A longer phrase is asked for only if its first
and its last words, without the other end, are such phrases, which both directions of the index tell: it is named by
those two, so the keys that cross the shuffle are two numbers whatever the phrase's length. They cross it in blocks, one
for each shard and part of the keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import forget, keep, ragged, slices, starts

#: Words of a shard (a text without any separator may make a longer one), and bits of a shard's number in its task.
SHARD_WORDS, SHARD_BITS = 3 << 19, 10
#: Words of a phrase. The transforms sort by one word less, which is the longest phrase that is lengthened.
LONGEST = 5
#: Words of the corpus for each part that phrases are summed in; its phrases are fewer.
PART_ROWS = 1 << 20
SEPARATORS = r"[.,;:!?\n\x0b\x0c\r]+"


def _tokens(texts: pa.Array) -> pa.Array:
    """Words of all texts in order, lower-cased in ASCII, with ``.`` for separators and after each text."""
    marked = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS, " . ")
    flat = pc.ascii_split_whitespace(pc.binary_join_element_wise(marked, ".", " ")).flatten()
    return flat.filter(pc.greater(pc.binary_length(flat), 0))


def shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``shard``, ``lang``, distinct ``words`` with their ``counts``, and ``codes``: the words as positions in that
    list from 1 on, 0 between pieces, packed. A NULL language is ``und``. Texts without words leave nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        sizes: dict[str, int] = {}
        made, part = 0, TaskContext.get().partitionId()

        def emit(lang: str) -> pa.RecordBatch:
            nonlocal made
            if made >> SHARD_BITS:
                raise ValueError(f"one partition has more than {1 << SHARD_BITS} shards: use smaller input splits")
            coded = pa.chunked_array(held.pop(lang)).unify_dictionaries().combine_chunks()
            sizes.pop(lang)
            words, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            dot = pc.index(words, ".").as_py()
            codes = np.where(index == dot, 0, index + 1 - (index > dot)).astype("<i4")
            codes = codes[(codes > 0) | (np.roll(codes, 1) > 0)]
            words = words.filter(pc.not_equal(words, "."))
            counts = np.bincount(codes, minlength=len(words) + 1)[1:]
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part << SHARD_BITS | made - 1]), pa.array([lang]),
                 pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
                 pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts, pa.int64())),
                 pa.array([_pack([codes])], pa.binary())], names=["shard", "lang", "words", "counts", "codes"])

        for batch in batches:
            for rows in slices(batch, "__text"):
                for lang in pc.unique(rows.column("__lang")).to_pylist():
                    coded = _tokens(rows.column("__text").filter(pc.equal(rows.column("__lang"), lang))).dictionary_encode()
                    held.setdefault(lang, []).append(coded)
                    sizes[lang] = sizes.get(lang, 0) + len(coded)
                    if sizes[lang] >= SHARD_WORDS:
                        yield emit(lang)
                while sum(sizes.values()) >= 2 * SHARD_WORDS:  # of many languages, the one that holds most
                    yield emit(max(sizes, key=sizes.get))
        for lang in list(held):
            yield emit(lang)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("__lang"),
                       F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, "shard long, lang string, words array<string>, counts array<bigint>, codes binary")


def transform(text: np.ndarray, depth: int = LONGEST - 1) -> np.ndarray:
    """The Burrows-Wheeler transform of a sequence of small integers, taken as a circle, sorted by ``depth`` symbols.

    That is what intervals of phrases up to that length need: backward steps count symbols before an interval's
    start, and which rows of equal phrases come first does not matter to that.
    """
    rank, known = text.astype(np.int64), 1
    while known < depth:
        rank = np.unique(rank * (rank.max(initial=0) + 1) + np.roll(rank, -known), return_inverse=True)[1]
        known *= 2
    return np.roll(text, 1)[np.argsort(rank, kind="stable")]


def _steps(bwt: np.ndarray) -> np.ndarray:
    """Of each row of a transform, the row that one more symbol in front leads to."""
    out = np.empty(len(bwt), np.int64)
    out[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    return out


def lengthen(bwt: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """All phrases with one symbol (not 0) more in front: (interval that it comes from, symbol, first row, size)."""
    owner = np.repeat(np.arange(len(first)), size)
    rows = ragged(first.astype(np.int64), size.astype(np.int64))
    symbol = bwt[rows]
    real = symbol > 0
    owner, symbol, row = owner[real], symbol[real], _steps(bwt)[rows[real]]
    order = np.argsort(row, kind="stable")
    owner, symbol, row = owner[order], symbol[order], row[order]
    begin = np.nonzero(np.concatenate([np.ones(min(len(row), 1), bool),
                                       (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])]))[0]
    return owner[begin], symbol[begin].astype(np.int64), row[begin], np.diff(np.append(begin, len(row)))


def both_ways(forward: np.ndarray, backward: np.ndarray, first: np.ndarray, back: np.ndarray,
              size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases one word longer than the given ones, of which both ends are given ones.

    ``first``, ``back`` and ``size`` are the phrases' intervals in the transforms of the sequence and of its reverse.
    Returns (phrase without the last word, phrase without the first word, first, back, size).
    """
    owner, symbol, new_back, number = lengthen(backward, back, size)
    # In the forward transform the longer phrase starts after those of its phrase that go on with smaller symbols.
    order = np.lexsort((symbol, owner))
    sorted_owner, sorted_number = owner[order], number[order]
    inner = np.bincount(owner, weights=number, minlength=len(size)).astype(np.int64)
    before = starts(sorted_number)[:-1]
    group = np.searchsorted(sorted_owner, sorted_owner)
    offset = np.empty(len(owner), np.int64)
    offset[order] = before - before[group] if len(group) else before
    new_first = first[owner] + (size - inner)[owner] + offset
    suffix, _, start, _ = lengthen(forward, first, size)
    _, a, b = np.intersect1d(new_first, start, assume_unique=True, return_indices=True)
    return owner[a], suffix[b], new_first[a], new_back[a], number[a]


#: What is known of phrases in a shard, and of those that the corpus has often.
_FOUND = ["prefix", "suffix", "n", "first", "back"]
_OFTEN = [*_FOUND, "gid", "total"]


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of integers, byte by byte and compressed: keys and rows of a shard differ in few of their eight bytes."""
    stacked = np.stack(columns).astype("<i8")
    planes = stacked.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return stacked.shape[1].to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, columns: int) -> np.ndarray:
    rows = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], 8 * rows * columns, "zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(columns, 8, rows).transpose(0, 2, 1).copy().view("<i8")[:, :, 0]


def _blocks(parts: int, shard: int, lang: str, gids: np.ndarray, found: tuple[np.ndarray, ...]) -> dict[str, list]:
    """Phrases of a shard, one block for each of ``parts`` that its keys fall to."""
    prefix, suffix, first, back, size = found
    table = np.stack([gids[prefix], gids[suffix], size, first, back]).astype(np.int64)
    mixed = table[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + table[1].astype(np.uint64)
    part = ((mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    part, table = part[order], table[:, order]
    ends = np.append(np.nonzero(part[1:] != part[:-1])[0] + 1, len(part)) if len(part) else []
    out = {"part": [], "shard": [], "lang": [], "data": []}
    begin = 0
    for end in ends:
        out["part"].append(int(part[begin]))
        out["shard"].append(shard)
        out["lang"].append(lang)
        out["data"].append(_pack(list(table[:, begin:end])))
        begin = end
    return out


_BLOCKS = "part long, shard long, lang string, data binary"


def _block_table(blocks: dict[str, list]) -> pa.Table:
    types = {"part": pa.int64(), "shard": pa.int64(), "lang": pa.string(), "data": pa.binary()}
    return pa.table([pa.array(blocks.get(c, []), kind) for c, kind in types.items()], names=list(types))


def _index(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The index of a shard over the words that the corpus has often, and the gids of those."""
    order = np.argsort(right.column("code").to_numpy())
    codes, gids = right.column("code").to_numpy()[order], right.column("gid").to_numpy()[order]
    text = _unpack(left.column("codes")[0].as_py(), 1)[0]
    symbol = np.zeros(int(text.max(initial=0)) + 1, np.int64)
    order = np.argsort(-np.bincount(text, minlength=len(symbol))[codes], kind="stable")  # small numbers for common words
    codes, gids = codes[order], gids[order]
    symbol[codes] = np.arange(1, len(codes) + 1)
    text = np.concatenate([[0], symbol[text], [0]])
    # rare words end phrases as separators do; a word between two of those is in no phrase
    text = np.where((np.roll(text, 1) == 0) & (np.roll(text, -1) == 0), 0, text)
    text = text[(text > 0) | (np.roll(text, 1) > 0)]
    names = ["shard", "lang", "sequence", "gids"]
    if not len(text):
        return pa.table([pa.array([], x) for x in (pa.int64(), pa.string(), pa.binary(), pa.binary())], names=names)
    small = text.astype("<u2" if len(codes) < 1 << 16 else "<u4")
    both = np.concatenate([transform(small), transform(small[::-1])])
    both = both.view(np.uint8).reshape(-1, small.itemsize).T.tobytes()  # byte by byte: the high ones are mostly zero
    head = bytes([small.itemsize]) + len(small).to_bytes(8, "little")
    return pa.table([pa.array([key[0].as_py()]), pa.array([left.column("lang")[0].as_py()], pa.string()),
                     pa.array([head + pa.compress(both, "zstd", asbytes=True)], pa.binary()),
                     pa.array([_pack([gids])], pa.binary())], names=names)


def _transforms(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    width, length = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], 2 * width * length, "zstd", asbytes=True), np.uint8)
    both = planes.reshape(width, -1).T.copy().view(f"<u{width}")[:, 0]
    return both[:length], both[length:]


def _pairs(index: DataFrame, parts: int) -> DataFrame:
    """Blocks of the phrases of two words of each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, sequence, gids in zip(*(batch.column(c) for c in ("shard", "lang", "sequence", "gids"))):
                forward, backward = _transforms(sequence.as_py())
                names = _unpack(gids.as_py(), 1)[0]
                size = np.bincount(forward, minlength=len(names) + 1).astype(np.int64)
                first = starts(size)[1:-1]
                found = both_ways(forward, backward, first, first, size[1:])
                yield from _block_table(_blocks(parts, shard.as_py(), lang.as_py(), names, found)).to_batches()

    return index.mapInArrow(run, _BLOCKS)


def _longer(index: DataFrame, often: DataFrame, parts: int) -> DataFrame:
    """Blocks of the phrases one word longer than those in ``often``."""
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _block_table({})
        forward, backward = _transforms(left.column("sequence")[0].as_py())
        known = np.hstack([_unpack(x, len(_OFTEN)) for x in right.column("data").to_pylist()])
        n, first, back, gid = (known[_OFTEN.index(c)] for c in ("n", "first", "back", "gid"))
        found = both_ways(forward, backward, first, back, n)
        return _block_table(_blocks(parts, key[0].as_py(), left.column("lang")[0].as_py(), gid, found))

    return index.select("shard", "lang", "sequence").groupBy("shard").cogroup(
        often.select("shard", "data").groupBy("shard")).applyInArrow(run, _BLOCKS)


def _place(shard: np.ndarray | int, at: np.ndarray) -> np.ndarray:
    return shard << 31 | at


def _summed(blocks: DataFrame, least: int) -> DataFrame:
    """Blocks of the phrases that all shards together have ``least`` times, with that ``total`` and the phrase's ``gid``.

    All blocks of one part are summed in one group, about ``PART_ROWS`` phrases whatever the corpus. A phrase has
    one row in a shard at most, so the commonest one has as many rows as there are shards.
    """
    def run(key, table):  # annotated, Spark would look for iterators of tables
        shards, langs = table.column("shard").to_numpy(), table.column("lang").to_pylist()
        data = [_unpack(x, len(_FOUND)) for x in table.column("data").to_pylist()]
        row = np.repeat(np.arange(len(data)), [x.shape[1] for x in data])
        found = np.hstack(data)
        order = np.lexsort((found[1], found[0]))
        found, row = found[:, order], row[order]
        begin = np.nonzero(np.append(True, (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])))[0]
        total = np.add.reduceat(found[2], begin)
        gid = np.minimum.reduceat(_place(shards[row], found[3]), begin)
        size = np.diff(np.append(begin, len(row)))
        total, gid = np.repeat(total, size), np.repeat(gid, size)
        often = np.nonzero(total >= least)[0]
        often = often[np.argsort(row[often], kind="stable")]
        whole, row = np.vstack([found, gid, total])[:, often], row[often]
        out = {"part": [], "shard": [], "lang": [], "data": []}
        for i in np.unique(row):
            a, b = np.searchsorted(row, [i, i + 1])
            out["part"].append(key[0].as_py())
            out["shard"].append(int(shards[i]))
            out["lang"].append(langs[i])
            out["data"].append(_pack(list(whole[:, a:b])))
        return _block_table(out)

    return blocks.groupBy("part").applyInArrow(run, _BLOCKS)


def _named(often: DataFrame) -> DataFrame:
    """One row for each phrase in ``often``."""
    schema = "lang string, gid long, prefix long, suffix long, a long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, data in zip(*(batch.column(c) for c in ("shard", "lang", "data"))):
                known = dict(zip(_OFTEN, _unpack(data.as_py(), len(_OFTEN))))
                own = _place(shard.as_py(), known["first"]) == known["gid"]
                columns = [pa.array([lang.as_py()] * int(own.sum()), pa.string()),
                           *(pa.array(known[c][own]) for c in ("gid", "prefix", "suffix", "total"))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gid", "prefix", "suffix", "a"])

    return often.mapInArrow(run, schema)


def phrases(docs: DataFrame, least: int = 100, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to ``LONGEST`` words that a language has ``least`` times, and the number of words of each language.

    The first: ``lang``, ``size`` (words), ``gid``, ``prefix``, ``suffix`` (gids of the phrase without its last and first
    word), ``phrase``, ``a`` (occurrences), ``firsts`` (occurrences of its first 1, 2, ... words) and ``rests`` (of what
    follows those). The second: ``lang``, ``n``.
    """
    held = keep(shards(docs, text_col, lang_col), "phrase-shards")
    listed = held.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    same = Window.partitionBy("lang", "word")  # one row in a shard at most
    own = F.shiftleft(F.col("shard"), 31).bitwiseOR(F.col("code"))
    words = listed.select("shard", "lang", (F.col("at") + 1).cast("long").alias("code"), F.col("w.words").alias("word"),
                          F.col("w.counts").alias("n"))
    words = words.withColumns({"total": F.sum("n").over(same), "gid": F.min(own).over(same)}).where(F.col("total") >= least)
    words = keep(words.drop("n"), "phrase-words")
    sizes = keep(held.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")),
                 "phrase-sizes")
    parts = 1 + (sizes.agg(F.sum("n")).first()[0] or 0) // PART_ROWS
    index = keep(held.select("shard", "lang", "codes").groupBy("shard").cogroup(
        words.select("shard", "code", "gid").groupBy("shard")).applyInArrow(
            _index, "shard long, lang string, sequence binary, gids binary"), "phrase-index")
    forget(held)

    known = words.where(own == F.col("gid")).select(
        "lang", "gid", F.col("word").alias("phrase"), F.col("word").alias("last"), F.col("total").alias("a"),
        F.array().cast("array<bigint>").alias("firsts"), F.array().cast("array<bigint>").alias("rests"))
    levels, used, often = [], [], None
    for size in range(2, LONGEST + 1):
        found = _pairs(index, parts) if size == 2 else _longer(index, often, parts)
        often = keep(_summed(found, least), "phrases-often")
        begin = known.select(F.col("gid").alias("prefix"), F.col("phrase").alias("p_phrase"), F.col("a").alias("p_a"), "firsts")
        end = known.select(F.col("gid").alias("suffix"), "last", F.col("a").alias("s_a"), "rests")
        known = keep(_named(often).join(begin, "prefix").join(end, "suffix").select(
            "lang", "gid", "prefix", "suffix", F.concat_ws(" ", "p_phrase", "last").alias("phrase"), "last", "a",
            F.concat("firsts", F.array("p_a")).alias("firsts"), F.concat(F.array("s_a"), "rests").alias("rests")), "phrases-named")
        levels.append(known.withColumn("size", F.lit(size)).drop("last"))
        used.append(often)
    forget(words, index, *used)
    together = levels[0]
    for level in levels[1:]:
        together = together.unionByName(level)
    return together, sizes


def _exact(column: Column | str) -> Column:
    """As a number of up to 38 digits; products of such are exact, and an overflow is an error."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(38,0)")


def score(a: str, n: str, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact for products up to 38 digits."""
    top = F.lit(1000).cast("decimal(38,0)") * _exact(a) * _exact(n)
    low = _exact(left) * _exact(right)
    return _exact((top - top % low) / low).cast("long")


def collocations(docs: DataFrame, least: int = 100, most: int = 2000, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The ``most`` phrases of each language that bind their words closest.

    Columns: ``lang``, ``rank``, ``phrase``, ``a`` (occurrences), ``l`` and ``r`` (those of its two parts), ``n`` (words of
    the language), ``score``. The cut into parts is the one of least score, of equal ones that after fewest words.
    Phrases that a longer candidate holds just as often are left out. A NULL language is ``und``; NULL and empty
    texts have no words; repeated rows count each time; an empty table gives no rows. Other columns are left out.
    """
    found, sizes = phrases(docs, least, text_col, lang_col)
    longer = found.where(F.col("size") > 2)
    inside = longer.select((F.col("size") - 1).alias("size"), "a", F.explode(F.array("prefix", "suffix")).alias("gid"))
    free = found.join(inside.distinct(), ["size", "gid", "a"], "left_anti").join(sizes, "lang")
    cuts = F.inline(F.arrays_zip("firsts", "rests", F.sequence(F.lit(1), F.size("firsts")).alias("k")))
    cut = free.select("lang", "size", "gid", "phrase", "a", "n", cuts)
    cut = cut.withColumn("score", score("a", "n", F.col("firsts"), F.col("rests")))
    worst = cut.groupBy("lang", "size", "gid", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "firsts", "rests")).alias("cut"))
    flat = worst.select("lang", "phrase", "a", F.col("cut.firsts").alias("l"), F.col("cut.rests").alias("r"), "n",
                        F.col("cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
  FROM places, range(1, 6) AS s(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), sizes AS (
  SELECT lang, count(*) AS n FROM places GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), free AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.a >= 100 * c.a
      AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT c.lang, c.phrase, c.a, x.k, l.n AS l, r.n AS r, s.n,
         CAST((1000::HUGEINT * c.a * s.n) // (l.n::HUGEINT * r.n) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM free) c, LATERAL (SELECT cut AS k) x
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:x.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[x.k + 1:], ' ')
  JOIN sizes s ON s.lang = c.lang
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""
