"""SimHash near-dedup with multi-index hashing.

A 64-bit fingerprint has two segments of 32 bits. Two fingerprints that differ in at most two bits differ in at
most one bit of the high segment, or not at all in the low one. So a table of high and low segments is looked up
with each high segment's Hamming ball of radius 1 and with each low segment itself; matches are verified by their
complete distance. A pair that differs in one high bit is looked up from its member with that bit clear.

A segment value that over ``BLOCK`` fingerprints share would give all their pairs. Its table is not fetched:
everyone who looks it up, and everyone in it, is listed under the 65 values at most one bit from his fingerprint
instead. Two fingerprints differ in at most two bits just if they have such a value in common, so linking each
with the least fingerprint under the same value loses no component and adds none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import forget, keep, lookup, maybe_among, starts, with_columns

SEED, SHINGLE, DISTANCE = 42, 3, 2
#: The pipeline's near-duplicate stage: shingles of five words, similarity of the shingle sets.
PIPELINE_SHINGLE, SIMILARITY = 5, 0.8
#: Under each indexed hash, a text is compared with so many before it first.
BEFORE = 3
#: Common shingles are counted in one of so many texts; so many are told apart from rare ones.
COMMON_PART, COMMON = 16, 1_000_000
#: Fingerprints of one segment value that are compared pair by pair.
BLOCK = 64
LOW = (1 << 32) - 1


def _shingle_hashes(item: list[str], shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``shingle`` words of a text, some at a time; of all its words if it has no more."""
    digest = xxhash.xxh64_intdigest
    parts = [w.encode() for w in item if w]
    if not parts:
        return
    text = b" ".join(parts)
    if len(parts) <= shingle:
        yield np.array([digest(text, SEED)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    begin = np.concatenate([[0], ends[:-1] + 1])
    first, last = begin[: len(parts) - shingle + 1], ends[shingle - 1:]
    for at in range(0, len(first), 1 << 12):
        places = zip(first[at: at + (1 << 12)].tolist(), last[at: at + (1 << 12)].tolist())
        yield np.array([digest(text[a:b], SEED) for a, b in places], np.uint64)


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text as int64, the bits that over half of its hashes have; 0 for texts without words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    out = np.zeros(len(texts), np.uint64)
    for row, item in enumerate(lists.to_pylist()):
        ones, total = np.zeros(64, np.int64), 0
        for hashes in _shingle_hashes(item, shingle):
            total += len(hashes)
            bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little")
            for at in range(0, len(bits), 255):  # as many as a byte can count
                ones += bits[at: at + 255].sum(axis=0, dtype=np.uint8)
        out[row] = np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]
    return out.view(np.int64)


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE,
                      keep_columns: list[str] | None = None) -> DataFrame:
    """Adds ``fp``, the fingerprint of each whole text."""
    return with_columns(docs, text_col, "fp long", lambda t: [fingerprints(t, shingle)], keep_columns)


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(LOW))


def _probes(fp: str) -> Column:
    """(segment, value) pairs to look up: the low segment, the high one, and it with each clear bit set."""
    high = _high(F.col(fp))
    flips = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: high.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    values = F.array_distinct(F.concat(F.array(high), flips))
    return F.concat(F.array(F.struct(F.lit(1).alias("segment"), _low(F.col(fp)).alias("value"))),
                    F.transform(values, lambda v: F.struct(F.lit(0).alias("segment"), v.alias("value"))))


def links(distinct: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) between fingerprints, with the components that all pairs of at most two bits have.

    ``distinct`` has each fingerprint once, as ``fp``. Rows stay in proportion to it: 35 lookups at most of a
    fingerprint, ``BLOCK`` matches of each, 65 values of those that meet a larger block.
    """
    table = distinct.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("segment"), _high(F.col("fp")).alias("value")),
        F.struct(F.lit(1).alias("segment"), _low(F.col("fp")).alias("value")))).alias("s")).select("fp", "s.*")
    blocks = table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    table = keep(table.join(blocks, ["segment", "value"]), "simhash-table")
    small = table.where(F.col("n") <= BLOCK).select("segment", "value", F.col("fp").alias("b"))
    large = table.where(F.col("n") > BLOCK).select("segment", "value").distinct()
    probes = distinct.select(F.col("fp").alias("a"), F.explode(_probes("fp")).alias("s")).select("a", "s.*")
    found = probes.join(small, ["segment", "value"]).where(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
    met = probes.join(large, ["segment", "value"], "left_semi").select("a").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)),
                        lambda k: F.col("a").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    near = met.select("a", F.explode(F.concat(F.array("a"), flips)).alias("value"))
    least = near.groupBy("value").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    starred = near.join(least, "value").where(F.col("a") != F.col("b")).select("a", "b")
    return found.select("a", "b").union(starred).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node that it reaches) of every node of ``edges`` (``a``, ``b``).

    Alternates large-star and small-star steps, each a grouped minimum, until the links no longer change; every step
    is written to the shared folder. Rounds grow with the logarithm of the longest chain.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = keep(edges.where(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        parents = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(parents, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        older, edges = edges, keep(small.where(F.col("a") != F.col("b")).distinct(), "links")
        forget(older)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        before = now


def group_near_duplicates(prints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``component_id``, the smallest id whose document is reached over links, to rows with ``fp``.

    All rows of one fingerprint are linked; work goes by distinct fingerprint, counted before it is shuffled, so a
    group of copies of any size is one row. Rows without an id take part and get the group's smallest id, or NULL if
    the group has none. Repeated rows each get their group's id.
    """
    ids = keep(prints.groupBy("fp").agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("rows")), "fingerprints")
    roots = components(links(ids.select("fp")))
    grouped = ids.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = keep(grouped.join(least, "root").select(F.col("fp").cast("string").alias("__fp"), "component_id", "rows"), "groups")
    plain = [c for c in prints.columns if c != "component_id"]
    rows = prints.select(*plain).withColumn("__fp", F.col("fp").cast("string"))
    spread = F.xxhash64(*[c for c in (id_col, "fp")], F.monotonically_increasing_id())
    return lookup(rows, named, "__fp", "rows", spread).drop("__fp")


def text_key(text_col: str = "text") -> Column:
    """SHA-256 of a text: with an id, the key of a row. A NULL text counts as an empty one."""
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def _sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending; none for texts without words."""
    for item in pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))).to_pylist():
        hashes = list(_shingle_hashes(item, shingle))
        yield np.unique(np.concatenate(hashes).view(np.int64)) if hashes else np.zeros(0, np.int64)


def _lists(items: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(starts(np.array([len(x) for x in items])).astype(np.int32),
                                    np.concatenate([*items, np.zeros(0, np.int64)]))


def common_shingles(docs: DataFrame, text_col: str = "text", shingle: int = PIPELINE_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes that several texts of a sample have, ascending, and their counts; ``COMMON`` at most.

    They only set the order in which shingles are indexed: any order finds all pairs, this one at less cost.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("__t"), F.xxhash64(text_col).alias("__h"))
    rows = rows.where(F.pmod("__h", F.lit(COMMON_PART)) == 0).dropDuplicates(["__h"])
    sets = with_columns(rows, "__t", "hashes array<bigint>", lambda t: [_lists(list(_sets(t, shingle)))], [])
    counts = sets.select(F.explode("hashes").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("n") > 1).orderBy(F.col("n").desc(), "value").limit(COMMON).toArrow()
    values, counts = (found.column(c).to_numpy() for c in ("value", "n"))
    order = np.argsort(values)
    return values[order], counts[order]


def _prefixes(texts: pa.Array, shingle: int, common: tuple[np.ndarray, np.ndarray], part: Fraction) -> list[pa.Array]:
    """Digest and size of each text's shingle set, and its first hashes, rare ones first: sets as similar as ``part``
    have one of theirs in common."""
    values, counts = common
    digests, sizes, firsts = [], [], []
    for item in _sets(texts, shingle):
        n = len(item)
        often = np.zeros(n, np.int64)
        if n and len(values):
            at = np.minimum(np.searchsorted(values, item), len(values) - 1)
            often = np.where(values[at] == item, counts[at], 0)
        digests.append(xxhash.xxh3_128_digest(item.tobytes()))
        sizes.append(n)
        firsts.append(item[np.lexsort((item, often))[: n and n - math.ceil(part * n) + 1]])
    return [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), _lists(firsts)]


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, part: Fraction) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) whose complete shingle sets have a Jaccard similarity of at least ``part``.

    First the indexed hashes bound what two sets can share; sets are made again from the texts of what is left.
    """
    def enough(shared: Column) -> Column:
        return shared * (part.numerator + part.denominator) >= part.numerator * (F.col("na") + F.col("nb"))

    def joined(pairs: DataFrame, table: DataFrame) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(table.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("hashes").alias(f"h{x}")), x)
        return pairs

    same = F.size(F.array_intersect("ha", "hb")).cast("long")
    rest = F.greatest(F.col("na") - F.size("ha"), F.col("nb") - F.size("hb"))
    likely = joined(pairs, nodes.select("node", "n", F.col("prefix").alias("hashes"))).where(enough(same + rest))
    likely = keep(likely.select("a", "b"), "similar-likely")
    wanted = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    wanted = keep(wanted.join(nodes, "node").select("node", "row.*"), "similar-wanted")
    texts = maybe_among(docs, wanted, ["id", "sha"]).where("maybe").join(wanted, ["id", "sha"]).select("node", "__t")
    sets = with_columns(texts, "__t", "hashes array<bigint>", lambda t: [_lists(list(_sets(t, shingle)))], ["node"])
    sets = sets.groupBy("node").agg(F.first("hashes").alias("hashes"))
    sets = keep(sets.select("node", F.size("hashes").cast("long").alias("n"), "hashes"), "similar-sets")
    links = keep(joined(likely, sets).where(enough(same)).select("a", "b"), "similar-links")
    forget(likely, wanted, sets)
    return links


def fingerprint_links(nodes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY, shingle: int = PIPELINE_SHINGLE) -> DataFrame:
    """Links (``a``, ``b``) from ``nodes`` to the least node of their SimHash group, where at least ``similarity`` holds.

    The groups are those of ``group_near_duplicates``; each link is checked on the complete sets.
    """
    grouped = group_near_duplicates(nodes.select("node", "fp"), "node")
    pairs = grouped.where(F.col("node") != F.col("component_id")).select(F.col("node").alias("a"), F.col("component_id").alias("b"))
    pairs = keep(pairs, "fingerprint-pairs")
    links = _verified(pairs, nodes, docs, shingle, Fraction(str(similarity)))
    forget(pairs)
    return links


def similar_links(nodes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY, shingle: int = PIPELINE_SHINGLE) -> DataFrame:
    """Links (``a``, ``b``) with the components that all pairs of ``nodes`` of at least ``similarity`` have.

    The first come from SimHash groups; what those link is not compared again. A group holds fingerprints of at most two
    differing bits, so many similar texts are in none, or are not similar to its first; an index finds all of those.
    Two sets of similarity s share a hash among the first n - ceil(s * n) + 1 of each, in any one order of all hashes,
    and that hash is early enough for what follows it to make up the overlap. So under each indexed hash a node is
    compared with the ``BEFORE`` nodes before it, by size; then, where more nodes share a hash, all pairs that
    are not in one component yet are compared as well. All links are verified on the complete sets.
    """
    part = Fraction(str(similarity))

    def candidates(rows: DataFrame) -> DataFrame:
        most = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
        able = most * (part.numerator + part.denominator) >= part.numerator * (F.col("x.n") + F.col("y.n"))
        a, b = F.col("x.node"), F.col("y.node")
        return keep(rows.where(able & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "similar-pairs")

    entries = nodes.select("node", "n", F.posexplode("prefix").alias("place", "value"))
    own, order = F.struct("node", "n", "place"), W.partitionBy("value").orderBy("n", "node")
    entries = entries.select("value", own.alias("x"), F.array(*[F.lag(own, k).over(order) for k in range(1, BEFORE + 1)]).alias("before"),
                             F.count(F.lit(1)).over(W.partitionBy("value")).alias("rows"))
    entries = keep(entries.where(F.col("rows") > 1), "similar-entries")
    near = entries.select("x", F.explode("before").alias("y")).where(F.col("y").isNotNull())
    close, pairs = fingerprint_links(nodes, docs, similarity, shingle), candidates(near)
    apart = pairs
    for x in "ab":
        apart = apart.join(close.select(F.col("a").alias(x), F.col("b").alias(f"r{x}")), x, "left")
    apart = apart.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    links = close.union(_verified(apart, nodes, docs, shingle, part))
    forget(pairs)
    roots = components(links)
    large = entries.where(F.col("rows") > BEFORE + 1).select("value", "x", F.col("x.node").alias("node"))
    large = large.join(roots, "node", "left").select("value", "x", F.coalesce("root", "node").alias("root"))
    large, read = keep(large, "similar-large"), entries
    forget(read)
    classes = large.select("value", "root").distinct()
    several = classes.groupBy("value").agg(F.count(F.lit(1)).alias("roots")).where(F.col("roots") > 1).select("value")
    classes = classes.join(several, "value")
    apart = classes.withColumnRenamed("root", "p").join(classes.withColumnRenamed("root", "q"), "value").where(F.col("p") < F.col("q"))
    apart = apart.join(large.withColumnRenamed("root", "p"), ["value", "p"])
    apart = apart.join(large.select("value", F.col("root").alias("q"), F.col("x").alias("y")), ["value", "q"])
    pairs = candidates(apart)
    more = _verified(pairs, nodes, docs, shingle, part)
    forget(pairs, large)
    return links.union(more)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("sha"), F.col(text_col).cast("string").alias("__t"))


def members(docs: DataFrame, id_col: str, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``id``, ``sha`` and ``rows`` of every distinct row, and ``first``, the (``id``, ``sha``) of the first row of its
    group of near duplicates.

    ``id_col`` is a long, not NULL; ``sha`` is ``text_key``. Texts of one shingle set are one node, so exact copies cost
    one row. Texts without words are copies of each other. A row is what id and text make it: rows that share an id are
    told apart by their texts.
    """
    part, common = Fraction(str(similarity)), common_shingles(docs, text_col)
    rows = _rows(docs, id_col, text_col)
    found = with_columns(rows, "__t", "fp long, digest binary, n long, prefix array<bigint>",
                         lambda t: [fingerprints(t), *_prefixes(t, PIPELINE_SHINGLE, common, part)], ["id", "sha"])
    found = keep(found, "similar-rows")
    nodes = found.groupBy("digest").agg(F.min(F.struct("id", "sha", "fp")).alias("row"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    nodes = keep(nodes.select(F.monotonically_increasing_id().alias("node"), "digest", F.struct("row.id", "row.sha").alias("row"),
                              F.col("row.fp").alias("fp"), "n", "prefix"), "similar-nodes")
    keys = keep(found.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("rows"), F.first("digest").alias("digest")), "similar-keys")
    forget(found)
    roots = components(similar_links(nodes, rows, similarity))
    rooted = nodes.select("node", "digest", "row").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = rooted.groupBy("root").agg(F.min("row").alias("first"))
    named = rooted.join(firsts, "root").select("digest", "first")
    named = keep(keys.join(named, "digest").select("id", "sha", "rows", "first"), "similar-members")
    forget(nodes, keys)
    return named


def representatives(docs: DataFrame, id_col: str, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``id_col`` and ``sha`` of the first row of each group of near duplicates, see ``members``."""
    firsts = members(docs, id_col, text_col, similarity).select("first").distinct()
    return firsts.select(F.col("first.id").alias(id_col), F.col("first.sha").alias("sha"))


def drop_repeats(docs: DataFrame, id_col: str, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The first row of each group of near duplicates, see ``members``; of rows that repeat both id and text, one.

    Texts are shuffled only where the row is one to drop or a repeated one, or shares their bit in ``maybe_among``.
    """
    care = members(docs, id_col, text_col, similarity).withColumn("gone", F.struct("id", "sha") != F.col("first"))
    care = keep(care.where(F.col("gone") | (F.col("rows") > 1)).select(F.col("id").alias(id_col), "sha", "gone"), "similar-care")
    marked = maybe_among(docs.withColumn("sha", text_key(text_col)), care, [id_col, "sha"])
    rest = marked.where("maybe").dropDuplicates([id_col, "sha"]).join(care.where("gone"), [id_col, "sha"], "left_anti")
    return marked.where(~F.col("maybe")).select(*docs.columns).union(rest.select(*docs.columns))


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    prints = keep(with_fingerprints(docs, keep_columns=["doc_id"]), "prints")
    found = group_near_duplicates(prints)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
