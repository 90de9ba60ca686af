"""Line dedup by DataFrame functions only: lines that several documents hold stay in one of them.

Explodes normalised lines, hashes them, counts distinct documents for each hash, and drops lines over the
threshold; each document is put together again from the positions that remain.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import keep, lookup

#: White space that is stripped from the ends of a line, as in [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                min_docs: int = 2) -> DataFrame:
    """Drops lines whose key of at least ``min_chars`` code points is in ``min_docs`` documents or more.

    Such a line stays in the smallest id that holds it, in all its places there. Returns the columns of ``docs``
    with ``text_col`` cut, and ``n_lines`` (before) and ``n_dropped``; columns of those names are replaced.

    NULL and empty texts count as one empty line and become ''. Rows that repeat an id are the same document for
    the count, and each loses its own lines. All rows without an id are one document, the last in the order.
    Hashes have 128 bits. A line that a third of all documents hold is counted by partial sums, and its result
    comes back by broadcast (``lookup``); the positions to drop are gathered for one document at a time.
    """
    key_cols = ["__id", "__text1", "__text2"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = {"__id": F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)), "__text1": F.xxhash64(text),
             "__text2": F.xxhash64(F.lit(1), text)}
    lines = docs.select(*[c.alias(k) for k, c in keyed.items()],
                        F.posexplode(F.split(text, "\n", -1)).alias("__pos", "__line"))
    lines = lines.withColumn("__line", line_key("__line")).where(F.char_length("__line") >= min_chars)
    hashed = lines.select(*key_cols, "__pos", F.concat(F.hex(F.xxhash64("__line")), F.lit("-"),
                                                       F.hex(F.xxhash64(F.lit(1), "__line"))).alias("__hash"))
    hashed = keep(hashed, "line-hashes")
    shared = hashed.groupBy("__hash").agg(F.count_distinct("__id").alias("__docs"), F.min("__id").alias("__keeper"),
                                          F.count(F.lit(1)).alias("__rows"))
    shared = keep(shared.where(F.col("__docs") >= min_docs).drop("__docs"), "shared-lines")
    found = lookup(hashed, shared, "__hash", "__rows", F.xxhash64("__id", "__pos"))
    drops = found.where(F.col("__id") != F.col("__keeper")).groupBy(*key_cols).agg(
        F.collect_set("__pos").alias("__drops"))

    plain = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.select(*plain, *[c.alias(k) for k, c in keyed.items()]).join(drops, key_cols, "left")
    split = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__drops"))
    rebuilt = F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")
    new_text = F.when(F.col("__drops").isNull(), text).otherwise(rebuilt)
    return joined.select(*[new_text.alias(c) if c == text_col else F.col(c) for c in plain],
                         F.size(split).cast("long").alias("n_lines"),
                         F.coalesce(F.size("__drops"), F.lit(0)).cast("long").alias("n_dropped"))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
