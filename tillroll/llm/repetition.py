"""Quality rule: repeated text inside a document, from a suffix array over its words.

Neighbours in the suffix array with their longest common prefixes (LCP) span the LCP intervals. The deepest
interval that holds a suffix has the larger of the suffix's two neighbouring LCP values; that many words from
there on are the longest substring found again elsewhere in the text. Maximal repeated substrings are those that
no span starting a word earlier covers. The rule limits the share of words that the spans cover together, and
the longest repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import starts, text_bytes, with_columns, words

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))

#: Production limits: repeats of 10 words or more count, may cover 30 % of the words, and have 100 words at most.
MIN_WORDS, MAX_COVERED_PCT, MAX_REPEAT = 10, 30, 100

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long, spans array<struct<start: long, stop: long>>")


def longest_repeats(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word of each document, how many words from it on occur again in the same document.

    ``codes`` are the words of all documents in turn, ``counts`` the words of each. The suffix array comes from
    prefix doubling that sorts only suffixes not yet told apart; ranks of all rounds give the LCP values. Memory is
    4 bytes a word and round; rounds are the logarithm of the longest repeat.
    """
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    key = doc * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int32)
    rank[order] = _group_starts(key[order])
    levels, width = [rank], 1
    active = order[_repeated(rank[order])]
    while len(active):
        after = active + width
        inside = after < ends[active]
        second = np.where(inside, rank[np.where(inside, after, 0)].astype(np.int64) + 1, 0)
        key = rank[active].astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        rank = rank.copy()
        rank[active] = old + (_group_starts(key) - _group_starts(old))
        levels.append(rank)
        width *= 2
        active = active[_repeated(rank[active])]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)  # lcp[j]: of the suffixes j - 1 and j
    pairs = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]]) + 1
    if len(pairs):
        a, b = suffixes[pairs - 1], suffixes[pairs]
        room = np.minimum(ends[a] - a, ends[b] - b)
        common = np.zeros(len(pairs), np.int64)
        for level in reversed(range(len(levels))):
            inside = common < room
            x, y = np.where(inside, a + common, 0), np.where(inside, b + common, 0)
            common += np.where(inside & (levels[level][x] == levels[level][y]), 1 << level, 0)
        lcp[pairs] = common
    found = np.empty(n, np.int64)
    found[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return found


def _group_starts(ordered: np.ndarray) -> np.ndarray:
    """For each item of a sorted array, where the run of its value begins."""
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    begins = np.flatnonzero(first)
    return np.repeat(begins, np.diff(np.append(begins, len(ordered)))).astype(np.int32)


def _repeated(ordered: np.ndarray) -> np.ndarray:
    same = np.zeros(len(ordered) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    return same[1:] | same[:-1]


def _covered(found: np.ndarray, least: int, length: int | None = None) -> np.ndarray:
    """Whether each word is in a span of at least ``least`` words (of just ``length`` words, if given)."""
    at = np.flatnonzero(found >= least)
    edge = np.zeros(len(found) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + (found[at] if length is None else length), 1)
    return np.cumsum(edge)[:-1] > 0


def measure(texts: pa.Array, min_words: int) -> list:
    """The columns ``FIELDS`` of a slice of texts."""
    codes, counts, _ = words(texts)
    found = longest_repeats(codes, counts)
    begin = starts(counts)
    per_doc = lambda x: np.diff(starts(x)[begin])
    windows = per_doc(_covered(found, 5, 5).astype(np.int64))
    covered = _covered(found, min_words)
    longest = np.zeros(len(counts), np.int64)
    full = counts > 0
    if full.any():
        longest[full] = np.maximum.reduceat(found, begin[:-1][full])
    edge = covered.copy()
    edge[1:] &= ~covered[:-1]
    edge[begin[:-1][full]] |= covered[begin[:-1][full]]
    first = np.flatnonzero(edge)
    bounds = np.append(np.flatnonzero(edge | ~covered), len(covered))
    stop = bounds[np.searchsorted(bounds, first, "right")] if len(first) else first
    owner = np.searchsorted(begin, first, "right") - 1
    shift = begin[owner] if len(first) else first
    spans = pa.ListArray.from_arrays(
        np.searchsorted(first, begin).astype(np.int32),
        pa.StructArray.from_arrays([pa.array(first - shift), pa.array(stop - shift)], ["start", "stop"]))
    chars, symbols, lines = [], [], []
    for value in texts.to_pylist():
        data = text_bytes(value)
        chars.append(len(data.translate(None, SPACES + CONTINUATION)))
        symbols.append(len(data) - len(data.translate(None, SYMBOLS)))
        full_lines = [x for x in data.split(b"\n") if x and not x.isspace()]
        lines.append(len(full_lines) - len(set(full_lines)))
    return [counts, chars, symbols, lines, windows, per_doc(covered.astype(np.int64)), longest, spans]


def repetition(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS,
               max_covered_pct: int = MAX_COVERED_PCT, max_repeat: int = MAX_REPEAT,
               keep_columns: list[str] | None = None) -> DataFrame:
    """Adds the measures ``FIELDS``, ``base_failed`` and ``kept`` to each row, the whole text measured.

    ``kept`` is false if the base rules fail, if repeats of ``min_words`` words or more cover over
    ``max_covered_pct`` percent of the words, or if a repeat is longer than ``max_repeat`` words. ``spans`` are the
    covered stretches, in words. NULL and empty texts have no words and fail. Rows are judged alone: repeated ids,
    ties and NULL ids change nothing, and no row is dropped.
    """
    out = with_columns(docs, text_col, FIELDS, lambda texts: measure(texts, min_words), keep_columns)
    out = out.withColumn("base_failed", (F.col("n_words") < 10)
                         | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("longest_repeat") <= max_repeat)
                          & (100 * F.col("covered_words") <= max_covered_pct * F.col("n_words")))


def op1_suffix_repetition(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repetition(docs, keep_columns=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", (F.col("longest_repeat") > MAX_REPEAT).alias("too_long"))


def _window_sql(name: str, size: int) -> str:
    return f"""
{name} AS (
  SELECT doc_id, unnest(places) AS i FROM (
    SELECT doc_id, list(i) AS places FROM (
      SELECT doc_id, words, unnest(range(1, len(words) - {size - 2})) AS i FROM split)
    GROUP BY doc_id, md5(array_to_string(words[i : i + {size - 1}], ' ')) HAVING count(*) > 1)),
{name}_words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM {name}, range({size}) t(k) GROUP BY doc_id)"""


OP1_SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
{_window_sql("five", 5)},
{_window_sql("repeat", MIN_WORDS)},
{_window_sql("long", MAX_REPEAT + 1)},
measured AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
         - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))
           AS n_dup_lines,
         coalesce(five_words.n, 0) AS n_repeat_words, coalesce(repeat_words.n, 0) AS covered_words,
         long_words.n IS NOT NULL AS too_long
  FROM split LEFT JOIN five_words USING (doc_id) LEFT JOIN repeat_words USING (doc_id)
       LEFT JOIN long_words USING (doc_id)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT too_long AND 100 * covered_words <= {MAX_COVERED_PCT} * n_words AS kept,
       covered_words, too_long
FROM based
"""
