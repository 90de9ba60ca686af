"""The corpus pipeline: language, lines, near copies, benchmark passages, token ids.

Each stage takes the documents that the stage before it kept and returns documents, the last one encoded ones.
Rows are told apart by doc_id and text together; those without a doc_id come after all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import byte_bpe, decontaminate, language, line_dedup, simhash
from tillroll.llm.common import keep, new_path

LAST_ID = (1 << 63) - 1


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages that labels name; ``und`` and uncertain ones go."""
    found = language.identify(docs, language.fit(docs))
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= language.MIN_SCORE)
    return found.where(sure).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that an earlier document has; every document stays, with what is left of its text."""
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the smallest doc_id of each group of texts that share 0.8 of their shingles of five words; of
    rows that repeat both doc_id and text, one. SimHash groups give the first links, an index those beyond two bits."""
    return simhash.drop_repeats(_numbered(docs), "__id").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose own text holds a passage of the benchmark."""
    rows = docs.withColumn("__sha", simhash.text_key())
    found = decontaminate.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "__sha")
    return rows.join(keep(found.select("__sha").distinct(), "contaminated"), "__sha", "left_anti").select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document in place of its text, and digests of them and of what they decode to."""
    import public_tokenizers
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, with_decoded=True)
    return encoded.withColumns({
        "n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_sha256": F.sha2("ids", 256),
        "decoded_sha256": F.sha2("decoded", 256)}).drop("decoded")


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_tokens),
]

#: The network, the fingerprints and the encoding are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
