"""The query and its blocks against the library."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import tiktoken

from tillroll.llm import byte_bpe
from tillroll.llm.registry import queries

SF_DIR = "/root/testdata/sf0.001"


def expected(rows):
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("whole", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc_id, text in rows:
        ids = encoding.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out)


def test_query_equals_the_library(spark):
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    before = {t.name for t in spark.catalog.listTables()}
    found = sorted(tuple(r) for r in queries()["op8_byte_bpe"](spark, SF_DIR).collect())
    assert found == expected(zip(table["doc_id"], table["text"]))
    assert {t.name for t in spark.catalog.listTables()} == before  # no table is left behind


def test_more_than_a_thousand_blocks_in_a_partition(spark):
    """Blocks of one row each, 1,200 in a partition, and fewer buckets than blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        rows = [(i, f"word{i}") for i in range(2400)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
        ranks = byte_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
        found = sorted(tuple(r) for r in byte_bpe.digests(docs, ranks, P.PATTERN).collect())
    finally:
        spark.conf.set(key, before)
    assert found == expected(rows)
