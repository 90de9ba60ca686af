"""Operators on small tables: against brute force, and with NULLs, empty texts, ties, repeated rows, extra columns."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tillroll.llm import byte_bpe, decontaminate, language, line_dedup, registry, repetition, sharding, simhash, token_ids, toxicity, warc
from tillroll.llm.common import lookup, maybe_among, new_path

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "\n\n", "one two", "a b c d e f g h i j k l", "The same line here\nother", "the same line here \nz",
         "x " * 5000, "é ñ 漢字 ½  　 tail", "the same line here", None, ""]


@pytest.fixture(scope="module")
def odd(spark):
    """Edge cases with NULL and repeated ids, repeated rows and columns whose names operators use."""
    rows = [(k if k != 3 else None, t, "en" if k % 2 else None, k) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [rows[4], rows[4]], "doc_id long, text string, lang string, n_lines long")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = registry.queries()[name](spark, SF)
    wanted = duck.sql(registry.oracle_sql()[name])
    places = [list(wanted.columns).index(c) for c in found.columns]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        str(tuple(row[k] for k in places)) for row in wanted.fetchall())


def test_longest_repeats_equal_brute_force():
    def brute(words):
        out = [0] * len(words)
        for i in range(len(words)):
            for j in range(len(words)):
                n = 0
                while i != j and max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                    n += 1
                out[i] = max(out[i], n)
        return out

    rng = random.Random(1)
    for _ in range(100):
        some = [[rng.randrange(rng.choice([1, 2, 9])) for _ in range(rng.randrange(25))] for _ in range(rng.randrange(1, 5))]
        codes = np.array([w for d in some for w in d], np.int64)
        found = repetition.longest_repeats(codes, np.array([len(d) for d in some]))
        assert found.tolist() == [n for d in some for n in brute(d)]


def test_repetition_edge_cases(odd):
    rows = repetition.repetition(odd).collect()
    assert len(rows) == odd.count()
    by_text = {r.text: r for r in rows}
    assert by_text[None].base_failed and not by_text[None].kept and by_text[None].spans == []
    assert by_text["a b c d e f g h i j k l"].kept
    assert by_text["x " * 5000].longest_repeat == 4999 and not by_text["x " * 5000].kept
    assert [(s.start, s.stop) for s in by_text["x " * 5000].spans] == [(0, 5000)]
    assert repetition.repetition(odd.limit(0)).count() == 0


def test_line_dedup_edge_cases(spark, odd):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == odd.count() and "n_lines" in rows[0]
    kept = {(r.doc_id, r.text): r.n_dropped for r in rows}
    assert kept[(6, "The same line here\nother")] == 0 and kept[(7, "z")] == 1 and kept[(10, "")] == 1
    assert all(r.text == "" and r.n_lines == 1 for r in rows if r.doc_id in (0, 1))
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_lookup_equals_left_join_on_hot_keys(spark, monkeypatch):
    monkeypatch.setattr("tillroll.llm.common.HOT_KEYS", 2)
    left = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 9)).alias("k"))
    groups = left.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("v"))
    found = {r.id: r.v for r in lookup(left, groups, "k", "n", F.col("id")).collect()}
    assert found == {r.id: r.v for r in left.join(groups, "k", "left").collect()} and len(found) == 300


def test_warc_ranges_digests_and_false_magic(spark):
    rows = [(1, "u", "same"), (2, "u\r\n", "same"), (3, None, None), (4, "u", ""), (None, "u", "same"), (5, "u", "é" * 9000), (6, "u", "x" * (17 << 20))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = new_path(spark, "warc-test")
    warc.write_warc(pages, path)
    for size in (37, 1000, 1 << 25):
        found = warc.read_warc(spark, path, range_bytes=size).collect() if size > 37 else warc.read_warc(spark, path, size, False).collect()
        assert sorted((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes) for r in found) == [
            (-1, "revisit", 1, 4), (1, "response", None, 4), (2, "revisit", 1, 4), (3, "response", None, 0), (4, "revisit", 3, 0),
            (5, "response", None, 18000), (6, "response", None, 17 << 20)]
    assert warc.sha1_base32(b"same") in {r.payload_digest for r in found}
    warc.write_warc(pages.limit(0), empty := new_path(spark, "warc-empty"))
    assert warc.read_warc(spark, empty).count() == 0


def test_token_ids_equal_the_library(spark, docs):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    before = 0
    for doc_id, start, n, crc in sorted(token_ids.op4_token_ids(spark, SF).collect()):
        ids = library.encode(docs[doc_id] or "", add_special_tokens=False).ids + [token_ids.END_ID]
        assert (start, n, crc) == (before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        before += n


def test_word_encoder_on_odd_words(monkeypatch):
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as file:
        text = file.read()
    library = Tokenizer.from_str(text)
    library.encode_special_tokens = True
    rng = random.Random(3)
    letters = [chr(c) for c in range(33, 0x250)] + list("ΣσİéÀ漢字́🙂½²'''stremdv<|>")
    words = list({"".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(3000)} | {"<|endoftext|>", "WE'LL'D"})
    wanted = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(words, add_special_tokens=False)]
    assert token_ids.WordEncoder(text, "<u2").encode(words) == wanted
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 500)
    small = token_ids.WordEncoder(text, "<u2")
    for at in (0, 400, 200, 0, 2000, 0):  # words that come back from the older generation, and forgotten ones
        assert small.encode(words[at: at + 400]) == wanted[at: at + 400]


def test_token_ids_keep_added_tokens(spark):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ["a <|endoftext|> b", "foo<|startoftext|>Bar's é<|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "漢<|endoftext|>字 plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, width = token_ids.tokenize(docs, library.to_str(), "text", ["doc_id"])
    for r in rows.collect():
        wanted = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, width).tolist() == wanted + [token_ids.END_ID]


def test_rank_coding_round_trip():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, 7, 2 ** 32 - 1], np.uint32)
    counts = np.array([3, 0, 5])
    control, data = token_ids.code_ranks(ranks, counts)
    found, used = token_ids.decode_ranks(control, np.frombuffer(b"".join(data.to_pylist()), np.uint8), counts)
    assert found.tolist() == ranks.tolist() and used == sum(map(len, data.to_pylist()))


def test_token_ids_edge_cases(spark, odd):
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer_json = file.read()
    token_ids.write_ids(odd, path := new_path(spark, "ids-test"), tokenizer_json)
    rows = token_ids.read_ids(spark, path).orderBy("start").collect()
    assert len(rows) == odd.count() and rows[0].start == 0
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
    token_ids.write_ids(odd.limit(0), empty := new_path(spark, "ids-empty"), tokenizer_json)
    assert token_ids.read_ids(spark, empty).count() == 0


def test_language_held_out_accuracy(spark, odd):
    found = language.op5_language_cnn(spark, SF)
    rows = found.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held)
    model = language.train([("en", "the and of"), ("fr", "le la et")])
    assert all(r.lang_pred == "und" and r.score == 0 for r in language.identify(odd, model).collect() if not (r.text or "").strip())
    assert language.identify(odd, None).where("lang_pred <> 'und'").count() == 0
    assert language.identify(odd.limit(0), model).count() == 0


def test_toxicity_learns_and_shares_misspellings():
    rng = random.Random(5)
    clean = [" ".join(rng.choices(["tree", "house", "river", "stone", "cloud", "green"], k=40)) for _ in range(120)]
    bad = [" ".join(rng.choices(["tree", "house", "river", "stone", "cloud", "green"], k=40) + ["worthless", "idiot"]) for _ in range(120)]
    model = toxicity.train(clean + bad, [0] * 120 + [1] * 120)
    score = toxicity.score(model, pa.array(["you worthles idiots", "tree house", None, "", "cloud " * 3000 + "idiot"]))[0]
    assert score[0] > 0.7 and score[4] > 0.7 and max(score[1:4]) < 0.7
    assert toxicity.score(None, pa.array(["a", None]))[0].tolist() == [0, 0]


def test_toxicity_scores_every_start():
    rng = np.random.default_rng(5)
    names = ["sun", "you", "tree", "idiots", "a", "worthless"]
    model = {"gram": rng.normal(0, 3, toxicity.BUCKETS), "bias": -0.5}
    texts = [" ".join(rng.choice(names, n)) for n in (0, 1, 5, 7, 8, 9, 10, 40, 300)] + [None]
    weight = {}
    for name in names:
        bucket, _ = toxicity.grams([name])
        weight[name] = model["gram"][bucket].mean()
    for text, got in zip(texts, toxicity.score(model, pa.array(texts))[0]):
        each = [weight[w] for w in (text or "").split()]
        windows = [each[k: k + n] for n in range(1, 9) for k in range(len(each) - n + 1)] or [[]]
        assert got == pytest.approx(1 / (1 + np.exp(-(max(sum(w) for w in windows) / 8 - 0.5))))


def test_toxicity_verdict_holds_wherever_the_phrase_stands():
    rng = np.random.default_rng(1)
    neutral = ["tree", "house", "walk", "river", "green", "music", "paper", "cloud"]
    clean = [" ".join(rng.choice(neutral, 40)) for _ in range(120)]
    bad = [f"{t} you worthless idiots {t}" for t in clean]
    model = toxicity.train(clean + bad, [0] * 120 + [1] * 120)
    tail = " ".join(rng.choice(neutral, 30))
    moved = [" ".join([*rng.choice(neutral, k), "you worthless idiots", tail]) for k in range(8, 30)]
    plain = [" ".join(rng.choice(neutral, 40 + k)) for k in range(22)]
    assert (toxicity.score(model, pa.array(moved))[0] >= toxicity.THRESHOLD).all()
    assert (toxicity.score(model, pa.array(plain))[0] < toxicity.THRESHOLD).all()


def test_toxicity_of_odd_and_empty_tables(spark, odd):
    model = {"gram": np.zeros(toxicity.BUCKETS), "bias": -1.0}
    clashing = odd.withColumn("score", F.lit("mine"))
    rows = toxicity.rate(clashing, model).collect()
    assert len(rows) == odd.count() and sorted(rows[0].asDict()) == sorted(clashing.columns)
    assert {round(r.score, 6) for r in rows} == {round(1 / (1 + np.e), 6)}
    assert toxicity.rate(odd.limit(0), model).count() == 0
    assert {r.score for r in toxicity.rate(odd, None).collect()} == {0.0}


def test_toxicity_trains_on_whole_texts_only(spark):
    docs = spark.createDataFrame([(0, "short one"), (1, "y" * (toxicity.SAMPLE_CHARS + 1)), (2, None), (3, "")], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    held = {k for k in range(4) if zlib.crc32(str(k).encode()) % 3 == 1}
    texts, _ = toxicity.training_sample(docs, labels)
    assert sorted(texts) == sorted(t for k, t in [(0, "short one"), (3, "")] if k not in held)
    assert toxicity.training_sample(docs, labels.limit(0)) == ([], [])


def test_toxicity_query_holds_out_and_finds_labels(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = toxicity.op6_subword_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= toxicity.THRESHOLD)
    clean = [r.predicted for r in rows if truth.get(r.doc_id) == 0]
    assert np.mean(clean) < 0.1


def _fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i: i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _least_reached(prints):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in prints}


def test_simhash_equals_brute_force(spark, docs):
    prints = {d: _fingerprint(t) for d, t in docs.items()}
    reached = _least_reached(sorted(set(prints.values())))
    least = {}
    for d, f in prints.items():
        least[reached[f]] = min(d, least.get(reached[f], d))
    rows = simhash.op7_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(d, f"{f:016x}", least[reached[f]]) for d, f in prints.items()}


@pytest.mark.parametrize("block", [2, 64])
def test_simhash_dense_groups(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(2)
    prints = set()
    for base in (rng.getrandbits(64) for _ in range(3)):
        for _ in range(80):
            x = base
            for k in rng.sample(range(64), rng.randrange(4)):
                x ^= 1 << k
            prints.add(x - (1 << 64) if x >> 63 else x)
    found = simhash.components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")))
    roots = {r.node: r.root for r in found.collect()}
    wanted = _least_reached(sorted(prints))
    assert all(roots.get(p, p) == wanted[p] for p in prints)


def test_simhash_edge_cases(spark, odd):
    rows = simhash.group_near_duplicates(simhash.with_fingerprints(odd)).collect()
    assert len(rows) == odd.count() and all(r.component_id == 0 for r in rows if not (r.text or "").strip())
    assert simhash.group_near_duplicates(simhash.with_fingerprints(odd.limit(0))).count() == 0


def _jaccard(a, b):
    a, b = ({tuple(t.split()[i: i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(a & b) / len(a | b)


def test_similar_texts_have_one_representative(spark, odd):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    base = [[word() for _ in range(160)] for _ in range(30)]
    rows = [(k, " ".join(b)) for k, b in enumerate(base)]
    for n in range(150):  # single copies, and one large group whose members all differ
        k = n if n < 20 else 25
        copy = list(base[k])
        copy[rng.randrange(160)] = word()
        rows.append((100 + n, " ".join(copy)))
        assert _jaccard(rows[k][1], rows[-1][1]) >= simhash.SIMILARITY
    half = base[29][:80] + [word() for _ in range(80)]
    rows += [(400, " ".join(half)), (401, rows[3][1]), (402, " ".join(base[4]).upper())]
    found = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    assert sorted(r.doc_id for r in found) == [*range(30), 400]
    ids = [r.doc_id for r in simhash.representatives(odd.where("doc_id is not null"), "doc_id").collect()]
    assert len(ids) == len(set(ids)) and {0, 4, 5, 6, 7, 8, 9} <= set(ids) and not {1, 2, 11, 12} & set(ids)
    assert simhash.representatives(odd.limit(0), "doc_id").count() == 0


def test_similar_links_are_exact(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    shared = [word() for _ in range(40)]  # a passage under whose shingles unlike texts lie between near copies
    texts = [[*(word() for _ in range(20)), *shared, *(word() for _ in range(20))] for _ in range(40)]
    for n in range(160):  # copies with some words replaced: similarities on both sides of 0.8
        copy = list(texts[n % 40])
        for at in rng.sample(range(len(copy)), rng.choice([1, 2, 2, 3])):
            copy[at] = word()
        texts.append(copy)
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if _jaccard(texts[a], texts[b]) >= simhash.SIMILARITY:
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    found = simhash.representatives(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id")
    assert sorted(r.doc_id for r in found.collect()) == sorted(set(root)) and len(set(root)) > 45


def test_repeated_shingles_count_once(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    phrase = " ".join(word() for _ in range(6))
    texts = [" ".join([phrase] * 200 + [word() for _ in range(60)]) for _ in range(6)]  # one phrase repeated, else unlike
    base = [word() for _ in range(204)]  # 200 shingles
    just, under = list(base), list(base)
    for at in (0, 5, 50, 100, 150):  # replaced: 1 + 4 * 5 = 21 shingles of 200
        just[at] = word()
    for at in (20, 50, 100, 150, 180):
        under[at] = word()
    texts += [" ".join(base), " ".join(just), " ".join(under)]
    ids = sorted(r.doc_id for r in simhash.representatives(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id").collect())
    linked = {(a, b) for a in range(9) for b in range(a) if _jaccard(texts[a], texts[b]) >= simhash.SIMILARITY}
    assert ids == [k for k in range(9) if not any(a == k for a, _ in linked)] and ids[:6] == list(range(6))


def test_near_dedup_starts_from_simhash_groups(spark, monkeypatch):
    rng = random.Random(14)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    texts = [" ".join(word() for _ in range(400)) for _ in range(4)]
    close, far = texts[0], texts[1].split()
    while close == texts[0] or (_fingerprint(close) ^ _fingerprint(texts[0])).bit_count() > 2:
        close = texts[0].rsplit(" ", 1)[0] + " " + word()
    while (_fingerprint(" ".join(far)) ^ _fingerprint(texts[1])).bit_count() <= 2:
        far[rng.randrange(400)] = word()
    phrase = " ".join(word() for _ in range(5))  # one fingerprint, unlike texts
    alike = [" ".join([phrase] * 900 + [word() for _ in range(60)]) for _ in range(2)]
    assert (_fingerprint(alike[0]) ^ _fingerprint(alike[1])).bit_count() <= 2
    assert _jaccard(texts[1], " ".join(far)) >= simhash.SIMILARITY > _jaccard(*alike)
    texts += [close, " ".join(far), *alike]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    seen, verified = [], simhash._verified

    def spy(pairs, nodes, *rest):
        ids = {r.node: r.id for r in nodes.select("node", "row.id").collect()}
        seen.append({tuple(sorted((ids[r.a], ids[r.b]))) for r in pairs.collect()})
        return verified(pairs, nodes, *rest)

    monkeypatch.setattr(simhash, "_verified", spy)
    near = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF)
    assert sorted(r.doc_id for r in near.collect()) == [0, 1, 2, 3, 6, 7]
    assert seen[0] == {(0, 4), (6, 7)} and (1, 5) in seen[1] and (0, 4) not in set().union(*seen[1:])


def test_only_marked_keys_need_a_join(spark):
    rows = spark.range(5000).selectExpr("id", "concat('k', id) AS sha")
    wanted = rows.where("id % 50 = 0")
    marked = maybe_among(rows, wanted, ["id", "sha"])
    assert "hashpartitioning(id" not in marked._jdf.queryExecution().toString()
    found = {r.id for r in marked.where("maybe").collect()}
    assert found >= set(range(0, 5000, 50)) and len(found) < 110
    assert marked.count() == 5000 and maybe_among(rows, wanted.limit(0), ["id", "sha"]).where("maybe").count() == 0


def test_rows_of_one_id_are_told_apart(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(12)]
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first().text
    texts += [texts[0], texts[1] + " x", leak]
    docs = spark.createDataFrame([(None if k % 3 else 5, t, "en", "s", len(t)) for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    near = stages["near_dedup"](spark, docs, SF)
    kept = [r.text for r in near.collect()]
    assert len(kept) == 13 and set(texts[2:12]) | {texts[0], leak} <= set(kept) and len({texts[1], texts[13]} & set(kept)) == 1
    assert sorted(r.text for r in stages["decontamination"](spark, near, SF).collect()) == sorted(set(kept) - {leak})


def test_byte_bpe_equals_tiktoken(spark, odd):
    ranks = byte_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    letters = "ab'stTvé 漢1²\n\n\t  　\x85\x1c\x1f!?-_🙂́Σ\r"
    more = [(100 + i, "".join(rng.choices(letters, k=rng.randrange(60))), None, None) for i in range(500)]
    docs = odd.union(spark.createDataFrame(more, odd.schema))
    wanted = sorted((t or "", n) for (t,), n in ((r, 1) for r in docs.select("text").collect()))
    encoded = byte_bpe.encode(docs.withColumn("copy", F.col("text")), ranks, P.PATTERN)
    rows = byte_bpe.decode(encoded, ranks).collect()
    assert sorted(((r["copy"] or ""), 1) for r in rows) == wanted
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r["copy"] or "")
        assert r.decoded.decode() == (r["copy"] or "")
    assert byte_bpe.encode(odd.limit(0), ranks, P.PATTERN).count() == 0


def test_decontamination_finds_edited_passages(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([12, 25, 60, 300])] + [(9, None), (10, "ab")]
    docs = [(k, " ".join(word() for _ in range(200)), "x") for k in range(20)]
    for k, (item, text) in enumerate(items[:4]):
        text = list(text)
        for at in rng.sample(range(len(text)), int(decontaminate.EDITS * min(len(text), 100))):
            text[at] = "#"
        docs.append((100 + item, docs[k][1] + " " + "".join(text).upper() + "\n" + docs[k + 1][1], "x"))
    docs += [(None, items[2][1], "x"), (1, None, "x"), (2, "", "x"), (50, "ab", "x")]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string, place string"),
                                       spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(100, 0), (101, 1), (102, 2), (103, 3), (None, 2)}


def test_passages_with_early_edits_are_found():
    rng = random.Random(14)
    item = "".join(rng.choices("abcdefghij ", k=300)).replace("  ", "ab")
    item = decontaminate.normalize(item)
    (index,) = decontaminate.build([(1, item)])
    for begin, size, edits in [(0, 110, (7, 15, 23)), (40, 100, (7, 15, 23)), (90, 101, (3, 9, 17, 25)), (len(item) - 100, 100, (7, 15, 23)),
                               (20, 120, (5, 12, 20, 28, 36, 44)), (0, 100, (5, 12, 20, 28, 36, 44, 52, 60, 68))]:
        part = list(item[begin: begin + size])
        for at in edits:
            part[at] = "#"
        text = "".join(rng.choices("klmnopqrst", k=50)) + "".join(part) + "".join(rng.choices("klmnopqrst", k=50))
        points = decontaminate._points(text)
        brute = any(decontaminate.banded_distance(decontaminate._points(item[k: k + 100]), points, 50 + k - begin - 50, 200, 6) <= 6
                    for k in range(max(0, begin - 12), min(len(item) - 100, begin + size - 88) + 1))
        assert bool(decontaminate.matches(index, points, decontaminate._grams(points))) == brute == (len(edits) < 9)


def test_decontamination_equals_containment(spark, docs):
    items = {r.item_id: decontaminate.normalize(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, b in items.items() if b in decontaminate.normalize(t)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.op3_qgram_decontamination(spark, SF).collect()} >= whole


def test_banded_distance_equals_plain_distance():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.randrange(3) for _ in range(n)] for n in (rng.randrange(1, 12), rng.randrange(1, 20)))
        row = [0] * (len(b) + 1)
        for c in a:
            new = [row[0] + 1]
            for j, d in enumerate(b):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        assert decontaminate.banded_distance(np.array(a), np.array(b), 0, 40, 99) == min(row)


def test_shards_are_even_boxes(spark, docs):
    rows = sharding.op10_kd_sharding(spark, SF).collect()
    assert len(rows) == len(docs)
    weight, slots = {}, {}
    for r in rows:
        text = (docs[r.doc_id] or "").encode()
        assert r["size"] == len(text) + 16 and r.text_crc32 == zlib.crc32(text) and r.law == "bytes"
        weight[r.shard] = weight.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    mean, largest = sum(weight.values()) / 40, max(r["size"] for r in rows)
    assert set(weight) <= set(range(40)) and max(weight.values()) <= mean + largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_texts_share_a_shard_where_sizes_allow(spark, docs):
    rows = sharding.op10_kd_sharding(spark, SF).collect()
    groups, mean = {}, sum(r["size"] for r in rows) / 40
    for r in rows:
        groups.setdefault(docs[r.doc_id] or "", []).append(r)
    small = [g for g in groups.values() if len(g) > 1 and sum(r["size"] for r in g) <= sharding.GROUP_TOLERANCE * mean]
    apart = sum(len({r.shard for r in g}) > 1 for g in groups.values() if len(g) > 1)
    assert all(len({r.shard for r in g}) == 1 for g in small) and apart <= 39


def test_shards_below_the_driver(spark, monkeypatch):
    frame = spark.range(3000).selectExpr("id", "id * 7919 % 1009 AS x", "IF(id % 3 = 0, 5, id * 31 % 640) AS y", "id % 40 AS g", "id % 90 + 10 AS w")
    by_size = {}
    for nodes in (256, 4):
        monkeypatch.setattr(sharding, "DRIVER_NODES", nodes)
        rows = sharding.shard_rows(frame, [F.col("x"), F.col("y")], F.col("w"), F.col("id"), 11, group=F.col("g")).collect()
        by_size[nodes] = {r.id: (r.shard, r.slot) for r in rows}
    assert by_size[256] == by_size[4] and len({s for s, _ in by_size[4].values()}) == 11


def test_slots_of_many_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ALL_PARTS", 3)  # fewer than shards: a shard's slots are numbered by one task
    rows = sharding.shard_rows(spark.range(500), [F.col("id")], F.lit(1), F.col("id"), 4)
    for r in rows.groupBy("shard").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert list(r[1]) == list(range(len(r[1])))


def test_shards_are_those_of_a_plain_tree(spark):
    rng = random.Random(8)
    points = [(k, rng.randrange(1 << 20), rng.randrange(1 << 12)) for k in range(2000)]
    found = sharding.shard_rows(spark.createDataFrame(points, "id long, x long, y long"), [F.col("x"), F.col("y")], F.lit(1), F.col("id"), 16)

    def plain(rows, first, shards, spans):
        if shards == 1:
            return {r[0]: first for r in rows}
        widths = [(max(r[d] for r in rows) - min(r[d] for r in rows)) / spans[d] for d in (1, 2)]
        dim = 1 if widths[0] >= widths[1] else 2
        cut = sorted(r[dim] for r in rows)[len(rows) // 2 - 1]
        low, high = [r for r in rows if r[dim] <= cut], [r for r in rows if r[dim] > cut]
        return plain(low, first, shards // 2, spans) | plain(high, first + shards // 2, shards // 2, spans)

    wanted = plain(points, 0, 16, (1, 1 << 20, 1 << 12))
    same = sum(wanted[r.id] == r.shard for r in found.collect())
    assert same >= 1940, same  # values that several rows share are cut between those rows


def test_sharding_edge_cases(spark, odd):
    dims = [F.char_length("text"), F.col("n_lines")]
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    found = sharding.shard_rows(odd, dims, size, F.struct("doc_id", "n_lines"), target_bytes=6000)
    assert found.count() == odd.count() and found.columns == [*odd.columns, "shard", "slot"]
    assert sharding.shard_rows(odd.limit(0), dims, size, F.struct("doc_id"), 4).count() == 0
    same = spark.range(4000).select(F.lit(7).alias("v"), "id")
    even = sharding.shard_rows(same, [F.col("v")], F.lit(1), F.col("id"), 5).groupBy("shard").count().collect()
    assert len(even) == 5 and all(780 <= r["count"] <= 820 for r in even)


def test_pipeline_stages_take_effect(spark, docs):
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert 0 < len(rows) <= len(docs)
    leaks = {r.doc_id for r in decontaminate.op3_qgram_decontamination(spark, SF).collect()}
    assert not leaks & set(rows)
    for r in rows.values():
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() and len(r.ids) == 4 * r.n_tokens


def test_pipeline_stages_on_odd_rows(spark, odd):
    odd = odd.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for _, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count()
            assert stage is corpus_pipeline.STAGES[-1][1] or out.columns == docs.columns
    near = dict(corpus_pipeline.STAGES)["near_dedup"](spark, odd, SF)
    assert near.where("trim(coalesce(text, '')) = ''").count() <= 2


def plain_contains(pattern: str, text: str, limit: int) -> bool:
    """Whether some stretch of ``text`` is within ``limit`` edits of ``pattern``, by the whole table of distances."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1)
    return min(row) <= limit


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(23)
    letters = "abcdefghijklmnopqrstuvwxyz "

    def text(n):
        return decontaminate.normalize("".join(rng.choices(letters, k=n))).ljust(n, "q")

    def edited(passage, edits):
        out = list(passage)
        for _ in range(edits):
            k = rng.randrange(len(out))
            out[k: k + 1] = rng.choice([[], ["#"], [out[k], "#"]])
        return "".join(out)

    items = [text(40), text(70), text(103), None, "short"]
    bodies = [text(60) + edited(item[a: a + 100], edits) + text(40)
              for item in items[:3] for a in (0, 3) for edits in (0, 2, 4, 6, 8, 11)] + [None, "", text(150)]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    wanted = set()
    for n, body in enumerate(bodies):
        for k, item in enumerate(items):
            if item is None or body is None or len(item) < decontaminate.Q:
                continue
            span = min(len(item), decontaminate.SPAN)
            limit = int(decontaminate.EDITS * span)
            plain, whole = decontaminate.normalize(item), decontaminate.normalize(body)
            if any(plain_contains(plain[a: a + span], whole, limit) for a in range(len(plain) - span + 1)):
                wanted.add((n, k))
    found = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()]
    assert sorted(found) == sorted(wanted) and 10 < len(wanted) < len(bodies)
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


def test_decontamination_by_blocks(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefgh", k=90)) for _ in range(30)]
    items = [(k % 25, t) for k, t in enumerate(texts)] + [(7, texts[7]), (None, texts[3]), (99, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(k, "w " + t + " w", "x") for k, t in enumerate(texts)], "place long, text string, item_id string")
    wanted = sorted([(k, k % 25) for k in range(30)] + [(3, -1)])
    for size in (8 << 20, 300):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        found = decontaminate.contaminated(docs, benchmark, id_col="place")
        assert found.columns == ["doc_id", "item_id", "place", "length", "edits"]
        assert sorted((r.doc_id, -1 if r.item_id is None else r.item_id) for r in found.collect()) == wanted
    named = benchmark.select(F.concat(F.lit("b"), "item_id").alias("item_id"), "text")
    assert {r.item_id for r in decontaminate.contaminated(docs, named, id_col="item_id").collect()} == {None, *(f"b{k}" for k in range(25))}
