import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalog_sync.llm import packing, registered, tokens
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(BPE)


def test_both_libraries_agree_on_every_character(own):
    encode = tokens._load(BPE)
    points = [c for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(points), 4096):
        texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 .{chr(c)}! {chr(c)} \n{chr(c)}\t'{chr(c)}s {chr(c)}" for c in points[at:at + 4096]]
        for ids, e in zip(encode(texts), own.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            assert ids.tolist() == e.ids


def test_encoder_on_random_and_special_texts(own):
    rng = random.Random(3)
    parts = ["<|endoftext|>", " ", "  ", "\n", "\t", "word", "Wörter", "don't", "12345", "…", "🙂", "\U000e0001", "a" * 300, "　", "'s", "x9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["", " ", "\x00", "long " * 250_000]
    for ids, e in zip(tokens._load(BPE)(texts), own.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == e.ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    path = public_tokenizers.path(name)
    texts = ["Hello world", "", "<s> [INST] ok", "Grüße  !"]
    if name.endswith(".model"):
        import sentencepiece

        want = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)
    else:
        want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tokens._load(path)(texts)] == want


def test_token_counts_query(spark, own):
    rows = registered.op2_token_counts(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        n = len(own.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 512)


def test_cache_encodes_only_distinct_misses(spark, scratch, odd_docs, no_docs, own):
    cache = f"{scratch.path}/cache"
    assert tokens.token_counts(no_docs, BPE, cache, scratch).count() == 0
    first = tokens.token_counts(odd_docs.limit(4).withColumn("n_tokens", F.lit("clash")), BPE, cache, scratch)
    assert first.count() == 4 and dict(first.dtypes)["n_tokens"] == "bigint"
    stored = spark.read.parquet(cache).count()
    assert stored == len({r["text"] or "" for r in odd_docs.limit(4).collect()})
    out = tokens.token_counts(odd_docs, BPE, cache, scratch).collect()
    texts = [r["text"] or "" for r in odd_docs.collect()]
    assert spark.read.parquet(cache).count() == len(set(texts))
    assert sorted(r["n_tokens"] for r in out) == sorted(len(own.encode(t, add_special_tokens=False).ids) for t in texts)
    tokens.token_counts(odd_docs, BPE, cache, scratch)
    assert spark.read.parquet(cache).count() == len(set(texts))  # all were found
    # a stored count is used, not made again
    text = "never encoded"
    digest = spark.range(1).select(tokens.content_digest(F.lit(text)).alias("digest"))
    digest.select("digest", F.lit(4242).cast("long").alias("n_tokens"), F.lit(tokens.tokenizer_version(BPE)).alias("tokenizer")).write.mode("append").parquet(cache)
    one = tokens.token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), BPE, cache, scratch).first()
    assert one["n_tokens"] == 4242
    other = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), other, cache, scratch).first()["n_tokens"] != 4242


def check_packing(rows, docs, own, most=1024, most_docs=1024):
    ids = {k: np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for k, t in docs.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == docs.keys()
    for k, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        at = 0
        for i, r in enumerate(pieces):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[k][at:at + r["length"]].tobytes())
            assert r["length"] == most if i else 0 < r["length"] <= most
            at += r["length"]
        assert at == len(ids[k])
    for held in by_sequence.values():
        held.sort(key=lambda r: r["offset"])
        at = 0
        for r in held:
            assert r["offset"] == at
            at += r["length"]
        assert at <= most and len(held) <= most_docs
    return len(by_sequence), sum(map(len, ids.values()))


def test_packing_query(spark, own):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    n, total = check_packing(registered.op4_best_fit_packing(spark, SF).collect(), docs, own)
    assert n <= 1.05 * -(-total // 1024) + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_keeps_every_capacity(spark, scratch, own, rule):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()}
    frame = spark.createDataFrame([(k, v) for k, v in docs.items()], "doc_id long, text string")
    capacity = packing.Capacity(tokens=512, documents=3, attention=512 * 512 // 2 + 512, rule=rule)
    with pytest.raises(Exception, match="exceeds a capacity"):
        packing.pack_documents(frame, BPE, scratch, capacity=capacity).collect()
    capacity = packing.Capacity(tokens=512, documents=2, attention=512 * 512, rule=rule)
    rows = packing.pack_documents(frame, BPE, scratch, capacity=capacity, group_rows=50).collect()
    check_packing(rows, docs, own, 512, 2)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r["length"])
        assert len(r["ids"]) == 4 * r["length"] and r["ids_crc32"] == zlib.crc32(r["ids"])
    assert all(sum(x * x for x in v) <= 512 * 512 for v in by.values())


def test_packing_odd_rows(spark, scratch, odd_docs, no_docs):
    assert packing.pack_documents(no_docs, BPE, scratch).count() == 0
    out = packing.pack_documents(odd_docs.withColumn("piece", F.lit("clash")), BPE, scratch, with_ids=False)
    rows = out.collect()
    assert out.columns.count("piece") == 1 and sum(r["piece"] == 0 for r in rows) == odd_docs.count()
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in used.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:], strict=False)) and sum(held[-1]) <= 1024


def test_best_fit_is_near_the_bound():
    lengths = np.random.default_rng(5).integers(1, 1025, 20_000)
    bins, offsets = packing.best_fit(lengths, packing.Capacity())
    filled = np.bincount(bins, weights=lengths)
    assert filled.max() <= 1024 and len(filled) <= 1.02 * lengths.sum() / 1024


def test_version_names_all_that_decides_the_ids(monkeypatch):
    import tiktoken

    first = tokens.tokenizer_version(BPE)
    monkeypatch.setattr(tiktoken, "__version__", "another")
    second = tokens.tokenizer_version(BPE)
    monkeypatch.setattr(public_tokenizers, "PATTERN", public_tokenizers.PATTERN + "|x")
    assert len({first, second, tokens.tokenizer_version(BPE), tokens.tokenizer_version(public_tokenizers.path("word_bpe_49k.json"))}) == 4
