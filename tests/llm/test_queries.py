"""The registered queries' own columns, on the smallest tables."""

import zlib

import public_tokenizers

from haulwise.llm import bpe, queries
from tests.conftest import SF_SMALL
from tests.llm import brute


def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_token_counts(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = texts(spark)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op6_token_counts(spark, SF_SMALL).collect()}
    want = {}
    for d, t in docs.items():
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want[d] = (len((t or "").encode()), n, n > 512)
    assert got == want


def test_byte_bpe(spark):
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = {}
    for d, t in texts(spark).items():
        ids = enc.encode_ordinary(t or "")
        want[d] = (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t or ""))
    assert {r.doc_id: tuple(r)[1:] for r in queries.op7_byte_bpe(spark, SF_SMALL).collect()} == want


def test_decontamination_digests(spark):
    docs = texts(spark)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = {}
    for (d, t), (n, hit, found) in zip(docs.items(), brute.contamination(list(docs.values()), items)):
        want[d] = (n, hit, len(found), brute.sha(",".join(found)))
    for r in queries.op3_decontamination(spark, SF_SMALL).collect():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == want[r.doc_id] and r.contaminated == (r.n_hit > 0)


def test_scores_and_predictions(spark):
    languages = {r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang").distinct().collect()}
    docs = texts(spark)
    toxic = queries.op8_toxicity(spark, SF_SMALL).collect()
    assert {r.doc_id for r in toxic} == set(docs)
    for r in toxic:
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    found = queries.op10_language_id(spark, SF_SMALL).collect()
    assert {r.doc_id for r in found} == set(docs)
    for r in found:
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.lang_pred in languages | {"und"}


def test_simhash(spark):
    rows = list(texts(spark).items())
    want = [(d, f"{f:016x}", c) for (d, _), (f, c) in zip(rows, brute.components(rows))]
    assert sorted(map(tuple, queries.op1_simhash_near_dedup(spark, SF_SMALL).collect())) == sorted(want)
