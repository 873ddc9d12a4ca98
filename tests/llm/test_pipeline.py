"""The pipeline against brute force, and the registered queries."""

import importlib.util
import os
import random

import public_tokenizers

import __spark_entry__
import corpus_pipeline
from haulwise.llm import bpe, language_id
from haulwise.llm.queries import ORACLE, QUERIES
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def test_pipeline_is_the_chain_of_brute_force_stages(spark):
    read = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
    docs = read("documents")
    rows = [(r.doc_id, r.text) for r in language_id.keep_identified(docs).collect()]
    assert [d for d, _ in rows] == [r.doc_id for r in docs.where(r"text rlike '\\p{L}'").collect()]
    predicted = {r.doc_id: r._lang_pred for r in language_id.identify(docs).collect()}
    rows = [(d, t) for (d, t), (_, c) in zip(rows, brute.components(rows)) if d == c]
    rows = [(d, kept) for (d, _), (_, _, kept) in zip(rows, brute.without_repeats(rows))]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    rows = [(d, t) for (d, t), (_, hit, _) in zip(rows, brute.contamination([t for _, t in rows], items)) if not hit]
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = {d: (enc.encode_ordinary(t), brute.sha(t)) for d, t in rows}
    result = corpus_pipeline.run(spark, SMALL).collect()
    got = {r.doc_id: (r.ids, r.decoded_sha256) for r in result}
    assert got == want
    assert all(r.lang == predicted[r.doc_id] for r in result)
    assert 0 < len(got) < docs.count()


def test_stages_take_clashing_columns(tricky, spark):
    _, docs = tricky
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert sorted(kept.columns) == sorted(docs.columns), name
        assert kept.count() > 0


def test_language_stage_rejects_and_relabels(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, "the dog sat on the mat", None),
         (4, "12 345 !?", "en"), (5, None, "fr"), (6, "", "en"), (7, " \t\n", None)],
        "doc_id long, text string, lang string").selectExpr("*", "'s' AS source", "0L AS n_chars")
    kept = corpus_pipeline.language_filter(spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 3]
    assert all(r.lang in ("en", "fr") for r in kept)


def test_stages_take_no_rows(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SMALL).count() == 0


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_license_twin_agrees_on_notices(spark):
    import duckdb

    from haulwise.llm import license_scan, sql_twins
    rng, texts = random.Random(8), [license_scan.PHRASES[0][0] * 2, "", None]
    for text, _ in license_scan.NOTICES:
        words = text.split()
        texts += [text, text.upper() + " x " + text, " ".join(words[:8]), " ".join(words[:9] + ["one", "two"] + words[9:]),
                  " ".join(words[4:] + words[:4]), " ".join(w + " a b" for w in words), "GNU general public license " + text]
        texts += [" ".join(words[:i] + ["inserted"] + words[i:] + words[-5:]) for i in range(0, len(words), 2)]
        texts += [" ".join(words[:i] + ["one", "and", "more", "words", "put", "in"][:2 + i % 5] + words[i:]) for i in range(1, len(words), 3)]
        texts += [" ".join(rng.choice(words[:6] + words[-3:]) for _ in range(60)) for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(f"SELECT * FROM ({sql_twins.LICENSES}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in license_scan.scan(docs).orderBy("doc_id").collect()] == want


def test_library_does_not_import_this_subpackage():
    root = os.path.dirname(importlib.util.find_spec("haulwise").origin)
    for folder, _, files in os.walk(root):
        for name in files:
            if name.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, name)) as f:
                    assert "haulwise.llm" not in f.read()
