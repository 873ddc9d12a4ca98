"""SimHash and substring dedup against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from haulwise.llm import simhash, substrings, words
from tests.llm import brute
from tests.llm.conftest import by_row


def test_simhash_odd_rows(tricky):
    rows, docs = tricky
    found = simhash.near_duplicates(docs)
    want = [(d, f"{f:016x}", c) for (d, _), (f, c) in zip(rows, brute.components(rows))]
    assert by_row(found.select("doc_id", simhash.fingerprint_hex("fp").alias("f"), "component_id"),
                  "doc_id", "f", "component_id") == sorted(want, key=repr)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_are_all_pairs_within_distance(spark, distance):
    rng = random.Random(distance)
    values = set()
    for _ in range(40):
        seed = rng.getrandbits(64)
        for _ in range(6):
            values.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))))
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = [tuple(sorted(r)) for r in simhash.links(fps, distance).collect()]
    want = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i]
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    assert len(found) == len(set(found)) and set(found) == want


def test_one_document_of_each_group_stays(tricky):
    rows, docs = tricky
    want = {c for _, c in brute.components(rows)}
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(c for c in want if c is not None)


def test_chain_of_links_is_one_component(spark):
    from haulwise.llm.components import components
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1001), (1001, 1000)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert len({roots[i] for i in range(301)}) == 1 and roots[1000] == roots[1001] != roots[0]


def test_substring_odd_rows(tricky):
    rows, docs = tricky
    want = [(d, n, r, None if t is None else kept) for (d, t), (n, r, kept) in zip(rows, brute.without_repeats(rows))]
    found = substrings.remove_repeats(docs)
    assert len(set(found.columns)) == len(found.columns)
    assert by_row(found, "doc_id", "_n_words", "_n_removed", "text") == sorted(want, key=repr)
    kept = substrings.keep_rest(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_substring_small_chunks_and_buckets(spark, tricky):
    rows, docs = tricky
    want = [(d, n, r) for (d, _), (n, r, _) in zip(rows, brute.without_repeats(rows, 4))]
    found = substrings.remove_repeats(docs.select("doc_id", "text"), width=4, chunk_bytes=300, bucket_bytes=2000)
    assert by_row(found, "doc_id", "_n_words", "_n_removed") == sorted(want, key=repr)


def test_substring_ranges_split_again(spark, tricky):
    """More buckets than a chunk's ranges: rows are gathered by range and split a second time."""
    rows, docs = tricky
    want = [(d, n, r) for (d, _), (n, r, _) in zip(rows, brute.without_repeats(rows, 4))]
    found = substrings.remove_repeats(docs.select("doc_id", "text"), width=4, chunk_bytes=300, bucket_bytes=500, fan=3)
    assert by_row(found, "doc_id", "_n_words", "_n_removed") == sorted(want, key=repr)


def test_words_that_collide_modulo_2_64_are_kept(spark):
    """A Thue-Morse word and its complement hash alike under any polynomial modulo 2^64."""
    for n in (1024, 2048):
        one = "".join("ab"[i.bit_count() % 2] for i in range(n))
        other = one.translate(str.maketrans("ab", "ba"))
        common = [f"w{i}" for i in range(12)]
        docs = spark.createDataFrame([(1, " ".join([*common, one])), (2, " ".join([*common, other])),
                                      (3, " ".join([*common, one]))], "doc_id long, text string")
        assert by_row(substrings.remove_repeats(docs), "doc_id", "_n_removed") == [(1, 0), (2, 0), (3, 13)]


def test_word_keys_tell_words_apart():
    rng = random.Random(2)
    texts = {"".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200]))) for _ in range(3000)}
    texts |= {"a" * n for n in range(1, 300)} | {"a\0" * n for n in range(1, 40)} | {"a" + "\0" * n for n in range(40)}
    texts = sorted(texts)
    buf = np.frombuffer(" ".join(texts).encode(), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]
    one, two = words.word_keys(buf, starts, ends)
    assert len(set(one.tolist())) == len(set(two.tolist())) == len(texts)
    again = words.word_keys(np.concatenate([[32], buf]).astype(np.uint8), starts + 1, ends + 1)
    assert (again[0] == one).all() and (again[1] == two).all()


def test_a_chunk_does_not_grow_with_the_buckets():
    import pyarrow as pa
    import time

    rng = np.random.default_rng(1)
    text = " ".join(map(str, rng.integers(0, 1 << 40, 700_000)))
    column, ids = pa.array([text]), np.array([7])
    begin = time.time()
    rows = list(substrings._hash_chunk(ids, column, 5 << 32, 13, 1024))  # the most ranges of a chunk, at any corpus size
    assert len(rows) == 1024 and time.time() - begin < 6
    begin = time.time()
    wide = [r for b in substrings.refine(iter(pa.Table.from_pylist(rows[:8], substrings._arrow(substrings._ENTRIES))
                                              .to_batches()), 1024, 1024 * 600) for r in b.to_pylist()]
    assert time.time() - begin < 6
    assert sum(len(r["hashes"]) for r in wide) == sum(len(r["hashes"]) for r in rows[:8])
    assert {r["bucket"] // 600 for r in wide} == set(range(8))


def test_empty_tables(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one_per_group(no_docs).count() == 0
    assert substrings.remove_repeats(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1é漢 \t\n\x1c\x85-_", max_size=40), max_size=6))
def test_word_tables_match_the_patterns(texts):
    import pyarrow as pa

    for classes, find, low in ((words.SPACED, brute.spaced, False), (words.ALNUM, brute.alnum, True)):
        old, words.SLICE_BYTES = words.SLICE_BYTES, 7
        try:
            buf, off = words.flat(pa.array(texts, pa.string()))
            hashes, first, starts, ends = words.word_table(buf, off, classes, lower=low, spans=True)
        finally:
            words.SLICE_BYTES = old
        found = [bytes(buf[a:b]).decode() for a, b in zip(starts, ends)]
        got = [found[a:b] for a, b in zip(first[:-1], first[1:])]
        assert [[brute.lower(w) for w in x] if low else x for x in got] == [find(t) for t in texts]
        flat = [brute.lower(w) if low else w for w in found]
        same = {}
        for h, w in zip(hashes.tolist(), flat):
            assert same.setdefault(w, h) == h
        assert len(set(same.values())) == len(same)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n", max_size=80), st.integers(1, 9))
def test_text_slices_cut_between_words(text, limit):
    data = text.encode()
    pieces = list(words.text_slices(data, limit))
    assert b"".join(pieces) == data
    assert [w for p in pieces for w in p.split()] == data.split()


def test_packed_integers_come_back():
    for kind in (np.int32, np.int64):
        values = np.array([5, 5, 9, 0, np.iinfo(kind).max, -3], dtype=kind)
        assert (substrings._unpack(substrings._pack(values), kind) == values).all()


def test_first_chunks_of_all_partitions_spread_over_buckets():
    text = "a b c d " * 3
    rows = [r for p in range(64) for r in substrings._hash_chunk(
        np.array([1, 2]), substrings.pa.array([text, text]), p << 32, 4, 64)]
    own = [r["bucket"] for r in rows if r["kind"] == 1]
    assert len(own) == 64 and max(map(own.count, own)) <= 6
