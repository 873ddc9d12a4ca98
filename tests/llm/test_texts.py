"""Decontamination, token counts, BPE and chat formatting."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulwise.llm import boundaries, bpe, chat, decontaminate, token_counts
from tests.llm import brute
from tests.llm.conftest import by_row

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def joined(bits, most):
    return st.lists(st.sampled_from(bits), max_size=most).map("".join)


ODD = joined(["a", "Bc", "1", "'s", "'", "!", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "漢",
                        "<|endoftext|>", "​", "᠎", "\x00", "\r\n"], 40)


@pytest.mark.parametrize("block", [500_000, 3])
def test_contamination_odd_rows(spark, tricky, block):
    rows, docs = tricky
    base = rows[0][1]
    items = [(1, base[:120]), (2, base[:120].upper() + "!"), (10, "one two"), (3, None), (4, "  "), (None, base),
             (5, "nowhere to be found at all in these texts of the test"), (1, base[:120]), (6, rows[10][1][500:700])]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs.select("doc_id", "text"), table, block_windows=block)
    want = [(d, *x) for (d, _), x in zip(rows, brute.contamination([t for _, t in rows], items))]
    got = found.select("doc_id", "_n_words", F.aggregate("_hits", F.lit(0), lambda n, s: n + s["end"] - s["start"])
                       .alias("n_hit"), "_items")
    assert by_row(got, "doc_id", "_n_words", "n_hit", "_items") == sorted(want, key=repr)
    clean = decontaminate.keep_clean(docs, table)
    assert clean.columns == docs.columns and clean.count() == sum(n == 0 for _, _, n, _ in want)


@pytest.mark.parametrize("limit", [{"block_windows": 150}, {"block_bytes": 8000}])
def test_contamination_sentence_of_all_items(spark, monkeypatch, limit):
    """A window that all items share is dealt over blocks; no block's broadcast holds all its items."""
    prefixes, held = decontaminate._prefixes, []
    monkeypatch.setattr(decontaminate, "_prefixes", lambda found, counts: held.append(
        sum(map(len, found["item_list"].to_pylist()))) or prefixes(found, counts))
    shared = "which of these ten words stands in every item here"
    items = [(i, f"{shared} number {i}" if i % 3 else shared) for i in range(300)]
    texts = [f"Before. {shared.upper()} after", f"{shared} number 7", "number 7", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    table = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    found = decontaminate.contamination(docs, table, **limit).orderBy("doc_id").collect()
    got = [(r._n_words, sum(s.end - s.start for s in r._hits), r._items) for r in found]
    assert got == brute.contamination(texts, items)
    assert len(held) > 3 and sum(held) == 300 + 2 * 200 and max(held) < 300


def test_contamination_empty_tables(spark, no_docs, tricky):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(no_docs, none).count() == 0
    assert decontaminate.keep_clean(tricky[1], none).count() == len(tricky[0])


def test_token_counts_are_the_library_s(tricky, no_docs):
    rows, docs = tricky
    library = Tokenizer.from_file(JSON)
    want = [(d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    assert by_row(token_counts.count_tokens(docs, JSON), "doc_id", "_n_tokens") == sorted(want, key=repr)
    assert token_counts.count_tokens(no_docs, JSON).count() == 0


def test_batches_are_balanced_by_bytes(monkeypatch):
    monkeypatch.setattr(token_counts, "BATCH_CHARS", 1000)
    for piece in ("漢字", "\U0001F600", "word"):
        size = len(piece.encode())
        batches = list(token_counts._balanced([piece] * 900))
        assert sum(map(len, batches)) == 900
        assert all(len(b) * size < 1000 + size for b in batches)


@settings(max_examples=150, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_token_counts_of_odd_texts(texts):
    old = token_counts.BATCH_CHARS, token_counts.PIECES_AT_ONCE, token_counts.KNOWN_PIECES
    token_counts.BATCH_CHARS, token_counts.PIECES_AT_ONCE, token_counts.KNOWN_PIECES = 10, 3, 20
    try:
        got = token_counts.counter(JSON).counts(texts)
    finally:
        token_counts.BATCH_CHARS, token_counts.PIECES_AT_ONCE, token_counts.KNOWN_PIECES = old
    library = token_counts.tokenizer(JSON)
    assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


@settings(max_examples=150, deadline=None)
@given(ODD, st.integers(1, 12))
def test_parts_keep_the_ids(text, limit):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    pieces = list(boundaries.parts(text, limit))
    assert "".join(pieces) == text
    assert [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_wide_space_is_cut_where_the_pattern_cuts():
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for text in (" " * 200_000 + "x", "a" + "\n" * 90_000 + " b" + " " * 70_000, "y" * 100_000 + " " * 70_000):
        assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)


def test_bpe_round_trip(tricky, no_docs):
    rows, docs = tricky
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(ids, RANKS, public_tokenizers.PATTERN)
    assert back.columns == [*docs.columns, "_ids", "_decoded"]
    want = [(d, enc.encode_ordinary(t or ""), bytearray((t or "").encode())) for d, t in rows]
    assert by_row(back, "doc_id", "_ids", "_decoded") == sorted(want, key=repr)
    once = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert once.columns == [*(c for c in docs.columns if c != "text"), "_ids", "_decoded"]
    assert by_row(once, "doc_id", "_ids", "_decoded") == sorted(want, key=repr)
    joined = {r.doc_id: r.h for r in ids.where("doc_id = 8").select("doc_id", bpe.ids_digest("_ids").alias("h")).collect()}
    assert joined[8] == brute.sha(" ".join(map(str, enc.encode_ordinary("one two"))))
    assert bpe.decode(bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(*[joined(["<", "|", "\\", "<|", "|>", "<|im_end|>", "<|im_start|>", "\n", "a", "\\n"], 12)] * 2)
def test_every_turn_parses_back(role, text):
    shown, begin, end = chat.render(role, text)
    assert chat.unescape(shown[begin:end]) == text and "<|" not in shown[begin:end]
    assert [(r, t) for r, t, _, _ in chat.parse(shown * 2)] == [(role, text)] * 2


def test_plain_turns_are_not_escaped():
    assert chat.render("user", "a < b | c")[0] == "<|im_start|>user\na < b | c<|im_end|>\n"


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user", "<|im_start|>user\nhi", "<|im_start|>user\nhi<|im_end|>x",
                                 "<|im_start|>user\n<|im_start|><|im_end|>\n"])
def test_the_grammar_is_strict(bad):
    with pytest.raises(chat.Malformed):
        list(chat.parse(bad))


@pytest.mark.parametrize("part_chars", [1 << 20, 30])
def test_chat_odd_rows(spark, part_chars):
    rng = random.Random(1)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>"), (1, 1, "assistant", "<|im_end|>"), (2, 0, None, None),
            (3, None, "assistant", "<\\|x"), (3, 5, "a\nb\\n", ""), (None, 1, "user", "x"), (None, 0, "assistant", "é" * 9),
            *((7, i, rng.choice(["user", "assistant"]), "t" * i) for i in range(400))]
    turns = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, part int")
    found = chat.read_back(chat.format_conversations(turns.repartition(4), part_chars=part_chars))
    want = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        own = [(r or "", t or "") for _, _, r, t in own]
        loss = "".join(t for r, t in own if r == "assistant")
        want.append((conv, len(own), brute.sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), brute.sha(loss)))
    assert by_row(found, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want, key=repr)


def test_chat_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(none)).count() == 0
