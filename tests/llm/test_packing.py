"""Packing: every id in one piece, windows full, ids those of the tokenizer."""

import numpy as np
import oracle
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesloom.llm import packing
from salesloom.llm.words import WordIds

SF = f"{oracle.TESTDATA}/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def check(rows, documents, window):
    """``rows`` are pieces; ``documents`` the expected ids of each key (key, repeat)."""
    by_doc, by_sequence = {}, {}
    for doc, start, ids, total, sequence, offset in rows:
        by_doc.setdefault(doc, []).append((start, ids, total))
        by_sequence.setdefault(sequence, []).append((offset, len(ids) // 4))
    assert set(by_doc) == set(documents)
    for doc, pieces in by_doc.items():
        assert b"".join(ids for _, ids, _ in sorted(pieces)) == documents[doc]
        assert all(t == len(documents[doc]) // 4 for *_, t in pieces)
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    padding = sum(0 if s == window or s & (s - 1) == 0 else window - s for s in sizes)
    assert max(sizes, default=0) <= window and padding == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 6))
def test_packer(sizes, most):
    packer = packing.Packer(32, most)
    documents = {i: np.arange(n, dtype="<u4").tobytes() for i, n in enumerate(sizes)}
    for i, ids in documents.items():
        packer.add(i, ids)
        assert sum(len(v) for v in packer.open.values()) == packer.counts.sum() <= most
    packer.finish()
    check(packer.rows, documents, 32)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 4), max_size=12), st.integers(1, 31))
def test_level_minimises_the_sum_of_squares(counts, size):
    packer = packing.Packer(32)
    for fill, n in counts.items():
        packer.counts[fill] = n

    def after(fill):
        now = packer.counts.copy()
        if fill:
            now[fill] -= 1
        if fill + size < 32:
            now[fill + size] += 1
        return int((now**2).sum())

    options = [0] + [f for f in counts if f + size <= 32]
    assert after(packer.level(size)) == min(map(after, options))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3, "doc_id")
    rows = [tuple(r) for r in packing.pack(docs, TOKENIZER).collect()]
    plain = Tokenizer.from_file(TOKENIZER)
    documents = {}
    for r in docs.collect():
        ids = plain.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        documents[r["doc_id"]] = np.array(ids, "<u4").tobytes()
    check([(d, s, bytes(i), t, q, o) for d, s, i, t, q, o in rows], documents, 4096)


def test_edges(spark):
    long = "word " * 30_000
    rows = [(1, None, 5), (2, "", 6), (None, "a b", 7), (3, long, 8), (3, "twice", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long").coalesce(1)
    got = packing.pack(df, TOKENIZER).collect()
    sizes = {}
    for r in got:
        sizes[r["doc_id"], r["doc_tokens"]] = sizes.get((r["doc_id"], r["doc_tokens"]), 0) + len(r["ids"]) // 4
    assert sizes[1, 1] == 1 and sizes[2, 1] == 1 and sizes[None, 3] == 3
    assert all(total == n for (_, total), n in sizes.items())
    assert packing.pack(df.where("false"), TOKENIZER).count() == 0


HARD = [
    "don't  I'LL\t'S x, y., z,, A.B", "ÉÀ é ́ a", "ΑΣ ΟΔΟΣ. İ", "<|endoftext|>a <|ENDOFTEXT|> b<|startoftext|>",
    "a\x1fb\x85c\xa0d　e", "\x1c, . .. \x0b\x0c a\r\nb", "", "😀😀 a😀.", "3½ ² x1. ,", "It's. IT'S, its",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_words(text):
    expected = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(WordIds(TOKENIZER).encode(pa.array([text]))), "<u4").tolist() == expected


def test_any_words():
    plain, words = Tokenizer.from_file(TOKENIZER), WordIds(TOKENIZER, remembered=40)

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.one_of(st.sampled_from("aZ.,' <|>\n\t'"), st.characters(exclude_categories=["Cs"])), max_size=30))
    def run(text):
        ids = np.frombuffer(next(words.encode(pa.array([text]))), "<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids

    run()


def test_latin_words_go_straight_to_the_model():
    plain, words = Tokenizer.from_file(TOKENIZER), WordIds(TOKENIZER)
    assert words.plain

    @settings(max_examples=400, deadline=None)
    @given(st.text(st.characters(max_codepoint=0x260, categories=["L"]), min_size=1, max_size=15))
    def run(word):
        assert np.frombuffer(next(words.encode(pa.array([word]))), "<u4").tolist() == plain.encode(word, add_special_tokens=False).ids

    run()


def test_slices_and_nulls():
    plain, words = Tokenizer.from_file(TOKENIZER), WordIds(TOKENIZER)
    texts = ["skipped words", None, " a  B\n", "", "c <|endoftext|> D", "last"]
    got = [np.frombuffer(x, "<u4").tolist() for x in words.encode(pa.array(texts).slice(1, 4))]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts[1:5]]
