"""Token counts and packing against the tokenizers themselves."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from pipewatch.llm import packing, token_counts
from pipewatch.llm.queries import queries, tokenizer_path

SF = "/root/testdata/sf0.001"
PIECES = tokenizer_path("piece_bpe_32k.model")
WORDS = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pieces():
    return token_counts.load_pieces(PIECES)


@pytest.fixture(scope="module")
def library(pieces):
    """The library's own unigram model over the same pieces, with byte pieces."""
    return Tokenizer(models.Unigram([("<unk>", 0.0), *pieces, *[(f"<0x{b:02X}>", -1.0) for b in range(256)]], unk_id=0, byte_fallback=True))


def library_count(library, text):
    return sum(len(library.encode(token_counts.WORD_MARK + w).ids) for w in (text or "").split())


def test_counts_match_the_library_on_all_documents(spark, library):
    rows = queries()["op3_token_counts"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in rows} == {i: (len(t.split()), library_count(library, t)) for i, t in texts.items()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abc日", min_size=1, max_size=4), st.integers(-4, 0)), min_size=1, max_size=12, unique_by=lambda x: x[0]), st.text("abcd日é", max_size=12), st.booleans())
def test_ties_and_unknown_characters_match_the_library(vocabulary, word, fallback):
    vocabulary = [(p, float(s)) for p, s in vocabulary]
    more = [(f"<0x{b:02X}>", 0.0) for b in range(256)] if fallback else []
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary, *more], unk_id=0, byte_fallback=fallback))
    ours = token_counts.UnigramCounter(vocabulary + [("<unk>", 0.0)], fallback)
    if not any(t in word for t in ("<", ">")):
        got = model.encode(word).ids
        assert ours.count(word) == len(got)


def test_counts_of_odd_documents(spark, odd, no_docs, library):
    got = token_counts.count_tokens(odd.withColumn("n_tokens", F.lit("x")), PIECES).collect()
    want = Counter((r.doc_id, len((r.text or "").split()), library_count(library, r.text)) for r in odd.collect())
    assert Counter(map(tuple, got)) == want
    assert token_counts.count_tokens(no_docs, PIECES).collect() == []


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def fast():
    return packing.FastIds(WORDS)


ODD = ["İstanbul É ß Straße don't I'LL x²½ ª º \x1c a\x85b a\xa0b <|endoftext|> 日本語 ΣΑΣ é ​", "", " ", "a\x00b \x7f ~", "œuvre Ÿ ÿ", "it's 'S 'Re 12345 $$$### a—b …", "Á\u0301"]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(fast, word_tokenizer, text):
    assert np.frombuffer(fast.ids(text), "<u4").tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("abZ 'stre09.,é\xa0\u0301ß\n", max_size=40)))
def test_ids_of_any_text(text):
    fast, library = _pair()
    assert np.frombuffer(fast.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


_made = []


def _pair():
    if not _made:
        _made.append((packing.FastIds(WORDS), Tokenizer.from_file(WORDS)))
    return _made[0]


def check_packing(rows, size):
    """Every piece has its place; sequences are gapless and not too long."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing_of_all_documents(spark, word_tokenizer):
    rows = queries()["op9_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pieces = {(r.doc_id, r.piece): r for r in rows}
    assert len(pieces) == len(rows)
    for i, text in texts.items():
        ids = np.array([*word_tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        cut = [ids[a : a + 4 * 2048] for a in range(0, len(ids), 4 * 2048)]
        for k, part in enumerate(cut):
            r = pieces.pop((i, k))
            assert (r.start, r.length, r.ids_crc32) == (2048 * k, len(part) // 4, zlib.crc32(part))
    assert not pieces
    used = check_packing(rows, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.01 + 1


def test_packing_of_odd_documents(spark, odd, no_docs):
    rows = packing.pack_documents(odd, WORDS).collect()
    check_packing(rows, 2048)
    assert sum(1 for r in rows if r.doc_id == 13) == 2 and sum(1 for r in rows if r.doc_id == 3) == 1
    assert next(r.length for r in rows if r.doc_id == 3) == 1
    assert packing.pack_documents(no_docs, WORDS).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=15), st.integers(40, 60))
def test_layouts_use_every_piece_once(counts, size):
    used = Counter()
    for times, lengths in packing.layouts(counts, size):
        assert times > 0 and sum(lengths) <= size
        for k in lengths:
            used[k] += times
    assert used == Counter(counts)


def test_two_pieces_replace_the_smallest():
    # Greedy takes 6 and 3 of 10; 2 + 2 fill the gap that 3 leaves better.
    assert packing.layouts({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])
    with pytest.raises(ValueError):
        packing.layouts({11: 1}, 10)


def test_layouts_are_near_the_lower_bound():
    rng = random.Random(3)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    assert sum(t for t, _ in packing.layouts(counts)) <= -(-sum(k * n for k, n in counts.items()) // 2048) * 1.005
