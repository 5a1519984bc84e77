import random

import public_tokenizers
import pytest
import sentencepiece
from fixtures import clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


CODER = pieces.PieceCoder(pieces.PieceModel(PATH))


def same(library, text):
    ids = CODER.encode(text)
    assert ids == library.encode(text)
    assert CODER.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30))
def test_any_text(text):
    same(sentencepiece.SentencePieceProcessor(model_file=PATH), text)


def test_mixed_texts(library):
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "     ", "▁", "\n", "日", "é", "%", "123", ".", ",", "ing", "tion", "\x00", "😀", "(", "=", "\""]
    for _ in range(1500):
        same(library, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))))
    for text in ("", " ", "x" * 5000, " " * 100, "ab " * 3000):
        same(library, text)


def test_long_words_and_small_caches(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 3)
    monkeypatch.setattr(pieces, "CELLS", 10)
    monkeypatch.setattr(pieces, "CACHED_PAIRS", 2)
    coder = pieces.PieceCoder(pieces.PieceModel(PATH))
    for text in ("one two three four one two", "incomprehensibilities " * 5):
        assert coder.encode(text) == library.encode(text)


def test_long_texts_without_spaces(library):
    """Against the library, in linear time, and nothing of them stays behind."""
    rng = random.Random(4)
    letters = "日本語文字漢学校生天気電車" + "abcdeinorst" + "é😀\x00.1"
    coder = pieces.PieceCoder(pieces.PieceModel(PATH))
    for size in (63, 64, 65, 66, 500, 3000):
        text = "".join(rng.choice(letters) for _ in range(size))
        assert coder.encode(text) == library.encode(text)
        assert coder.tokens_alone(text) == coder.tokens([text])[0]
    whole = "".join(rng.choice(letters) for _ in range(300_000))
    assert coder.encode(whole + " a " + whole) == library.encode(whole + " a " + whole)
    assert coder.held == sum(map(len, coder.words)) and all(len(w) <= pieces.LONGEST_WORD for w in coder.words)


def test_tables(spark, library):
    texts = ["Hello, World", None, "", "Hello, World", "日本 x"]
    df = clashing(documents(spark, texts, [3, 1, None, 3, 5]))
    got = {(r.doc_id, tuple(r.ids), r.decoded) for r in pieces.encode(df, PATH).collect()}
    want = {(i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in
            zip([3, 1, None, 3, 5], texts)}
    assert got == want
    assert pieces.digests(df, PATH).count() == 5
    assert pieces.encode(documents(spark, []), PATH).collect() == []
