"""Units give the ids of whole texts, whatever the text."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from greenledger.llm.queries import tokenizer_path
from greenledger.llm.token_files import EliasFano
from greenledger.llm.tokens import Encoder, encoder

#: What is special to the pre-tokenizers' patterns, normalizers and added tokens.
SPECIAL = [
    "a", "b", "é", "é", "ß", "İ", "Σ", "ς", "²", "½", "5", "42", "_", "-", "'s", "'", "'ll", "n't", ".", ",", " ", "  ",
    "   ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "日本", "😀",
    "̀", "ﬁ", "Ⅷ", "the", "The", "WORD", "\0", "\0a", " a", " 5", " ,",
]


@pytest.mark.parametrize("name, rule", [("byte_bpe_50k.json", "space"), ("word_bpe_49k.json", "blank")])
def test_units_equal_whole_texts(name, rule):
    e = encoder(tokenizer_path(name))
    assert e.rule == rule

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(SPECIAL) | st.characters(exclude_categories=["Cs"]), max_size=20).map("".join), max_size=20))
    def check(texts):
        for text, got in zip(texts, e.encode(texts), strict=True):
            want = e.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(got, "<u4").tolist() == want

    check()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40) | st.integers(0, 50), max_size=700))
def test_elias_fano(values):
    values.sort()
    ef = EliasFano.encode(values)
    again = EliasFano.decode(ef.meta(), b"".join(ef.parts()))
    assert again.slice(0, len(values)).tolist() == values
    assert [again.select(i) for i in range(len(values))] == values
    if len(values) > 5:
        assert again.slice(3, len(values) - 1).tolist() == values[3:-1]
    with pytest.raises(IndexError):
        again.select(len(values))


def test_known_units_are_not_looked_up_piece_by_piece(monkeypatch):
    """A unit that is learned is put together from ids that are looked up once; the memory is asked once a unit."""
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"))
    asked = []

    class Counting(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    enc.often, enc.lately = Counting(), Counting()
    text = "one, two, one, three. two, one; one, " * 3
    whole = enc._ids([text])[0]
    assert enc.encode([text])[0] == whole
    learning = [x for x in asked if x == ","] + [x for x in asked if x == "\0,"]
    assert len(learning) <= 2  # often and lately, once each
    assert enc.encode([text])[0] == whole


def test_strings_of_special_tokens_as_plain_text():
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"), plain=True)
    assert enc.tokenizer.encode_special_tokens
    texts = ["a <|endoftext|>, b-c.", "x<|endoftext|>y", "<|endoftext|>", "one, two's"]
    for text, got in zip(texts, enc.encode(texts), strict=True):
        ids = np.frombuffer(got, "<u4").tolist()
        assert ids == enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert enc.tokenizer.token_to_id("<|endoftext|>") not in ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_letters_that_are_newer_than_python(name):
    enc = Encoder(tokenizer_path(name))
    texts = ["a\U00013460", "x a\U00013460b, c", "word\U0001CCF0 y"]  # unassigned, or assigned only lately
    for text, got in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_remember_more_units():
    """Units that a worker meets again after as many others as it held before are not learned twice."""
    import inspect

    from greenledger.llm import token_files, tokens

    assert "encoder(tokenizer_path, ROOMY)" in inspect.getsource(token_files.write_token_files)
    learned = []
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"), remembered=tokens.ROOMY)
    enc._learn = lambda units: learned.append(len(units)) or dict.fromkeys(units, b"1234")
    words = [f"w{i}" for i in range(tokens.LATELY + 20_000)]
    for at in range(0, len(words), 10_000):
        enc.encode(["x " + " ".join(words[at : at + 10_000])])
    enc.encode(["x " + " ".join(words[:10_000])])
    assert learned[-1] == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_learned_together_and_without_the_point_after_them(name, monkeypatch):
    """A word with a point after it is not a unit of its own, and new words reach the model in one call."""
    enc = Encoder(tokenizer_path(name))
    learned, calls = [], []
    learn, words = enc._learn, enc._words
    monkeypatch.setattr(enc, "_learn", lambda units: learned.extend(units) or learn(units))
    monkeypatch.setattr(enc, "_words", lambda spelled: calls.append(len(spelled)) or words(spelled))
    texts = ["one, two. one; wörd! two? wörd: (three)", "", "two, one  wörd,\n\nthree.\n"]
    got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)]
    assert got == [enc.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert not {"one,", "two.", "one;", "wörd!", "two?", "wörd:"} & {x.lstrip("\0") for x in learned}
    assert len(calls) == 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_points_after_letters_that_normalize_to_marks(name):
    enc = Encoder(tokenizer_path(name))
    letters = ["יִ", "İ", "é", "K", "하", "²", "Ⅷ", "ﬁ", "ǅ", "_", "7"]
    texts = [f"a{x}{p} {x}{p}" for x in letters for p in ",.\n'-\x1c"]
    got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)]
    assert got == [enc.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_words_after_a_space():
    """Words are encoded as they stand after a space, without texts being made of them and cut again."""
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"), plain=True)
    words = ["one", "one,", "", "\n", "a b", "\tx", "wörd.\nTwo", "it's", "x\0y", " ", "<|endoftext|>", "5.", "two"]
    want = [enc.tokenizer.encode(" " + x, add_special_tokens=False).ids for x in words]
    texts = []
    encode = enc.encode
    enc.encode = lambda some: texts.extend(some) or encode(some)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_words(words)] == want
    assert sorted(texts) == sorted([" ", " \n", " a b", " \tx", " x\0y", "  "])
    assert enc.encode_words([]) == [] and enc.encode([]) == []
    assert Encoder(tokenizer_path("word_bpe_49k.json")).encode_words(["one", ""])[1] == b""
