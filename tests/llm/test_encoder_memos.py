"""The encoder's memos: what they hold is bounded, and neither they nor single pre-tokens change the library's ids."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from podium.llm import tokens

VOCABULARIES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


def _texts() -> list[str]:
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHßüéñçèÑÓİıǅªºμ9.,'’-\n\t$%&!žșẞﬁ漢字🙂́­\x00\x7f"
    word = lambda: "".join(rng.choices(letters, weights=[9] * 34 + [1] * (len(letters) - 34), k=rng.randint(1, 9)))
    return [" ".join(word() for _ in range(40)) for _ in range(300)]


@pytest.mark.parametrize("name,keep_blank", VOCABULARIES)
def test_ids_are_the_librarys_whatever_the_memos_drop(monkeypatch, name, keep_blank):
    monkeypatch.setattr(tokens, "CHUNK", 16)
    monkeypatch.setattr(tokens, "MEMO_GENERATION", 500, raising=False)
    monkeypatch.setattr(tokens, "MEMO_WORDS", 200, raising=False)
    monkeypatch.setattr(tokens, "_loaded", {})
    path = public_tokenizers.path(name)
    texts = _texts() * 2 + ["x" * 500 + " " + "y" * 500 + ".", "", " a", "a  b ", "it's. x's, 3.5, ..."]
    encode, library = tokens.encoder(path, keep_blank), Tokenizer.from_file(path)
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def _held(encode) -> int:
    """Entries of all dictionaries that the encoder's functions hold."""
    seen, todo = {}, [encode]
    while todo:
        for cell in getattr(todo.pop(), "__closure__", None) or ():
            held = cell.cell_contents
            if id(held) not in seen and (isinstance(held, dict) or callable(held)):
                seen[id(held)] = held
                todo += [held, *(x for x in vars(held).values() if callable(x))] if isinstance(held, type) else [held]
    return sum(len(x) for x in seen.values() if isinstance(x, dict))


@pytest.mark.parametrize("name,keep_blank", VOCABULARIES)
def test_memos_hold_two_generations_at_most(monkeypatch, name, keep_blank):
    monkeypatch.setattr(tokens, "MEMO_GENERATION", 2000, raising=False)
    monkeypatch.setattr(tokens, "MEMO_WORDS", 1000, raising=False)
    monkeypatch.setattr(tokens, "_loaded", {})
    encode = tokens.encoder(public_tokenizers.path(name), keep_blank)
    rng = random.Random(1)
    for _ in range(10):
        encode([" ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(10)) for _ in range(tokens.CHUNK)])
    assert _held(encode) < 2 * (2000 + 10 * tokens.CHUNK) + 1000 + 10 * tokens.CHUNK


def test_letters_below_u0250_are_those_of_the_pattern():
    letter = regex.compile(r"\p{L}").fullmatch
    assert all(chr(x).isalpha() == bool(letter(chr(x))) for x in range(0x250))
