"""Token ids by the tokenizers library, with memos of pieces and pre-tokens.

Both vocabularies cut a text into pre-tokens by a pattern before merging, and no
pre-token joins what stands on both sides of a blank that a non-blank follows.  So a
text is split there and the ids of each piece are looked up.  A new piece is cut by the
vocabulary's own pattern, and the library encodes only pre-tokens not seen yet.  The
ids are the library's own for the whole text; tests compare them.  A text in which a
special token of the vocabulary is spelt out goes to the library whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer, pre_tokenizers

#: Entries (some 200 bytes each) of the memos of ``Pretokens``; a memo that has grown to so many is emptied.
MEMO_PIECES, MEMO_PRETOKENS = 700_000, 600_000
#: An encoder's memo of pieces becomes the older one at so many entries, and the one before it goes: what occurs
#: again moves to the newer one, so two workers stay well within what an executor leaves beside its heap.
MEMO_GENERATION = 400_000
#: Its memo of pre-tokens that are not whole pieces loses the newer half at so many: what is frequent was seen early.
MEMO_WORDS = 100_000
#: Longer pieces are not kept.
MEMO_CHARS = 64
CHUNK = 256
#: ASCII marks but for the apostrophe, which may begin a pre-token of letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_SPLIT = re.compile(r" (?=\S)")
_LOOSE = re.compile(r" (?!\S)")
_loaded: dict[tuple[str, bool], Callable[[list[str]], list[bytes]]] = {}


def pieces(text: str) -> list[str]:
    """The text cut at blanks that a non-blank follows; those blanks are left out."""
    return _SPLIT.split(text) if _LOOSE.search(text) else text.split(" ")


def encoder(path: str, keep_blank: bool) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids as little-endian unsigned 32-bit integers.

    ``keep_blank``: the vocabulary has words with their leading blank (byte-level); else
    it normalises, drops white space and has its pattern in the file.
    """
    if (path, keep_blank) not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = Tokenizer.from_file(path)
        if keep_blank:
            cut = regex.compile(public_tokenizers.PATTERN).findall
            pretokens = lambda piece: cut(" " + piece)
        else:
            with open(path) as file:
                steps = json.load(file)["pre_tokenizer"]["pretokenizers"]
            split = regex.compile(steps[0]["pattern"]["Regex"]).findall
            normal = tokenizer.normalizer.normalize_str
            # below U+0250 nothing composes, and lower case is the same in Python
            pretokens = lambda piece: split(piece.lower() if piece.isascii() or max(piece) < "\u0250" else normal(piece))
        _loaded[path, keep_blank] = _encoder(tokenizer, pretokens, not keep_blank)
    return _loaded[path, keep_blank]


def specials(tokenizer: Tokenizer) -> list[str]:
    return sorted(token.content for token in tokenizer.get_added_tokens_decoder().values())


def _of_pretokens(tokenizer: Tokenizer) -> Tokenizer:
    """For what is a pre-token already."""
    single = Tokenizer(tokenizer.model)
    single.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return single


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary has for each byte: its own where it prints, else the next from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in printed]
    return {x: chr(x) for x in printed} | {x: chr(256 + k) for k, x in enumerate(rest)}


def _encoder(tokenizer: Tokenizer, pretokens: Callable[[str], list[str]], lower: bool) -> Callable[[list[str]], list[bytes]]:
    """``lower``: the vocabulary is lower case and marks the ends of words."""
    special = specials(tokenizer)
    letters, merged = _byte_letters(), tokenizer.model.tokenize
    code = "I" if array("I").itemsize == 4 else "L"
    start = "" if lower else letters[ord(" ")]
    older: dict[str, bytes] = {}
    words: dict[str, bytes] = {}

    def encode(texts: list[str]) -> list[bytes]:
        return [array(code, e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_pretoken(spelt: str) -> bytes:
        """Of byte letters, by the library's model itself: around single words the rest of the library takes longer than the merging."""
        return array(code, [token.id for token in merged(spelt)]).tobytes()

    def spelt(word: str) -> str:
        return word.encode().decode("latin-1").translate(letters)

    def of_word(word: str) -> bytes:
        ids = words.get(word)
        if ids is None:
            ids = encode_pretoken(spelt(word))
            if len(word) <= MEMO_CHARS:
                words[word] = ids
        return ids

    class Memo(dict):
        """Ids of pieces; one that it lacks was known before, or is derived, or encoded by pre-tokens."""

        def __missing__(self, piece: str) -> bytes:
            ids = older.get(piece)
            if ids is None:
                form = piece.lower() if lower else piece
                if not form.isalpha():
                    ids = derived(piece)
                    if ids is None:
                        ids = b"".join(map(of_word, pretokens(piece)))
                elif form.isascii():  # one pre-token, as below
                    ids = memo.get(form) if lower and form != piece else None
                    if ids is None:
                        ids = encode_pretoken(start + form)
                elif max(piece) < "\u0250":
                    ids = encode_pretoken(start + spelt(form))
                else:
                    ids = b"".join(map(of_word, pretokens(piece)))
            if len(piece) <= MEMO_CHARS:
                self[piece] = ids
            return ids

    memo = Memo()

    @lru_cache(maxsize=70_000)
    def closes(last: str) -> bool:
        """Whether stops after a letter or digit stand by themselves: not where it normalises to more, as a mark would join them."""
        return last.isalnum() and (not lower or last.isascii() or (len(form := tokenizer.normalizer.normalize_str(last)) == 1 and form.isalnum()))

    def derived(piece: str) -> bytes | None:
        """Of marks after a letter or digit, which are one pre-token, from what stands before them."""
        core = piece.rstrip(MARKS)
        if core != piece and core and closes(core[-1]):
            return memo[core] + of_word(piece[len(core) :])
        return None

    def run(texts: list[str]) -> list[bytes]:
        nonlocal memo, older
        out = []
        gc.disable()  # the memos hold no cycles; walking them again and again takes longer than the work
        for at in range(0, len(texts), CHUNK):
            chunk = texts[at : at + CHUNK]
            whole = [k for k, text in enumerate(chunk) if any(x in text for x in special)]
            plain = chunk if not whole else ["" if k in set(whole) else text for k, text in enumerate(chunk)]
            first, rest = zip(*((cut[0], cut[1:]) for cut in map(pieces, plain)))
            found = [head + b"".join(map(memo.__getitem__, tail)) for head, tail in zip(encode(list(first)), rest)]
            for k, ids in zip(whole, encode([chunk[k] for k in whole])):
                found[k] = ids
            out += found
            if len(memo) > MEMO_GENERATION:
                memo, older = Memo(), memo
            if len(words) > MEMO_WORDS:
                for key in list(words)[MEMO_WORDS // 2 :]:
                    del words[key]
        gc.enable()
        return out

    return run


class Pretokens:
    """Pre-tokens of a byte-level vocabulary, their lengths and token counts.

    The pattern never looks back, and forward at most one character beyond white space: so
    pre-tokens depend only on what follows their begin, and those that end ``CONTEXT``
    characters before a change stay as they are.  Special tokens are pre-tokens of their own.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = Tokenizer.from_file(path)
        self.special = specials(tokenizer)
        self.context = 2 + max(map(len, self.special), default=0)
        self._find = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)").search
        self._match = regex.compile(public_tokenizers.PATTERN).finditer
        self._single = _of_pretokens(tokenizer)
        self._counts: dict[str, int] = {}
        self._memo: dict[str, bytes] = {}

    def ends(self, text: str, start: int = 0) -> Iterator[int]:
        """Where the pre-tokens end that follow from ``start``, the begin of one; nothing is read ahead of need."""
        while start < len(text):
            mark = self._find(text, start)
            stop = mark.start() if mark else len(text)
            for match in self._match(text, start, stop):
                yield match.end()
            if mark:
                yield mark.end()
            start = mark.end() if mark else stop

    def counts(self, words: list[str]) -> list[int]:
        """Ids of each pre-token."""
        held = self._counts
        unseen = list({word for word in words if word not in held})
        found = dict(zip(unseen, (len(e.ids) for e in self._single.encode_batch_fast(unseen, add_special_tokens=False))))
        found |= {word: 1 for word in self.special if word in found}
        out = [found[word] if word in found else held[word] for word in words]
        if len(held) > MEMO_PRETOKENS:
            held.clear()
        held.update((word, n) for word, n in found.items() if len(word) <= MEMO_CHARS)
        return out

    def table(self, text: str, start: int = 0, stops: list[int] | None = None) -> np.ndarray:
        """(length, ids) of the pre-tokens from ``start`` to the ends ``stops``, or to the text's end."""
        stops = list(self.ends(text, start)) if stops is None else stops
        words = [text[a:b] for a, b in zip([start, *stops], stops)]
        return np.array([list(map(len, words)), self.counts(words)], "<u4").T.reshape(-1, 2)

    def tables(self, texts: list[str]) -> list[np.ndarray]:
        """``table`` of whole texts, by a memo of the pieces between blanks."""
        memo = self._memo
        cut = [None if any(x in text for x in self.special) else pieces(text) for text in texts]
        missing = list({piece for parts in cut if parts for piece in parts[1:] if piece not in memo})
        words = [[m[0] for m in self._match(" " + piece)] for piece in missing]
        sizes = self.counts([word for parts in words for word in parts])
        flat = np.array([[len(word) for parts in words for word in parts], sizes], "<u4").T.tobytes()
        place, new = 0, {}
        for piece, parts in zip(missing, words):
            new[piece] = flat[place : (place := place + 8 * len(parts))]
        memo.update(new)
        out = []
        for text, parts in zip(texts, cut):
            if parts is None:
                out.append(self.table(text))
            else:
                data = self.table(parts[0]).tobytes() + b"".join(map(memo.__getitem__, parts[1:]))
                out.append(np.frombuffer(data, "<u4").reshape(-1, 2))
        if len(memo) > MEMO_PIECES:
            memo.clear()
        else:
            for piece in new:
                if len(piece) > MEMO_CHARS:
                    del memo[piece]
        return out
