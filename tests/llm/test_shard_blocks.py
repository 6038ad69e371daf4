"""Blocks of a shard: every word holds as many ids as fit, at block ends too, and decodes to the same ids."""

from __future__ import annotations

import numpy as np
import pytest

from podium.llm import simple8b


def _plain(ids: list[int], block: int) -> list[int]:
    """The words, id by id."""
    words = []
    for at in range(0, len(ids), block):
        rest = ids[at : at + block]
        while rest:
            for s, (count, width) in enumerate(zip(simple8b.COUNTS.tolist(), simple8b.WIDTHS.tolist())):
                held = rest[:count]
                if all(x < 1 << width for x in held):
                    words.append(s << 60 | sum(x << j * width for j, x in enumerate(held)))
                    break
            else:
                held = rest[:1]
                words += [simple8b.ESCAPE << 60, held[0]]
            rest = rest[len(held) :]
    return words


@pytest.mark.parametrize("block", [7, 64, 1024])
@pytest.mark.parametrize("bits", [1, 5, 12, 16, 31, 60, 64])
def test_words_are_those_of_a_plain_walk(block, bits):
    rng = np.random.default_rng(bits)
    for n in (1, 6, 7, 65, 1500):
        widths = rng.integers(0, bits + 1, n // 40 + 1).repeat(40)[:n].astype(np.uint64)
        ids = np.array([int(x) >> 64 - int(w) if w else 0 for x, w in zip(rng.integers(0, 2**64 - 1, n, np.uint64, endpoint=True), widths)], np.uint64)
        words, first = simple8b.encode_blocks(ids, block)
        assert words.tolist() == _plain(ids.tolist(), block)
        assert np.array_equal(simple8b.decode_blocks(words, first, n, block), ids)
