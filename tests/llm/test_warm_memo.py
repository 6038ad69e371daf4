"""Ids do not depend on what an encoder has met before, nor on who shares a doc_id."""

import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from podium.llm import simple8b
from podium.llm.tokens import encoder

PARTS = ["a", "0a", "İ", "I", "é", "é", "ſ", "ß", "日", "́", "각", "가", "ﬁ", "½", "x²", "̇", "A", "Z9", "_", "'s", "Ω", "Ǆ", "ﬀ", "٣"]
TAILS = ["", ".", ",", "..", ".,", "...", ",.a"]


@pytest.mark.parametrize("name, keep_blank", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_a_warm_memo_changes_nothing(name, keep_blank):
    path = public_tokenizers.path(name)
    tokenizer, encode = Tokenizer.from_file(path), encoder(path, keep_blank)
    rng = random.Random(8)
    for _ in range(60):
        texts = [" ".join("".join(rng.choices(PARTS, k=rng.randint(1, 2))) + rng.choice(TAILS) for _ in range(rng.randint(1, 5))) for _ in range(120)]
        for text, ids in zip(texts, encode(texts)):
            plain = b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids)
            assert ids == plain, text


def test_shared_and_missing_ids_over_many_ranges(spark, tmp_path):
    texts = [f"see İ. and word İ here . it ended {k % 40}." for k in range(900)]
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, text) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("extra", "n_tokens")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    simple8b.write_ids(docs, f"{tmp_path}/ids", public_tokenizers.path("word_bpe_49k.json"))
    got = simple8b.read_ids(spark, f"{tmp_path}/ids").collect()
    want = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
