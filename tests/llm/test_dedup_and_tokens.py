import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from podium.llm import packing, simhash, simple8b
from podium.llm.tokens import encoder

ODD = [
    None, "", " ", "a", "one two", "x  y   z", "tab\t and\n \nnew  line ", "  lead", "it's we'll  nbsp\x1c end", "é" * 300,
    "Ünïcode wörds İstanbul ſ K", "<|endoftext|> plain <|startoftext|>", "plain <|endoftext|> more", "a  <|endoftext|>\n b<|endoftext|><|endoftext|>c <|endoftext", "x <|ENDOFTEXT|> y", "a ́ b", "日本語 テキスト", "trailing \n", "12,345.67 $%^ &&&  *",
]


def rows(spark, texts):
    data = [(i * 7 % 101, t, "src", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, source string, fp string")


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(items):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    out = {}
    for i, (d, _) in enumerate(items):
        out.setdefault(find(i), []).append(d)
    return {i: min((x for x in out[find(i)] if x is not None), default=None) for i in range(len(items))}


def test_fingerprints_and_components(spark):
    rng = random.Random(1)
    words = ["w%d" % i for i in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 200]))) for _ in range(40)]
    texts = [*ODD, *base, *base[:10]]
    for t in base[:20]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    data = [(i, t, "x") for i, t in enumerate(texts)] + [(None, base[0], "x"), (3, base[1], "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp string")
    got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    items = [(d, brute_fingerprint(t)) for d, t, _ in data]
    comps = brute_components(items)
    assert sorted(map(str, got)) == sorted(str((d, f, comps[i])) for i, (d, f) in enumerate(items))


def test_trie_links_match_brute_force(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(60)]
    values = {0, 2**64 - 1, 2**63, *seeds}
    for s in seeds:
        v = s
        for _ in range(4):
            v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    roots = {r.node % 2**64: r.root for r in simhash.components(simhash.trie_links(df)).collect()}
    comp = brute_components(list(enumerate(values)))
    for i, v in enumerate(values):
        for j, u in enumerate(values):
            assert (comp[i] == comp[j]) == (v == u or (v in roots and roots.get(v) == roots.get(u)))


def test_empty_table(spark):
    empty = rows(spark, ["x"]).where("false")
    assert simhash.near_duplicates(empty).count() == 0
    assert packing.packed_digests(empty).count() == 0


@pytest.mark.parametrize("name,keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_memo_gives_the_library_ids(spark, name, keep):
    path = public_tokenizers.path(name)
    tk = Tokenizer.from_file(path)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(2)
    odd = ["".join(rng.choice("ab1 é́\n\t '.s\x1c  ") for _ in range(30)) for _ in range(300)]
    texts = [t or "" for t in [*ODD, *docs, *odd]]
    want = [np.array(e.ids, "<u4").tobytes() for e in tk.encode_batch(texts, add_special_tokens=False)]
    assert encoder(path, keep)(texts) == want


def test_pack_covers_every_id_once(spark):
    texts = [*ODD, "word " * 5000, "word " * 5000]
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack(rows(spark, texts).repartition(3), public_tokenizers.path("byte_bpe_50k.json")).collect()
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(seqs) == list(range(len(seqs)))
    for k, spans in seqs.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 2048 or k == max(seqs)
    for i, t in enumerate(texts):
        mine = sorted((r.start, bytes(r.ids)) for r in out if r.doc_id == i * 7 % 101)
        ids = tk.encode(t or "", add_special_tokens=False).ids + [1]
        assert b"".join(x for _, x in mine) == np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("top", [1, 2, 16, 2**16, 2**31, 2**62])
def test_simple8b_round_trip(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        ids = rng.integers(0, top, n, dtype=np.uint64) if n else np.zeros(0, np.uint64)
        ids[: n // 3] = 0
        words, first = simple8b.encode_blocks(ids)
        assert (simple8b.decode_blocks(words, first, n) == ids).all()


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simple8b, "SHARD_IDS", 300)
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = rows(spark, [*ODD, "lots of words here " * 200])
    simple8b.write_ids(docs, str(tmp_path / "ids"), path)
    got = [tuple(r) for r in simple8b.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()]
    tk = Tokenizer.from_file(path)
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = tk.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
