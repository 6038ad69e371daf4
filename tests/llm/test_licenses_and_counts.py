import random
import re
import time

import public_tokenizers
from tokenizers import Tokenizer

from podium.llm import licenses, token_counts
from podium.llm.tokens import Pretokens

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_base(text):
    words = WORD.findall(lower(text))
    out = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(out)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_base_places_match_brute_force(spark):
    rng = random.Random(6)
    atoms = ["MIT", "mit", "License", "license", "LICENSE,", "apache", "general", "public", "é", "x1", "\n", "-", "GNU", "İ", "mit license"]
    texts = [None, "", "mit license mit license", "…", *(rng.choice([" ", ". ", "-"]).join(rng.choice(atoms) for _ in range(rng.randrange(60))) for _ in range(200))]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    for r in licenses.scanned(docs).collect():
        n, base = brute_base(texts[r.doc_id] or "")
        assert (r.n_words, [(x.word, x.label) for x in r.base]) == (n, base)
        assert 0 <= r.score <= 1


def test_notices_with_errors():
    rng = random.Random(8)
    for notice in licenses.NOTICE_LIST:
        text = next(t for t in licenses.NOTICES if len(t) == notice.length and licenses.NOTICES[t] == notice.label)
        for _ in range(4):
            chars = list(text)
            for _ in range(notice.errors):
                chars[rng.randrange(1, len(chars) - 1)] = rng.choice("abcdexyz")
            changed = "".join(chars)
            found = [s for s in licenses.scan(f"Some prose first. {changed}! And after it, more words.".encode())[2] if s[2] == notice.label]
            assert found and found[0][3] <= distance(text, changed)
    assert licenses.scan(b"plain words about nothing of the sort, with rights and licenses unreserved")[2] == []
    many = b"all rights reserved. " * 3000 + b"all rihts reserved"
    assert len(licenses.scan(many)[2]) == 3001


PATH = public_tokenizers.path("byte_bpe_50k.json")


def tree_of(text, by):
    (leaves,) = by.tables([text])
    assert (token_counts.load(token_counts.dump(leaves)) == leaves).all()
    return token_counts.CountTree(text, leaves, by)


def test_time_grows_with_the_hits():
    def took(n):
        at = time.process_time()
        licenses.scan(b"all rights reserved. " * n)
        return time.process_time() - at

    took(500)
    small, large = (min(took(n) for _ in range(3)) for n in (3000, 12000))
    assert large < 8 * small


def test_query_columns_match_brute_force(spark, tmp_path):
    texts = [None, "", "The MIT License and the Apache License. mit license", "all rights reserved", "plain", "plain", "released under the mit licence here", "word " * 50000 + "general public license"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in licenses.op2_license_scan(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        n, base = brute_base(text or "")
        r = got[i]
        assert (r.n_words, r.n_base) == (n, len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in base})) and 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert got[3].labels == "all-rights-reserved" and got[3].notices == "all-rights-reserved:0:3:0"
    # one letter differs from "released under the mit license", which is words 0 to 4
    assert got[6].labels == "mit-notice" and got[6].notices == "mit-notice:0:5:1" and got[6].score == 1 - 1 / 30
    assert licenses.scanned(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_edits_keep_exact_counts():
    tk = Tokenizer.from_file(PATH)
    by, rng = Pretokens(PATH), random.Random(1)
    full = lambda t: len(tk.encode(t, add_special_tokens=False).ids)
    atoms = ["ab", "c ", " ", "\n", " d", "é", "1", ".", " the word", "<|endoftext|>", "<|end", "oftext|>", "'ll", "  ", "日本語"]
    make = lambda n: "".join(rng.choice(atoms) for _ in range(n))
    for _ in range(200):
        tree = tree_of(make(rng.choice([0, 1, 5, 50, 3000])), by)
        assert tree.total == full(tree.text)
        for _ in range(6):
            at = rng.randrange(len(tree.text) + 2)
            tree.edit(at, at + rng.choice([0, 1, 3, 200, 5000]), make(rng.choice([0, 0, 1, 4, 900])))
            assert tree.total == full(tree.text)
            # the leaves are those of a tree of the new text
            assert [x for x in tree.table().tolist() if x[0]] == by.table(tree.text).tolist()


def test_an_edit_recodes_little():
    by = Pretokens(PATH)
    for unit in ("some words to count here ", "日本語の文章は、空白なしで続く。", "line\n", "a,b;c=d(e);"):
        tree = tree_of(unit * (1_000_000 // len(unit)), by)
        tree.recoded = 0
        tree.edit(500_000, 500_003, "xyz")
        assert 0 < tree.recoded < 25
        assert tree.recoded < 10 or len(unit) / len(list(by.ends(unit))) < 2  # the context is 15 characters
    assert tree.total == len(Tokenizer.from_file(PATH).encode(tree.text, add_special_tokens=False).ids)


def test_edit_table(spark):
    long = "many words in a very long text " * 20000
    rows = [(1, "one two three", "a"), (2, None, "b"), (3, "left alone", "c"), (None, "x", "d"), (4, long, "e"), (4, long, "e"), (5, "a <|endoftext|> b", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits string")
    edits = spark.createDataFrame([(1, 2, 0, 3, "four"), (1, 1, 0, 0, "zero "), (2, 1, 5, 9, "new"), (9, 1, 0, 0, "lost"), (1, 3, None, None, None), (4, 1, 100000, 100003, "xyz")], "doc_id long, seq int, start int, end int, replacement string")
    stored = token_counts.trees(docs, PATH)
    out = token_counts.edited(token_counts.attach_edits(stored, edits), PATH, keep=True)
    got = {r.doc_id: r for r in out.collect()}
    tk = Tokenizer.from_file(PATH)
    assert got[1].text == "fouro one two three" and got[1].tokens_after == len(tk.encode(got[1].text).ids) and got[1].n_edits == 3
    assert (got[2].tokens_before, got[2].tokens_after) == (0, 1)
    assert got[3].tokens_before == got[3].tokens_after and got[None].n_edits == 0
    assert got[4].tokens_after == len(tk.encode(long[:100000] + "xyz" + long[100003:]).ids) and got[4].n_recoded < 25
    assert got[5].tokens_before == len(tk.encode("a <|endoftext|> b").ids)
    assert out.where("doc_id = 4").count() == 2
    # stored trees take the next table of edits
    later = spark.createDataFrame([(1, 1, 0, 5, "")], "doc_id long, seq int, start int, end int, replacement string")
    again = {r.doc_id: r for r in token_counts.edited(token_counts.attach_edits(out.select("doc_id", "text", "tree"), later), PATH).collect()}
    assert again[1].tokens_before == got[1].tokens_after and again[1].tokens_after == len(tk.encode(" one two three").ids)
    assert token_counts.edited(token_counts.sample_edits(stored.where("false")), PATH).count() == 0


def test_query_counts_are_the_library_s(spark):
    folder = "/root/testdata/sf0.001"
    tk = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r for r in token_counts.sample_edits(token_counts.trees(spark.read.parquet(f"{folder}/documents.parquet"), PATH)).collect()}
    rows = token_counts.op3_token_counts(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id].text or ""
        assert r.tokens_before == len(tk.encode(text, add_special_tokens=False).ids)
        for e in texts[r.doc_id].edits:
            text = text[: e.start] + e.replacement + text[max(e.start, e.end) :]
        assert (r.tokens_after, r.chars_after) == (len(tk.encode(text, add_special_tokens=False).ids), len(text))
