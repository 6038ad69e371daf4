"""License notices in whole texts: exact phrases, and short notices with errors.

A notice of n characters may have ``n // CHARS_PER_ERROR`` errors.  It is split into one
seed more than that, so at least one seed stands unchanged wherever the notice does
(pigeonhole).  Exact seed hits mark candidate stretches; overlapping ones are merged, and
those with too few of the notice's trigrams dropped; the regex library then looks for the
notice with bounded errors there and reports span and edits.

Texts are lower-cased (A-Z) and cut into words; all matching is on words joined by single
blanks, and spans are word places from 0, ends exclusive.

Defined results: a null or wordless text has no words, no labels and score 0; repeated
rows are reported each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import table, utf8

#: The base phrases of the contract and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices and labels of our own.
NOTICES = {
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-notice",
    "licensed under the apache license version 2 0": "apache-2.0-notice",
    "licensed under the gnu general public license version 3": "gpl-3.0-notice",
    "licensed under the gnu general public license version 2": "gpl-2.0-notice",
    "this program is free software you can redistribute it and or modify it": "gnu-notice",
    "gnu lesser general public license": "lgpl-notice",
    "gnu affero general public license": "agpl-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-notice",
    "permission to use copy modify and or distribute this software for any purpose": "isc-notice",
    "subject to the terms of the mozilla public license": "mpl-notice",
    "licensed under the eclipse public license": "epl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "creative commons attribution": "cc-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
    "all rights reserved": "all-rights-reserved",
    "this work is licensed under a creative commons": "cc-notice",
    "distributed under the boost software license": "bsl-notice",
    "licensed under the artistic license 2 0": "artistic-notice",
    "licensed under the server side public license": "sspl-notice",
    "use of this source code is governed by a bsd style license": "bsd-notice",
    "dedicated to the public domain under cc0": "cc0-notice",
    "the software is provided as is without warranty of any kind": "no-warranty-notice",
}
CHARS_PER_ERROR = 10
_WORDS = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Notice:
    def __init__(self, text: str, label: str) -> None:
        self.label, self.length = label, len(text)
        self.errors = self.length // CHARS_PER_ERROR
        cuts = [self.length * k // (self.errors + 1) for k in range(self.errors + 2)]
        self.seeds = [(a, text[a:b].encode()) for a, b in zip(cuts, cuts[1:])]
        self.grams = [text[i : i + 3].encode() for i in range(self.length - 2)]
        self.patterns = [regex.compile(b"(?e)(?:%s){e<=%d}" % (text.encode(), e)) for e in range(self.errors + 1)]

    def find(self, joined: bytes, begins: list[int]) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits) of matches in stretches that begin at ``begins``; overlapping stretches are one."""
        merged: list[list[int]] = []
        for begin in sorted(begins):
            end = begin + self.length + 2 * self.errors
            if merged and begin <= merged[-1][1]:
                merged[-1][1] = end
            else:
                merged.append([max(0, begin), end])
        gaps = [(begin, min(end, len(joined))) for begin, end in merged]
        for pattern in self.patterns:  # few errors first: what is found need not be searched with more
            left = []
            for begin, end in gaps:
                if not self._may_hold(joined[begin:end]):
                    continue
                for match in pattern.finditer(joined, begin, end):
                    yield match.start(), match.end(), sum(match.fuzzy_counts)
                    left.append((begin, match.start()))
                    begin = match.end()
                left.append((begin, end))
            gaps = left

    def _may_hold(self, stretch: bytes) -> bool:
        """An error changes three trigrams at most: a stretch with fewer left holds no match."""
        if len(stretch) < self.length - self.errors:
            return False
        return sum(gram in stretch for gram in self.grams) >= len(self.grams) - 3 * self.errors


NOTICE_LIST = [Notice(text, label) for text, label in NOTICES.items()]


def _seed_automaton() -> ahocorasick.Automaton:
    """Finds all seeds of all notices in one pass; a hit tells (last character, [(notice, its begin before that)])."""
    places: dict[str, list[tuple[int, int]]] = {}
    for k, notice in enumerate(NOTICE_LIST):
        for at, seed in notice.seeds:
            places.setdefault(seed.decode("latin-1"), []).append((k, at + len(seed) - 1 + notice.errors))
    automaton = ahocorasick.Automaton()
    for seed, owners in places.items():
        automaton.add_word(seed, owners)
    automaton.make_automaton()
    return automaton


SEEDS = _seed_automaton()


def scan(text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, int]], float]:
    """Words, base places (word, label), notices (first word, word after, label, edits), score."""
    words = text.translate(_WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    base = []
    for phrase, label in BASE.items():
        wanted = b" " + phrase.encode() + b" "
        place, counted, word = joined.find(wanted), 0, 0
        while place >= 0:
            word += joined.count(b" ", counted, place)
            counted = place
            base.append((word, label))
            place = joined.find(wanted, place + 1)
    spans, score = [], 1.0 if base else 0.0
    candidates: dict[int, list[int]] = {}
    for last, owners in SEEDS.iter(joined.decode("latin-1")):
        for k, back in owners:
            candidates.setdefault(k, []).append(last - back)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) if candidates else None
    for k, begins in candidates.items():
        notice = NOTICE_LIST[k]
        for start, end, edits in notice.find(joined, begins):
            first, after = np.searchsorted(blanks, [start + 1, end - 1]).tolist()
            spans.append((first - 1, after, notice.label, edits))
            score = max(score, 1 - edits / notice.length)
    return len(words), sorted(base), sorted(set(spans)), score


def scanned(docs: DataFrame) -> DataFrame:
    """Per document: n_words, base and notices (arrays), score."""
    places = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    spans = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("label", pa.string()), ("edits", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(text) for text in utf8(batch, "text")]
            columns = [
                batch.column(0),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([[{"word": w, "label": x} for w, x in f[1]] for f in found], places),
                pa.array([[dict(zip(("first", "after", "label", "edits"), s)) for s in f[2]] for f in found], spans),
                pa.array([f[3] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "base", "notices", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run,
        "doc_id long, n_words long, base array<struct<word:long,label:string>>, "
        "notices array<struct<first:long,after:long,label:string,edits:long>>, score double",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents"))
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        listed(F.col("base.label")).alias("base_labels"), listed(F.concat("base.label", "notices.label")).alias("labels"), "score",
        F.array_join(F.transform("notices", lambda n: F.concat_ws(":", n["label"], n["first"].cast("string"), n["after"].cast("string"), n["edits"].cast("string"))), ",").alias("notices"),
    )
