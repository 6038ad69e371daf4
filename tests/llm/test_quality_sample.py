import zlib

import numpy as np
from podium.llm import quality
from pyspark.sql import functions as F


def test_unlabelled_documents_teach_at_every_size(spark):
    rows = [(i, i * 37 % 997, "1" if i % 2 else "0", None if i % 5 < 3 else i % 2) for i in range(1000)]
    rows.append((None, 1, "1", None))
    voted = spark.createDataFrame(rows, "doc_id long, key long, pattern string, given int")
    sides = [F.col("pattern") == "0", F.col("pattern") == "1"]
    given = {d: g for d, _, _, g in rows}
    for size, free in ((100, 50), (50, 25), (380, 190), (450, 250)):  # of 300 unlabelled and 200 labelled rows a side
        drawn = quality.draw(voted, sides, size)
        for side in "01":
            mine = [d for d, _, p in drawn if p == side]
            assert len(mine) == len(set(mine)) == size
            assert sum(given[d] is None for d in mine) == free
    few = quality.draw(voted.where("given is not null"), sides, 100)
    assert len(few) == 200


def test_repeated_rows_come_once_to_the_driver(spark, monkeypatch):
    texts = [f"plain words number w{i} that say a little of this and that é" for i in range(30)] + ["|" * 40 + f" !! {i}" for i in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7])] * 300 + [(7, f"another text w{i} of the same doc_id") for i in range(300)] + [(8, None)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(quality, "train_scorer", lambda rows, target: seen.append((len(rows), len(target))))
    quality.fit(docs, None, 40)
    assert seen[0][0] == seen[0][1] <= 40
    chosen = spark.createDataFrame([(7, zlib.crc32(texts[7].encode()), "1"), (8, 0, "0"), (40, zlib.crc32(texts[40].encode()), "0")], "doc_id long, key long, pattern string")
    found = {r.doc_id: r for r in quality.drawn_features(docs, chosen).collect()}
    assert len(found) == quality.drawn_features(docs, chosen).count() == 3
    assert sorted(np.frombuffer(found[7].x, np.int32)) == sorted(quality.features(texts[7]))


def test_em_teaches_the_scorer(spark, monkeypatch):
    """The same documents and labels, with the first guess in place of EM, give other targets and other weights."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    targets = []
    plain = quality.train_scorer
    monkeypatch.setattr(quality, "train_scorer", lambda rows, target: targets.append(target) or plain(rows, target))
    weight, _ = quality.fit(docs, labels)
    assert any(0 < t < 1 for t in targets[0])  # posteriors of documents without a given label
    fitted = quality.fit_labellers
    monkeypatch.setattr(quality, "fit_labellers", lambda counts: fitted(counts, rounds=0))
    guessed, _ = quality.fit(docs, labels)
    assert not np.array_equal(weight, guessed)
