import random
import time

import numpy as np
from pyspark.sql import functions as F

from lattica.llm import classifier as c


def plain_score(model, text):
    x = c.array_of(text)
    n = -(-(len(x) + c.WIDTH - 1) // c.CHUNK)
    x = np.concatenate([x, np.zeros(n * c.CHUNK + c.WIDTH - len(x), np.uint8)])
    maxima = np.zeros((n, c.FILTERS))
    for p in range(n * c.CHUNK - c.WIDTH + 1):
        z = sum(model.table[k, x[p + k]] for k in range(c.WIDTH))
        maxima[p // c.CHUNK] = np.maximum(maxima[p // c.CHUNK], z)
    h = np.concatenate([maxima.max(0), maxima.mean(0)])
    return 1 / (1 + np.exp(-(h @ model.weights + model.bias)))


def a_model(seed=1):
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.3, (c.WIDTH, 256, c.FILTERS))
    table[:, 0] = 0
    return c.Model(table, rng.normal(0, 0.3, 2 * c.FILTERS), 0.1)


def test_scores_equal_the_plain_network():
    model = a_model()
    texts = [b"", b"a", b"abc abc abc", "é ü".encode() * 40, bytes(range(32, 127)) * 9, b"x" * c.CHUNK, b"y" * (c.CHUNK * 3 + 1)]
    together = model.scores([c.array_of(t) for t in texts], model.pairs())
    for t, s in zip(texts, together, strict=True):
        assert abs(s - plain_score(model, t)) < 1e-4
        assert model.scores([c.array_of(t)], model.pairs())[0] == s


def test_slabs_do_not_change_scores(monkeypatch):
    model, text = a_model(2), b"some words in a row " * 500
    whole = model.scores([c.array_of(text)], model.pairs())
    monkeypatch.setattr(c, "SLAB", 3)
    assert model.scores([c.array_of(text)], model.pairs())[0] == whole[0]


def test_stretches_are_spread_over_the_whole_text():
    text = bytes(range(1, 251)) * 4000
    assert c.stretches(text[: 4 * c.CHUNK], 4) == text[: 4 * c.CHUNK]
    got = c.stretches(text, 5)
    own = c.CHUNK - c.WIDTH + 1
    assert len(got) == 5 * c.CHUNK
    assert got[:own] == text[:own] and got[-c.CHUNK :][:own] == text[-own:] and got[2 * c.CHUNK :][:own] in text


def test_very_long_texts():
    model = a_model(4)
    one = b"word after word, " * 300_000
    start = time.perf_counter()
    (score,) = model.scores([c.array_of(one)], model.pairs())
    assert 0 <= score <= 1 and time.perf_counter() - start < 10
    assert list(c._by_bytes([b"x" * 9, b"", b"y" * 3, b"zz"], 4)) == [[b"x" * 9], [b"", b"y" * 3], [b"zz"]]


def test_labels_of_every_length_are_learned(spark):
    """What sets the labels apart stands only in texts beyond any number of chunks."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 5) + ("$" if i % 2 else "") for _ in range(9000)), 1 - i % 2) for i in range(60)]
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(0, 1), (0, 1)], "doc_id long, quality int")
    sample, weight = c.training_rows(docs, labels, max_chunks=8)
    held = {r["doc_id"] for r in docs.filter(c.fold() == 0).select("doc_id").collect()}
    assert len(sample) == 60 - len(held) and {len(t) for t, _ in sample} == {8 * c.CHUNK}
    model = c.fit(sample, weight)
    got = {r["id"]: r["score"] for r in c.scored(docs, model).collect()}
    assert all((got[d] > 0.5) == bool(y) for d, _, y in rows)


def test_learns_and_holds_out(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(500):
        good = i % 4 > 0
        text = " ".join(word() + ("" if good else rng.choice(["$$$", "###"])) for _ in range(rng.randint(5, 80)))
        rows.append((i, text, int(good)))
    docs = spark.createDataFrame([(d, t, 1.0) for d, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(10_000, 1), (None, 0), (3, None)], "doc_id long, quality int")
    sample, weight = c.training_rows(docs, labels)
    held = {r["doc_id"] for r in docs.filter(c.fold() == 0).select("doc_id").collect()}
    assert held and not {t for d, t, _ in rows if d in held} & {t.decode() for t, _ in sample}
    got = {r["id"]: r["score"] for r in c.scored(docs, c.fit(sample, weight)).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    right = [(got[d] >= c.THRESHOLD) == bool(y) for d, _, y in rows if d in held]
    assert sum(right) >= 0.97 * len(right)
    bound, _ = c.training_rows(docs, labels, max_rows=20)
    assert len(bound) <= 40


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "words"), (4, "x" * 300_000), (4, "x" * 300_000)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = c.fit(*c.training_rows(docs, labels))
    assert [r["score"] for r in c.scored(docs, model).collect()] == [0.5] * 5
    scores = c.scored(docs, a_model()).select("id", F.round("score", 9).alias("s")).collect()
    assert scores[0]["s"] == scores[1]["s"] and scores[3]["s"] == scores[4]["s"]
    assert c.scored(docs.limit(0), model).collect() == []
