"""Near-duplicates and components against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lattica.llm import minhash
from lattica.llm.components import components

DOCS = "doc_id long, text string, source string, id string, component int"


def plain(rows, width, percent):
    """component and number of shingles by id, by comparing all pairs."""
    sets = {}
    for d, text in rows:
        words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        k = min(width, len(words))
        sets[d] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    above = {d: d for d in sets}

    def top(d):
        while above[d] != d:
            d = above[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                above[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}


def near_copies(seed, groups=6, size=25, words=60):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(9)):
                text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", "clash", 7) for d, t in rows], DOCS)


def found(df):
    return {r["id"]: (r["n_shingles"], r["component"]) for r in df.collect()}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_groups_of_near_copies(spark, width, percent):
    rows = list(enumerate(near_copies(width)))
    got = found(minhash.near_duplicates(frame(spark, rows), minhash.Settings(width=width, percent=percent)))
    assert got == plain(rows, width, percent)


def test_blocks_lose_no_link(spark, monkeypatch):
    for name, size in (("BLOCK", 16), ("BLOCK_SETS", 8), ("FIRSTS", 4), ("PARTNERS", 8), ("BROADCAST_IDS", 0)):
        monkeypatch.setattr(minhash, name, size)
    rows = list(enumerate(near_copies(3, groups=2, size=60)))
    s = minhash.Settings(width=3, percent=85)
    monkeypatch.setattr(minhash._blocks, "__defaults__", None)
    assert found(minhash.near_duplicates(frame(spark, rows), s)) == plain(rows, 3, 85)


def test_nulls_short_and_repeated(spark):
    rows = [(5, "A b"), (3, "a  B"), (4, None), (9, ""), (7, " \n"), (8, "one two three four five six"), (2, "one two three four five six"), (2, "one two three four five six"), (None, "one two three four five six"), (11, "x" * 200_000)]
    got = sorted((r["id"], r["n_shingles"], r["component"]) for r in minhash.near_duplicates(frame(spark, rows), minhash.Settings(width=3, percent=85)).collect())
    assert got == [(2, 4, 2), (2, 4, 2), (3, 1, 3), (4, 0, 4), (5, 1, 3), (7, 0, 7), (8, 4, 2), (9, 0, 9), (11, 1, 11)]


def test_keep_first(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None), (None, "q"), (None, "q")]
    kept = minhash.keep_first(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "source", "id", "component"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 3), (False, 4), (True, 0), (True, 0)]


def test_empty_table(spark):
    assert minhash.near_duplicates(frame(spark, [])).collect() == []
    assert minhash.keep_first(frame(spark, [])).collect() == []


def test_bands_follow_the_allowed_miss():
    for percent in (70, 80, 85, 95):
        s = minhash.Settings(percent=percent)
        assert (1 - (percent / 100) ** s.rows) ** s.bands <= s.miss
        assert 0 < s.least_agreement < s.minima * percent / 100


@given(st.text(alphabet="aB c\n\tD", max_size=60))
@settings(max_examples=60, deadline=None)
def test_shingles_ignore_case_and_spacing(text):
    shingle = minhash.Shingler(3)
    words = text.lower().split()
    assert shingle(text.encode()).tolist() == shingle("  ".join(words).encode()).tolist()
    k = min(3, len(words))
    assert len(shingle(text.encode())) == (len({tuple(words[i : i + k]) for i in range(len(words) - k + 1)}) if words else 0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 120
    edges = [(i, i + 1) for i in range(0, 30)] + [(rng.randrange(40, n), rng.randrange(40, n)) for _ in range(60)] + [(3, 3), (None, 4), (5, None)]
    above = {i: i for i in range(n)}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: top(x) for x in touched}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
