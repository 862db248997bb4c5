import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lattica.llm import linededup, quality


def plain_lines(rows, ratio):
    pages, seen = Counter(h for _, h in rows), Counter()
    for text, host in rows:
        seen.update({(host, x) for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")})
    out = []
    for text, host in rows:
        if text is None:
            out.append(None)
            continue
        bad = lambda x: x.strip(" \t\n\r\x0b\x0c") and seen[host, x] > 1 and seen[host, x] > pages[host] * ratio  # noqa: B023, E731
        out.append("\n".join(x for x in text.split("\n") if not bad(x)))
    return out


def test_line_dedup_equals_plain(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        host = rng.choice(["a", "a", "a", "b", "c", None, f"small {rng.randrange(30)}"])
        lines = [rng.choice(["menu", "", "  ", "footer é", f"line {rng.randrange(40)}", f"own {i}"]) for _ in range(rng.randrange(0, 7))]
        rows.append((rng.choice([None, "menu"]) if i % 50 == 0 else "\n".join(lines), host))
    docs = spark.createDataFrame([(i, t, h, 9) for i, (t, h) in enumerate(rows)], "doc_id long, text string, source string, line int")
    for size in (linededup.BROADCAST_BYTES, 0):
        got = linededup.drop_lines(docs, max_ratio=0.2, broadcast_bytes=size)
        assert got.columns == docs.columns
        assert [r["text"] for r in got.orderBy("doc_id").collect()] == plain_lines(rows, 0.2)


def test_line_dedup_counts_and_edges(spark):
    docs = spark.createDataFrame([(i, "same\nown %d" % i if i else "same", "h") for i in range(12)] + [(20, None, "h"), (21, "same", "small"), (22, "", None)], "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["text"], r["n"], r["d"]) for r in linededup.drop_lines(docs, counts=("n", "d")).collect()}
    assert got[0] == ("", 1, 1) and got[3] == ("own 3", 2, 1) and got[20] == (None, 0, 0) and got[21] == ("same", 1, 0) and got[22] == ("", 1, 0)
    assert linededup.drop_lines(docs.limit(0)).collect() == []


def plain_repeats(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    return len(inside)


@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=60) | st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e"]), max_size=200))
@settings(max_examples=200, deadline=None)
def test_repeated_words(words):
    assert quality.repeated_words(words * 2) == plain_repeats(words * 2)
    assert quality.repeated_words(words) == plain_repeats(words)


@given(st.text(alphabet="aé#*$ \n\t\x0b\x85 !", max_size=80))
@settings(max_examples=200, deadline=None)
def test_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    got = quality.counts_of(text.encode(), len(text))
    assert got[:4] == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))


def test_thresholds_follow_the_group(spark):
    rng = random.Random(4)
    clean = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "to", "of"]) + str(rng.randrange(99)) for _ in range(n))
    rows = [(i, clean(40), "en", "plain") for i in range(260)]
    # in this source every word has a symbol: that is its ordinary state
    rows += [(1000 + i, " ".join(w + "$" for w in clean(40).split()), "en", "prices") for i in range(260)]
    rows += [(5000, " ".join(w + "$$$" for w in clean(40).split()), "en", "plain"), (5001, clean(19), "en", "plain"), (5002, None, "en", "plain"), (5003, "", None, None), (5004, clean(40), None, None)]
    rows += [(5005, " ".join(["again"] * 7 + clean(8).split() + ["echo"] * 7 + clean(20).split()), "en", "plain")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_words int")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    gone = {r[0] for r in rows} - {r["doc_id"] for r in kept.collect()}
    assert gone == {5000, 5001, 5002, 5003, 5005}
    assert quality.keep_good(docs.limit(0)).collect() == []


def exact_verdicts(rows, slack=0.0):
    """By doc_id: passes the fences set from exact quartiles; ``slack`` moves their ranks apart
    (above 0) or together (below)."""
    names = [*quality.COUNTS, *quality._EXTRA]
    counts = {d: dict(zip(names, quality.counts_of((t or "").encode(), len(t or "")), strict=True)) for d, t, _, _ in rows}
    base = {d: c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"] for d, c in counts.items()}
    passed = [(d, lang, source) for d, _, lang, source in rows if not base[d]]
    out = {d: not base[d] for d, *_ in rows}
    for m in quality.MEASURES:
        rate = {d: counts[d][m.count] / max(counts[d][m.size], 1) for d, _, _ in passed}
        chance = {d: np.sqrt(counts[d][m.count] / m.unit) / max(counts[d][m.size] / m.unit, 1 / m.unit) for d, _, _ in passed}

        def points(keep):
            own = [rate[d] for d, lang, source in passed if keep(lang, source)]
            ranks = (0.25 - slack, 0.5 + slack, 0.5 - slack, 0.75 + slack)
            return len(own), np.quantile(own, ranks, method="inverted_cdf")

        whole = points(lambda lang, source: True)[1]
        for lang, source in {(lang, source) for _, lang, source in passed}:
            n, q = points(lambda a, b: a == lang)  # noqa: B023
            of_lang = (n * q + quality.PRIOR * whole) / (n + quality.PRIOR)
            n, q = points(lambda a, b: (a, b) == (lang, source))  # noqa: B023
            low, mid_low, mid_high, high = (n * q + quality.PRIOR * of_lang) / (n + quality.PRIOR)
            for d, a, b in passed:
                if (a, b) == (lang, source):
                    out[d] &= rate[d] - 3 * chance[d] <= high + 6 * (high - mid_high) and (not m.below or rate[d] + 3 * chance[d] >= low - 6 * (mid_low - low))
    return out


def test_verdicts_equal_exact_quartiles_within_rank_error(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = random.Random(9)
    # groups that differ in every measure, with a few documents far out in each
    made = []
    for g in range(6):
        for i in range(rng.choice([30, 150, 400])):
            odd = rng.random() < 0.05
            words = [rng.choice("abcdefg") * rng.randrange(1 + g, 4 + 2 * g + 9 * odd) + "$" * (rng.random() < 0.1 * g) + "#" * (3 * odd) for _ in range(rng.randrange(15, 90))]
            text = " ".join(w.upper() if rng.random() < 0.05 * g else w for w in words)
            made.append((10_000_000 + 1000 * g + i, text, f"l{g % 2}", f"s{g}"))
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()] + made
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["__keep"] for r in quality.judged(table, carry=["doc_id"]).collect()}
    wide, narrow = exact_verdicts(rows, 0.02), exact_verdicts(rows, -0.02)
    assert all(narrow[d] <= k <= wide[d] for d, k in got.items())
    assert sum(wide[d] != narrow[d] for d in got) < 0.05 * len(got) and 20 < sum(not k for k in got.values()) < 0.4 * len(got)


def test_fences_are_those_of_the_sketches(spark, sf_dir):
    """In every group each fence moves with the quartiles, and one that is 0 stands for
    quartiles that are 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = quality.sketches(quality.with_counts(docs))
    near, far = ({(r["lang"], r["source"]): r for r in quality.fences(found, spread).collect()} for spread in (1.0, 2.0))
    assert near and all(far[g]["mean_word_chars_high"] > r["mean_word_chars_high"] > r["mean_word_chars_low"] > far[g]["mean_word_chars_low"] for g, r in near.items())
    assert all(far[g]["upper_share_high"] > r["upper_share_high"] > 0 for g, r in near.items())


def test_a_few_documents_weigh_little(spark):
    """The fences of a group go smoothly from its language's to its own."""
    few = lambda n: [(i, " ".join(f"w{j}{'$' * 2}" for j in range(25)), "en", "new") for i in range(n)]
    plain = [(10_000 + i, " ".join(f"w{j}" for j in range(25)), "en", "old") for i in range(300)]
    fence = []
    for n in (1, 10, 100, 1000):
        docs = spark.createDataFrame(few(n) + plain, "doc_id long, text string, lang string, source string")
        fence += [r["symbols_per_word_high"] for r in quality.fences(quality.sketches(quality.with_counts(docs))).collect() if r["source"] == "new"]
    assert 0 < fence[0] < 0.1 and fence == sorted(fence) and fence[-1] > 1.5


def test_sketches_merge(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(25)), "en", f"s{i % 7}") for i in range(70)], "doc_id long, text string, lang string, source string")
    whole = quality.fences(quality.sketches(quality.with_counts(docs)))
    parts = quality.sketches(quality.with_counts(docs.filter("doc_id < 30"))).union(quality.sketches(quality.with_counts(docs.filter("doc_id >= 30"))))
    merged = quality.fences(parts.groupBy("lang", "source").agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(m.name).alias(m.name) for m in quality.MEASURES]))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
