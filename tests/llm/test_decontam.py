import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from lattica.llm import decontam


def edit_distance_in(pattern, text):
    """Least distance of the pattern to a stretch of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != t)))
    return min(row)


@given(st.text("ab ", min_size=1, max_size=20), st.text("ab ", max_size=40))
@settings(max_examples=200, deadline=None)
def test_myers_is_the_edit_distance(pattern, text):
    best = edit_distance_in(pattern, text)
    hit = decontam.myers(pattern, text, len(pattern))
    assert (hit[0] if hit else len(pattern)) == best
    assert decontam.myers(pattern, text, best - 1) is None


@given(st.lists(st.text("ab é", min_size=1, max_size=70), min_size=1, max_size=9), st.text("ab é.", max_size=50))
@settings(max_examples=200, deadline=None)
def test_side_by_side_equals_one_by_one(patterns, text):
    most = [len(p) * 2 // 3 for p in patterns]
    assert decontam.myers_together(patterns, text, most) == [decontam.myers(p, text, k) for p, k in zip(patterns, most, strict=True)]


@given(st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_any_item_within_its_budget_is_found(seed):
    rng = random.Random(seed)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(8, 20)))
    (known,) = decontam.items_of([(4, item)])
    text = list(item)
    for _ in range(rng.randint(0, known.budget)):
        i = rng.randrange(len(text))
        text[i : i + 1] = rng.choice([[], [text[i], "x"], ["y"]])
        text = text or ["z"]
    before, after = "qq rr ss " * rng.randint(0, 5), " tt uu" * rng.randint(0, 5)
    hits = decontam.Searcher([known])(before + "".join(text).upper() + after)
    assert [h[0] for h in hits] == [4] and hits[0][1] <= known.budget


def test_places_are_those_of_the_text_as_given():
    item = "The quick brown fox jumps over the lazy dog"
    text = "Éa -- «THE quick,\n\nbrown fox; jumps over the lazy dog!» end"
    ((_, distance, start, end),) = decontam.Searcher(decontam.items_of([(1, item)]))(text)
    assert distance == 0 and text[start:end] == "THE quick,\n\nbrown fox; jumps over the lazy dog"


def test_search_equals_brute_force():
    rng = random.Random(5)
    words = ["the", "of", "and", "alpha", "beta", "gamma", "delta"]
    items = decontam.items_of([(i, " ".join(rng.choice(words) for _ in range(9))) for i in range(12)])
    search = decontam.Searcher(items)
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(40))
        expected = {(x.item_id, d) for x in items if (d := edit_distance_in(x.text, decontam.normalised(text))) <= x.budget}
        assert {(i, d) for i, d, _, _ in search(text)} == expected


def test_templated_items_equal_brute_force_and_are_quick():
    """Items that share all but a word or two, and texts made from the same template."""
    rng = random.Random(11)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 14))) for _ in range(2000)]
    ask = "Which of the following cities is the capital of the old kingdom of {}? Choose one of the answers below.".format
    items = decontam.items_of([(i, ask(n)) for i, n in enumerate(names)])
    texts = [" ".join(ask(rng.choice(names) if rng.random() < 0.5 else "nowhere" * rng.randint(1, 3)) for _ in range(rng.choice([1, 1, 1, 2, 24]))) for _ in range(30)]
    search, start = decontam.Searcher(items), time.perf_counter()
    got = [{(i, d) for i, d, _, _ in search(t)} for t in texts]
    assert time.perf_counter() - start < 20
    few = set(rng.sample(range(len(items)), 40))
    for text, own in zip(texts[:15], got):
        norm = decontam.normalised(text)
        expected = {(items[i].item_id, hit[0]) for i in few if (hit := decontam.myers(items[i].text, norm, items[i].budget))}
        assert {x for x in own if x[0] in few} == expected
    assert sum(map(len, got)) > 5_000


def test_places_with_letters_that_change_their_length():
    item = "The quick brown fox jumps over the lazy dog"
    text = "ΣΑΣ İİ ß: the quick brown fox jumps over the lazy dog ΣΑΣ"
    ((_, _, start, end),) = decontam.Searcher(decontam.items_of([(1, item)]))(text)
    assert text[start:end] == item.lower()


def test_very_long_texts():
    items = decontam.items_of([(1, ITEM), (2, "short one")])
    search = decontam.Searcher(items)
    for filling in (" " * 3_000_000, "what is " * 200_000, "x" * 3_000_000, "the boiling point " * 100_000):
        start = time.perf_counter()
        assert [x[0] for x in search(f"{filling} {ITEM}")] == [1] and time.perf_counter() - start < 20


ITEM = "what is the boiling point of water at sea level in degrees"
DOCS = "doc_id long, text string, item_id string, start int"


def test_leaks_and_edges(spark):
    docs = spark.createDataFrame([(1, f"so: {ITEM.title()}?", "x", 1), (2, None, "x", 1), (3, "", "x", 1), (None, ITEM, "x", 1), (4, "clean words only " * 2000, None, 1), (1, f"so: {ITEM.title()}?", "x", 1)], DOCS)
    bench = spark.createDataFrame([(7, ITEM), (None, "another item that has no number at all"), (8, None), (9, "short")], "item_id long, text string")
    rows = sorted(map(tuple, decontam.leaks(docs, bench).collect()), key=str)
    assert rows == [(1, 7, 0, 4, 4 + len(ITEM)), (1, 7, 0, 4, 4 + len(ITEM)), (None, 7, 0, 0, len(ITEM))]
    assert sorted(r["doc_id"] for r in decontam.drop_leaks(docs, bench).collect()) == [2, 3, 4]
    many = decontam.leaks(docs, bench, block_chars=30)
    assert sorted(map(tuple, many.collect()), key=str) == rows
    assert decontam.drop_leaks(docs, bench, block_chars=30).count() == 3
    assert decontam.leaks(docs, bench.limit(0)).count() == 0
    assert decontam.leaks(docs.limit(0), bench).count() == 0
    assert decontam.drop_leaks(docs, bench.limit(0)).count() == 6


def test_short_items_and_items_without_id(spark):
    short, han, edited = "What is 12 times 7?", "水的沸点在海平面是多少摄氏度", "What is 12 times 8?"
    docs = spark.createDataFrame([(1, f"Q: {short} A: 84", "x", 1), (2, f"请问{han}呢。", "x", 1), (3, f"{edited} 96", "x", 1), (4, "somewhat is 12 times 7", "x", 1), (5, "what is 12 times 70", "x", 1), (6, f"so: {ITEM}", "x", 1), (7, "clean", "x", 1)], DOCS)
    bench = spark.createDataFrame([(1, short), (2, han), (None, ITEM), (3, "?!")], "item_id long, text string")
    rows = sorted(map(tuple, decontam.leaks(docs, bench).collect()))
    assert rows == [(1, 1, 0, 3, 3 + len(short) - 1), (2, 2, 0, 2, 2 + len(han)), (6, None, 0, 4, 4 + len(ITEM))]
    assert sorted(r["doc_id"] for r in decontam.drop_leaks(docs, bench).collect()) == [3, 4, 5, 7]
