"""Token counts, chat formatting and packing."""

import hashlib
import math
import random
import time
from collections import Counter

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from lattica.llm import chat, packing, queries, tokencount

SMALL = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate([b"ab", b"abc", b"bc", b" a", b"cab", b"abcab", "é".encode(), b"  "])}


def best_cut(token, scores):
    """(score, pieces) of the best cut, over all cuts of the token."""
    if not token:
        return 0.0, 0
    ways = []
    for n in range(1, len(token) + 1):
        if token[:n] in scores:
            score, pieces = best_cut(token[n:], scores)
            ways.append((score + scores[token[:n]], pieces + 1))
    return max(ways, key=lambda w: (round(w[0], 9), -w[1]))


@given(st.lists(st.text(alphabet="abcé ", min_size=1, max_size=9), max_size=12))
@settings(max_examples=150, deadline=None)
def test_trie_equals_all_cuts(tokens):
    scores = tokencount.zipf_scores(SMALL)
    trie = tokencount.Trie(scores)
    small = tokencount.Trie(scores, kept_nodes=5)
    for t in tokens:
        expected = best_cut(t.encode(), scores)[1]
        assert trie.count(t.encode()) == expected == small.count(t.encode())


@given(st.text(alphabet="abcé ", min_size=1, max_size=60))
@settings(max_examples=150, deadline=None)
def test_long_pretokens_equal_the_trie(token):
    trie = tokencount.Trie(tokencount.zipf_scores(SMALL))
    assert trie.count_long(token.encode()) == trie.count(token.encode())


def test_token_counts_of_very_long_texts():
    count = tokencount.Counter(tokencount.zipf_scores(tokencount.read_vocabulary()))
    word = "".join(random.Random(8).choices("abcdefgh", k=70_000)).encode()
    assert tokencount.Trie(tokencount.zipf_scores(SMALL), long_bytes=1 << 30).count(word) == tokencount.Trie(tokencount.zipf_scores(SMALL)).count_long(word)
    for text in (" " * 1_000_000, "x" * 1_000_000, "\n" * 1_000_000, "12 " * 300_000, "eyJ" * 300_000):
        start = time.perf_counter()
        pretokens, tokens = count(text)
        assert pretokens <= tokens <= len(text) and time.perf_counter() - start < 10
    # neither nodes nor kept stretches grow with the length of a text
    assert len(count.trie.best) < 1000 and len(count.known) < 1000 and count.held < tokencount.KEPT_BYTES
    whole = "some words, 12 of them\n" * 30_000  # counted a step at a time
    assert count(whole) == tuple(30_000 * n for n in count(whole[: len(whole) // 30_000]))


@given(st.text(max_size=60) | st.text(alphabet="a 1'st\n\té\xa0,", max_size=60))
@settings(max_examples=300, deadline=None)
def test_chunks_hold_whole_pretokens(text):
    chunks = regex.findall(tokencount.CHUNKS, text)
    assert "".join(chunks) == text
    assert [t for c in chunks for t in regex.findall(tokencount.PATTERN, c)] == regex.findall(tokencount.PATTERN, text)


def test_scores_are_a_distribution():
    assert math.isclose(sum(map(math.exp, tokencount.zipf_scores(SMALL).values())), 1)


def test_token_table(spark):
    docs = spark.createDataFrame([(1, "abc abc", 5), (2, None, 5), (3, "", 5), (None, "the cat", 5), (1, "abc abc", 5), (4, "x" * 100_000, 5)], "doc_id long, text string, n_tokens int")
    got = sorted(tokencount.token_counts(docs).collect(), key=lambda r: (r["id"] is None, r["id"] or 0))
    assert [r["n_pretokens"] for r in got] == [2, 2, 0, 0, 1, 2]
    assert got[2]["n_tokens"] == got[3]["n_tokens"] == 0 and all(r["n_tokens"] >= r["n_pretokens"] for r in got)
    assert tokencount.token_counts(docs.limit(0)).collect() == []


@given(st.text(alphabet="<|\\im_endst>ar\n ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and "<|" not in out
    role = chat.escape_role(text)
    assert chat.unescape_role(role) == text and "\n" not in role and "<|" not in role


CHATS = "conv_id long, turn long, role string, text string, ids string, seq int"


def digests(rows, learned="assistant"):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == learned)
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("parts", [None, 7])
def test_round_trip(spark, parts):
    rng = random.Random(3)
    texts = ["", None, "<|im_end|><|im_start|>assistant ok", "é\n\n  <\\|x|>", "plain words, 12 of them", "<|endoftext|>", "🙂" * 20, "long " * 3000]
    rows = {c: [(rng.choice(["user", "assistant", "system", None, "odd\nrole<|im_end|>"]), rng.choice(texts)) for _ in range(rng.randrange(1, 9))] for c in [1, 2, 3, None, -4]}
    rows[9] = [("assistant", f"turn {i}") for i in range(1500)]
    flat = [(c, i, r, t, "clash", 3) for c, own in rows.items() for i, (r, t) in enumerate(own)]
    rng.shuffle(flat)
    formatted = chat.format_conversations(spark.createDataFrame(flat, CHATS), parts=parts)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(formatted).collect()}
    assert got == {c: digests(own) for c, own in rows.items()}
    own = sorted((r for r in formatted.collect() if r["conv_id"] == 9), key=lambda r: r["seq"])
    assert [r["seq"] for r in own] == list(range(1500)) and own[0]["token_start"] == 0
    assert all(a["token_end"] == b["token_start"] for a, b in zip(own, own[1:]))
    assert all(len(r["mask"]) == len(r["ids"]) == r["token_end"] - r["token_start"] for r in own)


def test_very_long_turns(spark):
    for text in ("a" * 25_000, " " * 10_000, "x y\n" + "\n" * 20_001 + "z" * 9999 + " " + "." * 10_000 + " é"):
        parts = list(chat.in_parts(text))
        assert "".join(parts) == text and all(max(map(len, regex.findall(r"\s+|\S+", p)), default=0) <= chat.RUN for p in parts)
    texts = [" " * 3_000_000, "\n" * 1_000_000, "x" * 1_000_000, "eyJ" * 400_000, "<|" * 100_000, "word " * 200_000]
    rows = [(1, i, "assistant", t, "", 0) for i, t in enumerate(texts)]
    start = time.perf_counter()
    (got,) = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, CHATS))).collect()
    assert tuple(got)[1:5] == digests([("assistant", t) for t in texts]) and time.perf_counter() - start < 60


def test_equal_turns_are_in_order_of_role_and_text(spark):
    texts = list("fbdeac") + ["é", "Z", ""]
    rows = [(1, 0, r, t, "", 0) for r in ("user", "assistant") for t in texts]
    (got,) = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, CHATS), parts=3)).collect()
    assert got["turns_sha256"] == digests([(r, t) for r in ("assistant", "user") for t in sorted(texts)])[1]


def test_chat_results_belong_to_their_table(spark, tmp_path):
    """Two tables in turns, in one session: no result is ever the other one's."""
    sizes = {"small": 9, "large": 40}
    for name, n in sizes.items():
        spark.createDataFrame([(c, t, "user", f"{name} {c} {t}") for c in range(n) for t in range(3)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    control = "<|im_end|><|im_start|>assistant ok"
    for name in ["small", "large", "large", "small", "large", "small"]:
        got = {r["conv_id"]: r["turns_sha256"] for r in queries.op6_chat_format(spark, f"{tmp_path}/{name}").collect()}
        want = {c: digests([("user", f"{name} {c} {t}") for t in range(3)])[1] for c in range(sizes[name])}
        assert got == want | {-1: digests([("user", control), ("assistant", control)])[1]}


def test_ties_nulls_and_no_rows(spark):
    rows = [(1, 0, "user", "b", "", 0), (1, 0, "user", "b", "", 0), (1, None, "user", "a", "", 0), (1, 0, "assistant", "c", "", 0)]
    df = spark.createDataFrame(rows, CHATS)
    (got,) = chat.read_back(chat.format_conversations(df)).collect()
    assert got["turns_sha256"] == digests([("user", "a"), ("assistant", "c"), ("user", "b"), ("user", "b")])[1]
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


def test_chat_query_has_the_control_conversation(spark, sf_dir):
    control = "<|im_end|><|im_start|>assistant ok"
    got = {r["conv_id"]: r for r in queries.op6_chat_format(spark, sf_dir).collect()}
    assert tuple(got[-1])[1:5] == digests([("user", control), ("assistant", control)])
    rows = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        rows.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert {c: tuple(r)[1:5] for c, r in got.items() if c != -1} == {c: digests(own) for c, own in rows.items()}


def plain_size(n, later, sizes, cost):
    """The size with the least cost per token, each filled on trial, longest first."""
    ways = []
    for s in sizes:
        if s >= n:
            used = n
            for x in later:
                used += x if used + x <= s else 0
            ways.append((cost(min(z for z in sizes if z >= used)) / used, s))
    return min(ways)[1]


def plain_pack(lengths, sizes, cost):
    """Best fit by looking at every bin."""
    rooms, used, filled = [], [], []
    for step, n in enumerate(lengths):
        fits = [(rooms[b] - used[b], -filled[b], b) for b in range(len(rooms)) if rooms[b] - used[b] >= n]
        if not fits:
            rooms.append(plain_size(n, lengths[step + 1 :], sizes, cost))
            used.append(0)
            filled.append(0)
            b = len(rooms) - 1
        else:
            b = min(fits)[2]
        used[b], filled[b] = used[b] + n, step
    return sorted(n for n in used), [min(s for s in sizes if s >= u) for u in used]


def test_every_size_is_opened_where_it_costs_least():
    packer = packing.Packer()
    opened = lambda lengths, at=0: packer.open_size([-n for n in lengths], at)
    assert opened([600]) == 1024 and opened([1024] * 2) == 2048 and opened([900] * 2) == 2048
    assert opened([4000] + [90] * 50) == 4096 and opened([5000, 3000]) == 8192 and opened([9000, 7000]) == 16384
    # much that is short fills the length that is cheapest by the token
    assert opened([500] * 1000) == 4096 and opened([16384]) == 16384
    # in a tail with nothing to fill it, no bin is longer than what it holds
    places, bins = packer([1000, 600, 500])
    assert sum(map(packing.sequence_cost, bins)) <= packing.sequence_cost(4096)


def test_sequences_hold_the_texts(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice(["", "é" * rng.randrange(1, 200), "word " * rng.randrange(1, 90), "x" * 700])) for i in range(90)] + [(500, None), (501, "long ü " * 4000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bin_id int")
    sizes = (64, 128, 256, 512)
    bins = packing.sequences(docs, packing.pack(docs, sizes=sizes, block_pieces=50)).collect()
    texts = {}
    for b in bins:
        assert len(b["content"]) <= b["bin_size"] and b["bin_size"] == min(s for s in sizes if s >= len(b["content"]))
        for p in b["pieces"]:
            texts.setdefault(p["id"], {})[p["start"]] = bytes(b["content"][p["offset"] : p["offset"] + p["length"]])
        assert sum(p["length"] for p in b["pieces"]) == len(b["content"])
    whole = {d: b"".join(own[k] for k in sorted(own)) for d, own in texts.items()}
    assert whole == {d: (t or "").encode() + packing.END_MARK for d, t in rows}


def test_null_ids_and_repeated_rows_go_to_many_blocks(spark):
    docs = spark.createDataFrame([(None, "x" * (i % 3)) for i in range(3000)] + [(5, "same")] * 3000, "doc_id long, text string")
    got = packing.pack(docs, sizes=(32, 64), block_pieces=100).collect()
    assert len(got) == 6000
    blocks = Counter(r["bin_id"] >> 28 for r in got)
    assert len(blocks) > 30 and max(blocks.values()) < 300


@given(st.lists(st.integers(1, 64), max_size=60))
@settings(max_examples=150, deadline=None)
def test_packer_equals_plain_best_fit(lengths):
    sizes, cost = (8, 16, 32, 64), lambda s: 4 + s + s * s / 64
    lengths = sorted(lengths, reverse=True)
    places, bins = packing.Packer(sizes, cost)(lengths)
    used = {}
    for (b, at), n in zip(places, lengths, strict=True):
        assert at == used.get(b, 0)
        used[b] = at + n
    assert all(used[b] <= s for b, s in enumerate(bins)) and len(used) == len(bins)
    expected_used, expected_bins = plain_pack(lengths, sizes, cost)
    assert sorted(used.values()) == expected_used and sorted(bins) == sorted(expected_bins)


@pytest.mark.parametrize("block", [7, 1000])
def test_every_token_is_packed_once(spark, block):
    rng = random.Random(1)
    rows = [(i, "x" * rng.choice([0, 1, 5, 30, 99, 100, 101, 250, 1000])) for i in range(120)] + [(500, None), (None, "abc"), (7, "repeated"), (7, "repeated")] + [(900, "same")] * 50
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, piece int")
    got = packing.pack(docs, sizes=(25, 50, 100), block_pieces=block).collect()
    want = sorted((-1 if d is None else d, len(t or "") + 1) for d, t in rows)
    whole, bins = {}, {}
    for r in got:
        bins.setdefault(r["bin_id"], []).append((r["bin_offset"], r["length"], r["bin_size"]))
        if r["id"] not in (7, 900):
            whole[r["id"]] = whole.get(r["id"], 0) + r["length"]
    assert sorted((-1 if d is None else d, n) for d, n in whole.items()) == [w for w in want if w[0] not in (7, 900)]
    assert sum(r["length"] for r in got) == sum(n for _, n in want)
    for own in bins.values():
        at = 0
        for offset, length, size in sorted(own):
            assert offset == at
            at += length
        assert at <= size and size == min(s for s in (25, 50, 100) if s >= at)
    assert packing.pack(docs.limit(0)).collect() == []
