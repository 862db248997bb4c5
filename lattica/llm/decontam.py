"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is split into k + 1 pieces: if a document
holds the item with at most k edits, one piece is there untouched.  One Aho-Corasick
automaton finds the exact piece hits of all items in a pass over a text.  Around a hit lies
a window that holds the item, if it is there; a window that lacks more than k characters of
the item, counted by kind, cannot, and this is worked out for all items of a piece at once,
so that items made from one template cost little.  In the windows left Myers' bit-parallel
algorithm (1999) gives the least edit distance between the item and any stretch; windows
that overlap are joined first, so a stretch is verified once.  Where many items meet in one
stretch their bit vectors are laid end to end in one long integer, so that a character of
the text advances all of them together.

Short items have no budget: they are found as they are, not inside longer words.

The items are the query set.  They go to the tasks in blocks of at most ``block_chars``
characters, one after the other: a larger benchmark means more passes over the documents,
and neither a larger broadcast nor more on the driver.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable, map_batches, record_batch, slices, strings

#: Edits that are allowed, as a share of the characters of the normalised item.
ERROR_RATE = 0.08
#: Items with fewer normalised characters are searched exactly and as whole words.
LEAST_CHARS = 24
#: Characters of items in one broadcast block.
BLOCK_CHARS = 4_000_000

#: Kinds of characters that a window is counted by, and windows counted at a time.
KINDS = 96
WINDOWS = 4096
#: So many items in one stretch are verified together.
TOGETHER = 12

_GAPS = re.compile(r"[\W_]+")
#: Letters of scripts that put no space between words: Thai to Lao, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def normalised(text: str) -> str:
    """Lower case, runs of anything but letters and digits as one space."""
    return _GAPS.sub(" ", text.lower()).strip()


@dataclass(frozen=True)
class Item:
    item_id: int | None
    text: str
    budget: int
    whole: bool = False  # only as whole words


def items_of(rows: Iterable[tuple[int | None, str | None]], error_rate: float = ERROR_RATE, least_chars: int = LEAST_CHARS) -> list[Item]:
    """The items that have a letter or digit."""
    out = []
    for item_id, text in rows:
        norm = normalised(text or "")
        if norm:
            short = len(norm) < least_chars
            out.append(Item(item_id, norm, 0 if short else int(len(norm) * error_rate), short))
    return out


def pieces(item: Item) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces whose lengths differ by one at most."""
    n, m = item.budget + 1, len(item.text)
    cuts = [m * i // n for i in range(n + 1)]
    return [(a, item.text[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to a stretch of ``text``, with the end of the
    first such stretch; None if it is above ``most``."""
    m = len(pattern)
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        at[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, most + 1, -1
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        vertical = eq | down
        eq |= (((eq & up) + up) ^ up) & full
        raised = down | (full & ~(eq | up))
        lowered = up & eq
        if raised & top:
            score += 1
        elif lowered & top:
            score -= 1
        raised = (raised << 1) & full
        lowered = (lowered << 1) & full
        up = lowered | (full & ~(vertical | raised))
        down = raised & vertical
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= most else None


def _bits(mask: np.ndarray) -> int:
    return int.from_bytes(np.packbits(mask, bitorder="little").tobytes(), "little")


def myers_together(patterns: list[str], text: str, most: list[int]) -> list[tuple[int, int] | None]:
    """myers() of every pattern, side by side: a field of the bit vectors for each, and a bit
    between two fields that takes what an addition or a shift carries out of one."""
    lengths = np.array([len(p) for p in patterns], np.int64)
    guard = 1 << 31  # no character
    flat = np.frombuffer("".join(p + "\0" for p in patterns).encode("utf-32-le"), np.uint32).copy()
    ends = np.cumsum(lengths + 1) - 1
    flat[ends] = guard
    full, tops = _bits(flat != guard), np.zeros(len(flat), bool)
    tops[ends - 1] = True
    tops, size, places, shifts = _bits(tops), -(-len(flat) // 8), (ends - 1) // 8, ((ends - 1) % 8).astype(np.uint8)

    def at_tops(x: int) -> np.ndarray:
        return (np.frombuffer(x.to_bytes(size, "little"), np.uint8)[places] >> shifts) & 1

    at = {c: _bits(flat == ord(c)) for c in set(text)}
    up, down, score = full, 0, lengths.copy()
    best, end = np.array(most, np.int64) + 1, np.full(len(patterns), -1, np.int64)
    for j, c in enumerate(text):
        eq = at[c]
        vertical = eq | down
        eq |= (((eq & up) + up) ^ up) & full
        raised = down | (full ^ (eq | up))
        lowered = up & eq
        if more := raised & tops:
            score += at_tops(more)
        if less := lowered & tops:
            score -= at_tops(less)
            better = score < best
            if better.any():
                best[better], end[better] = score[better], j + 1
        raised = (raised << 1) & full
        lowered = (lowered << 1) & full
        up = lowered | (full ^ (vertical | raised))
        down = raised & vertical
    return [(b, e) if b <= k else None for b, e, k in zip(best.tolist(), end.tolist(), most, strict=True)]


def _parted(norm: str, at: int) -> bool:
    """Whether a word can begin or end at a place of a normalised text."""
    return at in (0, len(norm)) or any(c == " " or _UNSPACED.match(c) for c in norm[at - 1 : at + 1])


def _kinds(norm: str) -> np.ndarray:
    return (np.frombuffer(norm.encode("utf-32-le"), np.uint32) % KINDS).astype(np.int64)


class Searcher:
    """Finds the items of a block in texts."""

    def __init__(self, items: list[Item]):
        self.items = items
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, item in enumerate(items):
            for offset, piece in pieces(item):
                found[piece].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            own, offsets = np.array(where, np.int64).T
            self.automaton.add_word(piece, (len(piece), own, offsets))
        if found:
            self.automaton.make_automaton()
        self.lengths = np.array([len(x.text) for x in items], np.int64)
        self.budgets = np.array([x.budget for x in items], np.int64)
        self.whole = np.array([x.whole for x in items], bool)
        self.counts = np.array([np.bincount(_kinds(x.text), minlength=KINDS) for x in items], np.int32).reshape(-1, KINDS)

    def windows(self, norm: str) -> dict[int, list[list[int]]]:
        """By item, the stretches that can hold it: sorted, joined where they overlap."""
        spans: dict[int, list[list[int]]] = {}
        if not self.items or not norm:
            return spans
        hits = [(own, last + 1 - length - offsets) for last, (length, own, offsets) in self.automaton.iter(norm)]
        if not hits:
            return spans
        item, start = np.concatenate([x for x, _ in hits]), np.concatenate([x for _, x in hits])
        short = self.whole[item]
        for i, a in zip(item[short].tolist(), start[short].tolist(), strict=True):
            b = a + len(self.items[i].text)
            if i not in spans and _parted(norm, a) and _parted(norm, b):
                spans[i] = [[a, b]]
        # one window an item and place, in order of both; ends go up with starts
        ahead = int(self.lengths.max())
        item, start = np.divmod(np.unique(item[~short] * (len(norm) + ahead + 1) + start[~short] + ahead), len(norm) + ahead + 1)
        start -= ahead
        low = np.maximum(0, start - self.budgets[item])
        high = np.minimum(len(norm), start + self.lengths[item] + self.budgets[item])
        if len(item):
            held = self._can_hold(norm, item, low, high)
            for i, a, b in zip(item[held].tolist(), low[held].tolist(), high[held].tolist(), strict=True):
                own = spans.setdefault(i, [])
                if own and a <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], b)
                else:
                    own.append([a, b])
        return spans

    def _can_hold(self, norm: str, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a window lacks no more characters of its item than the budget: an edit
        makes up for one of them at most."""
        kinds, out = _kinds(norm), np.zeros(len(item), bool)
        order = np.lexsort((high, low))
        for at in range(0, len(order), WINDOWS):
            own = order[at : at + WINDOWS]
            new = np.concatenate([[True], (np.diff(low[own]) != 0) | (np.diff(high[own]) != 0)])
            counted = np.array([np.bincount(kinds[low[w] : high[w]], minlength=KINDS) for w in own[new]], np.int32)
            lacking = np.maximum(self.counts[item[own]] - counted[np.cumsum(new) - 1], 0).sum(1)
            out[own] = lacking <= self.budgets[item[own]]
        return out

    def _verified(self, norm: str) -> Iterator[tuple[int, int, int, int]]:
        """(item number, distance, start of its stretch, end) of matches, in text order."""
        flat = sorted((a, b, i) for i, own in self.windows(norm).items() for a, b in own)
        at = 0
        while at < len(flat):
            low, high, upto = flat[at][0], flat[at][1], at + 1
            while upto < len(flat) and flat[upto][0] < high:
                high, upto = max(high, flat[upto][1]), upto + 1
            own, at = flat[at:upto], upto
            numbers = sorted({i for _, _, i in own})
            if len(numbers) >= TOGETHER:
                hits = myers_together([self.items[i].text for i in numbers], norm[low:high], [self.items[i].budget for i in numbers])
                yield from ((i, hit[0], low, low + hit[1]) for i, hit in zip(numbers, hits, strict=True) if hit)
                continue
            for a, b, i in own:
                if hit := myers(self.items[i].text, norm[a:b], self.items[i].budget):
                    yield i, hit[0], a, a + hit[1]

    def found(self, norm: str) -> Iterator[tuple[int, int, int, int]]:
        """(item number, distance, start, end) of the best stretch of each item found."""
        best: dict[int, tuple[int, int, int]] = {}
        for i, distance, low, end in self._verified(norm):
            if i not in best or distance < best[i][0]:
                best[i] = (distance, low, end)
        # back from the end to the start; items that end at one place go together
        by_end: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i, (_, low, end) in best.items():
            by_end[low, end].append(i)
        for (low, end), own in by_end.items():
            back = norm[low:end][::-1]
            turned = [self.items[i].text[::-1] for i in own]
            if len(own) >= TOGETHER:
                reach = max(len(self.items[i].text) + self.items[i].budget for i in own)
                hits = myers_together(turned, back[:reach], [best[i][0] for i in own])
            else:
                hits = [myers(t, back[: len(t) + self.items[i].budget], best[i][0]) for i, t in zip(own, turned, strict=True)]
            for i, hit in zip(own, hits, strict=True):
                yield i, best[i][0], end - (hit[1] if hit else len(self.items[i].text)), end

    def any(self, text: str) -> bool:
        return next(self._verified(normalised(text)), None) is not None

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best stretch of each item found; start
        and end are code points of the text as given."""
        found = list(self.found(normalised(text)))
        places = _places(text) if found else []
        return [(self.items[i].item_id, distance, places[a], places[b - 1] + 1) for i, distance, a, b in found]


def _places(text: str) -> list[int]:
    """For each character of the normalised text, its place in the text.

    What a letter's lower case is can depend on its place, how long it is cannot, nor
    whether it is a gap; so letters are looked at one by one.
    """
    out, gap = [], None
    for i, c in enumerate(text):
        for x in c.lower():
            if _GAPS.match(x):
                gap = i if gap is None else gap
                continue
            if gap is not None and out:
                out.append(gap)
            gap = None
            out.append(i)
    return out


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, error_rate: float, least_chars: int, block_chars: int) -> tuple[int, Iterator[list[Item]]]:
    """The number of blocks, and the items of one after the other."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
    total = rows.agg(F.sum(F.char_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))

    def each() -> Iterator[list[Item]]:
        for block in range(blocks):
            own = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
            yield items_of([(r.i, r.t) for r in own.collect()], error_rate, least_chars)  # one block

    return blocks, each()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE, least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """id, item_id, distance, start, end: one row per document and item found in it.

    Null or empty texts and items, and items without a letter or digit, match nothing; an
    item with a null id is searched like any other; an item id that occurs twice stands for
    both texts.  Items under ``least_chars`` are found exactly, as whole words.  Of stretches
    with equal distances the first is given.  Every row of ``docs`` is searched by itself, so
    repeated rows give repeated results; a text of any length is searched whole.  Empty tables
    give no rows.  With one block the result is lazy; with more, each block's is a durable
    table, made before the next block is read.
    """
    schema = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
    texts_only = docs.select(F.col(id_col).cast("long"), F.col(text))
    blocks, each = _blocks(benchmark, item_id, item_text, error_rate, least_chars, block_chars)
    keep = Durable(docs.sparkSession, "decontam") if blocks > 1 else None
    out = None
    for items in each:

        def work(batches: Iterator[pa.RecordBatch], items: list[Item] = items) -> Iterator[pa.RecordBatch]:
            search = Searcher(items)
            for batch in slices(batches):
                found = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True) for hit in search(t)]
                if found:
                    yield record_batch(schema, [list(c) for c in zip(*found, strict=True)])

        part = map_batches(texts_only, work, "id long, item_id long, distance long, start long, end long")
        part = keep.save(part) if keep else part
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", error_rate: float = ERROR_RATE, least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents that hold a test item, row by row and with no join:
    rows with a null id, and repeated ids, are each judged by their own text.  Items need no
    id.  Lazy with one block of items; with more, what a block leaves is a durable table."""
    blocks, each = _blocks(benchmark, "item_id", "text", error_rate, least_chars, block_chars)
    keep = Durable(docs.sparkSession, "decontam") if blocks > 1 else None
    at = docs.columns.index(text)
    for items in each:

        def work(batches: Iterator[pa.RecordBatch], items: list[Item] = items) -> Iterator[pa.RecordBatch]:
            search = Searcher(items)
            for batch in slices(batches):
                yield batch.filter(pa.array([not search.any(t) for t in strings(batch.column(at))], pa.bool_()))

        left = docs.mapInArrow(work, docs.schema)
        if keep:
            before, left = docs, keep.save(left)
            keep.drop(before)
        docs = left
    return docs
