"""Token counts of a unigram model by dynamic programming shared along a trie.

A text is cut into pre-tokens; each pre-token is cut into the vocabulary pieces with the
greatest total log probability (of equal ones, the fewest pieces).  The distinct
pre-tokens of a task go into a trie of bytes.  A node stands for a prefix and keeps the
best forward score and piece count of that prefix, worked out once, when the node is made,
from the nodes above it; pre-tokens that share a prefix share its scores, and the node
where a pre-token ends has its count.  A text's count is the sum over its pre-tokens.

A pre-token of more than ``LONG_BYTES`` shares no prefix worth keeping: the same scores are
worked out along it in a window as wide as the longest piece, and no node is made.

Tokenizers are not trained here.  Pieces come from a public vocabulary file of ranked byte
strings; the log probability of a rank follows Zipf's law.  Every byte is a piece, so
every text can be cut.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, slices, strings

#: Ranked byte strings, one a line: base 64, space, rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Nodes that a task keeps before it starts a new trie, and bytes of stretches whose counts
#: it keeps.
KEPT_NODES = 400_000
KEPT_BYTES = 24 << 20
#: Pre-tokens of more bytes are counted without the trie.
LONG_BYTES = 512
#: Characters of a text that are cut into stretches at a time.
STEP = 1 << 18

#: Fixed value: the pre-token pattern of the public byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Stretches that no pre-token crosses: words with one space before, and white space.
CHUNKS = r"\s+(?!\S)| ?\S+|\s+"


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log probability of each piece: proportional to 1 / (rank + 1)."""
    whole = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {p: -math.log(r + 1) - whole for p, r in ranks.items()}


def piece_endings(scores: dict[bytes, float]) -> dict[bytes, float | None]:
    """Every ending of a piece, with the piece's score if it is a piece itself.  What is not
    here ends no piece, however far it is extended to the left."""
    out: dict[bytes, float | None] = {}
    for piece in scores:
        for i in range(len(piece) - 1, -1, -1):
            out.setdefault(piece[i:], None)
    return out | scores


class Trie:
    """Prefixes of the pre-tokens seen so far, with forward scores and piece counts."""

    def __init__(self, scores: dict[bytes, float], kept_nodes: int = KEPT_NODES, long_bytes: int = LONG_BYTES):
        self.endings, self.kept, self.long_bytes = piece_endings(scores), kept_nodes, long_bytes
        self.longest = max(map(len, scores))
        self.automaton = None  # made for the first long pre-token
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        self.best, self.pieces = [0.0], [0]

    def count(self, token: bytes) -> int:
        """Pieces of ``token``; makes the nodes of its path that are missing."""
        if len(token) > self.long_bytes:
            return self.count_long(token)
        if len(self.best) > self.kept:
            self.clear()
        child, best, pieces, endings = self.child, self.best, self.pieces, self.endings
        path, node = [0], 0
        for end, byte in enumerate(token, 1):
            known = child.get(node * 256 + byte)
            if known is None:
                top, fewest, start = -math.inf, 0, end - 1
                while start >= 0:
                    score = endings.get(token[start:end], 1.0)
                    if score is not None:
                        if score > 0:  # no piece ends like this
                            break
                        above = path[start]
                        total = best[above] + score
                        if total > top or total == top and pieces[above] + 1 < fewest:
                            top, fewest = total, pieces[above] + 1
                    start -= 1
                known = child[node * 256 + byte] = len(best)
                best.append(top)
                pieces.append(fewest)
            node = known
            path.append(node)
        return pieces[node]


    def count_long(self, token: bytes) -> int:
        """The same in memory that does not grow with the token: an automaton of all pieces
        gives those that end at a byte, and only the scores of as many prefixes as the
        longest piece has bytes are needed."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for piece, score in self.endings.items():
                if score is not None:
                    self.automaton.add_word(piece.decode("latin-1"), (len(piece) - 1, score))
            self.automaton.make_automaton()
        best, pieces, first = [0.0], [0], 0  # of the prefixes from the length ``first`` on
        now, top, fewest = -1, 0.0, 0
        for last, (before, score) in self.automaton.iter(token.decode("latin-1")):
            if last != now:
                if now >= 0:
                    best.append(top)
                    pieces.append(fewest)
                    if len(best) > 65_536:
                        first += len(best) - self.longest
                        del best[: -self.longest], pieces[: -self.longest]
                now, top = last, -math.inf
            at = last - before - first
            total = best[at] + score
            if total > top or total == top and pieces[at] + 1 < fewest:
                top, fewest = total, pieces[at] + 1
        return fewest


class Counter:
    """(pre-tokens, tokens) of texts."""

    def __init__(self, scores: dict[bytes, float]):
        self.trie = Trie(scores)
        self.pattern, self.chunks = regex.compile(PATTERN), regex.compile(CHUNKS)
        self.known: dict[str, int] = {}
        self.held = 0  # bytes of the keys of known, about

    def _chunk(self, chunk: str) -> int:
        """Pre-tokens of a chunk times 2 ** 32, plus its tokens."""
        if chunk.isalpha() or chunk[0] == " " and chunk[1:].isalpha():  # one pre-token
            return (1 << 32) + self.trie.count(chunk.encode())
        found = self.pattern.findall(chunk)
        return (len(found) << 32) + sum(self.trie.count(t.encode()) for t in found)

    def _sum(self, chunks: list[str]) -> int:
        if self.held > KEPT_BYTES:
            self.known.clear()
            self.held = 0
        known = self.known
        for c in set(chunks).difference(known):
            known[c] = self._chunk(c)
            self.held += len(c) + 100
        return sum(map(known.__getitem__, chunks))

    def __call__(self, text: str) -> tuple[int, int]:
        if len(text) <= STEP:
            return divmod(self._sum(self.chunks.findall(text)), 1 << 32)
        total, chunks, size = 0, [], 0
        for m in self.chunks.finditer(text):
            chunk = m[0]
            if len(chunk) > LONG_BYTES:  # not kept
                total += self._chunk(chunk)
                continue
            chunks.append(chunk)
            size += len(chunk)
            if size > STEP:
                total += self._sum(chunks)
                chunks, size = [], 0
        return divmod(total + self._sum(chunks), 1 << 32)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """id, n_pretokens, n_tokens, one row per row of ``docs``.

    A null or empty text has 0 of both; a null id stays null; repeated rows have a row each,
    with equal counts; an empty table gives no rows.  Of cuts with equal scores the one with
    the fewest pieces counts.  A text of any length is counted whole: what a task keeps is
    bounded by KEPT_NODES and KEPT_BYTES, and a long pre-token by the longest piece.
    ``vocabulary`` is read on the driver only.
    """
    schema = pa.schema([("id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])
    shipped = docs.sparkSession.sparkContext.broadcast(zipf_scores(read_vocabulary(vocabulary)))  # the vocabulary file: fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(shipped.value)
        for batch in slices(batches):
            found = [count(t) for t in strings(batch.column(1))]
            yield record_batch(schema, [batch.column(0), [a for a, _ in found], [b for _, b in found]])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text)), work, "id long, n_pretokens long, n_tokens long")
