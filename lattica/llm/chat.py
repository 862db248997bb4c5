"""Chat formatting at the level of tokens.

A turn becomes: start id, role and line feed, text, end id, line feed.  Role and text are
encoded separately and the reserved ids are spliced in, so no text can produce one.  The
rendered form writes reserved ids as control strings; where a text holds a control string
itself, a backslash after its "<" keeps the two apart, and reading back takes it out.

Turns are dealt out by ranges of (conversation, turn), so that a long conversation lies in
many parts, and are encoded in that order.  The loss mask of a turn is the prefix sum of +1
where an assistant text begins and -1 where it ends.  Places in the conversation are prefix
sums of lengths: each part adds up its own, and what the parts before hold of a
conversation is added to it.  No part has to hold a conversation, and none waits for
another.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Durable, map_batches, record_batch, slices, sorted_stream, strings
from .tokencount import PATTERN, VOCABULARY, read_vocabulary

START, END = "<|im_start|>", "<|im_end|>"
#: Role whose texts are learned.
LEARNED = "assistant"

#: A longer run of white space, or of anything else, is encoded in parts of this many
#: characters: the encoder's time and stack grow with a run.
RUN = 10_000

_LONG = re.compile(rf"(?<!\S)\S{{{RUN},}}|(?<!\s)\s{{{RUN},}}")
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """One backslash more between "<" and "|": the result holds no control string."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """As a text, with line feeds and the backslashes that could mimic them written out."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def encoding(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("lattica", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def reserved(ranks: dict[bytes, int]) -> tuple[int, int]:
    """Ids of START and END: the first two behind the vocabulary."""
    first = max(ranks.values()) + 1
    return first, first + 1


def in_parts(text: str) -> Iterator[str]:
    """The text, cut inside its long runs only."""
    at = 0
    for m in _LONG.finditer(text):
        for cut in range(m.start() + RUN, m.end(), RUN):
            yield text[at:cut]
            at = cut
    yield text[at:]


class Turns:
    """Token ids of single turns, and where the learned text lies in them."""

    def __init__(self, ranks: dict[bytes, int], learned: str = LEARNED):
        self.ordinary = encoding(ranks).encode_ordinary
        self.start, self.end = reserved(ranks)
        self.feed = self.encode("\n")
        self.learned = learned

    def encode(self, text: str) -> list[int]:
        if len(text) < RUN:
            return self.ordinary(text)
        return [x for part in in_parts(text) for x in self.ordinary(part)]

    def __call__(self, role: str, text: str) -> tuple[list[int], int, int]:
        head = self.encode(escape_role(role) + "\n")
        body = self.encode(escape(text))
        begin = 1 + len(head)
        learn = len(body) if role == self.learned else 0
        return [self.start, *head, *body, self.end, *self.feed], begin, begin + learn


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", vocabulary: str = VOCABULARY, learned: str = LEARNED, parts: int | None = None) -> DataFrame:
    """One row per turn: conv_id, seq (from 0), turn, ids, mask (a byte per id, 1 where
    the loss counts), token_start and token_end in the conversation.

    Turns are in order of ``turn``; of equal ones, of role and then of text (bytes); a null
    turn comes first.  Null texts and roles are empty, a null conversation is one of its own,
    repeated rows are turns of their own, an empty table gives no rows.  A text of any length
    is one turn; a run of more than RUN characters is encoded in parts, which reads back the
    same.  ``parts`` is the number of ranges (that of shuffle partitions if None).
    """
    keep = Durable(rows.sparkSession, "chat")
    ranks = rows.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # the vocabulary file: fixed size
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), plain(role).alias("role"), plain(text).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    ranged = turns.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    schema = pa.schema([("part", pa.int64()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("ids", pa.list_(pa.int32())), ("mask", pa.binary()), ("seq", pa.int64()), ("token_start", pa.int64()), ("token_end", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoded = TaskContext.get().partitionId(), Turns(ranks.value, learned)
        last: tuple | None = None
        seq = at = 0
        for batch in slices(batches):
            found = [encoded(r, t) for r, t in zip(strings(batch.column(2)), strings(batch.column(3)), strict=True)]
            lengths = np.array([len(ids) for ids, _, _ in found])
            starts = np.cumsum(lengths) - lengths
            # prefix sums over the ids of the batch: +1 where a learned text begins, -1 behind it
            steps = np.zeros(int(lengths.sum()) + 1, np.int8)
            np.add.at(steps, starts + [x[1] for x in found], 1)
            np.add.at(steps, starts + [x[2] for x in found], -1)
            mask = np.cumsum(steps, dtype=np.int8)
            masks = [mask[a : a + n].tobytes() for a, n in zip(starts, lengths, strict=True)]
            places: list[tuple[int, int, int]] = []
            for c, n in zip(batch.column(0).to_pylist(), lengths.tolist(), strict=True):
                if last != (c,):
                    last, seq, at = (c,), 0, 0
                places.append((seq, at, at + n))
                seq, at = seq + 1, at + n
            yield record_batch(schema, [[part] * len(found), batch.column(0), batch.column(1), [x[0] for x in found], masks, *map(list, zip(*places, strict=True))])

    local = keep.save(map_batches(ranged, encode, "part long, conv_id long, turn long, ids array<int>, mask binary, seq long, token_start long, token_end long"))
    held = local.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("n"), F.max("token_end").alias("tokens"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    carried = held.select(F.col("part").alias("__part"), F.col("conv_id").alias("__conv"), F.sum("n").over(before).alias("__n"), F.sum("tokens").over(before).alias("__tokens")).filter(F.col("__n") > 0)
    placed = local.join(carried, (F.col("part") == F.col("__part")) & F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    n, tokens = (F.coalesce(F.col(c), F.lit(0)) for c in ("__n", "__tokens"))
    return placed.select("conv_id", (F.col("seq") + n).alias("seq"), "turn", "ids", "mask", (F.col("token_start") + tokens).alias("token_start"), (F.col("token_end") + tokens).alias("token_end"))


def _parts(ids: list[int], start: int, end: int, decode) -> tuple[str, str]:
    """Role and text of a turn, as escaped, from its ids."""
    if ids[0] != start or end not in ids:
        raise ValueError("not a turn")
    role, _, text = decode(ids[1 : ids.index(end)]).partition("\n")
    return role, text


def read_back(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, one row per
    conversation, read from the ids and masks of format_conversations().

    A digest of a whole conversation has to see its turns one after the other: they stream
    by in one task, which holds a batch and the state of two digests.
    """
    ranks = formatted.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoding(ranks.value).decode
        start, end = reserved(ranks.value)
        last: tuple | None = None
        turns = chars = loss_chars = 0
        of_turns, of_loss = hashlib.sha256(), hashlib.sha256()

        def result() -> tuple:
            return last[0], turns, of_turns.hexdigest(), loss_chars, of_loss.hexdigest(), chars

        for batch in slices(batches):
            done: list[tuple] = []
            for c, ids, mask in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if last is None or last[0] != c:
                    if last is not None:
                        done.append(result())
                    last, turns, chars, loss_chars = (c,), 0, 0, 0
                    of_turns, of_loss = hashlib.sha256(), hashlib.sha256()
                role, text = _parts(ids, start, end, decode)
                of_turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                learned = unescape(decode([x for x, m in zip(ids, mask, strict=True) if m]))
                of_loss.update(learned.encode())
                turns, loss_chars = turns + 1, loss_chars + len(learned)
                chars += len(START) + len(role) + 1 + len(text) + len(END) + 1
            if done:
                yield record_batch(schema, [list(x) for x in zip(*done, strict=True)])
        if last is not None:
            yield record_batch(schema, [[x] for x in result()])

    stream = sorted_stream(formatted.select("conv_id", "seq", "ids", "mask"), ["conv_id"], ["seq"]).select("conv_id", "ids", "mask")
    return map_batches(stream, work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
