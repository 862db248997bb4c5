"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces no longer than the longest sequence.  Pieces go, longest
first, into the open bin that they fill best; where none has room, a bin is opened.  Its
size is chosen over all permitted lengths at once: for each, the bin is filled on trial from
the lengths that are still to come, shrunk to what it holds, and the one with the least cost
per token is opened.  At the end each bin shrinks to the shortest permitted length that
holds its contents.

Packing is by block: pieces are dealt out by a hash into blocks of about ``block_pieces``
pieces, and a block that repeated rows or null ids make larger is dealt out again by row, so
tasks hold a bounded number of pieces and work on their own.  Only ids and lengths are
shuffled, never a text; sequences() puts the texts into the bins.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Durable, map_batches, record_batch, sorted_stream

#: Permitted sequence lengths, in tokens.
SIZES = (1024, 2048, 4096, 8192, 16384)
BLOCK_PIECES = 16_384
#: Tokens that a document takes beside its text: the mark of its end.
END_TOKENS = 1


def sequence_cost(size: int) -> float:
    """Cost of a sequence: its tokens, a fixed part, and attention, which grows with the
    square of the length."""
    return 256 + size + size * size / 65_536


def byte_tokens(text: str = "text") -> Column:
    """Length of a text in byte-level tokens, with the mark of its end; null is empty."""
    return F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long")) + END_TOKENS


class Packer:
    """Packs lengths, given longest first."""

    def __init__(self, sizes: Sequence[int] = SIZES, cost: Callable[[int], float] = sequence_cost):
        self.sizes, self.cost = sorted(sizes), cost

    def shrunk(self, used: int) -> int:
        return next(s for s in self.sizes if s >= used)

    def open_size(self, falling: Sequence[int], at: int) -> int:
        """The size for a bin that the piece ``at`` opens.  ``falling``: the lengths, negated,
        longest first.  Of equally cheap sizes the shortest."""
        best = None
        for size in self.sizes:
            room, upto = size + falling[at], at + 1
            if room < 0:
                continue
            while room and (upto := bisect_left(falling, -room, upto)) < len(falling):
                # as many of this length as there are and have room
                one = -falling[upto]
                n = min(room // one, bisect_left(falling, falling[upto] + 1, upto) - upto)
                room, upto = room - n * one, upto + n
            cost = self.cost(self.shrunk(size - room)) / (size - room)
            if best is None or cost < best[0]:
                best = (cost, size)
        return best[1]

    def __call__(self, lengths: Sequence[int]) -> tuple[list[tuple[int, int]], list[int]]:
        """(bin, offset) of each length, and the final size of each bin.

        Open bins wait by the room that they have left; a mask with a bit for each room
        that some bin has gives the least that is enough.  Of bins with equal room the one
        that was filled last is taken.
        """
        waiting: dict[int, list[int]] = {}
        mask, used, room, places = 0, [], [], []
        falling = [-n for n in lengths]
        for at, n in enumerate(lengths):
            fitting = mask >> n
            if fitting:
                left = n + (fitting & -fitting).bit_length() - 1
                own = waiting[left]
                b = own.pop()
                if not own:
                    mask &= ~(1 << left)
            else:
                b = len(used)
                used.append(0)
                room.append(self.open_size(falling, at))
            places.append((b, used[b]))
            used[b] += n
            left = room[b] - used[b]
            if left:
                own = waiting.setdefault(left, [])
                own.append(b)
                mask |= 1 << left
        return places, [self.shrunk(u) for u in used]


PACKED = "id long, piece long, start long, length long, bin_id long, bin_offset long, bin_size long"


def pack(docs: DataFrame, length: Column | None = None, id_col: str = "doc_id", sizes: Sequence[int] = SIZES, block_pieces: int = BLOCK_PIECES, cost: Callable[[int], float] = sequence_cost) -> DataFrame:
    """id, piece, start, length, bin_id, bin_offset, bin_size: one row per piece.

    ``length`` is the length of a row in tokens (by default byte_tokens()); a row with a
    length of 0 or less, or null, takes no room and gives no row.  A null id stays null.
    Repeated rows are packed each; ties are in order of id and piece.  A text of any length
    is cut into pieces, all of which are packed.  An empty table gives no rows.
    """
    keep = Durable(docs.sparkSession, "packing")
    longest = max(sizes)
    # the row number tells equal rows apart; it is written, so that it stays what it is
    items = docs.select(F.col(id_col).cast("long").alias("id"), (byte_tokens() if length is None else length).cast("long").alias("all"), F.monotonically_increasing_id().alias("row"))
    items = keep.save(items.filter(F.col("all") > 0))
    pieces = items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / longest))))
    pieces = pieces.select("id", "piece", "row", (F.col("piece") * longest).alias("start"), F.least(F.lit(longest).cast("long"), F.col("all") - F.col("piece") * longest).alias("length"))
    total = items.agg(F.sum(F.ceil(F.col("all") / longest))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_pieces))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("id", "piece"), F.lit(blocks)))
    full = dealt.groupBy(F.col("block").alias("__block")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * block_pieces)
    full = keep.save(full.select("__block", F.ceil(F.col("n") / block_pieces).alias("parts")), blocks)
    if not full.isEmpty():
        part = F.coalesce(F.pmod(F.xxhash64("row", "piece"), F.col("parts")), F.lit(0))
        dealt = dealt.join(full, F.col("block") == F.col("__block"), "left").withColumn("block", F.col("block") + part * blocks)
    dealt = dealt.withColumn("rank", -F.col("length"))
    schema = pa.schema([(n, pa.int64()) for n in ("id", "piece", "start", "length", "bin_id", "bin_offset", "bin_size")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(sizes, cost)
        opened: tuple[int, int] | None = None  # block and bins opened in it so far

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("block", "id", "piece", "start", "length")), strict=True)

        def portions() -> Iterator[list[tuple]]:
            held: list[tuple] = []
            for row in rows():
                if held and (held[0][0] != row[0] or len(held) >= 4 * block_pieces):
                    yield held
                    held = []
                held.append(row)
            if held:
                yield held

        for held in portions():
            block = held[0][0]
            first = opened[1] if opened and opened[0] == block else 0
            places, bins = packer([r[4] for r in held])
            opened = (block, first + len(bins))
            columns = [[r[1] for r in held], [r[2] for r in held], [r[3] for r in held], [r[4] for r in held]]
            columns += [[(block << 28) + first + b for b, _ in places], [o for _, o in places], [bins[b] for b, _ in places]]
            yield record_batch(schema, columns)

    return map_batches(sorted_stream(dealt, ["block"], ["rank", "id", "piece"]).select("block", "id", "piece", "start", "length"), work, PACKED)


#: The mark of a text's end in a sequence; no UTF-8 text has this byte.
END_MARK = b"\xff"


def sequences(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """bin_id, bin_size, content (bytes; every text ends with END_MARK) and pieces (array of
    offset, id, piece, start, length, in order of offset): one row per bin of pack(docs).

    Ids have to be unique; rows with a null id cannot be told apart and are left out.  A bin
    holds at most the longest permitted length, so no group is larger than that.
    """
    own = docs.select(F.col(id_col).cast("long").alias("__id"), F.concat(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), F.lit(END_MARK)).alias("__bytes"))
    placed = packed.join(own, F.col("id") == F.col("__id"))
    piece = F.struct(F.col("bin_offset").alias("offset"), "id", "piece", "start", "length", F.substring("__bytes", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("bytes"))
    bins = placed.groupBy("bin_id", "bin_size").agg(F.array_sort(F.collect_list(piece)).alias("held"))
    content = F.aggregate("held", F.lit(b""), lambda whole, x: F.concat(whole, x["bytes"]))
    return bins.select("bin_id", "bin_size", content.alias("content"), F.transform("held", lambda x: x.dropFields("bytes")).alias("pieces"))
