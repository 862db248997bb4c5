"""Near-duplicate documents: MinHash, banding, verification, connected components.

1. Signatures.  Words of a text give k-word shingles; each distinct shingle is a 64-bit
   hash, and "shingle" means that hash from here on, in full sets too (two shingles of a pair
   of texts share one by a chance of n^2 / 2^64); universal hashes h(x) = a x + b (mod 2^32, a odd) give one minimum each.  Texts
   with equal shingle sets share a 128-bit fingerprint and go on as one representative
   (the smallest id), so a group of copies costs one row from there on.
2. Banding.  A bucket is a band and a hash of its minima.  Rows and bands are chosen so
   that a pair right at the threshold is missed with probability ``miss`` or less.
3. Star links.  In each bucket every member is paired with the smallest one only: as many
   pairs as members, whatever the size of the bucket.
4. Verification.  Pairs are confirmed on the full shingle sets of both texts.
5. Components of the confirmed links.
6. The rest, exactly.  Members of a bucket that are still in different components are
   compared on their signatures; those that come near enough to a member of another
   component are then compared on full sets.  Both go by blocks of bounded size, and what
   leaves a block is a member or a link that joins two components, never a list of pairs,
   so that rows stay in proportion to the members.  A large group that the stars have
   joined costs nothing here.
7. Components of all links; every document gets the smallest id of its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable, fresh, map_batches, record_batch, runs, slices, sorted_stream, texts
from .components import components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Members of a block: what a task holds for step 6 is two blocks of signatures.
BLOCK = 2048
#: The same on full sets.
BLOCK_SETS = 512
#: Documents whose sets a verification group holds, and partners that stream by them.
FIRSTS = 128
PARTNERS = 4096
#: Ids of documents to verify that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Distinct words whose hashes a task keeps.
KEPT_WORDS = 400_000


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity of a link.  ``miss``: largest chance that banding
    misses a pair right at that similarity."""

    width: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 1e-6
    seed: int = 20240607
    bands: int = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "bands", math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows)))

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        """Agreeing minima below which a pair is not verified: five standard deviations
        under what a pair right at the threshold agrees on."""
        t, n = self.percent / 100, self.minima
        return max(0, math.floor(n * t - 5 * math.sqrt(n * t * (1 - t))))

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        draw = lambda: rng.integers(0, 2**32, self.minima, dtype=np.uint64).astype(np.uint32)
        return draw() | np.uint32(1), draw()


#: Odd multipliers that join the hashes of a shingle's words.
_JOIN = np.random.default_rng(7).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Distinct shingles of a text as a sorted array of 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.translate(LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.width, len(words))
        out = x[: len(x) - k + 1] * _JOIN[0]
        for i in range(1, k):
            out = out + x[i : len(x) - k + 1 + i] * _JOIN[i]
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(out ^ (out >> np.uint64(32)))


def _minima(values: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of each run of ``values`` under each hash: a row per run."""
    out = np.empty((len(starts), len(a)), np.uint32)
    x = (values >> np.uint64(32)).astype(np.uint32)
    held = np.empty_like(x)
    for i in range(len(a)):
        np.multiply(x, a[i], out=held)
        np.add(held, b[i], out=held)
        out[:, i] = np.minimum.reduceat(held, starts)
    return out


def _band_keys(minima: np.ndarray, s: Settings) -> np.ndarray:
    """One 64-bit key per band: a row per document."""
    rows = minima.reshape(len(minima), s.bands, s.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, s.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), rows.shape[:2]).copy()
    for i in range(s.rows):
        key = (key ^ rows[:, :, i]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def signatures(docs: DataFrame, s: Settings, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, print, keys, signature, one row per row; without words the last three
    are null.  The keys are those of the bands; the signature has the low byte of each
    minimum: equal minima have equal bytes, others have them by a chance of 1 in 256."""
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("keys", pa.list_(pa.int64())), ("signature", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, (a, b) = Shingler(s.width), s.hashes()
        for batch in slices(batches, 128):
            sets = [shingle(t) for t in texts(batch.column(1))]
            full = [i for i, x in enumerate(sets) if len(x)]
            keys: list[np.ndarray | None] = [None] * len(sets)
            signs: list[bytes | None] = [None] * len(sets)
            if full:
                lengths = np.array([len(sets[i]) for i in full])
                found = _minima(np.concatenate([sets[i] for i in full]), np.concatenate([[0], np.cumsum(lengths)[:-1]]), a, b)
                for i, own, row in zip(full, _band_keys(found, s), found.astype(np.uint8), strict=True):
                    keys[i], signs[i] = own, row.tobytes()
            prints = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            yield record_batch(schema, [batch.column(0), [len(x) for x in sets], prints, keys, signs])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text)), work, "id long, n_shingles long, print binary, keys array<long>, signature binary")


def _few(ids: DataFrame) -> DataFrame:
    """The ids of a durable table, broadcast if there are not too many."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _sets(docs: DataFrame, ids: DataFrame, rows: int, s: Settings, keep: Durable, id_col: str, text: str) -> DataFrame:
    """__id, print, shingles (bytes of sorted uint64) of the documents in ``ids``.  Rows that
    repeat an id and its shingles count once."""
    ids = _few(keep.save(ids.toDF("__id").distinct(), rows))
    needed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).join(ids, F.col("id") == F.col("__id"), "left_semi")
    schema = pa.schema([("__id", pa.int64()), ("print", pa.binary()), ("shingles", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(s.width)
        for batch in slices(batches, 128):
            blobs = [shingle(t).tobytes() for t in texts(batch.column(1))]
            yield record_batch(schema, [batch.column(0), [xxhash.xxh3_128_digest(x) for x in blobs], blobs])

    return map_batches(needed, work, "__id long, print binary, shingles binary").groupBy("__id", "print").agg(F.first("shingles").alias("shingles"))


class _Overlaps:
    """Sizes of the overlap of one set with each of many."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        values = np.concatenate([*sets, np.empty(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def similar(self, mine: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the sets that are similar enough, the overlaps and the unions."""
        low, high = np.searchsorted(self.values, mine, "left"), np.searchsorted(self.values, mine, "right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(self.owners[at], minlength=len(self.sizes))
        total = self.sizes + len(mine) - common
        hit = np.flatnonzero((100 * common >= percent * total) & (common > 0))
        return hit, common[hit], total[hit]


def confirmed(pairs: DataFrame, rows: int, docs: DataFrame, s: Settings, keep: Durable, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """a, b, common, total of the pairs whose full shingle sets are similar enough.

    ``pairs``: label, a, b; ``rows`` bounds their number.  Pairs of a label share documents, so they are verified
    together: a group holds the sets of at most about FIRSTS first documents, and the sets
    of their partners stream by, each shipped once a group.  A label with many documents
    is dealt out over several groups by both ends.
    """
    pairs = pairs.select("label", "a", "b").distinct()
    large = pairs.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("a").alias("na"), F.approx_count_distinct("b").alias("nb")).filter(F.col("n") > FIRSTS)
    large = large.select(F.col("label").alias("__label"), F.ceil(F.col("na") / FIRSTS).alias("pa"), F.ceil(F.col("nb") / PARTNERS).alias("pb"))
    part = lambda c, n: F.coalesce(F.pmod(F.xxhash64(c), F.col(n)), F.lit(0).cast("long"))
    dealt = keep.save(pairs.join(large, F.col("label") == F.col("__label"), "left").select("label", part("a", "pa").alias("i"), part("b", "pb").alias("j"), "a", "b"), rows)
    rows = dealt.count()
    partners = dealt.groupBy("label", "i", "j", F.col("b").alias("id")).agg(F.collect_list("a").alias("firsts"))
    firsts = dealt.select("label", "i", "j", F.col("a").alias("id")).distinct().withColumn("firsts", F.lit(None).cast("array<long>"))
    needs = partners.unionByName(firsts)

    found = _sets(docs, dealt.select("a").union(dealt.select("b")), 2 * rows, s, keep, id_col, text)
    stream = needs.join(found, F.col("id") == F.col("__id")).select("label", "i", "j", "firsts", "id", "shingles", F.col("firsts").isNotNull().cast("int").alias("turn"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("common", pa.int64()), ("total", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, overlaps = None, [], None
        for batch in slices(batches, 1024):
            rows: list[tuple[int, int, int, int]] = []
            for label, i, j, near, b, blob in zip(*(c.to_pylist() for c in batch.columns[:6]), strict=True):
                if group != (label, i, j):
                    group, held, overlaps = (label, i, j), [], None
                mine = np.frombuffer(blob, np.uint64)
                if near is None:
                    held.append((b, mine))
                    continue
                overlaps = overlaps or _Overlaps([x for _, x in held])
                wanted = set(near)
                rows += [(held[k][0], b, int(c), int(t)) for k, c, t in zip(*overlaps.similar(mine, s.percent)) if held[k][0] in wanted]
            yield record_batch(out, [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []])

    return keep.save(map_batches(sorted_stream(stream, ["label", "i", "j"], ["turn", "id"]), verify, "a long, b long, common long, total long"), rows, per_task=2_000)


def _blocks(members: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Each member of a group of ``n`` for each pair of blocks (i <= j) that its own block
    (``mine``) is part of."""
    parts = F.ceil(F.col("n") / size).cast("int")
    dealt = members.withColumn("mine", F.pmod(F.xxhash64("id"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("other", "n")


def _open_members(members: DataFrame, s: Settings) -> DataFrame:
    """label, id, component of the members of a bucket that agree on enough minima with a
    member of another component, other than the leader (who has been compared with all).
    ``members``: key, n, leader, id, component, signature; the leader is the label."""
    out = pa.schema([("label", pa.int64()), ("id", pa.int64()), ("component", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, i, j), rows in runs(batches, ["key", "i", "j"]):
            ids, component, mine = (rows.column(c).to_numpy() for c in ("id", "component", "mine"))
            if (component == component[0]).all():
                continue
            minima = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(ids), s.minima)
            keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(ids), s.bands)
            leader = rows.column("leader")[0].as_py()
            band = int(np.argmax(keys[0] == key))
            near = np.zeros(len(ids), bool)
            for p in np.flatnonzero((mine == i) & (ids != leader)):
                q = np.arange(p + 1, len(ids)) if i == j else np.flatnonzero(mine == j)
                q = q[(component[q] != component[p]) & (ids[q] != leader)]
                if len(q):
                    q = q[(minima[q] == minima[p]).sum(1) >= s.least_agreement]
                if len(q) and band:  # a pair that meets in an earlier band is seen there
                    q = q[~(keys[q, :band] == keys[p, :band]).any(1)]
                if len(q):
                    near[p] = near[q] = True
            if near.any():
                yield record_batch(out, [pa.array(np.full(int(near.sum()), leader)), pa.array(ids[near]), pa.array(component[near])])

    return map_batches(sorted_stream(_blocks(members, ["key"], BLOCK), ["key", "i", "j"], ["id"]), work, "label long, id long, component long")


def _joining_links(members: DataFrame, rows: int, docs: DataFrame, s: Settings, keep: Durable, id_col: str, text: str) -> DataFrame:
    """Links (a, b) that join components of members with one label, found on full sets.

    In a pair of blocks every link between two components that no link found there has
    joined so far is kept, which is enough to join all that is linked.  ``rows`` bounds the
    number of members.
    """
    members = keep.save(members.distinct(), rows, per_task=20_000)
    rows = members.count()
    counts = members.groupBy(F.col("label").alias("__label")).agg(F.count(F.lit(1)).alias("n"))
    dealt = _blocks(members.join(counts, F.col("label") == F.col("__label")).drop("__label"), ["label"], BLOCK_SETS)
    found = _sets(docs, members.select("id"), rows, s, keep, id_col, text)
    stream = sorted_stream(dealt.join(found, F.col("id") == F.col("__id")).select("label", "i", "j", "mine", "id", "component", "shingles"), ["label", "i", "j"], ["id"])
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in runs(batches, ["label", "i", "j"]):
            ids, component, mine = (rows.column(c).to_pylist() for c in ("id", "component", "mine"))
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
            above = {c: c for c in component}

            def top(c: int) -> int:
                while above[c] != c:
                    above[c] = c = above[above[c]]
                return c

            firsts = [p for p in range(len(ids)) if mine[p] == i]
            overlaps, links = _Overlaps([sets[p] for p in firsts]), []
            for q in range(len(ids)):
                if mine[q] != j:
                    continue
                for k in overlaps.similar(sets[q], s.percent)[0]:
                    x, y = top(component[firsts[k]]), top(component[q])
                    if x != y:
                        above[max(x, y)] = min(x, y)
                        links.append((ids[firsts[k]], ids[q]))
            if links:
                yield record_batch(out, [list(c) for c in zip(*links, strict=True)])

    return keep.save(map_batches(stream, work, "a long, b long"), rows, per_task=2_000)


def near_duplicates(docs: DataFrame, s: Settings | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, component, one row per row of ``docs`` with an id.

    A text with fewer words than a shingle is one shingle as a whole; a null or empty text
    (or white space only) has none, is linked with nothing and is its own component.  Rows
    with a null id are left out: they cannot be named in a component.  Repeated rows get
    equal results; an id with several texts links all of them.  A text of any length has all
    its shingles in its set.  An empty table gives none.
    """
    s = s or Settings()
    keep = Durable(docs.sparkSession, "minhash")
    docs = docs.filter(F.col(id_col).isNotNull())
    signed = keep.save(signatures(docs, s, id_col, text))
    n = signed.count()
    reps = signed.filter(F.col("print").isNotNull()).groupBy("print").agg(F.min("id").alias("id"), F.first("keys").alias("keys"), F.first("signature").alias("signature"))
    reps = keep.save(reps, n, per_task=20_000)
    bands = reps.select(F.explode("keys").alias("key"), "id")
    lead = bands.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).withColumnRenamed("key", "__key")
    members = keep.save(bands.join(lead, F.col("key") == F.col("__key")).select("key", "n", "leader", "id"), n * s.bands)
    rows = members.count()

    stars = confirmed(members.filter(F.col("id") != F.col("leader")).select(F.col("leader").alias("label"), F.col("leader").alias("a"), F.col("id").alias("b")), rows, docs, s, keep, id_col, text)
    first = components(stars)

    placed = members.filter(F.col("n") > 2).join(first, F.col("id") == F.col("node"), "left").select("key", "n", "leader", "id", F.coalesce("component", "id").alias("component"))
    placed = keep.save(placed, rows)
    open_keys = placed.groupBy(F.col("key").alias("__key")).agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(F.col("low") != F.col("high")).select("__key")
    signs = reps.select(F.col("id").alias("__id"), "keys", "signature")
    rest = placed.join(open_keys, F.col("key") == F.col("__key"), "left_semi").join(signs, F.col("id") == F.col("__id")).select("key", "n", "leader", "id", "component", "keys", "signature")
    more = _joining_links(_open_members(rest, s), rows, docs, s, keep, id_col, text)

    # an id that has several prints (repeated ids with other texts) is one node
    links = stars.select("a", "b").union(more.select("a", "b"))
    copies = signed.join(reps.select(F.col("print").alias("__print"), F.col("id").alias("rep")), F.col("print") == F.col("__print"), "left").select("id", "n_shingles", F.coalesce("rep", "id").alias("rep"))
    copies = keep.save(copies, n)
    twice = copies.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count(F.lit(1)).alias("n")).filter(F.col("a") != F.col("b"))
    final = components(links.union(copies.join(twice.select(F.col("id").alias("__id")), F.col("id") == F.col("__id"), "left_semi").select(F.col("rep").alias("a"), F.col("id").alias("b"))))
    keep.keep_only(copies)  # all else has been read
    return copies.join(final, F.col("rep") == F.col("node"), "left").select("id", "n_shingles", F.coalesce("component", "rep").alias("component"))


def keep_first(docs: DataFrame, s: Settings | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id.

    Rows with a null id stay: no group can hold them.  Of rows that repeat an id, one
    stays.  The ids that go are broadcast if there are not too many; only beyond that are
    texts shuffled.
    """
    keep = Durable(docs.sparkSession, "keepfirst")
    (mark,) = fresh(docs.columns, "__id")
    found = near_duplicates(docs, s, id_col, text).groupBy("id").agg(F.min("component").alias("component"), F.count(F.lit(1)).alias("n")).filter((F.col("id") != F.col("component")) | (F.col("n") > 1))
    found = keep.save(found)
    gone = keep.save(found.filter(F.col("id") != F.col("component")).select(F.col("id").alias(mark)), found.count())
    kept = docs.join(_few(gone), F.col(id_col) == F.col(mark), "left_anti")
    again = found.filter(F.col("id") == F.col("component")).select(F.col("id").alias(mark))
    if not again.isEmpty():
        once = kept.join(again, F.col(id_col) == F.col(mark), "left_semi").dropDuplicates([id_col])
        kept = kept.join(again, F.col(id_col) == F.col(mark), "left_anti").unionByName(once)
    return kept
