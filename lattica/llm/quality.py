"""Quality rules whose thresholds follow the corpus.

Counts are taken from every whole text.  Two fixed base rules come first (too few words,
too much repetition inside the text).  Behind them stand adaptive rules: for each
language and source, a mergeable KLL sketch of each measure gives quartiles, and a
document fails when a measure lies outside a fence set from them.  Sketches are partial
aggregates, so a hot source costs one small sketch per task; sketches of sources merge
into one per language and one of all.  Filtering then is a join with the table of fences.

A fence lies ``spread`` times the distance from median to quartile beyond the quartile, and
nothing else: no floor and no cutoff set by hand.  Quartiles stay put while less than a
quarter of a group is junk.  The quartiles of a group are drawn towards those of its
language, and these towards those of all, by weights that fall with the number of
documents: PRIOR documents' worth, in groups of every size.

A measure is a rate: so many of something in so many words, letters or lines.  What a
document shows is its rate only up to chance, sqrt(rate / size), so it fails only if the
rate less DEVIATIONS of that is still outside.  In a group where nobody uses a symbol the
fence is 0, and a long run of symbols goes while a single one stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Durable, fresh, slices, texts

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Measure:
    """A rate, ``count`` per ``size`` (names of counts), with a fence above, or on both sides.
    ``unit``: how many of the count come together, as words of a repeated window do."""

    name: str
    count: str
    size: str
    below: bool = False
    unit: int = 1


#: Measures with adaptive fences, from the counts of a document.
MEASURES = (
    Measure("symbols_per_word", "n_symbols", "n_words"),
    Measure("mean_word_chars", "word_chars", "n_words", below=True),
    Measure("dup_line_share", "n_dup_lines", "n_lines"),
    Measure("repeat_share", "n_repeat_words", "n_words", unit=2 * WINDOW),
    Measure("echo_share", "n_echoes", "n_words"),
    Measure("upper_share", "n_upper", "word_chars"),
)
#: From a quartile to its fence, in distances from the median to the quartile.  If rates were
#: normal, fences would be 4.7 standard deviations from the median.
SPREAD = 6.0
#: Standard deviations of a document's own rate that are left to chance.
DEVIATIONS = 3.0
#: Documents that a language's quartiles count for in those of a source, and those of all in a
#: language's.
PRIOR = 100
#: Size parameter of the sketches (rank error about 1 %).
SKETCH_K = 400
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Fences (one row per language and source) up to so many rows are broadcast.
BROADCAST_ROWS = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("n_lines", "n_upper", "n_echoes")
_UPPER = bytes(range(65, 91))


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more (the first too).

    Windows get exact ids by doubling: a pair of ids of width w gives the id of width 2w.
    Positions whose id is unique at some width cannot repeat at a greater one, so most
    texts end after the first step.
    """
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    size = 1
    while size < width:
        pairs = ids[: len(ids) - size] * (ids.max() + 1) + ids[size:]
        distinct, ids = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        size *= 2
    again = np.bincount(ids)[ids] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    marks[:-width][again] += 1
    marks[width:][again] -= 1
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def counts_of(text: bytes, n_chars: int) -> tuple[int, ...]:
    words = text.split()
    rows = [x for x in text.split(b"\n") if x.strip()]
    white = len(text) - len(text.translate(None, WHITE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    upper = len(text) - len(text.translate(None, _UPPER))
    return len(words), n_chars - white, symbols, len(rows) - len(set(rows)), repeated_words(words), len(rows), upper, sum(map(eq, words, words[1:]))


def with_counts(docs: DataFrame, text: str = "text", into: str = "__q", carry: list[str] | None = None) -> DataFrame:
    """``carry`` (all columns if None) and a struct of counts.  A null or empty text has
    0 of everything."""
    names = [*COUNTS, *_EXTRA]
    kept = docs.columns if carry is None else list(dict.fromkeys(carry))
    docs = docs.select(*dict.fromkeys([*kept, text]))
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(into, T.StructType([T.StructField(n, T.LongType()) for n in names]))])
    struct = pa.struct([(n, pa.int64()) for n in names])
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column(at)
            chars = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
            found = [counts_of(t, int(n)) for t, n in zip(texts(column), chars, strict=True)]
            measured = pa.StructArray.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(len(names))], fields=list(struct))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], measured], [*kept, into])

    return docs.mapInArrow(work, schema)


def measure(m: Measure, of: str = "__q") -> tuple[Column, Column]:
    """The rate of a document, and its standard deviation by chance."""
    count, size = (F.col(of).getField(n).cast("double") / m.unit for n in (m.count, m.size))
    size = F.greatest(size, F.lit(1.0 / m.unit))
    return count / size, F.sqrt(count) / size


def base_failed(of: str = "__q") -> Column:
    words, repeat = (F.col(of).getField(n) for n in ("n_words", "n_repeat_words"))
    return (words < MIN_WORDS) | (repeat * 100 > words * MAX_REPEAT_PERCENT)


def sketches(measured: DataFrame, lang: str = "lang", source: str = "source", of: str = "__q", k: int = SKETCH_K) -> DataFrame:
    """One row per language and source: number of documents and a sketch per measure, of
    the documents that pass the base rules.  Rows of this table merge further."""
    return measured.filter(~base_failed(of)).groupBy(F.col(lang).alias("lang"), F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(measure(m, of)[0], F.lit(k)).alias(m.name) for m in MEASURES])


#: Ranks of the lower quartile, the median and the upper quartile.
_RANKS = (0.25, 0.5, 0.75)


def fences(found: DataFrame, spread: float = SPREAD, prior: float = PRIOR) -> DataFrame:
    """lang, source, n and low/high of each measure."""

    def quartiles(sketched: DataFrame, mark: str) -> DataFrame:
        own = [c for c in ("lang", "source") if c in sketched.columns]
        # a sketch of nothing, as of an empty table, has no quantiles
        points = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(m.name, F.lit(p))).alias(f"{mark}_{m.name}_{i}") for m in MEASURES for i, p in enumerate(_RANKS)]
        return sketched.select(*[F.col(c).alias(f"{mark}_{c}") for c in own], F.col("n").cast("double").alias(f"{mark}_n"), *points)

    def merged(*keys: str) -> DataFrame:
        return found.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(m.name).alias(m.name) for m in MEASURES])

    rows = quartiles(found, "s").join(quartiles(merged("lang"), "l"), F.col("s_lang").eqNullSafe(F.col("l_lang")))
    whole = quartiles(merged(), "a").first()  # one row of numbers, whatever the input
    out = []
    for m in MEASURES:
        points = []
        for i in range(len(_RANKS)):
            value = F.lit(whole[f"a_{m.name}_{i}"]).cast("double")
            for mark in ("l", "s"):
                weight = F.col(f"{mark}_n") / (F.col(f"{mark}_n") + F.lit(float(prior)))
                value = weight * F.col(f"{mark}_{m.name}_{i}") + (1 - weight) * value
            points.append(value)
        low, mid, high = points
        out.append((low - (mid - low) * spread if m.below else F.lit(float("-inf"))).alias(f"{m.name}_low"))
        out.append((high + (high - mid) * spread).alias(f"{m.name}_high"))
    return rows.select(F.col("s_lang").alias("lang"), F.col("s_source").alias("source"), F.col("s_n").cast("long").alias("n"), *out)


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", into: str = "__q", verdict: str = "__keep", carry: list[str] | None = None) -> DataFrame:
    """``carry`` (all columns if None), the struct of counts as the column ``into`` and the
    verdict (boolean, never null) as the column ``verdict``; the two names must be new.

    Nulls: a null language or source is a group of its own; a null text fails the base
    rules, an empty one too.  Repeated rows get equal verdicts; a rate on its fence passes.
    A text of any length is counted whole.  An empty table gives an empty table.
    """
    keep = Durable(docs.sparkSession, "quality")
    kept = docs.columns if carry is None else list(dict.fromkeys(carry))
    needed = list(dict.fromkeys([*kept, lang, source]))
    if text in kept:
        # the texts are counted once for the fences and once for the verdicts: cheaper than to
        # write them out in between
        found = keep.save(sketches(with_counts(docs, text, into, [lang, source]), lang, source, into))
        measured = with_counts(docs, text, into, needed)
    else:
        measured = keep.save(with_counts(docs, text, into, needed))
        found = keep.save(sketches(measured, lang, source, into))
    limits = fences(found)
    names = fresh([*needed, into, verdict], *(f"__{c}" for c in limits.columns))
    of = dict(zip(limits.columns, names, strict=True))
    limits = keep.save(limits.toDF(*names), found.count())
    few = limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = measured.join(F.broadcast(limits) if few else limits, F.col(lang).eqNullSafe(F.col(of["lang"])) & F.col(source).eqNullSafe(F.col(of["source"])), "left")
    inside = F.lit(True)
    for m in MEASURES:
        rate, chance = measure(m, into)
        slack = chance * DEVIATIONS
        above, below = rate - slack > F.col(of[f"{m.name}_high"]), rate + slack < F.col(of[f"{m.name}_low"])
        inside = inside & ~F.coalesce(above | below, F.lit(False))
    return joined.select(*[F.col(c) for c in kept], into, (~base_failed(into) & inside).alias(verdict))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with their columns."""
    into, verdict = fresh(docs.columns, "__q", "__keep")
    return judged(docs, text, lang, source, into, verdict).filter(F.col(verdict)).select(*docs.columns)
