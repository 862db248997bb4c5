"""Site-relative line frequency: drop the lines that most pages of a host share.

For each host, the share of its pages that contain a line is compared with a ratio;
lines above it are boilerplate of that host and are dropped from its pages.  The rule is the
same for a host of any size.  Only lines that repeat are boilerplate: one that a single page
has is none, or a host of a few pages would lose all its text, each line being on a large
share of its pages.  DataFrame functions only.

Counting works in two steps, both exact in their result.  Step one counts 64-bit line
hashes per host, so that what is shuffled is a few bytes a line and not the line; hashes
whose count does not exceed the ratio are out.  A hash count is never below the count of
any line with that hash, so nothing is lost.  Step two counts the lines
themselves, for the few hashes left.  Both are partial aggregates, so a host or a line
that holds a third of all rows reaches the shuffle as one row per task.

On one host, at most (mean number of lines of a page) / ratio lines can exceed the
ratio.  So they fit into one array per host, and a page needs a look-up by host and no
shuffle of its lines.  That look-up is broadcast only if its measured size is within
``broadcast_bytes``; otherwise it is a shuffled join, whose hot hosts AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Durable, fresh

#: A line is boilerplate if it is on more than this share of a host's pages ...
MAX_RATIO = 0.1
#: ... and on so many of them at least: it repeats.
REPEATS = 2
#: Largest table of boilerplate lines (bytes of text) that is broadcast.
BROADCAST_BYTES = 4 << 20


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def boilerplate_lines(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO) -> DataFrame:
    """host, line, n_pages, host_pages of each line above the ratio, as a durable table.

    Each row of ``docs`` is a page, repeated rows too.  A line counts once a page.  Lines
    of white space only are never boilerplate: they carry nothing and mark paragraphs.  A
    null host is a host of its own; a null text has no lines; an empty table has none.
    """
    keep = Durable(docs.sparkSession, "linededup")
    pages = docs.groupBy(F.col(host).alias("__of")).agg(F.count(F.lit(1)).alias("__pages"))
    rows = docs.select(F.col(host).alias("__host"), F.explode(F.array_distinct(_lines(F.col(text)))).alias("__line")).filter(F.col("__line").rlike(r"[^\x20\x09-\x0D]"))
    repeats = F.col("__n") >= REPEATS
    above = repeats & (F.col("__n") > F.col("__pages") * F.lit(float(max_ratio)))

    hashes = rows.groupBy("__host", F.xxhash64("__line").alias("__hash")).agg(F.count(F.lit(1)).alias("__n")).filter(repeats)
    likely = hashes.join(pages, _same("__host", "__of")).filter(above).select("__of", F.col("__hash").alias("__likely"), "__pages")
    likely = keep.save(likely)

    exact = rows.join(likely, _same("__host", "__of") & (F.xxhash64("__line") == F.col("__likely"))).groupBy("__host", "__line", "__pages").agg(F.count(F.lit(1)).alias("__n")).filter(above)
    return keep.save(exact.select(F.col("__host").alias("host"), F.col("__line").alias("line"), F.col("__n").alias("n_pages"), F.col("__pages").alias("host_pages")))


def drop_lines(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO, broadcast_bytes: int = BROADCAST_BYTES, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` without its boilerplate lines: same rows, same columns, text rewritten.

    ``counts`` names two long columns to add: lines before, lines dropped.  A page whose
    every line is boilerplate keeps its row with an empty text; a null text stays null
    (0 lines); the other lines keep their order and bytes.  A line at the ratio exactly
    stays.  A text of any length, and a line of any length, is handled whole.  An empty table
    gives none.
    """
    lines = boilerplate_lines(docs, text, host, max_ratio)
    size = lines.agg(F.sum(F.octet_length("line") + 64)).first()[0] or 0
    of, drop = fresh(docs.columns, "__of", "__drop")
    by_host = lines.groupBy(F.col("host").alias(of)).agg(F.collect_set("line").alias(drop))
    if size <= broadcast_bytes:
        by_host = F.broadcast(by_host)
    all_lines = _lines(F.col(text))
    left = F.filter(all_lines, lambda x: ~F.array_contains(F.col(drop), x))
    joined = docs.join(by_host, _same(host, of), "left")
    cleaned = F.when(F.col(drop).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    out = [cleaned.alias(c) if c == text else F.col(c) for c in docs.columns]
    if counts:
        none = F.lit(0).cast("long")
        n = F.coalesce(F.size(all_lines).cast("long"), none)
        n = F.when(F.col(text).isNull(), none).otherwise(n)
        dropped = F.when(F.col(text).isNull() | F.col(drop).isNull(), none).otherwise((F.size(all_lines) - F.size(left)).cast("long"))
        out += [n.alias(counts[0]), dropped.alias(counts[1])]
    return joined.select(*out)
