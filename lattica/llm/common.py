"""Shared plumbing: durable intermediates, streamed groups and text batches."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text that are turned into Python objects at a time.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir of the session.

    Only a session without one, on a local master, gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    own = getattr(spark.sparkContext, "_lattica_shared", None)
    if own is None:
        folder = tempfile.mkdtemp(prefix="lattica-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        own = f"file://{folder}"
        spark.sparkContext._lattica_shared = own
    return own


def _remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever it is; a session that has ended leaves it to the cluster."""
    context = spark.sparkContext
    if context._jsc is None:
        return
    with contextlib.suppress(Py4JError, OSError):
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


class Durable:
    """Writes intermediate tables to the shared folder, so that a lost executor costs
    one task and not the whole lineage, and drops those that are no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.count = 0
        self.saved: list[DataFrame] = []
        # results are lazy and read these tables, so they stay until the program ends
        atexit.register(_remove, spark, self.root)

    def save(self, df: DataFrame, rows: int | None = None, per_task: int = 250_000) -> DataFrame:
        """The table, written and read again.  Where ``rows`` bounds its rows, the last stage
        has a task, and so a file, for each ``per_task`` of them: small tables are one file."""
        if rows is not None:
            df = df.coalesce(max(1, -(-rows // per_task)))
        path = f"{self.root}/{self.count:04d}"
        self.count += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._lattica_path = path
        self.saved.append(out)
        return out

    def keep_only(self, *kept: DataFrame) -> None:
        """Drops all tables saved so far but these, once nothing lazy reads them."""
        for df in self.saved:
            if all(df is not k for k in kept):
                self.drop(df)
        self.saved = list(kept)

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_lattica_path", None)
        if path:
            _remove(self.spark, path)


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores before them until none is one of ``columns`` (names differ
    in more than case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, to bound what is held as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """Each text as str; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def record_batch(schema: pa.Schema, columns: list[Any]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(work, schema)


def sorted_stream(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of a key in one task, next to one another, in order; sorting spills to disk."""
    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows with equal keys out of a stream sorted by them.  A group may
    cross batches; only the one in hand is kept, so use it for bounded groups."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*lists, strict=True))
        start = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield last, pa.Table.from_batches(held)
                held, last, start = [], key, i
        held.append(batch.slice(start))
    if held:
        yield last, pa.Table.from_batches(held)
