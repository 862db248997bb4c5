"""Results of relational queries as encoded rows, whole or one partition at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame

from ..types import encode_row


def buffered(df: DataFrame) -> list[list[Any]]:
    """All rows; for results that fit the driver."""
    return [encode_row(r, df.schema) for r in df.collect()]


def streamed(df: DataFrame) -> Iterator[list[Any]]:
    """Rows as they come; the driver holds two partitions at most."""
    schema = df.schema
    for row in df.toLocalIterator(prefetchPartitions=True):
        yield encode_row(row, schema)
