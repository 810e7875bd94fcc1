"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word of a text: a run of characters that are neither a space nor U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
# Rows up to which a table of one short row per key may be broadcast; beyond that the
# same join is a shuffle.
SMALL_ROWS = 100_000
# Rows of an Arrow batch.  Texts are long, and a batch is held on both sides of the pipe.
BATCH_ROWS = 1_000


def whole_row(df: DataFrame) -> Column:
    """The input row as one struct, so that result columns never clash with its names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def hinted(df: DataFrame, rows: int, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast when its counted ``rows`` are few."""
    return F.broadcast(df) if rows <= limit else df


def small_batches(spark: SparkSession) -> SparkSession:
    """Let Arrow batches hold at most BATCH_ROWS rows; results do not depend on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def in_slices(function: Callable[[pa.Array], pa.Array], rows: int = 256):
    """``function`` as the body of an iterator UDF that works on a few rows at a time, so that
    what it holds besides its input does not grow with the batch."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for start in range(0, len(batch), rows):
                yield function(batch.slice(start, rows))
        pa.default_memory_pool().release_unused()

    return run


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows each, for the same reason."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


def word_count(text: Column) -> Column:
    """Words of a text; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
