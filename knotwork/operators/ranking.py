"""Limits with a total order, per group and over a whole result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from knotwork.session import cut_lineage

SALTS = 64
# Rows that one task may sort for a limit.
ONE_TASK = 10_000
# Up to this many rows Spark's window group limit prunes below the shuffle.
PRUNED_BELOW_SHUFFLE = 1000


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                  salts: int = SALTS) -> DataFrame:
    """The first ``k`` rows of every group.

    A label or a hub may hold a third of all rows, so groups are cut twice: first
    per (group, salt), spread over many tasks, then over the at most ``salts * k``
    survivors.  Spark's window group limit pushes these cuts below their shuffle for
    small ``k``.  For a larger one a first cut per group and input partition, whose
    rows are bounded by the size of a split, does the same.
    """
    if k > PRUNED_BELOW_SHUFFLE:
        parted = df.withColumn("_salt", F.spark_partition_id())
        df = _first_ranked(parted, [*group, "_salt"], order, k).drop("_salt")
    salted = df.withColumn("_salt", F.spark_partition_id() % salts)
    return _first_ranked(_first_ranked(salted, [*group, "_salt"], order, k), group, order, k).drop("_salt")


def _first_ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """``LIMIT n`` made deterministic.

    Up to ONE_TASK rows this is a top-n per partition and one merge.  For more, the rows are
    dealt by ranges of the order and sorted inside each range; the counts of the ranges, one
    number each, say which come in whole and which one is cut, so no task sorts ``n`` rows.
    The order must tell all rows apart.
    """
    if n <= ONE_TASK:
        return df.orderBy(*order).limit(n)
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = cut_lineage(ranges.withColumn("_range", F.spark_partition_id()))
    counts = sorted((r["_range"], r["count"]) for r in ranges.groupBy("_range").count().collect())
    whole, missing = -1, n
    for number, count in counts:
        if count > missing:
            break
        whole, missing = number, missing - count
    kept = ranges.where(F.col("_range") <= whole)
    if missing and counts and whole < counts[-1][0]:
        cut = min(number for number, _ in counts if number > whole)
        kept = kept.union(ranges.where(F.col("_range") == cut).orderBy(*order).limit(missing))
    return kept.drop("_range")
