"""Measured sizes, so that only data known to be small is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A measured table up to this size is broadcast; beyond it joins shuffle.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def _width(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        size = F.octet_length(c)
    elif isinstance(dtype, T.ArrayType) and not isinstance(dtype.elementType, (T.StringType, T.ArrayType, T.StructType)):
        size = 8 * F.size(c)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(c))
    else:
        size = F.lit(8)
    return F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long") + 16


def measured_bytes(settled: DataFrame) -> int:
    """Size in memory of a table that is already computed, by reading all of it."""
    total = F.lit(0)
    for f in settled.schema.fields:
        total = total + _width(f.name, f.dataType)
    return settled.agg(F.sum(total)).first()[0] or 0


def fits_memory(settled: DataFrame) -> bool:
    return measured_bytes(settled) <= MAX_BROADCAST_BYTES


def mark(df: DataFrame, fits: bool) -> DataFrame:
    """A broadcast hint if the table was found to fit."""
    return F.broadcast(df) if fits else df


# The hash of a key.  Names of a type begin alike, so sorting them compares whole strings;
# with the hash before the key of a join or a group, eight bytes decide.
KEY_HASH = "_key_hash"


def hashed(df: DataFrame, *key: str) -> DataFrame:
    """``df`` with the hash of a key, if it has none yet."""
    return df if KEY_HASH in df.columns else df.withColumn(KEY_HASH, F.xxhash64(*key))


def not_stored(fresh: DataFrame, stored: DataFrame, key: Sequence[str], fits: bool = False) -> DataFrame:
    """Rows of ``fresh`` whose key is not stored.

    When ``fresh`` fits in memory it is sent to the stored rows, which then need no
    shuffle; otherwise both sides are joined by key.
    """
    keys = list(key)
    known = stored.select(*keys)
    if fits:
        known = known.join(F.broadcast(fresh.select(*keys)), keys, "left_semi")
        return fresh.join(known, keys, "left_anti")
    return hashed(fresh, *keys).join(hashed(known, *keys), [KEY_HASH, *keys], "left_anti").drop(KEY_HASH)
