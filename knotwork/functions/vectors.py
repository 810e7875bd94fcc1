"""Cosine scores over embedding columns, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def check_vector(vector: Sequence[float] | None) -> list[float]:
    """A usable feature vector: numeric, finite and not empty."""
    if vector is None or len(vector) == 0:
        raise ValueError("the vector is empty")
    if any(isinstance(x, bool) or not isinstance(x, (int, float, np.number)) for x in vector):
        raise ValueError("the vector must be numeric")
    values = [float(x) for x in vector]
    if not np.isfinite(values).all():
        raise ValueError("the vector must be finite")
    return values


def unit(vector: Sequence[float]) -> np.ndarray:
    """The vector scaled to length one; a zero vector stays zero."""
    v = np.asarray(vector, dtype="float64")
    length = np.linalg.norm(v)
    return v / length if length > 0 else v


def unit_rows(batch: pa.Array, dim: int) -> np.ndarray:
    """Rows of an embedding array (all of width ``dim``) scaled to length one."""
    rows = batch.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dim)
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    lengths[lengths == 0] = 1.0
    return rows / lengths[:, None]


def similarities(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosines of unit rows and unit queries (a vector or a matrix).

    Rounded far below the precision of the stored floats, so copies of one vector
    score the same in whatever batch they arrive and ties break by record id.
    """
    return np.round(rows @ queries.T, 12)


def has_width(embedding: Column, dim: int) -> Column:
    """Only embeddings of the configured width are searchable."""
    return F.coalesce(F.size(embedding) == dim, F.lit(False))


def cosine(embedding: Column, query: Sequence[float]) -> Column:
    """Cosine similarity to one query; the rows must satisfy ``has_width``.

    An embedding with a missing element has no similarity.
    """
    direction = unit(check_vector(query))
    dim = len(direction)

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        return pa.array(similarities(unit_rows(batch, dim), direction), from_pandas=True)

    return score(embedding)


def score_of(similarity: Column) -> Column:
    """One minus the cosine distance, never below zero."""
    return F.greatest(F.lit(0.0), similarity)
