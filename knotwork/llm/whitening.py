"""Whitening of embeddings: principal components scaled to unit variance.

Entries become whole numbers ``floor(scale * c) + shift``, so every sum below is exact and the
result does not depend on how the rows are dealt.  One pass counts the rows and sums each
dimension; a second one multiplies the vectors, centred on the rounded mean, into a scatter
matrix per task, which Spark adds up.  What rounding the mean left is taken out exactly.  The
driver holds one matrix of ``width`` by ``width``; ``MAX_WIDTH`` bounds it.

The scatter matrix is factored by Cholesky with pivots, and one-sided Jacobi rotations make
the columns of the triangular factor orthogonal: their norms are the square roots of the
eigenvalues and the columns, at unit length, are the components.  A third pass measures how
far the covariance of the whitened rows is from the identity.

Defined cases: a row takes no part when its vector is null or empty, holds a null or a
non-finite entry or one of ``LIMIT`` or more in size, or has another width than most vectors
have (of two such widths the smaller); repeated rows count as often as they are there; ids
may be null or repeated; directions without variance give no component, so equal vectors, a
single one or an empty table give an empty result; components of equal eigenvalues are any
basis of their space; input columns may have any names, because rows come back inside
``row``.  A deviation that no long can hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from knotwork.llm.common import whole_row

SCALE, SHIFT = 1024, 100_000
LIMIT = 2.0**30
MAX_WIDTH = 4096
# Products of halves of this many bits, summed over ROWS rows, are exact as doubles.
HALF, ROWS = 21, 1 << 10


def usable(vector: Column) -> Column:
    """Vectors without a null, non-finite or oversized entry."""
    return F.coalesce((F.size(vector) > 0) & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT)), F.lit(False))


def whole_numbers(vectors: pa.Array, width: int):
    """One row of whole numbers per vector."""
    import numpy as np

    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, width) + SHIFT


def totals(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        count, sums = 0, np.zeros(width, object)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                x = whole_numbers(batch.column(0).slice(start, ROWS), width)
                count += len(x)
                sums += x.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([
            pa.array([count], pa.int64()), pa.array([[str(v) for v in sums]], pa.list_(pa.string()))], ["n", "sums"])

    parts = rows.mapInArrow(partial, "n long, sums array<string>")
    found = parts.select("n", F.posexplode("sums")).groupBy("pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r.pos: int(r.s) for r in found}
    return (int(found[0].n) if found else 0), [sums.get(i, 0) for i in range(width)]


def halves_product(x):
    """x' x as three exact integer matrices: of high halves, mixed and low halves."""
    import numpy as np

    high = (x + (1 << (HALF - 1))) >> HALF
    low = (x - (high << HALF)).astype(np.float64)
    square = (low.T @ low).astype(np.int64)
    if not high.any():
        return np.zeros_like(square), np.zeros_like(square), square
    high = high.astype(np.float64)
    mixed = (high.T @ low).astype(np.int64)
    return (high.T @ high).astype(np.int64), mixed + mixed.T, square


def scatter(rows: DataFrame, n: int, sums: list[int]):
    """The matrix sum((x - S / n)(x - S / n)'), exact until it is rounded to doubles."""
    import numpy as np

    width = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each addend is at most 2**53, so a long holds the sum of 512 of them.
        held, times = np.zeros((3, width, width), np.int64), 0
        middle = np.array(centre, np.int64)

        def out() -> pa.RecordBatch:
            table = held.transpose(1, 0, 2)
            return pa.RecordBatch.from_arrays([
                pa.array(range(width), pa.int32()), *[pa.array(list(table[:, k]), pa.list_(pa.int64())) for k in range(3)]],
                ["i", "high", "mixed", "low"])

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                held += np.stack(halves_product(whole_numbers(batch.column(0).slice(start, ROWS), width) - middle))
                times += 1
                if times == 512:
                    yield out()
                    held[:], times = 0, 0
        if times:
            yield out()

    parts = rows.mapInArrow(partial, "i int, high array<long>, mixed array<long>, low array<long>")
    cells = parts.select("i", F.posexplode(F.arrays_zip("high", "mixed", "low")).alias("j", "v")).groupBy("i", "j").agg(
        *[F.sum(F.col(f"v.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "mixed", "low")])
    out = np.zeros((width, width), object)
    for r in cells.toLocalIterator():
        out[r.i, r.j] = (int(r.high) << (2 * HALF)) + (int(r.mixed) << HALF) + int(r.low)
    rest = np.array([s - n * c for s, c in zip(sums, centre)], object)
    # sum((x - c)(x - c)') - rest rest' / n, times n, is a whole number; only now rounded.
    return (out * n - np.outer(rest, rest)).astype(np.float64) / n


def pivoted_cholesky(matrix):
    """Columns L with L L' = matrix; as many as its rank."""
    import numpy as np

    rest = np.array(matrix, np.float64)
    size, rank = len(rest), 0
    diagonal, used = rest.diagonal().copy(), np.zeros(size, bool)
    # What rounding may leave of each entry, by its own size: small directions count too.
    least = size * np.finfo(np.float64).eps * diagonal
    factor = np.zeros((size, size))
    for k in range(size):
        open_ = ~used & (diagonal > least)
        if not open_.any():
            break
        pivot = int(np.argmax(np.where(open_, diagonal, -np.inf)))
        column = (rest[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(diagonal[pivot])
        column[used] = 0.0
        factor[:, k] = column
        diagonal -= column**2
        used[pivot] = True
        rank += 1
    return factor[:, :rank]


def jacobi_columns(factor, sweeps: int = 60, tolerance: float = 1e-15):
    """(norms, unit columns), largest first, of the factor after its columns were rotated
    until they are orthogonal.  Pairs without a common column are rotated together."""
    import numpy as np

    columns = np.array(factor.T, np.float64)
    count = len(columns)
    if count > 1:
        ring = list(range(count + count % 2))
        for _ in range(sweeps):
            worst = 0.0
            for _ in range(len(ring) - 1):
                half = len(ring) // 2
                pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if max(a, b) < count]
                p, q = np.array(pairs).T
                a, b = columns[p], columns[q]
                aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
                cosine = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(np.float64).tiny))
                worst = max(worst, float(cosine.max()))
                turn = cosine > tolerance
                if turn.any():
                    p, q, a, b = p[turn], q[turn], a[turn], b[turn]
                    zeta = (bb[turn] - aa[turn]) / (2 * ab[turn])
                    tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                    cos = 1 / np.sqrt(1 + tangent**2)
                    sin = cos * tangent
                    columns[p] = cos[:, None] * a - sin[:, None] * b
                    columns[q] = sin[:, None] * a + cos[:, None] * b
                ring = [ring[0], ring[-1], *ring[1:-1]]
            if worst <= tolerance * 8:
                break
    norms = np.sqrt((columns**2).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    return norms[order], columns[order] / norms[order][:, None]


@dataclass
class Whitening:
    """A fitted whitening: the sums S of n rows, unit components, their eigenvalues, and trace(V)."""

    n: int
    sums: list[int]
    components: Any
    eigenvalues: Any
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def deviations(self, vectors: pa.Array):
        """n * x - S of each vector, as exact integers (objects where longs could overflow)."""
        import numpy as np

        x = whole_numbers(vectors, self.width)
        if self.n * (int(np.abs(x).max(initial=0)) + max(abs(s) // self.n + 1 for s in self.sums)) < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def scores(self, deviations):
        """Whitened coordinates of rows given by n * x - S."""
        import numpy as np

        return (deviations.astype(np.float64) / self.n) @ self.components.T / np.sqrt(self.eigenvalues)


def fitting(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows that take part, as ``vector`` and ``row``, and their width."""
    content = F.col(f"`{vector}`")
    rows = vectors.filter(usable(content)).select(whole_row(vectors), content.alias("vector"))
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    best = widths.orderBy(F.desc("count"), "width").first()
    width = best.width if best else 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of more than {MAX_WIDTH} entries are not whitened")
    return rows.filter(F.size("vector") == width), width


def fit(rows: DataFrame, width: int, components: int) -> Whitening | None:
    """Fit on all rows of ``fitting``; None when no direction varies."""
    import numpy as np

    n, sums = totals(rows.select("vector"), width)
    if not n:
        return None
    spread = scatter(rows.select("vector"), n, sums)
    trace = float(np.trace(spread)) / n
    norms, found = jacobi_columns(pivoted_cholesky(spread))
    kept = norms[:components] ** 2 > 0
    if not kept.any():
        return None
    return Whitening(n, sums, found[:components][kept], norms[:components][kept] ** 2 / n, trace)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    import numpy as np

    size = len(model.eigenvalues)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((size + 1, size))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                w = model.scores(model.deviations(batch.column(0).slice(start, ROWS)))
                held[0] += w.sum(axis=0)
                held[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(held.size), pa.int32()), pa.array(held.ravel())], ["cell", "v"])

    # Decimals, so that the order in which tasks are added makes no difference.
    parts = rows.select("vector").mapInArrow(partial, "cell int, v double")
    found = parts.groupBy("cell").agg(F.sum(F.col("v").cast("decimal(38,18)")).alias("v")).collect()
    cells = np.zeros((size + 1) * size)
    for r in found:
        cells[r.cell] = float(r.v)
    mean, square = cells[:size] / model.n, cells[size:].reshape(size, size) / model.n
    return float(np.abs(square - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = 8) -> DataFrame:
    """row, component (from 1), n, deviation, whitened, explained and identity_error for each row
    that takes part and each component."""
    rows, width = fitting(vectors, vector)
    model = fit(rows, width, components) if width else None
    shape = "array<double>"
    if model is None:
        nothing = rows.limit(0).select("row", F.lit(None).cast(f"struct<deviation:bigint,whitened:{shape}>").alias("out"))
        return _spread(nothing, 0, [], 0.0)
    error = identity_error(rows, model)

    @F.arrow_udf(f"struct<deviation:bigint,whitened:{shape}>")
    def scored(batch: pa.Array) -> pa.Array:
        parts = []
        for start in range(0, max(1, len(batch)), ROWS):
            z = model.deviations(batch.slice(start, ROWS))
            exact = z.dtype == object or len(z) and int(abs(z).max()) ** 2 * z.shape[1] >= 2**63
            squares = ((z.astype(object) if exact else z) ** 2).sum(axis=1).tolist()
            w = model.scores(z)
            parts.append(pa.StructArray.from_arrays([
                pa.array([s if s < 2**63 else None for s in squares], pa.int64()),
                pa.array(list(w), pa.list_(pa.float64()))], ["deviation", "whitened"]))
        return pa.concat_arrays(parts)

    shares = [float(e) / model.trace for e in model.eigenvalues]
    return _spread(rows.select("row", scored.asNondeterministic()("vector").alias("out")), model.n, shares, error)


def _spread(rows: DataFrame, n: int, shares: list[float], error: float) -> DataFrame:
    explained = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    wide = rows.select("row", "out.deviation", F.posexplode("out.whitened").alias("at", "whitened"))
    return wide.select(
        "row", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
