"""Nearest neighbours with one vantage-point tree per shard.

Vectors are dealt to shards of about ``shard_rows`` rows by a hash of the row, so that no
vector, however often repeated, fills a shard.  A tree splits its rows at the median distance
to a vantage point and keeps the range of distances of each side.  A query first goes down to
its own leaf, which gives a radius, and then visits every part whose range, by the triangle
inequality, can hold a nearer vector.  With ``factor`` f a part is visited only if its gap is
at most radius / f: one is exact, larger factors prune more.

Trees are rows (one per shard); queries come in packed blocks of bounded size, and every
(tree, block) pair is searched by itself.  The k best of each shard are merged per query.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take
no part, nor do rows with a null id; vectors are compared only with vectors of equal width;
a query's own row is every row with its id, and rows repeated with one id are one query
(the smallest vector); ties go to the smaller id; equal rows are separate
candidates; with fewer candidates than k all are returned; an empty table gives an empty
result.
"""

from __future__ import annotations

import pickle

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from knotwork.llm.common import hinted
from knotwork.session import cut_lineage

LEAF = 128
SHARD_ROWS = 20_000
BLOCK_QUERIES = 512
SAMPLE = 32


def usable(vector: Column) -> Column:
    """Whether a vector takes part: finite throughout and not zero."""
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def _distances(points, query):
    import numpy as np

    return np.sqrt(((points - query) ** 2).sum(axis=1))


def build(ids, points, rng):
    """A tree over all rows: nested (vantage, ranges, inside, outside) or leaves of row numbers."""
    import numpy as np

    def grow(rows):
        if len(rows) <= LEAF:
            return ("leaf", rows)
        # A vantage point far from its fellows spreads the distances.
        tried = rng.choice(rows, min(SAMPLE, len(rows)), replace=False)
        probe = points[rng.choice(rows, min(SAMPLE, len(rows)), replace=False)]
        spread = [np.std(_distances(probe, points[t])) for t in tried[:8]]
        vantage = points[tried[int(np.argmax(spread))]]
        distance = _distances(points[rows], vantage)
        order = np.argsort(distance, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        ranges = [(distance[side[0]], distance[side[-1]]) for side in (near, far)]
        return ("split", vantage, ranges, grow(rows[near]), grow(rows[far]))

    return ids, points, grow(np.arange(len(ids)))


class Search:
    """k best (distance, id) of a block of queries in one tree."""

    def __init__(self, tree, ids, queries, k: int, factor: float):
        import numpy as np

        self.ids, self.points, self.root = tree
        self.query_ids, self.queries, self.k, self.factor = ids, queries, k, factor
        self.score = np.full((len(ids), k), np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def run(self):
        import numpy as np

        everything = np.arange(len(self.query_ids))
        home = np.full(len(self.query_ids), -1)
        self._descend(self.root, everything, home)
        self._visit(self.root, everything, home)
        return self.score, self.found

    def _leaf(self, rows, active):
        import numpy as np

        points, ids = self.points[rows], self.ids[rows]
        queries = self.queries[active]
        # One matrix product rules out most rows; what it leaves is measured exactly.
        squares = (queries ** 2).sum(axis=1)[:, None] + (points ** 2).sum(axis=1)[None, :]
        radius = self.score[active][:, -1:]
        near = squares - 2 * (queries @ points.T) <= radius ** 2 * (1 + 1e-9) + 1e-9 * squares
        near &= ids[None, :] != self.query_ids[active][:, None]
        hit = near.any(axis=1)
        some, near = active[hit], near[hit]
        if not len(some):
            return
        at, row = np.nonzero(near)
        score = np.full(near.shape, np.inf)
        score[at, row] = np.sqrt(((self.queries[some[at]] - points[row]) ** 2).sum(axis=1))
        score = np.concatenate([self.score[some], score], axis=1)
        found = np.concatenate([self.found[some], np.broadcast_to(ids, near.shape)], axis=1)
        order = np.lexsort((found, score), axis=1)[:, :self.k]
        self.score[some] = np.take_along_axis(score, order, axis=1)
        self.found[some] = np.take_along_axis(found, order, axis=1)

    def _descend(self, node, active, home):
        """Search the leaf that each query falls into."""
        import numpy as np

        if not len(active):
            return
        if node[0] == "leaf":
            home[active] = id(node)
            self._leaf(node[1], active)
            return
        _, vantage, ranges, near, far = node
        distance = _distances(self.queries[active], vantage)
        inside = distance <= (ranges[0][1] + ranges[1][0]) / 2
        self._descend(near, active[inside], home)
        self._descend(far, active[~inside], home)

    def _visit(self, node, active, home):
        import numpy as np

        if not len(active):
            return
        if node[0] == "leaf":
            self._leaf(node[1], active[home[active] != id(node)])
            return
        _, vantage, ranges, near, far = node
        distance = _distances(self.queries[active], vantage)
        for (low, high), child in zip(ranges, (near, far)):
            gap = np.maximum(np.maximum(low - distance, distance - high), 0)
            radius = self.score[active][:, -1]
            # A hair of slack, because distances are rounded.
            keep = gap * self.factor <= radius * (1 + 1e-12) + 1e-12
            self._visit(child, active[keep], home)


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """(trees, sizes) of the usable rows of (id, vector): trees holds (width, shard, tree), sizes
    the number of shards of each width."""
    rows = vectors.filter(F.col("id").isNotNull() & usable(F.col("vector"))).select(
        "id", F.col("vector").cast("array<double>").alias("vector"), F.size("vector").alias("width"))
    sizes = cut_lineage(rows.groupBy("width").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards")))
    # The salt separates repeated rows; it only decides where a row is indexed.
    salt = F.monotonically_increasing_id()
    dealt = rows.withColumn("salt", salt).join(hinted(sizes, sizes.count()), "width").withColumn(
        "shard", F.pmod(F.xxhash64("id", "salt"), F.col("shards")).cast("int"))

    def plant(batches):
        import numpy as np

        for batch in batches:
            trees = []
            for shard, members in zip(batch.column("shard").to_pylist(), batch.column("members")):
                ids = members.values.field("id").to_numpy()
                points = members.values.field("vector")
                points = points.flatten().to_numpy().reshape(len(ids), -1)
                order = np.argsort(ids, kind="stable")
                trees.append(pickle.dumps(build(ids[order], points[order], np.random.default_rng(shard))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("width"), batch.column("shard"), pa.array(trees, pa.binary())], ["width", "shard", "tree"])

    gathered = dealt.groupBy("width", "shard").agg(F.collect_list(F.struct("id", "vector")).alias("members"))
    return gathered.mapInArrow(plant, "width int, shard int, tree binary"), sizes


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 2.0, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest of (id, vector) to each row of ``queries``."""
    trees, sizes = index(vectors, shard_rows)
    trees = cut_lineage(trees)
    asked = queries.filter(F.col("id").isNotNull() & usable(F.col("vector"))).groupBy("id").agg(
        F.min("vector").alias("vector"))
    asked = asked.select(
        F.struct("id", F.col("vector").cast("array<double>").alias("vector")).alias("q"), F.size("vector").alias("width"))
    blocks = F.lit(max(1, -(-queries.count() // BLOCK_QUERIES)))
    packed = asked.groupBy("width", F.pmod(F.xxhash64("q.id"), blocks).alias("block")).agg(F.collect_list("q").alias("queries"))
    dealt = packed.join(hinted(sizes, sizes.count()), "width").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards", "block")

    def look(batches):
        import numpy as np

        for batch in batches:
            out = ([], [], [])
            for tree, asked in zip(batch.column("tree"), batch.column("queries")):
                ids = asked.values.field("id").to_numpy()
                points = asked.values.field("vector").flatten().to_numpy().reshape(len(ids), -1)
                score, found = Search(pickle.loads(tree.as_py()), ids, points, k, factor).run()
                real = np.isfinite(score)
                out[0].append(np.repeat(ids, real.sum(axis=1)))
                out[1].append(found[real])
                out[2].append(score[real])
            columns = [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, (np.int64, np.int64, float))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "id", "score"])

    found = dealt.join(trees, ["width", "shard"]).select("tree", "queries").mapInArrow(
        look, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")
