"""Jaccard similarity join of texts on word shingles by chosen paths.

Equal texts are one class from the start.  Each class is the set of its five-word shingles.
In every run a set extends each of its paths by those shared tokens (shingles) whose hash
under the path falls below ``1 / (rate * size)``, so similar sets go down the same paths
and unlike sets part.  Paths held by few sets are buckets; longer paths split the others.
Sets of a bucket are compared by brute force, first on a 256-bin sketch, then exactly; in large
buckets all meet one of them first, and only what that leaves apart is compared further.
Runs are repeated so that a pair at the threshold is missed with a probability below 1e-2.

Similar sketches link the classes of a bucket into candidate groups.  The shingles of each
group are gathered once and all its pairs are compared exactly, in blocks when the group is
large; pairs are counted where they are compared and never written out.

Defined cases: a text of fewer than five words is one shingle of all its words; a text
without a word (null, empty, blank) is a class of its own row and links to nothing; copies
are links; repeated rows are copies; an empty table gives an empty result; a class is named
by the smallest doc_id of its documents (null when they have none).
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StructField, StructType,
)

from knotwork.llm.common import hinted, in_slices, slices, whole_row
from knotwork.llm.components import components
from knotwork.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
RUNS, DEPTH, RATE = 10, 3, 0.75
BINS = 256
# Sets compared at once: paths held by more are split, or compared in blocks at full depth.
BUCKET, BLOCK, BLOCK_SHINGLES = 64, 512, 2_000_000
CHUNK = 1 << 12
SEEDS = [(0x9E3779B97F4A7C15 * (2 * run + 1)) % 2**64 for run in range(RUNS)]

LONGS = ArrayType(LongType())
SIGNATURE = StructType([
    StructField("n", IntegerType()), StructField("sketch", BinaryType()), StructField("path1", LONGS),
    StructField("path2", LONGS), StructField("from2", LONGS), StructField("path3", LONGS), StructField("from3", LONGS),
])


def _mix(x):
    """A bijective scrambling of 64-bit numbers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@functools.lru_cache(maxsize=4)
def _tables(longest: int):
    """A number for each byte, white space 0, and powers up to the longest word."""
    import numpy as np

    numbers = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    numbers[list(b" \t\n\x0b\x0c\r")] = 0
    return numbers, np.cumprod(np.full(longest, 0xD1342543DE82EF95, np.uint64))


def word_hashes(text: bytes):
    """A 64-bit hash of each word, in order: a polynomial over its bytes."""
    import numpy as np

    codes = np.frombuffer(text, np.uint8)
    numbers = _tables(1 << 10)[0][codes]
    inside = numbers != 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    longest = int(lengths.max())
    powers = _tables(1 << max(10, longest.bit_length()))[1]
    # Bytes from the first word on, each with its distance from the start of its word.
    numbers = numbers[starts[0]:]
    starts = starts - starts[0]
    at = np.arange(len(numbers)) - np.repeat(starts, np.diff(starts, append=len(numbers)))
    numbers *= powers[np.minimum(at, longest - 1)]
    return _mix(np.add.reduceat(numbers, starts) + lengths.astype(np.uint64))


def shingle_hashes(text: bytes):
    """Distinct 64-bit hashes of the five-word shingles, ascending."""
    import numpy as np

    numbers = word_hashes(text)
    if not len(numbers):
        return numbers
    width = min(SHINGLE, len(numbers))
    last = len(numbers) - width + 1
    out = np.full(last, width, np.uint64)
    for i in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + numbers[i:i + last]
    return np.unique(_mix(out))


def _extend(paths, tokens, limit):
    """(index of the parent, child path) of each path extended by each token below ``limit``."""
    import numpy as np

    parents, children = [], []
    odd = (paths | np.uint64(1))[:, None]
    for start in range(0, len(tokens), CHUNK):
        # In place and in short pieces: the hashes stay in the processor's cache.
        hashed = odd * tokens[None, start:start + CHUNK]
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0x9FB21C651E98DF25)
        at, token = np.nonzero(hashed <= limit)
        parents.append(at)
        children.append(_mix(hashed[at, token] ^ odd[at, 0]))
    return np.concatenate(parents), np.concatenate(children)


def _signature(tokens) -> tuple:
    import numpy as np

    bounds = np.searchsorted(tokens, np.arange(BINS, dtype=np.uint64) << np.uint64(56))
    filled = np.append(bounds[1:], len(tokens)) > bounds
    sketch = np.zeros(BINS, np.uint8)
    sketch[filled] = _mix(tokens[bounds[filled]]) % np.uint64(255) + np.uint64(1)
    limit = np.uint64(min(2**64 - 1, int(2**64 / (RATE * len(tokens)))))
    paths = np.array(SEEDS, np.uint64)
    levels = []
    for _ in range(DEPTH):
        parents, children = _extend(paths, tokens, limit)
        levels.append((paths[parents].view(np.int64), children.view(np.int64)))
        paths = children
    (_, one), (from2, two), (from3, three) = levels
    return len(tokens), sketch.tobytes(), one, two, from2, three, from3


def _signatures(texts: pa.Array) -> pa.Array:
    """Number of shingles, sketch and paths of each text; null without a word."""
    rows = []
    for text in texts.cast(pa.binary()):
        tokens = shingle_hashes(text.as_py() or b"")
        rows.append(_signature(tokens) if len(tokens) else None)
    kinds = [pa.int32(), pa.binary()] + [pa.list_(pa.int64())] * 5
    columns = [pa.array([r and r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.StructArray.from_arrays(columns, SIGNATURE.names, mask=pa.array([r is None for r in rows], pa.bool_()))


def _shingles(texts: pa.Array) -> pa.Array:
    import numpy as np

    return pa.array([shingle_hashes(t.as_py() or b"").view(np.int64) for t in texts.cast(pa.binary())], pa.list_(pa.int64()))


# Marked so that Catalyst runs it once: a deterministic one would be copied into the filter
# on its result.
signature = F.arrow_udf(in_slices(_signatures), SIGNATURE).asNondeterministic()
shingles = F.arrow_udf(in_slices(_shingles), LONGS)


def _roots(linked):
    """The smallest member of each member's connected part of a symmetric matrix."""
    import numpy as np

    label = np.arange(len(linked))
    for start in range(len(linked)):
        if label[start] != start:
            continue
        part = np.zeros(len(linked), bool)
        part[start] = True
        front = part
        while front.any():
            reached = linked[front].any(axis=0) & ~part
            part |= reached
            front = reached
        label[part] = start
    return label


def _near(same, either, sizes, others):
    """Rows of bins whose agreement leaves a similarity of THRESHOLD possible (five deviations)."""
    import numpy as np

    union = either.sum(axis=1)
    least = THRESHOLD * union - 5 * np.sqrt(THRESHOLD * (1 - THRESHOLD) * union) - 1
    return (same.sum(axis=1) >= least) & (np.minimum(sizes, others) >= THRESHOLD * np.maximum(sizes, others))


def _alike(sizes, sketches):
    """Pairs of sketches that may be similar."""
    import numpy as np

    count = len(sizes)
    alike = np.zeros((count, count), bool)
    filled = sketches > 0
    for i in range(count - 1):
        same = (sketches[i] == sketches[i + 1:]) & filled[i]
        alike[i, i + 1:] = _near(same, filled[i] | filled[i + 1:], sizes[i], sizes[i + 1:])
    return alike | alike.T


def _sketches(column):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def _edges(us, vs) -> pa.RecordBatch:
    import numpy as np

    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (us, vs)], ["u", "v"])


def link_sketches(batches):
    """Each list of (cid, n, sketch) as edges (u, v) to the smallest of its linked part."""
    import numpy as np

    for batch in slices(batches):
        us, vs = [], []
        for members in batch.column("members"):
            values = members.values
            ids = values.field("cid").to_numpy()
            roots = _roots(_alike(values.field("n").to_numpy(), _sketches(values.field("sketch"))))
            linked = roots != np.arange(len(ids))
            us.append(ids[linked])
            vs.append(ids[roots[linked]])
        yield _edges(us, vs)


def link_pivots(batches):
    """The pairs (cid, pivot) with their sketches that may be similar, as edges."""
    import numpy as np

    for batch in slices(batches, 4096):
        sizes = [batch.column(c).to_numpy() for c in ("n", "pivot_n")]
        a, b = (_sketches(batch.column(c)) for c in ("sketch", "pivot_sketch"))
        near = _near((a == b) & (a > 0), (a > 0) | (b > 0), *sizes)
        yield _edges([batch.column("cid").to_numpy()[near]], [batch.column("pivot").to_numpy()[near]]) if len(near) else _edges([], [])


def link_parts(batches):
    """Each list of (cid, n, sketch, comp, side) as one edge for each pair of parts (comp) that
    it links anew.  Of a list with two sides only links across count: those inside a side come
    out of that side's own list."""
    import numpy as np

    for batch in slices(batches):
        us, vs = [], []
        for members in batch.column("members"):
            values = members.values
            comp, side = values.field("comp").to_numpy(), values.field("side").to_numpy()
            alike = _alike(values.field("n").to_numpy(), _sketches(values.field("sketch")))
            alike &= comp[:, None] != comp[None, :]
            if side.min() != side.max():
                # What a side links inside is one part for the other side.
                same = comp[:, None] == comp[None, :]
                parts = _roots((alike | same) & (side[:, None] == side[None, :]))
                alike &= side[:, None] != side[None, :]
            else:
                parts = np.arange(len(comp))
            x, y = np.nonzero(np.triu(alike))
            keep = np.unique(np.stack([parts[x], parts[y]], axis=1), axis=0)
            if side.min() == side.max() and len(keep):
                # One tree for each linked part.
                kinds, number = np.unique(comp, return_inverse=True)
                linked = np.zeros((len(kinds), len(kinds)), bool)
                linked[number[keep[:, 0]], number[keep[:, 1]]] = True
                roots = _roots(linked | linked.T)
                moved = roots != np.arange(len(kinds))
                us.append(kinds[moved])
                vs.append(kinds[roots[moved]])
            else:
                us.append(comp[keep[:, 0]])
                vs.append(comp[keep[:, 1]])
        yield _edges(us, vs)


def _common(lists, count):
    """Sizes of all pairwise intersections of ``lists``."""
    import numpy as np

    owner = np.repeat(np.arange(count), [len(x) for x in lists])
    values, column, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((count, count), np.float32)
    width = max(1, (1 << 22) // count)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, [start, start + width])
        held = np.zeros((count, min(width, int(column[high - 1]) - start + 1)), np.float32)
        held[owner[low:high], column[low:high] - start] = 1
        out += held @ held.T
    return out


def verify(batches):
    """Exact comparison of lists of (cid, copies, side, shingles): (cid, root, links).

    With two sides only pairs across are counted, so every pair of a group counts once.
    """
    import numpy as np

    for batch in slices(batches):
        out = ([], [], [])
        for members in batch.column("members"):
            values = members.values
            ids, copies = values.field("cid").to_numpy(), values.field("copies").to_numpy()
            side = values.field("side").to_numpy()
            lists = [x.values.to_numpy() for x in values.field("shingles")]
            sizes = np.array([len(x) for x in lists], np.float32)
            common = _common(lists, len(ids))
            linked = common >= THRESHOLD * (sizes[:, None] + sizes[None, :] - common) - 1e-4
            np.fill_diagonal(linked, False)
            if side.min() != side.max():
                linked &= side[:, None] != side[None, :]
            out[0].append(ids)
            out[1].append(ids[_roots(linked)])
            out[2].append(linked @ copies)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out], ["cid", "root", "links"])


def in_blocks(rows: DataFrame, group: str, blocks: Column, item: list[str]) -> DataFrame:
    """Lists ``members`` of at most two blocks of a group, one list for each pair of blocks.

    A list of two blocks of which one is empty is left out: its pairs are those of one block.
    """
    spread = rows.withColumn("blocks", blocks).withColumn(
        "side", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (
        spread.groupBy(group, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
        .agg(F.collect_list(F.struct("cid", "side", *item)).alias("members"),
             F.min("side").alias("low"), F.max("side").alias("high"))
        .filter((F.size("members") > 1) & ((F.col("i") == F.col("j")) | (F.col("low") != F.col("high")))).drop("low", "high")
    )


def buckets(classes: DataFrame) -> DataFrame:
    """(path, cid, held): the paths held by two classes or more, split down to DEPTH."""
    done, above = [], None
    for level in range(1, DEPTH + 1):
        rows = classes.select("cid", F.explode(
            F.arrays_zip(F.col(f"sig.path{level}").alias("path"), F.col(f"sig.from{level}").alias("up")) if level > 1
            else F.transform("sig.path1", lambda p: F.struct(p.alias("path")))).alias("at")).select("cid", "at.*").distinct()
        if above is not None:
            rows = rows.join(hinted(above.withColumnRenamed("path", "up"), above.count()), "up", "left_semi").drop("up")
            rows = cut_lineage(rows)
        held = cut_lineage(rows.groupBy("path").agg(F.count("*").alias("held")).filter("held > 1"))
        members = rows.join(hinted(held, held.count()), "path")
        if level < DEPTH:
            above = held.filter(F.col("held") > BUCKET).select("path")
            members = members.filter(F.col("held") <= BUCKET)
        done.append(members.select("path", "cid", "held"))
    return functools.reduce(DataFrame.union, done)


def large_links(held: DataFrame, sketched: DataFrame) -> DataFrame:
    """Edges (u, v) that link what is similar in the large buckets (path, cid).

    First every member meets one pivot, the smallest of its bucket; near copies share few
    pivots, so this is a few comparisons for each member, however many buckets they share.
    What one pivot links is one part, and so is what its own smallest pivot links.  Only buckets
    with several parts are compared further: in blocks, and never within the largest part.
    """
    pivots = held.groupBy("path").agg(F.min("cid").alias("pivot"))
    pairs = held.join(hinted(pivots, pivots.count()), "path").filter("cid != pivot").select("cid", "pivot").distinct()
    of_pivot = sketched.select(F.col("cid").alias("pivot"), F.col("n").alias("pivot_n"), F.col("sketch").alias("pivot_sketch"))
    linked = cut_lineage(pairs.join(sketched, "cid").join(of_pivot, "pivot").mapInArrow(link_pivots, "u long, v long"))
    least = cut_lineage(linked.groupBy("u").agg(F.min("v").alias("v")))
    known = least.join(least.select(F.col("u").alias("v"), F.col("v").alias("w")), "v", "left").select(
        F.col("u").alias("cid"), F.coalesce("w", "v").alias("root"))
    placed = cut_lineage(held.join(known, "cid", "left").select("path", "cid", F.coalesce("root", "cid").alias("comp")))
    sizes = placed.groupBy("path", "comp").agg(F.count("*").alias("n"))
    open_ = cut_lineage(sizes.groupBy("path").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all"))
        .filter("n_main < n_all").select(
            "path", "main", F.ceil((F.col("n_all") - F.col("n_main")) / BLOCK).cast("int").alias("rest"),
            F.ceil(F.col("n_main") / BLOCK).cast("int").alias("mains")))
    rows = placed.join(hinted(open_, open_.count()), "path")
    # Blocks of the largest component come after the others and meet only those.
    main = F.col("comp") == F.col("main")
    hashed = F.xxhash64("cid")
    rows = rows.withColumn("side", F.when(main, F.col("rest") + F.pmod(hashed, F.col("mains"))).otherwise(
        F.pmod(hashed, F.col("rest"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(
        F.lit(0), F.when(main, F.col("rest")).otherwise(F.col("rest") + F.col("mains")) - 1)))
    lists = rows.select("path", "cid", "comp", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")).join(
        sketched, "cid").groupBy("path", "i", "j").agg(
        F.collect_list(F.struct("cid", "n", "sketch", "comp", "side")).alias("members"),
        F.min("side").alias("low"), F.max("side").alias("high"))
    lists = lists.filter((F.size("members") > 1) & ((F.col("i") == F.col("j")) | (F.col("low") != F.col("high"))))
    return linked.union(lists.select("members").mapInArrow(link_parts, "u long, v long"))


def similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(key, copies, first_id, class_id, links, chosen) for each distinct text with a word.

    ``key`` is the MD5 of the text, ``first_id`` its smallest id, ``links`` the number of
    other documents at a similarity of THRESHOLD or more, and ``chosen`` marks the one text
    that stands for its class.
    """
    content, identity = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    keyed = docs.select(text_key(content).alias("key"), identity.alias("id"), content.alias("text"))
    classes = cut_lineage(
        keyed.select("key", "id", signature("text").alias("sig")).filter(F.col("sig").isNotNull())
        .groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("first_id"), F.first("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    found = buckets(classes)
    # Buckets with the same members are compared once.
    small = (
        found.filter(F.col("held") <= BUCKET).groupBy("path").agg(F.sort_array(F.collect_list("cid")).alias("cids"))
        .select("cids").distinct().select(F.xxhash64("cids").alias("path"), F.explode("cids").alias("cid"))
    )
    sketched = classes.select("cid", "sig.n", "sig.sketch")
    small = small.join(sketched, "cid").groupBy("path").agg(
        F.collect_list(F.struct("cid", "n", "sketch")).alias("members"))
    edges = small.mapInArrow(link_sketches, "u long, v long").union(
        large_links(cut_lineage(found.filter(F.col("held") > BUCKET).select("path", "cid")), sketched))
    grouped = cut_lineage(components(edges).withColumnRenamed("node", "cid").withColumnRenamed("root", "comp"))

    members = grouped.join(classes.select("cid", "key", "copies", "first_id", F.col("sig.n").alias("n")), "cid")
    weight = members.groupBy("comp").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    weight = cut_lineage(weight)
    members = cut_lineage(members.join(hinted(weight, weight.count()), "comp"))
    wanted = hinted(members.drop("n"), members.count())
    texts = keyed.join(wanted, "key").filter(F.col("id").eqNullSafe(F.col("first_id")))
    full = texts.select("comp", "cid", "copies", "blocks", shingles("text").alias("shingles"))
    if not texts.groupBy("cid").agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty():
        # Rows repeated in full give the same class twice; one is enough.
        full = full.dropDuplicates(["cid"])
    verified = cut_lineage(in_blocks(full, "comp", F.col("blocks"), ["copies", "shingles"]).select("members").mapInArrow(
        verify, "cid long, root long, links long"))
    named = verified.join(hinted(members.select("cid", "blocks"), members.count()), "cid")
    single = named.filter("blocks = 1").select(F.col("cid").alias("node"), "root")
    several = named.filter("blocks > 1")
    roots = single
    if not several.isEmpty():
        roots = single.union(components(several.select(F.col("cid").alias("u"), F.col("root").alias("v"))))
    counts = verified.groupBy("cid").agg(F.sum("links").alias("links"))
    narrow = classes.select("cid", "key", "copies", "first_id")
    whole = cut_lineage(
        narrow.join(roots.withColumnRenamed("node", "cid"), "cid", "left").join(counts, "cid", "left").select(
            "key", "copies", "first_id", F.coalesce("root", "cid").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    heads = cut_lineage(whole.groupBy("root").agg(F.min(F.struct(
        F.col("first_id").isNull().alias("none"), "first_id", "key")).alias("head")))
    return whole.join(heads, "root").select(
        "key", "copies", "first_id", F.col("head.first_id").alias("class_id"), "links",
        (F.col("head.key") == F.col("key")).alias("chosen"),
    )


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, class_id and links of every document."""
    classes = cut_lineage(similar(docs, text, doc_id))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("key"))
    out = rows.join(classes.select("key", "class_id", "links"), "key", "left")
    return out.select(
        "doc_id", F.when(F.col("links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class is kept: the one with
    the smallest id.  Documents without a word all stay."""
    classes = cut_lineage(similar(docs, text, doc_id))
    kin = cut_lineage(classes.filter((F.col("copies") > 1) | ~F.col("chosen")).select("key", "first_id", "chosen"))
    rows = docs.select(whole_row(docs), text_key(F.col(f"`{text}`")).alias("key"), F.col(f"`{doc_id}`").alias("id"))
    marked = rows.join(hinted(kin, kin.count()), "key", "left")
    alone = marked.filter(F.col("chosen").isNull())
    heads = marked.filter(F.col("chosen") & F.col("id").eqNullSafe(F.col("first_id"))).dropDuplicates(["key"])
    return alone.union(heads).select("row.*")
