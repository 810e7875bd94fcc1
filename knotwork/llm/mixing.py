"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of times the mix takes it on average.  Among all
rates between 0 and ``cap`` that give each source its target number of words, the ones
nearest to 1 in relative entropy are exponentially tilted: ``min(cap, exp(l * x))`` with
one multiplier ``l`` per source and ``x`` the document's size over the mean of its source.
The multipliers solve the convex dual; each Newton step is one aggregation over the
counted (source, size) pairs, kept inside a bracket so that flat parts cannot throw it off.
Rates are then rounded to whole copies: a hash of the row decides which documents get the
fractional copy, and its cut-off is searched per source so that the words taken end within
half a document of the target.

Defined cases: a null text has 0 words; a null source is a source of its own and comes
last; documents without words are taken once; an empty table gives an empty result; rows
equal in all of ``identity`` columns get the same number of copies; input columns may have
any names (they come back inside ``row``).

Sums are taken over integers and decimals, so reruns agree whatever the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from knotwork.llm.common import hinted, whole_row, word_count
from knotwork.session import cut_lineage

DIGIT_BITS, DIGITS = 12, 3
TOLERANCE, MAX_STEPS = 1e-7, 60
EXACT = "decimal(38,9)"


def source_key(source: Column) -> Column:
    """A never-null key in code point order, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def ordered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``position`` from 0 in the order of ``skey``, without one task that sorts all."""
    parts = cut_lineage(
        sources.repartitionByRange("skey").sortWithinPartitions("skey").select(
            "*",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at"),
        )
    )
    # One row for each partition of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    return parts.join(offsets, "part").withColumn("position", F.col("offset") + F.col("at")).drop("part", "at", "offset")


def targets(sources: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """``sources`` (skey, words) with ``target``: all words shared by weight, none above ``cap``
    times its own words, what is above shared again."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    weighted = cut_lineage(ordered(sources).withColumn("weight", weight.cast("long")))
    total, all_weights = weighted.agg(F.sum("words"), F.sum("weight")).first()
    level, full = (total / all_weights if all_weights else 0.0), -1
    while True:
        over = F.col("weight") * F.lit(level) >= F.col("words") * F.lit(cap)
        capped, taken, rest = weighted.agg(
            F.count_if(over), F.sum(F.when(over, F.col("words"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if capped == full or not rest:
            break
        level, full = (total - cap * (taken or 0)) / rest, capped
    share, most = F.col("weight") * F.lit(float(level)), F.col("words") * F.lit(float(cap))
    return weighted.select("skey", "words", "documents", F.least(share, most).alias("target"), (share >= most).alias("capped"))


def _tilt(cap: float) -> tuple[Column, Column, Column]:
    """x, the unbounded rate and the rate of a size under its source's multiplier."""
    x = F.col("size") / F.col("mean")
    free = F.exp(F.col("tilt") * x)
    return x, free, F.when(F.col("capped") | (free >= cap), F.lit(float(cap))).otherwise(free)


def multipliers(sizes: DataFrame, sources: DataFrame, many: int, cap: float) -> DataFrame:
    """Solve the dual: ``sources`` with ``mean`` size and multiplier ``tilt``.

    ``sizes`` holds (skey, size, n); ``many`` is the number of sources.
    """
    state = sources.select(
        "*",
        (F.col("words") / F.greatest(F.col("documents"), F.lit(1))).alias("mean"),
        F.lit(0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        (F.col("capped") | (F.col("words") == 0)).alias("done"),
    )
    state = cut_lineage(state)
    for _ in range(MAX_STEPS):
        if state.filter(~F.col("done")).isEmpty():
            break
        open_, rest = state.filter(~F.col("done")), state.filter("done")
        x, free, rate = _tilt(cap)
        joined = sizes.join(hinted(open_, many), "skey")
        mass = F.col("n") * F.col("size")
        sums = joined.groupBy(*open_.columns).agg(
            F.sum((mass * rate).cast(EXACT)).cast("double").alias("f"),
            F.sum(F.when(free < cap, mass * x * free).otherwise(0.0).cast(EXACT)).cast("double").alias("slope"),
        )
        low = F.when(F.col("f") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("f") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        # Newton on the logarithm of the words taken, which is nearly straight.
        newton = F.col("tilt") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("slope")
        inside = (F.col("f") > 0) & (F.col("slope") > 0) & (newton > F.coalesce("low_", F.lit(float("-inf")))) & (
            newton < F.coalesce("high_", F.lit(float("inf"))))
        outward = F.when(F.col("f") < F.col("target"), 2 * F.abs("tilt") + 1).otherwise(-2 * F.abs("tilt") - 1)
        halved = F.coalesce((F.col("low_") + F.col("high_")) / 2, outward)
        near = F.abs(F.col("f") - F.col("target")) <= F.lit(TOLERANCE) * F.col("target")
        stepped = sums.withColumns({"low_": low, "high_": high}).select(
            *sources.columns, "mean",
            F.when(near, F.col("tilt")).otherwise(F.when(inside, newton).otherwise(halved)).alias("tilt"),
            F.col("low_").alias("low"), F.col("high_").alias("high"), near.alias("done"),
        )
        state = cut_lineage(rest.union(stepped))
    return state.drop("low", "high", "done")


def cutoffs(rated: DataFrame, solved: DataFrame, many: int) -> DataFrame:
    """``solved`` with ``cut``: documents whose ``place`` is at most that get the extra copy.

    The place of the document at which the words taken reach the target is found digit by
    digit: each pass sums the words of one digit's values, at most 4096 for a source.
    """
    needed = rated.groupBy("skey").agg(
        F.sum(F.floor("rate") * F.col("size")).alias("base"),
        F.coalesce(F.sum(F.when(F.col("place").isNotNull(), F.col("size"))), F.lit(0)).alias("extra"),
    )
    state = cut_lineage(solved.join(needed, "skey").select(
        "skey", (F.col("target") - F.col("base")).alias("lack"), F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("before"), F.col("extra").alias("here"),
    ))
    for digit in range(DIGITS):
        shift = DIGIT_BITS * (DIGITS - 1 - digit)
        value = F.shiftright("place", shift)
        sums = (
            rated.filter(F.col("place").isNotNull()).join(hinted(state, many), "skey")
            .filter(F.shiftright(value, DIGIT_BITS) == F.col("prefix"))
            .groupBy("skey", "lack", "before", value.alias("value")).agg(F.sum("size").alias("here"))
        )
        upto = Window.partitionBy("skey").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        running = sums.withColumn("end", F.col("before") + F.sum("here").over(upto))
        # The first value that reaches what is lacking; the last one when none does.
        pick = F.when(F.col("end") >= F.col("lack"), F.col("value")).otherwise(F.lit(1 << 40) + F.col("value"))
        reached = running.groupBy("skey", "lack").agg(
            F.min_by(F.struct("value", (F.col("end") - F.col("here")).alias("before"), "here"), pick).alias("first"),
            F.max_by(F.struct("value", (F.col("end") - F.col("here")).alias("before"), "here"), "value").alias("last"),
            F.max("end").alias("most"),
        )
        chosen = F.when(F.col("most") >= F.col("lack"), F.col("first")).otherwise(F.col("last"))
        state = cut_lineage(reached.select(
            "skey", "lack", chosen["value"].alias("prefix"), chosen["before"].alias("before"), chosen["here"].alias("here")
        ))
    nearer = F.abs(F.col("before") + F.col("here") - F.col("lack")) <= F.abs(F.col("lack") - F.col("before"))
    cuts = state.select("skey", (F.col("prefix") - F.when(nearer, 0).otherwise(1)).alias("cut"))
    return cut_lineage(solved.join(cuts, "skey", "left").withColumn("cut", F.coalesce("cut", F.lit(-1).cast("long"))))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", identity: tuple[str, ...] = ("doc_id", "text"),
    weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0,
) -> DataFrame:
    """Each input row as ``row`` with size, source_size, target, rate, copies and taken."""
    place_bits = DIGIT_BITS * DIGITS
    uniform = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in identity]), 64 - place_bits)
    sized = docs.select(
        whole_row(docs), source_key(F.col(f"`{source}`")).alias("skey"),
        word_count(F.col(f"`{text}`")).alias("size"), uniform.alias("uniform"),
    )
    narrow = cut_lineage(sized.select("skey", "size", "uniform"))
    sizes = cut_lineage(narrow.groupBy("skey", "size").agg(F.count("*").alias("n")))
    sources = sizes.groupBy("skey").agg(
        F.sum(F.col("size") * F.col("n")).alias("words"),
        F.coalesce(F.sum(F.when(F.col("size") > 0, F.col("n"))), F.lit(0)).alias("documents"),
    )
    sources = targets(sources, weights, cap)
    many = sources.count()
    solved = multipliers(sizes, sources, many, cap)

    def rated(rows: DataFrame, known: DataFrame) -> DataFrame:
        joined = rows.join(hinted(known, many), "skey")
        _, _, rate = _tilt(cap)
        joined = joined.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate))
        part = F.col("rate") - F.floor("rate")
        # Uniform minus the fraction, so that a cut-off in the middle takes each fraction's share.
        shifted = (F.col("uniform") + F.floor((1 - part) * (1 << place_bits))) / 2
        return joined.withColumn("place", F.when((F.col("size") > 0) & (part > 0), shifted.cast("long")))

    known = cutoffs(rated(narrow, solved), solved, many)
    out = rated(sized, known)
    copies = (F.floor("rate") + F.when(F.col("place") <= F.col("cut"), 1).otherwise(0)).cast("long")
    return out.select(
        "row", "size", F.col("words").alias("source_size"), "target", "rate", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
