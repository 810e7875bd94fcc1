"""Language identification by multilingual mixture inference.

Training counts character trigrams (hashed into a fixed number of buckets) of every labelled
text per language; the model is the smoothed log-likelihood of each bucket under each
language.  A document is a mixture: each of its words is drawn from one language with the
likelihood of its trigrams.  Expectation-maximisation estimates the proportions, and the set
of languages is grown one at a time as long as the likelihood gains more than a penalty
(half the logarithm of the number of words, times ``penalty``, for each further language).

The model is a matrix of ``buckets`` columns and one row per language; its size is bounded by
MAX_CELLS, whatever the corpus, so it may pass through the driver and be broadcast.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text when there is no labelled text with a letter; ties go to the language whose name sorts
first; texts are used whole, in pieces of bounded size; repeated rows count as often as they
are there; an empty table gives an empty result; input columns may have any names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from knotwork.llm.common import whole_row

BUCKETS = 1 << 15
MAX_CELLS = 1 << 22
SMOOTHING = 0.5
EM_STEPS, PENALTY = 25, 4.0
PIECE = 1 << 18
UNDETERMINED = "und"

MIXTURE = StructType([
    StructField("lang", StringType()), StructField("score", DoubleType()),
    StructField("langs", ArrayType(StringType())), StructField("shares", ArrayType(DoubleType())),
])


@functools.lru_cache(maxsize=1)
def _letters():
    import numpy as np

    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of bounded size, cut at white space where there is some."""
    start = 0
    while len(text) - start > PIECE:
        cut = max(text.rfind(" ", start + PIECE // 2, start + PIECE), text.rfind("\n", start + PIECE // 2, start + PIECE))
        cut = cut if cut > start else start + PIECE
        yield text[start:cut]
        start = cut
    yield text[start:]


def trigrams(text: str, buckets: int):
    """(bucket of the trigram around each letter, index at which each word starts in them)."""
    import numpy as np

    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letter = _letters()[codes] if len(codes) else np.zeros(0, bool)
    codes = np.where(letter, codes, 0)
    padded = np.concatenate([np.zeros(1, np.uint64), codes, np.zeros(1, np.uint64)])
    mixed = (padded[:-2] << np.uint64(42)) ^ (padded[1:-1] << np.uint64(21)) ^ padded[2:]
    mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero(letter)
    starts = np.flatnonzero(np.append(True, np.diff(at) > 1)) if len(at) else at
    return ((mixed[at] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), starts


def count(rows: DataFrame, languages: list[str], buckets: int) -> DataFrame:
    """(lang index, bucket, n): trigrams of (lang, text); one row per pair and task before the shuffle."""

    def partial(batches):
        import numpy as np

        counts = np.zeros((len(languages), buckets), np.int64)
        index = {lang: i for i, lang in enumerate(languages)}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang in index:
                    for piece in pieces(text.as_py()):
                        counts[index[lang]] += np.bincount(trigrams(piece, buckets)[0], minlength=buckets)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (lang, bucket, counts[lang, bucket])], ["lang", "bucket", "n"])

    parts = rows.mapInArrow(partial, "lang long, bucket long, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, max_cells: int = MAX_CELLS):
    """(languages, log-likelihoods) from (lang, text) rows; nulls are left out."""
    import numpy as np

    rows = rows.toDF("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    # Language codes: one short row each, checked before the model is laid out.
    languages = sorted(r.lang for r in rows.select("lang").distinct().limit(max_cells // 256 + 1).collect())
    if len(languages) * 256 > max_cells:
        raise ValueError("too many languages for a bounded model")
    buckets = BUCKETS
    while len(languages) * buckets > max_cells:
        buckets //= 2
    counts = np.zeros((len(languages), buckets))
    if languages:
        for r in count(rows, languages, buckets).toPandas().itertuples():
            counts[r.lang, r.bucket] = r.n
    known = counts.sum(axis=1) > 0
    languages = [lang for lang, k in zip(languages, known) if k]
    smooth = counts[known] + SMOOTHING
    return languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)


def _proportions(likelihood, active):
    """EM over the ``active`` columns: (proportions, log-likelihood)."""
    import numpy as np

    part = likelihood[:, active]
    share = np.full(len(active), 1 / len(active))
    total = -np.inf
    for _ in range(EM_STEPS):
        joint = part * share
        norm = joint.sum(axis=1)
        before, total = total, np.log(norm).sum()
        share = (joint / norm[:, None]).mean(axis=0)
        if total - before < 1e-6 * abs(total):
            break
    return share, total


def infer(words, penalty: float = PENALTY) -> tuple[list[int], list[float]]:
    """Languages and proportions of a document from its words' log-likelihoods, largest first."""
    import numpy as np

    shifted = words - words.max(axis=1, keepdims=True)
    likelihood = np.exp(np.maximum(shifted, -60))
    sums = shifted.sum(axis=0, dtype=np.float64)
    active, share = [int(np.argmax(sums))], np.ones(1)
    total = np.log(likelihood[:, active[0]]).sum()
    cost = penalty * 0.5 * np.log(len(words) + 1)
    while len(active) < words.shape[1]:
        # The language that explains best what the present set explains worst.
        mixed = likelihood[:, active] @ share
        gains = np.log1p(likelihood / mixed[:, None]).sum(axis=0)
        gains[active] = -np.inf
        grown = [*active, int(np.argmax(gains))]
        new_share, new_total = _proportions(likelihood, grown)
        if new_total - total <= cost:
            break
        active, share, total = grown, new_share, new_total
    order = sorted(range(len(active)), key=lambda i: (-share[i], active[i]))
    return [active[i] for i in order], [float(share[i]) for i in order]


def word_likelihoods(text: str, model):
    """One row of log-likelihoods per word."""
    import numpy as np

    out = []
    for piece in pieces(text):
        grams, starts = trigrams(piece, len(model))
        if len(grams):
            out.append(np.add.reduceat(model[grams], starts, axis=0))
    return np.concatenate(out) if out else None


def predict(docs: DataFrame, languages: list[str], model, text: str = "text") -> DataFrame:
    """Each input row as ``row`` with ``mixture``: lang, score and the languages with their shares."""
    shared = docs.sparkSession.sparkContext.broadcast((languages, model))

    @F.arrow_udf(MIXTURE)
    def mixture(texts: pa.Array) -> pa.Array:
        names, table = shared.value
        rows = []
        for value in texts:
            words = word_likelihoods(value.as_py() or "", table) if names else None
            if words is None:
                rows.append((UNDETERMINED, 0.0, [], []))
            else:
                found, shares = infer(words)
                rows.append((names[found[0]], min(1.0, shares[0]), [names[i] for i in found], shares))
        kinds = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())]
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], MIXTURE.names)

    return docs.select(whole_row(docs), mixture(F.col(f"`{text}`")).alias("mixture"))


def fold(doc_id: Column, folds: int = 5) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``folds``; null ids have none."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
