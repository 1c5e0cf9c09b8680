"""Quality by importance resampling.

Two generative models over hashed word and word-pair buckets, one of target
text (labelled good) and one of all raw text, give each document the logarithm
of its importance weight, log p_target - log p_raw over its n-grams.  Documents
are then drawn without replacement with these weights by Gumbel top-k: the k
greatest sums of a log weight and a Gumbel noise that depends on the document's
id alone.

The raw model counts every n-gram of every document, in a number of buckets
that grows with the number of documents, as its fourth root (2^16 to 2^21).  The target model is
fitted on half of at most ``max_labelled`` labelled documents (those with the
smallest hashes of their ids).  Good are those labelled as of quality and not
toxic, for the model and for the cut; all others are bad.

Tempering: the plain sum over n-grams grows with a text's length, so the mean
per n-gram is taken (with ``shrink`` n-grams of weight 0 added, and the target's
own mean taken off) and scaled so that the good documents of the other half
spread by ``sharpness`` standard units.  Their weights then differ by a few
units, beside a Gumbel noise that spreads by 1.3: among neighbours the draw
decides.  ``k`` is how many documents are drawn; where it is not given, as many
as score at least the cut that best separates the labelled documents.

A few toxic words hardly move the mean of a long text, so toxic documents are
told apart by a filter of its own, before the draw and outside the weight:
n-grams that tell toxic text, in 2^31 buckets.  Telling is an n-gram of toxic
labelled documents (of the half that fits) whose holders are toxic ``loss`` to
one and whose excess is beyond chance (likelihood ratio test, ``certain``).  Its
log-ratio counts whole at each occurrence, however long the text: their sum is
the column toxic_evidence.  Documents whose evidence is above the limit that
best separates the toxic from the good ones of the other half are not drawn.
Without toxic labels nothing is telling.

Texts are tokenised twice (those of the labelled half three times), once to count and once to score; the scored rows are
written to the shared folder.

Defined results: a null or empty text has no n-grams and weight 0; documents
without id share the noise of a null id; rows that tie with the k-th (repeated
rows) are all drawn; without labels of both kinds everything is, unless k is
given; an empty table gives an empty result; further columns are kept, but
log_weight, toxic_evidence and gumbel_key are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trackforge.llm.common import in_batches, mixed, pieces, span_hashes, utf8, written

#: 0 blank, 1 word (letters, digits, all non-ASCII), 2 other marks; marks in a row are one token.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[:33] = 0
_TWICE = 0xD1B54A32D192ED03
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = 1


def ngram_buckets(texts: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of each word and word pair, a part of the column at a time."""
    data, offsets = utf8(texts)
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True
    last_hash, last_row = np.zeros(1, np.uint64), -1
    shift = np.uint64(64 - bits)
    for at, end in pieces(data, offsets, _CLASS == 0):
        part = data[at:end]
        kind = _CLASS[part]
        change = np.ones(len(part) + 1, bool)
        change[1:-1] = (kind[1:] != kind[:-1]) | begins[at + 1 : end]
        edges = np.flatnonzero(change)
        starts, ends = edges[:-1], edges[1:]
        words = kind[starts] > 0
        starts, ends = starts[words], ends[words]
        if not len(starts):
            continue
        h = span_hashes(part, starts, ends)
        row = np.searchsorted(offsets, at + starts, "right") - 1
        before = np.concatenate([last_hash, h[:-1]])
        pair = np.concatenate([[last_row], row[:-1]]) == row
        # a word and itself again are one and the same pair, whatever the word
        pairs = np.where(before == h, np.uint64(_TWICE), mixed(before * np.uint64(3) + h))[pair]
        yield np.concatenate([row, row[pair]]), (np.concatenate([h, pairs]) >> shift).astype(np.int64)
        last_hash, last_row = h[-1:], row[-1]


def ngram_counts(documents: DataFrame, is_target: Column, bits: int) -> DataFrame:
    """bucket, raw, target: counts over all documents and over those that are target."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for b in batches:
            good = b.column("good").to_numpy(zero_copy_only=False).astype(bool)
            for row, bucket in ngram_buckets(b.column("text"), bits):
                raw += np.bincount(bucket, minlength=1 << bits)
                target += np.bincount(bucket[good[row]], minlength=1 << bits)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    each = in_batches(documents.select("text", F.coalesce(is_target, F.lit(False)).alias("good"))).mapInArrow(work, "bucket int, raw long, target long")
    return each.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, bits: int, smoothing: float = 2.0) -> np.ndarray:
    """Centred log p_target - log p_raw per bucket; the table has 2^bits rows at most, whatever the input."""
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    found = counts.toArrow()
    at = found.column("bucket").to_numpy()
    raw[at], target[at] = found.column("raw").to_numpy(), found.column("target").to_numpy()
    if not target.sum():
        return np.zeros(1 << bits, np.float32)
    # the target is smoothed towards the raw text, so that a bucket it has not seen says little unless it is common
    share = raw / raw.sum()
    strength = smoothing * np.count_nonzero(raw)
    p = (target + strength * share) / (target.sum() + strength)
    ratio = np.where(raw > 0, np.log(np.maximum(p, 1e-300) / np.maximum(share, 1e-300)), 0.0)
    return (ratio - (p * ratio).sum()).astype(np.float32)


#: Columns that ``resample`` adds, in place of any of these names.
ADDED = ("log_weight", "toxic_evidence", "gumbel_key")

#: Bits of the buckets in which telling n-grams are told apart.
FINE_BITS = 31


def telling_ngrams(marked: DataFrame, loss: float, certain: float, smoothing: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fine buckets of n-grams that tell toxic documents, and their log-ratios; from the labelled half that fits alone."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, 64) for whole in batches for at in range(0, whole.num_rows, 64)):
            toxic = b.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            held = [np.unique(row.astype(np.int64) << FINE_BITS | bucket) for row, bucket in ngram_buckets(b.column("text"), FINE_BITS)]
            each = np.unique(np.concatenate(held)) if held else np.zeros(0, np.int64)
            bucket, at = np.unique(each & ((1 << FINE_BITS) - 1), return_inverse=True)
            of_toxic = np.bincount(at, toxic[each >> FINE_BITS], len(bucket)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(of_toxic), pa.array(np.bincount(at, minlength=len(bucket)))], names=["bucket", "a", "n"])

    fitting = marked.filter("fits").select("text", (F.col("toxic") > 0).alias("toxic"))
    sizes = fitting.agg(F.count_if("toxic"), F.count("*")).first()
    A, B = sizes[0], sizes[1] - sizes[0]
    if not A or not B:
        return np.zeros(0, np.int64), np.zeros(0)
    counted = in_batches(fitting).mapInArrow(work, "bucket int, a long, n long").groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    term = lambda x, of: F.when(x > 0, x * F.log(x * (A + B) / (F.col("n") * of))).otherwise(0.0)
    # every telling n-gram stands in several of the toxic documents of the bounded sample, which bounds their number
    found = counted.filter((a >= loss * (b + 1)) & (a * B > b * A) & (2 * (term(a, A) + term(b, B)) >= certain)).orderBy("bucket").toArrow()
    at, a, n = (found.column(c).to_numpy() for c in ("bucket", "a", "n"))
    share = smoothing * n / (A + B)
    return at.astype(np.int64), np.log((a + share) / (A + smoothing)) - np.log((n - a + share) / (B + smoothing))


def score(documents: DataFrame, ratios: np.ndarray, shrink: int, telling: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Every row with its log_weight, not tempered yet, and its toxic_evidence; no shuffle."""
    bits = int(len(ratios)).bit_length() - 1
    source = documents.drop(*ADDED)
    model = source.sparkSession.sparkContext.broadcast((ratios, *telling))  # 2^21 ratios at most, and telling n-grams of the labelled sample

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, fine, strengths = model.value
        may_tell = np.zeros(len(ratios), bool)
        may_tell[fine >> (FINE_BITS - bits)] = True
        for b in batches:
            total, n, evidence = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for row, exact in ngram_buckets(b.column("text"), FINE_BITS):
                bucket = exact >> (FINE_BITS - bits)
                total += np.bincount(row, ratios[bucket], b.num_rows)
                n += np.bincount(row, minlength=b.num_rows)
                some = np.flatnonzero(may_tell[bucket])
                if len(some):
                    at = np.minimum(np.searchsorted(fine, exact[some]), len(fine) - 1)
                    evidence += np.bincount(row[some], np.where(fine[at] == exact[some], strengths[at], 0.0), b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(total / (n + shrink)), pa.array(evidence)], names=[*b.schema.names, "log_weight", "toxic_evidence"])

    added = [T.StructField(name, T.DoubleType()) for name in ("log_weight", "toxic_evidence")]
    return in_batches(source).mapInArrow(work, T.StructType([*source.schema.fields, *added]))


def gumbel(seed: int) -> Column:
    """Noise of the standard Gumbel distribution, a function of the document's id."""
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def best_cut(good: np.ndarray, bad: np.ndarray, loss: float) -> float:
    """The score below which the least is lost, a good document counting ``loss`` times a bad one; halfway in its gap."""
    if not len(good) or not len(bad):
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.unique(np.concatenate([good, bad, [max(good[-1], bad[-1]) + 1]]))
    cost = loss * np.searchsorted(good, cuts) + len(bad) - np.searchsorted(bad, cuts)
    at = int(np.argmin(cost))
    return float(cuts[at]) if at == 0 else float(cuts[at] + cuts[at - 1]) / 2


def kth_largest(df: DataFrame, key: str, k: int, enough: int = 100_000) -> float | None:
    """The k-th largest value of a column, ties counted; null if there are fewer.

    Two pivots from a quantile sketch, a little above and below, narrow the range
    until few rows are left to sort.  A pivot never stays in the range, so rows
    of equal values, however many, are settled by counting.
    """
    c, inside, rank = F.col(key), df.select(key), k
    while (n := inside.count()) > enough:
        q = 1 - rank / n
        low, high = inside.agg(F.percentile_approx(key, [max(0.0, q - 0.001), min(1.0, q + 0.001)], 10_000)).first()[0]
        above, at_high, between, at_low = inside.agg(F.count_if(c > high), F.count_if(c == high), F.count_if((c < high) & (c > low)), F.count_if((c == low) & (c < high))).first()
        for count, settled in ((above, c > high), (at_high, high), (between, (c < high) & (c > low)), (at_low, low), (n, c < low)):
            if rank <= count:
                if isinstance(settled, float):
                    return settled
                inside = inside.filter(settled)
                break
            rank -= count
        else:
            return None
    rows = inside.groupBy(key).count().orderBy(F.desc(key)).collect()  # ``enough`` at most
    for r in rows:
        rank -= r["count"]
        if rank <= 0:
            return r[key]
    return None


def buckets_for(rows: int) -> int:
    """Bits of the bucket number: it doubles whenever the documents grow sixteenfold, as every task sends a count of each bucket."""
    return min(21, 16 + max(0, rows.bit_length() - 16) // 4)


def resample(
    documents: DataFrame, labels: DataFrame, k: int | None = None, max_labelled: int = 20_000, smoothing: float = 2.0, sharpness: float = 4.0, shrink: int = 20, loss: float = 5.0, certain: float = 24.0, seed: int = 17
) -> DataFrame:
    """The documents drawn, with log_weight, toxic_evidence and gumbel_key; ``loss`` is what a good document below the cut costs, a bad one above it costing 1."""
    bits = buckets_for(documents.count())
    text = documents.withColumn("text", F.col("text").cast("string"))
    labelled = F.broadcast(  # max_labelled rows at most
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"))
        .limit(max_labelled)
        .withColumn("fits", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(2)) == 0)
    )
    marked = text.select("doc_id", "text").join(labelled, "doc_id", "left")
    ratios = log_ratios(ngram_counts(marked, F.expr("fits AND quality = 1 AND toxic = 0"), bits), bits, smoothing)
    scored = written(score(text, ratios, shrink, telling_ngrams(marked, loss, certain, smoothing)))
    is_good = (F.max("quality") == 1) & (F.max("toxic") == 0)
    held = scored.select("doc_id", "log_weight", "toxic_evidence").join(labelled.filter("NOT fits"), "doc_id").groupBy("doc_id")
    held = held.agg(is_good.alias("good"), (F.max("toxic") > 0).alias("is_toxic"), F.min("log_weight").alias("log_weight"), F.max("toxic_evidence").alias("toxic_evidence")).toArrow()
    which, scores, evidence = held.column("good").to_numpy().astype(bool), held.column("log_weight").to_numpy(), held.column("toxic_evidence").to_numpy()
    toxic = held.column("is_toxic").to_numpy().astype(bool)
    allowed = -best_cut(-evidence[which], -evidence[toxic], loss)
    spread = float(scores[which].std()) if which.sum() > 1 else 0.0
    unit = spread / sharpness if spread > 0 else 1.0
    scores, stays = scores / unit, evidence <= allowed
    weighed = scored.filter(F.col("toxic_evidence") <= allowed).withColumn("log_weight", F.col("log_weight") / unit).withColumn("gumbel_key", F.col("log_weight") + gumbel(seed))
    if k is None:
        k = weighed.filter(F.col("log_weight") >= best_cut(scores[which & stays], scores[~which & stays], loss)).count()
    least = kth_largest(weighed, "gumbel_key", k) if k else float("inf")
    return weighed if least is None else weighed.filter(F.col("gumbel_key") >= least)
