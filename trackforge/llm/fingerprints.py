"""Fingerprints of improbable features in chained Bloom filters.

Every window of ``WINDOW`` bytes of a text has an entropy, kept as a whole number
from 0 to 1000.  How often each of these values occurs over the whole corpus
ranks them: the rarer the entropy, the more telling the window.  Windows of very
low entropy (runs of one letter, rules of dashes) come last whatever their
frequency.  A window that is the best ranked of at least ``POPULAR`` of the
``AROUND`` neighbourhoods around it is a feature of the text, the leftmost of
equals.  Features go into Bloom filters of ``BITS`` bits by ``HASHES`` hashes, in
text order; the next filter of the chain begins after ``PER_FILTER`` different
ones, or after ``LEAST`` at one that its own hash marks, so that filters of two
texts fall into step again behind a passage that only one of them has.

The likeness of two fingerprints goes through the filters of the one with fewer
features: each counts with its best match in the other, the bits shared beyond
what chance gives (two standard deviations above its mean) over the most that
could be shared beyond it, weighted by its features.  It lies between 0 and 1, is the same in both directions and is 1 for
equal fingerprints.

Texts are fingerprinted with all their bytes, in pieces of a fixed size that see
as far as any window reaches, so memory beyond the text itself is bounded.

``next to one another``: bounds of ranges are found on ids and hashes alone; then
the texts are shuffled once, each to its range, and the first text of every range
is sent to the one before as well, so a row's next one always is in its own task.

Defined results: a null text is empty; an empty text has no features, is like
another empty one (1) and unlike all others (0); a text shorter than a window is
itself one feature; rows without doc_id come first; rows with equal doc_id follow
one another by a hash of their text; equal rows are worked out once, and put
together before the shuffle; a row alone is its own next; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackforge.llm.common import mixed, span_hashes, written

WINDOW = 12
AROUND = 12  # at most WINDOW, so that neighbourhoods never reach into another text
POPULAR = 5
LOW = 300  # entropies below are never telling
BITS, HASHES, PER_FILTER = 2048, 5, 160
LEAST, MARKED = 40, 64  # a filter of that many features ends with the next whose hash that number divides
PIECE = 1 << 18
ENTROPIES = 1001

_UNIT = 1 << 20
_C_LOG_C = np.array([0, *[round(_UNIT * c * np.log2(c)) for c in range(1, WINDOW + 1)]], np.int64)
_STEP = np.diff(_C_LOG_C).astype(np.int32)  # what the sum gains when a byte that occurs c times occurs once more
_FULL = int(_C_LOG_C[WINDOW])


def entropies(data: np.ndarray) -> np.ndarray:
    """The entropy, from 0 to 1000, of every whole window of the bytes; it depends on nothing but the window."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)  # equal bytes within reach
    for d in range(1, WINDOW):
        equal = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += equal
        after[:-d] += equal
    total = int(_C_LOG_C[np.bincount(data[:WINDOW])].sum())
    sums = np.empty(n, np.int64)
    sums[0] = total
    np.cumsum(_STEP[before[WINDOW:]] - _STEP[after[: n - 1]], out=sums[1:])
    sums[1:] += total
    return (1000 * (_FULL - sums) // _FULL).astype(np.int32)


def _whole(offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which windows beginning at a to b - 1 lie in one text."""
    row = np.searchsorted(offsets, np.arange(a, b), "right")
    return np.arange(a, b) + WINDOW <= offsets[np.minimum(row, len(offsets) - 1)]


def histogram(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often every entropy occurs among the windows of the texts."""
    out = np.zeros(ENTROPIES, np.int64)
    n = len(data) - WINDOW + 1
    for a in range(0, max(n, 0), PIECE):
        b = min(a + PIECE, n)
        out += np.bincount(entropies(data[a : b + WINDOW - 1])[_whole(offsets, a, b)], minlength=ENTROPIES)
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """Of every entropy its rank: the rarer the lower, low entropies last; ties: the higher entropy first."""
    values = np.arange(ENTROPIES)
    order = np.lexsort((-values, counts, values < LOW))
    out = np.empty(ENTROPIES, np.int64)
    out[order] = values
    return out


_PLACE_BITS = 24
_NONE = np.int64(1 << 50)


def popular(rank: np.ndarray) -> np.ndarray:
    """For positions AROUND - 1 and more from both ends: of how many neighbourhoods of AROUND windows each is the best, the leftmost of equals.  Negative ranks take no part."""
    n = len(rank)
    keys = np.where(rank >= 0, (rank << _PLACE_BITS) + np.arange(n), _NONE)
    keys = np.concatenate([keys, np.full(-n % AROUND + AROUND, _NONE)])
    blocks = keys.reshape(-1, AROUND)
    to_end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    from_start = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    best = np.minimum(to_end[: n - AROUND + 1], from_start[AROUND - 1 : n])
    best = best[best < _NONE] & ((1 << _PLACE_BITS) - 1)
    return np.bincount(best, minlength=n)


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the features of all texts, in text order; ``offsets`` says where each text starts and the last ends."""
    n, pad = len(data), AROUND - 1
    places = []
    for a in range(0, n, PIECE):
        b = min(a + PIECE, n)
        low, high = max(a - pad, 0), min(b + pad, n)
        reach = data[low : min(high + WINDOW - 1, n)]
        own = rank[entropies(reach)]
        own = np.where(_whole(offsets, low, low + len(own)), own, -1)
        line = np.full(b - a + 2 * pad, -1, np.int64)  # windows from a - pad on
        first = low - (a - pad)
        own = own[: len(line) - first]
        line[first : first + len(own)] = own
        places.append(a + np.flatnonzero(popular(line)[pad : pad + b - a] >= POPULAR))
    starts = np.concatenate([np.zeros(0, np.int64), *places])
    ends = starts + WINDOW
    short = np.flatnonzero((np.diff(offsets) < WINDOW) & (np.diff(offsets) > 0))
    starts, ends = np.concatenate([starts, offsets[short]]), np.concatenate([ends, offsets[short + 1]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    hashes = np.concatenate([np.zeros(0, np.uint64), *[_hashes(data, starts[i : i + 65536], ends[i : i + 65536]) for i in range(0, len(starts), 65536)]])
    return np.searchsorted(offsets, starts, "right") - 1, hashes


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans, each on its own: what lies around does not matter."""
    lengths = ends - starts
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    own = data[np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])]
    return span_hashes(own, bounds[:-1], bounds[1:])


class Chain:
    """The Bloom filters of one text and how many features each holds."""

    def __init__(self, hashes: np.ndarray) -> None:
        _, first = np.unique(hashes, return_index=True)
        kept = hashes[np.sort(first)]
        marks, ends = np.flatnonzero(kept % np.uint64(MARKED) == 0) + 1, [0]
        while ends[-1] < len(kept):
            most = min(ends[-1] + PER_FILTER, len(kept))
            at = np.searchsorted(marks, ends[-1] + LEAST)
            ends.append(int(min(marks[at], most)) if at < len(marks) else most)
        self.counts = np.diff(ends)
        bits = np.zeros((len(self.counts), BITS), np.uint8)
        which = np.repeat(np.arange(len(self.counts)), self.counts)
        for i in range(HASHES):
            bits[which, (mixed(kept + np.uint64(i * 0x9E3779B97F4A7C15 & (2**64 - 1))) % np.uint64(BITS)).astype(np.int64)] = 1
        self.bits = np.packbits(bits, axis=1)

    def text(self) -> str:
        return f"{','.join(map(str, self.counts))}:{base64.b64encode(self.bits.tobytes()).decode()}"

    @staticmethod
    def parse(text: str) -> Chain:
        counts, bits = text.split(":")
        out = Chain.__new__(Chain)
        out.counts = np.array([int(c) for c in counts.split(",") if c], np.int64)
        out.bits = np.frombuffer(base64.b64decode(bits), np.uint8).reshape(-1, BITS // 8)
        return out


def likeness(a: Chain, b: Chain) -> float:
    """Normalised overlap of bits, from 0 to 1."""
    if not len(a.counts) or not len(b.counts):
        return float(len(a.counts) == len(b.counts))
    if (b.counts.sum(), b.bits.tobytes()) < (a.counts.sum(), a.bits.tobytes()):
        a, b = b, a
    other = np.unpackbits(b.bits, axis=1).astype(np.float32)
    other_bits = other.sum(axis=1)
    total = 0.0
    for at in range(0, len(a.bits), 64):
        own = np.unpackbits(a.bits[at : at + 64], axis=1).astype(np.float32)
        own_bits = own.sum(axis=1)
        best = np.zeros(len(own))
        for to in range(0, len(other), 4096):
            shared = own @ other[to : to + 4096].T
            chance = own_bits[:, None] * other_bits[None, to : to + 4096] / BITS
            most = np.minimum(own_bits[:, None], other_bits[None, to : to + 4096])
            beyond = np.minimum(chance + 2 * np.sqrt(chance * (1 - most / BITS)), most - 0.5)
            best = np.maximum(best, ((shared - beyond) / (most - beyond)).max(axis=1))
        total += float((np.minimum(best, 1) * a.counts[at : at + 64]).sum())
    return total / float(a.counts.sum())


def chains(texts: list[str], rank: np.ndarray) -> list[Chain]:
    """The fingerprints of texts."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)
    rows, hashes = features(np.frombuffer(b"".join(encoded), np.uint8), offsets, rank)
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
    return [Chain(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the one that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def corpus_ranks(documents: DataFrame, text_col: str = "text") -> np.ndarray:
    """The ranks of entropies over all windows of all texts (ENTROPIES counts reach the driver)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ENTROPIES, np.int64)
        for batch in batches:
            for texts in _parts(batch.column(0).fill_null("").to_pylist()):
                encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
                offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)
                counts += histogram(np.frombuffer(b"".join(encoded), np.uint8), offsets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENTROPIES)), pa.array(counts)], names=["entropy", "n"])

    found = documents.select(F.col(text_col).cast("string")).mapInArrow(work, "entropy long, n long").groupBy("entropy").agg(F.sum("n").alias("n"))
    counts = np.zeros(ENTROPIES, np.int64)
    for r in found.collect():
        counts[r["entropy"]] = r["n"]
    return ranks(counts)


def _parts(texts: list[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Texts a few at a time, a long one alone."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > chars:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)
DEALT_DDL = "doc_id long, text string, id long, h long, n long, range int, follows int"
DEALT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("range", pa.int32()), ("follows", pa.int32())])
_LEAST_ID = -(1 << 63)


def _compared(ids: list[int | None], counts: list[int], texts: list[str], following: list[str], rank: np.ndarray) -> pa.RecordBatch:
    """Result rows of texts and the ones that follow them; of a row that stands for several, all but one are followed by themselves."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    own_changed = {t: edited(t, t) for t, n in zip(texts, counts) if n > 1}
    place = {t: i for i, t in enumerate(dict.fromkeys([*texts, *following, *changed, *own_changed.values()]))}
    found = chains(list(place), rank)
    printed: dict[int, str] = {}

    def row(doc_id: int | None, text: str, after: str, new: str) -> tuple:
        a, b, c = place[text], place[new], place[after]
        for i in (a, b):
            if i not in printed:
                printed[i] = found[i].text()
        return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), printed[a], printed[b], likeness(found[a], found[b]), likeness(found[a], found[c])

    rows = []
    for doc_id, n, text, after, new in zip(ids, counts, texts, following, changed):
        rows.append(row(doc_id, text, after, new))
        rows += [row(doc_id, text, text, own_changed[text])] * (n - 1) if n > 1 else []
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


class Bounds:
    """Where the ranges of (id, hash) begin."""

    def __init__(self, keys: list[tuple[int, int]]) -> None:
        self.keys = sorted(set(keys))
        self.ids = np.array([k[0] for k in self.keys], np.int64)

    def range_of(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The last range that does not begin after each key."""
        low, high = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        for i in np.flatnonzero(low < high):  # the id is that of a bound: the hash decides
            high[i] = bisect.bisect_right(self.keys, (int(ids[i]), int(hashes[i])))
        return np.maximum(high - 1, 0)


def neighbours(documents: DataFrame, rank: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text", partition_rows: int = 1 << 14) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how like it is to this and to the next document.

    ``partition_rows`` says how many documents a task should have; it does not change the result.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rank = corpus_ranks(docs) if rank is None else rank
    order = F.coalesce("doc_id", F.lit(_LEAST_ID))
    keyed = docs.select("doc_id", "text", order.alias("id"), F.xxhash64("text").alias("h"))
    keys = written(keyed.select("id", "h"))
    rows = keys.count()
    n = max(1, -(-rows // partition_rows), min(spark.sparkContext.defaultParallelism, -(-rows // 256)))
    ranges = keys.repartitionByRange(n, "id", "h").groupBy(F.spark_partition_id()).agg(F.min(F.struct("id", "h")).alias("k"))
    bounds = Bounds([(r["k"]["id"], r["k"]["h"]) for r in ranges.collect()])  # one key a range
    if not bounds.keys:
        return spark.createDataFrame([], OUT)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("id").to_numpy(), batch.column("h").to_numpy()
            _, first, count = np.unique(np.stack([ids, hashes], axis=1), axis=0, return_index=True, return_counts=True)  # equal rows become one
            kept = batch.take(pa.array(first))
            at = bounds.range_of(ids[first], hashes[first]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(count, pa.int64()), pa.array(at), pa.array(np.zeros(len(at), np.int32))], names=DEALT.names)

    dealt = keyed.mapInArrow(deal, DEALT_DDL)
    # the first document of every range, once more, behind the last one of the range before
    before = [(k, h, (i - 1) % len(bounds.keys)) for i, (k, h) in enumerate(bounds.keys)]
    first = F.broadcast(spark.createDataFrame(before, "id long, h long, range int"))
    following = keyed.join(first, ["id", "h"]).dropDuplicates(["range"]).select("doc_id", "text", "id", "h", F.lit(0).cast("long").alias("n"), "range", F.lit(1).alias("follows"))
    placed = dealt.unionByName(following).repartitionById(len(bounds.keys), F.col("range")).sortWithinPartitions("range", "follows", "id", "h")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "text", "follows"))))
            at = 0
            for texts in _parts([r[2] for r in rows]):
                some = [*([held] if held else []), *rows[at : at + len(texts)]]
                at += len(texts)
                held = some[-1] if not some[-1][3] else None
                pairs = [(a, b) for a, b in zip(some, some[1:]) if not a[3]]
                if pairs:
                    yield _compared([a[0] for a, _ in pairs], [a[1] for a, _ in pairs], [a[2] for a, _ in pairs], [b[2] for _, b in pairs], rank)

    return placed.select("doc_id", "n", "text", "follows").mapInArrow(work, OUT)
