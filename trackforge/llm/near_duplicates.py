"""Near duplicates by an n-gram Jaccard self-join with a MinHash LSH forest.

A text is the set of its word 5-grams (words: runs of digits, letters and
non-ASCII characters, A-Z lower-cased; a text of fewer words is one n-gram of
all of them).  Texts of equal sets are one node, so copies cost nothing more.

Each tree of the forest gives a node a label of ``deepest`` MinHash values; the
labels of a tree, in order, are a prefix trie, and nodes below one prefix are
candidates.  Matching starts at whole labels.  Prefixes are shortened by one
value at a time until the recall measured on the data meets the target: about
``sampled`` documents, a bounded sample, are compared exactly with every
document while the labels are made, which tells for each true link of theirs
how similar it is and how long a prefix its ends share (``recalls``).  Where the
sample holds fewer than ``enough`` links near the threshold, links at the
threshold are taken to share prefixes as MinHash values do on average.

Nodes that candidates tie together form a group.  Within a group every pair of
nodes is compared exactly, in blocks: a task holds two blocks, counts their
links and gives each node the least node it is linked to; pairs are never
written out.  A group of more than one block whose candidates are loosely tied
(its prefixes hold less pairs than the group) is compared prefix by prefix
instead, each pair in the first tree that it meets in, so a chain of loose ties
costs what its prefixes hold.  Classes are the components of the exact links.

Result: one row per document with its class (least doc_id of the class) and
the number of other documents that it is linked to, copies included.

Defined results: texts without words (null, empty, only marks) are classes of
their own; a class whose documents have no ids has the null class; repeated
rows are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackforge.llm.common import checkpointed, fresh, in_batches, mixed, span_hashes, utf8
from trackforge.llm.components import components

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def shingle_sets(texts: pa.Array, n: int = 5, size: int = 1 << 18) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row, row by row."""
    data, offsets = utf8(texts)
    step = np.uint64(0x9FB21C651E98DF25)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        part, begins = _LOWER[data[offsets[row] : offsets[last]]], offsets[row : last + 1] - offsets[row]
        word = np.concatenate([[False], _WORD[part], [False]])
        edge = word[1:] != word[:-1]
        cut = begins[1:-1]
        inner = cut[word[cut] & word[cut + 1]] if len(part) else cut[:0]  # rows that meet without a gap
        starts = np.union1d(np.flatnonzero(edge & word[1:]), inner)
        ends = np.union1d(np.flatnonzero(edge & word[:-1]), inner)
        h = span_hashes(part, starts, ends)
        first = np.searchsorted(starts, begins)
        runs = max(len(h) - n + 1, 0)
        grams = np.zeros(runs, np.uint64)
        for i in range(n):
            grams = grams * step + h[i : i + runs]
        grams = mixed(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                x = np.zeros(1, np.uint64)
                for v in h[a:b]:
                    x = x * step + v
                yield mixed(x + np.uint64(b - a))
            else:
                yield grams[:0]
        row = last


def expected_recall(depth: int, trees: int, similarity: float) -> float:
    return 1 - (1 - similarity**depth) ** trees


def recalls(links: list[tuple[float, int, int]], trees: int, deepest: int, similarity: float, near: float, enough: int) -> list[float]:
    """The forest's recall at depths 0 to ``deepest``, from (similarity, longest shared prefix, how many) of the sample's links.

    Of the links near the threshold and of all, what the sample shows and what
    its similarities let expect, the least counts.
    """
    out = []
    for depth in range(deepest + 1):
        least = 1.0 if sum(n for j, _, n in links if j < similarity + near) >= enough else expected_recall(depth, trees, similarity)
        for some in (links, [x for x in links if x[0] < similarity + near]):
            if total := sum(n for _, _, n in some):
                seen = sum(n for _, shared, n in some if shared >= depth) / total
                expected = sum(n * expected_recall(depth, trees, j) for j, _, n in some) / total
                least = min(least, expected, seen)
        out.append(least)
    return out


def prefix_depth(recall_at: list[float], target: float) -> int:
    """Shorten the prefixes until the recall meets the target."""
    depth = len(recall_at) - 1
    while depth > 1 and recall_at[depth] < target:
        depth -= 1
    return depth


def labels_of(sets: list[np.ndarray], depth: int, trees: int, seed: int) -> np.ndarray:
    """(set, tree, depth): the MinHash values of each set's label in each tree; no set is empty."""
    r = np.random.default_rng(seed)
    factors = r.integers(0, 1 << 32, (trees, depth), np.uint32) | np.uint32(1)
    shifts = r.integers(0, 1 << 32, (trees, depth), np.uint32)
    out = np.zeros((len(sets), trees, depth), np.uint32)
    at = 0
    while at < len(sets):  # about 64k values at a time stay in the cache
        end, total = at + 1, len(sets[at])
        while end < len(sets) and total + len(sets[end]) <= 65536:
            total += len(sets[end])
            end += 1
        values = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        begins = np.concatenate([[0], np.cumsum([len(s) for s in sets[at : end - 1]])]).astype(np.int64)
        scratch = np.empty_like(values)
        for t in range(trees):
            for d in range(depth):
                np.multiply(values, factors[t, d], out=scratch)
                np.add(scratch, shifts[t, d], out=scratch)
                out[at:end, t, d] = np.minimum.reduceat(scratch, begins)
        at = end
    return out


class Sample:
    """A few texts that are compared with every other; ``links`` gives the exact links of a set to them."""

    def __init__(self, texts: list[str], depth: int, trees: int, n: int, seed: int) -> None:
        sets = {s.tobytes(): s for s in shingle_sets(pa.array(texts, pa.string()), n) if len(s)}
        self.sets = list(sets.values())
        self.labels = labels_of(self.sets, depth, trees, seed) if self.sets else None
        grams = np.concatenate([*self.sets, np.zeros(0, np.uint64)])
        order = np.argsort(grams, kind="stable")
        self.grams, self.owner = grams[order], np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])[order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)

    def links(self, one: np.ndarray, label: np.ndarray, similarity: float) -> list[tuple[float, int]]:
        """(similarity, longest shared prefix) of each text of the sample that is linked to the set and differs from it."""
        first, last = np.searchsorted(self.grams, one, "left"), np.searchsorted(self.grams, one, "right")
        some = last > first
        if not some.any():
            return []
        first, count = first[some], (last - first)[some]
        hits = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        common = np.bincount(self.owner[hits], minlength=len(self.sets))
        union = self.sizes + len(one) - common
        found = []
        for i in np.flatnonzero((common >= similarity * union - 1e-6) & (common < union)).tolist():
            shared = int(np.cumprod(self.labels[i] == label, axis=1).sum(axis=1).max())
            found.append((float(common[i] / union[i]), shared))
        return found


def signatures(documents: DataFrame, deepest: int, trees: int, n: int = 5, seed: int = 3, sample: Sample | None = None, similarity: float = 0.8) -> DataFrame:
    """doc_id, text_hash, n_bytes, n_grams, a 128-bit hash of the n-gram set (low, high), the trees' labels and the links to the sample."""
    links_type = pa.list_(pa.struct([("similarity", pa.float64()), ("shared", pa.int32())]))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            sets = list(shingle_sets(b.column("text"), n))
            used = [i for i, s in enumerate(sets) if len(s)]
            labels = np.zeros((len(sets), trees, deepest), np.uint32)
            if used:
                labels[used] = labels_of([sets[i] for i in used], deepest, trees, seed)
            links: list[list[dict]] = [[] for _ in sets]
            for i in used if sample and sample.sets else ():
                links[i] = [{"similarity": j, "shared": d} for j, d in sample.links(sets[i], labels[i], similarity)]
            total = lambda k: np.array([int(mixed(s ^ np.uint64(k)).sum(dtype=np.uint64)) for s in sets], np.uint64).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * trees * deepest, pa.int32()), pa.array(labels.view(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), b.column("text_hash"), b.column("n_bytes"), pa.array([len(s) for s in sets], pa.int64()), pa.array(total(0)), pa.array(total(0x5851F42D4C957F2D)), lists,
                    pa.array(links, links_type),
                ],
                names=["doc_id", "text_hash", "n_bytes", "n_grams", "low", "high", "labels", "links"],
            )

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return in_batches(source).mapInArrow(work, "doc_id long, text_hash long, n_bytes long, n_grams long, low long, high long, labels array<int>, links array<struct<similarity: double, shared: int>>")


def sample_of(documents: DataFrame, sampled: int, seed: int) -> list[str]:
    """About ``sampled`` different texts, by the hash of their ids; twice as many at most."""
    share = sampled / max(1, documents.count())
    chosen = documents.filter("text IS NOT NULL").filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))
    return [r.text for r in chosen.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).limit(2 * sampled).collect()]


def linked_in_block(sets: list[np.ndarray], weights: np.ndarray, split: int, similarity: float, done: np.ndarray | None = None, width: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Exact links among sets: (documents linked to each, label of its component).

    With ``split`` > 0 only pairs of one set before and one after it count;
    pairs that are ``done`` do not.
    """
    m, sizes = len(sets), np.array([len(s) for s in sets], float)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes.astype(int))
    shared = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[shared]]
    row = row[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n_columns = int(column[-1]) + 1 if len(column) else 0
    left, right = (slice(0, split), slice(split, m)) if split else (slice(0, m), slice(0, m))
    common = np.zeros((m, m) if not split else (split, m - split), np.float32)
    for at in range(0, n_columns, width):
        a, b = np.searchsorted(column, [at, at + width])
        has = np.zeros((m, min(width, n_columns - at)), np.float32)
        has[row[a:b], column[a:b] - at] = 1
        common += has[left] @ has[right].T
    union = sizes[left, None] + sizes[None, right] - common
    linked = common >= similarity * union - 1e-6
    if done is not None:
        linked &= ~done
    if not split:
        np.fill_diagonal(linked, False)
        links = linked @ weights
    else:
        links = np.concatenate([linked @ weights[right], weights[left] @ linked])
    label = np.arange(m)
    i, j = np.nonzero(linked)
    j = j + (split or 0)
    while len(i):
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    return links, label


def met_before(prefixes: np.ndarray, tree: int, left: slice, right: slice) -> np.ndarray:
    """Which pairs share their prefix in a tree before ``tree``."""
    out = np.zeros((len(prefixes[left]), len(prefixes[right])), bool)
    for t in range(tree):
        out |= prefixes[left, t, None] == prefixes[None, right, t]
    return out


def _verified(members: DataFrame, similarity: float, n: int) -> DataFrame:
    """node, links, label from rows (group, tree, i, j, side, node, copies, prefixes, text), the rows of a task being two blocks of one group or prefix."""
    out = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("label", pa.int64())])

    def compared(tree: int, rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0], r[1]))
        node, copies = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
        sides = np.array([r[0] for r in rows])
        split = int((sides == 1).sum())
        if (sides > 0).any() and split in (0, len(rows)):  # the other block is empty
            links, label = np.zeros(len(rows)), np.arange(len(rows))
        else:
            left, right = (slice(0, split), slice(split, None)) if split else (slice(None), slice(None))
            done = met_before(np.array([r[4] for r in rows]), tree, left, right) if tree > 0 else None
            links, label = linked_in_block([r[3] for r in rows], copies, split, similarity, done)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64)), pa.array(node[label])], schema=out)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("group", "tree", "i", "j", "side", "node", "copies", "prefixes")]
            for group, tree, i, j, side, node, copies, prefixes, s in zip(*columns, shingle_sets(b.column("text"), n)):
                if (group, tree, i, j) != current:
                    if len(rows) > 1:
                        yield compared(current[1], rows)
                    current, rows = (group, tree, i, j), []
                rows.append((side, node, copies, s, prefixes))
        if len(rows) > 1:
            yield compared(current[1], rows)

    key = ("group", "tree", "i", "j")
    return in_batches(members).repartition(*key).sortWithinPartitions(*key).mapInArrow(work, "node long, links long, label long")


def _placed(ties: DataFrame, nodes: DataFrame, groups: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """group, tree, node, block, blocks, prefixes: where nodes are compared, in whole groups (tree -1) or under prefixes of loosely tied groups."""
    blocks = lambda n, size: F.greatest(F.ceil(n / block_rows), F.ceil(size / block_bytes)).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    sized = checkpointed(groups.join(nodes.select("node", "n_bytes"), "node"))
    whole = sized.groupBy("root").agg(F.count("*").alias("n"), blocks(F.count("*"), F.sum("n_bytes")).alias("blocks"))
    large = checkpointed(whole.filter("blocks > 1"))
    none = F.lit(None).cast("array<long>").alias("prefixes")
    in_group = lambda df: df.select(F.col("root").alias("group"), F.lit(-1).alias("tree"), "node", block, "blocks", none)
    if large.isEmpty():
        return in_group(sized.withColumn("blocks", F.lit(1)))
    prefixes = ties.groupBy("tree", "prefix").agg(F.count("*").alias("n"), F.min("first").alias("node"))
    pairs = prefixes.join(groups, "node").groupBy("root").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    loose = checkpointed(large.join(pairs, "root").filter(F.col("pairs") < F.col("n").cast("double") * F.col("n")).select("root"))
    plain = in_group(sized.join(whole.select("root", "blocks"), "root").join(loose, "root", "left_anti"))
    if loose.isEmpty():
        return plain
    apart = groups.join(loose, "root", "left_semi").join(nodes.select("node", "n_bytes", "prefixes"), "node")
    below = checkpointed(ties.select("tree", "prefix", "node").join(apart, "node"))
    sizes = checkpointed(below.groupBy("tree", "prefix").agg(blocks(F.count("*"), F.sum("n_bytes")).alias("blocks")))
    return plain.unionByName(below.join(sizes, ["tree", "prefix"]).select(F.col("prefix").alias("group"), "tree", "node", block, "blocks", "prefixes"))


def _classes(
    documents: DataFrame,
    similarity: float = 0.8,
    n: int = 5,
    trees: int = 30,
    deepest: int = 10,
    target: float = 0.999,
    sampled: int = 512,
    enough: int = 100,
    near: float = 0.05,
    block_rows: int = 512,
    block_bytes: int = 4 << 20,
    broadcast_rows: int = 500_000,
    seed: int = 3,
) -> DataFrame:
    """doc_id, text_hash, root, n_links of every document row; root is null for texts without words."""
    sample = Sample(sample_of(documents, sampled, seed), deepest, trees, n, seed)
    signed = checkpointed(signatures(documents, deepest, trees, n, seed, sample, similarity).withColumn("row", F.monotonically_increasing_id()))
    links = signed.select(F.explode("links").alias("x")).groupBy(F.round("x.similarity", 2).alias("j"), "x.shared").agg(F.count("*").alias("n")).collect()
    depth = prefix_depth(recalls([(r.j, r.shared, r.n) for r in links], trees, deepest, similarity, near, enough), target)

    worded = signed.filter("n_grams > 0")
    nodes = worded.groupBy("low", "high").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    nodes = checkpointed(nodes)
    member = signed.select("row", "low", "high", "doc_id", "text_hash", "n_grams")
    prefix = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(t, F.slice("labels", t * deepest + 1, depth)))
    chosen = worded.select(F.col("row").alias("node"), "doc_id", "text_hash", "n_bytes", prefix.alias("prefixes")).join(nodes.select("node", "copies"), "node")

    below = chosen.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    least = below.groupBy("tree", "prefix").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    ties = checkpointed(below.join(least, ["tree", "prefix"]))
    groups = checkpointed(components(ties.filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))))

    tied = checkpointed(chosen.join(groups.select("node"), "node"))
    placed = checkpointed(_placed(ties, tied, groups, block_rows, block_bytes))
    keyed = placed.join(tied.select("node", "copies", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")), "node")
    wanted = tied.select("node", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    wanted = F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    # rows that repeat both id and text match one node more than once; the node has one text
    matched = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))).groupBy("node").agg(F.first("text").alias("text"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    meeting = keyed.drop("id", "hash").withColumn("other", other).select(
        "group", "tree", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"), "node", "copies", "prefixes",
    )
    compared = checkpointed(_verified(meeting.join(matched, "node"), similarity, n))

    roots = components(compared.filter("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v")))
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(links, "node", "left").join(roots, "node", "left").select("low", "high", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    found = member.filter("n_grams > 0").join(known, ["low", "high"]).select("doc_id", "text_hash", "root", "n_links")
    alone = member.filter("n_grams = 0").select("doc_id", "text_hash", F.lit(None).cast("long").alias("root"), F.lit(0).cast("long").alias("n_links"))
    return checkpointed(found.unionByName(alone))


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links of every document row.

    Options: ``similarity``, ``n`` (words of an n-gram), ``trees``, ``deepest``
    (length of a label), ``target`` (recall), ``sampled`` (documents on which it
    is measured), ``enough`` (links within ``near`` of the threshold that are
    enough to measure it); ``block_rows`` and ``block_bytes`` bound what a task
    holds of a group (a longer text is a block of its own) and
    ``broadcast_rows`` what is broadcast; these three do not change the result.
    """
    found = _classes(documents, **options)
    # written out, so that the join is of two plain exchanges and Spark splits a large class between tasks
    names = checkpointed(found.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("class_id")))
    classed = found.filter("root IS NOT NULL").join(names, "root").select("doc_id", "class_id", "n_links")
    return classed.unionByName(found.filter("root IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), "n_links"))


def one_of_each(documents: DataFrame, broadcast_rows: int = 500_000, **options) -> DataFrame:
    """The documents without near duplicates: of each class the one with the least doc_id stays (ties: the least hash of the text).

    Rows that repeat both id and text stay once; texts without words all stay.
    """
    found = _classes(documents, broadcast_rows=broadcast_rows, **options).filter("root IS NOT NULL")
    texts = found.groupBy("root", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(F.count("*").alias("n"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("hash").alias("hash"))
    first = checkpointed(texts.groupBy("root").agg(F.min(rank).alias("first")))
    judged = texts.join(first, "root").select("id", "hash", "n", (rank == F.col("first")).alias("stays"))
    gone = checkpointed(judged.filter("NOT stays OR n > 1"))
    same = lambda other: documents["doc_id"].eqNullSafe(other["id"]) & F.xxhash64(documents["text"]).eqNullSafe(other["hash"])
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone
    kept = documents.join(gone, same(gone), "left_anti")
    repeated = gone.filter("stays")
    if repeated.isEmpty():
        return kept
    key = fresh(documents, "text_hash")
    once = documents.join(repeated, same(repeated), "left_semi").withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key)
    return kept.unionByName(once)
