"""Merkle manifest of a table: mountain ranges per partition, merged where they meet.

Rows become leaves, hashed in the JVM.  Leaves are sorted over range partitions
by group and order, so every partition holds runs of consecutive leaves whose
places in their group follow from the counts of the partitions before.  A
partition reads its leaves once and keeps a stack of mountain peaks: whenever
``fanout`` siblings are complete they are carried into their parent, like the
digits of a number in that base.  What a partition cannot complete (siblings left
of its first leaf, the open end at its last) leaves it as edge nodes, at most
``2 * (fanout - 1)`` a level.  Edges are merged per group by neighbouring
partitions, ``MERGED_AT_ONCE`` at a time and in as many rounds as it takes; a run
at the end of a level may be short and is hashed as it is, without padding.
Subroots are the leaves of one more such tree, which gives the root.

Proofs need a second reading of the (hashed) leaves: a partition then gets the
few nodes beside its own range, and every path is filled from these and its own
nodes.  No task holds more than the leaves of one partition (``partition_rows``
hashes) or the edges of ``MERGED_AT_ONCE`` partitions; nothing goes to the driver
but counts.

Defined results: nulls are hashed as ``-``; rows without a group form one of
their own, which comes first, as do rows without an order within theirs; rows
with equal order are placed by their hash, equal rows are interchangeable but
count each (and are split over partitions however many they are); a group with
one row has its leaf as subroot, one group alone its subroot as root; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from trackforge.llm.common import checkpointed, written

MERGED_AT_ONCE = 64
NODE = "part long, grp string, level int, idx long, hash string, total long, open boolean"
NODE_SCHEMA = pa.schema([("part", pa.int64()), ("grp", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("hash", pa.string()), ("total", pa.int64()), ("open", pa.bool_())])
PATH = "array<struct<position: int, siblings: array<string>>>"
_ROW_BITS = 33  # monotonically_increasing_id: the partition above these bits, the row below


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length in bytes before it; null is a dash."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def levels(total: int, fanout: int) -> list[int]:
    """How many nodes each level has, from the leaves to the top."""
    out = [total]
    while out[-1] > 1:
        out.append(-(-out[-1] // fanout))
    return out


class Range:
    """The mountain range of consecutive nodes: per level the peaks that wait for siblings."""

    def __init__(self, fanout: int) -> None:
        self.fanout = fanout
        self.waiting: list[tuple[int, list[str]]] = []  # per level: the first index, the hashes
        self.edges: list[tuple[int, int, str]] = []

    def add(self, first: int, hashes: list[str], level: int = 0) -> None:
        """Put consecutive nodes at the end of a level; complete runs are carried upwards."""
        while True:
            if level == len(self.waiting):
                self.waiting.append((first, []))
            start, held = self.waiting[level]
            if not held:
                start = first
            held = held + hashes
            if -start % self.fanout:  # the left siblings are elsewhere
                cut = -start % self.fanout
                if start + len(held) < start + cut:
                    self.waiting[level] = (start, held)
                    return
                self.edges += [(level, start + i, h) for i, h in enumerate(held[:cut])]
                start, held = start + cut, held[cut:]
            whole = len(held) // self.fanout * self.fanout
            self.waiting[level] = (start + whole, held[whole:])
            if not whole:
                return
            hashes = [digest(held[i : i + self.fanout]) for i in range(0, whole, self.fanout)]
            first, level = start // self.fanout, level + 1

    def close(self) -> list[tuple[int, int, str]]:
        """All nodes that wait for siblings elsewhere, as (level, index, hash)."""
        return self.edges + [(level, start + i, h) for level, (start, held) in enumerate(self.waiting) for i, h in enumerate(held)]


def merge(nodes: Iterable[tuple[int, int, str]], fanout: int, total: int | None) -> tuple[list[tuple[int, int, str]], set[tuple[int, int]]]:
    """Carry edges of neighbouring ranges: (new nodes, the places of those that still wait).

    With ``total`` leaves known to be all here, short runs at the end of a level are carried too.
    """
    at: dict[int, dict[int, str]] = {}
    for level, idx, h in nodes:
        at.setdefault(level, {})[idx] = h
    widths = levels(total, fanout) if total is not None else None
    new, waits, level = [], set(), 0
    while at and level <= max(at):
        here = at.get(level, {})
        runs: dict[int, list[int]] = {}
        for idx in sorted(here):
            runs.setdefault(idx // fanout, []).append(idx)
        for run, members in runs.items():
            full = fanout
            if widths is not None:
                full = 0 if len(widths) == level + 1 else min(fanout, widths[level] - run * fanout)
            if len(members) == full:
                at.setdefault(level + 1, {})[run] = digest(here[i] for i in members)
                new.append((level + 1, run, at[level + 1][run]))
            else:
                waits.update((level, i) for i in members)
        level += 1
    return new, waits


def _nodes(part: int, group: str, total: int, nodes: list[tuple[int, int, str, bool]]) -> pa.RecordBatch:
    n = len(nodes)
    columns = [[part] * n, [group] * n, [x[0] for x in nodes], [x[1] for x in nodes], [x[2] for x in nodes], [total] * n, [x[3] for x in nodes]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODE_SCHEMA)], schema=NODE_SCHEMA)


def _runs(groups: pa.Array) -> Iterator[tuple[int, int]]:
    """Where the runs of equal values begin and end."""
    codes = groups.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)] if len(codes) else [0]
    yield from zip(cuts, cuts[1:])


def edges_of(leaves: DataFrame, fanout: int) -> DataFrame:
    """The edge nodes of every partition's runs; rows come sorted, with start, first_total, last_total of their partition."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, peaks, count, first, part, last_total = None, None, 0, True, 0, 0
        for batch in batches:
            groups = batch.column("grp")
            for a, b in _runs(groups):
                if peaks is None or groups[a].as_py() != group:
                    if peaks is not None:
                        yield _nodes(part, group, count, [(*n, True) for n in peaks.close()])
                        first = False
                    part, last_total = batch.column("part")[a].as_py(), batch.column("last_total")[a].as_py()
                    group, peaks = groups[a].as_py(), Range(fanout)
                    count = batch.column("start")[a].as_py() if first else 0
                peaks.add(count, batch.column("hash").slice(a, b - a).to_pylist())
                count += b - a
        if peaks is not None:
            yield _nodes(part, group, last_total, [(*n, True) for n in peaks.close()])

    return leaves.select("part", "grp", "hash", "start", "last_total").mapInArrow(work, NODE)


def _merge_round(edges: DataFrame, fanout: int, last: bool) -> DataFrame:
    """Merge the open nodes of neighbouring partitions; totals are the greatest seen of a group."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        nodes = list(zip(*(table.column(c).to_pylist() for c in ("level", "idx", "hash"))))
        total = max(table.column("total").to_pylist())
        new, waits = merge(nodes, fanout, total if last else None)
        made = {n[:2] for n in new}
        rows = [(*n, n[:2] in waits) for n in new] + [(*n, True) for n in nodes if n[:2] in waits and n[:2] not in made]
        return pa.Table.from_batches([_nodes(key[1].as_py(), key[0].as_py(), total, rows)], schema=NODE_SCHEMA)

    unit = F.floor(F.col("part") / MERGED_AT_ONCE).cast("long")
    return edges.withColumn("part", unit).groupBy("grp", "part").applyInArrow(work, NODE)


def _paths_of(hashes: np.ndarray, start: int, total: int, beside: dict[tuple[int, int], str], fanout: int) -> Iterator[pa.Array]:
    """The paths of consecutive leaves from ``start`` on, a few thousand at a time."""
    pool, base, firsts = [], [], []
    at, first = hashes, start
    widths = levels(total, fanout)
    for level, width in enumerate(widths[:-1]):
        last = first + len(at) - 1
        left = [beside[level, i] for i in range(first - first % fanout, first)]
        right = [beside[level, i] for i in range(last + 1, min(last - last % fanout + fanout, width))]
        at = np.concatenate([np.array(left, "S64"), at, np.array(right, "S64")])
        first -= len(left)
        pool.append(at)
        base.append(sum(map(len, pool[:-1])))
        firsts.append(first)
        joined = b"".join(at.tolist())
        at = np.array([hashlib.sha256(joined[64 * i : 64 * (i + fanout)]).hexdigest() for i in range(0, len(at), fanout)], "S64")
        first //= fanout
    n_levels, pool = len(widths) - 1, np.concatenate([*pool, np.array([], "S64")])
    powers, narrow = fanout ** np.arange(n_levels), np.array(widths[:-1], np.int64)
    for a in range(0, len(hashes), 4096):
        rows = np.arange(start + a, start + min(a + 4096, len(hashes)))
        own = rows[:, None] // powers  # row, level
        members = (own - own % fanout)[:, :, None] + np.arange(fanout)
        valid = (members < narrow[:, None]) & (members != own[:, :, None])
        places = members - np.array(firsts, np.int64)[:, None] + np.array(base, np.int64)[:, None]
        found = pool[places[valid]] if n_levels else np.array([], "S64")
        texts = pa.StringArray.from_buffers(len(found), pa.py_buffer((np.arange(len(found) + 1) * 64).astype(np.int32)), pa.py_buffer(found.tobytes()))
        per = valid.sum(axis=2).reshape(-1)
        siblings = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), texts)
        steps = pa.StructArray.from_arrays([pa.array((own % fanout).reshape(-1).astype(np.int32)), siblings], ["position", "siblings"])
        yield pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * n_levels, pa.int32()), steps)


def _beside(parts: DataFrame, fanout: int) -> DataFrame:
    """part, grp, level, idx of the nodes that a partition's first and last run need from others."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first, last = r["start"], r["start"] + r["n"] - 1
                for level, width in enumerate(levels(r["total"], fanout)[:-1]):
                    wanted = [*range(first - first % fanout, first), *range(last + 1, min(last - last % fanout + fanout, width))]
                    out += [(r["part"], r["grp"], level, i) for i in wanted]
                    first, last = first // fanout, last // fanout
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "grp", "level", "idx"), o)) for o in out], schema=schema)

    schema = pa.schema([("part", pa.int64()), ("grp", pa.string()), ("level", pa.int32()), ("idx", pa.int64())])
    return parts.select("part", "grp", "start", "n", "total").mapInArrow(work, "part long, grp string, level int, idx long")


def tree(leaves: DataFrame, order: list[Column], fanout: int = 2, partition_rows: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """Merkle trees over grp, hash (and any columns to carry along), leaves of a group in the given order.

    Returns the leaves with their ``path`` (per level the place among the
    siblings and the other siblings), and grp, root, total of every group.
    ``partition_rows`` says how many leaves a partition should hold; neither it
    nor the partitions change the result.
    """
    spark = leaves.sparkSession
    rows = leaves.count()
    n = max(1, -(-rows // partition_rows), min(spark.sparkContext.defaultParallelism, -(-rows // 1024)))
    tied = leaves.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("grp"), *order, F.col("hash"), F.col("tie")]
    placed = tied.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("tie").withColumn("at", F.monotonically_increasing_id())
    placed = checkpointed(placed.withColumn("part", F.shiftright("at", _ROW_BITS)))
    # consecutive runs: a group's partitions in their order
    runs = placed.groupBy("part", "grp").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    along, whole = Window.partitionBy("grp").orderBy("part"), Window.partitionBy("grp")
    before = F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("start", F.coalesce(before, F.lit(0).cast("long"))).withColumn("total", F.sum("n").over(whole))
    runs = written(runs)
    ends = runs.groupBy("part").agg(
        F.min(F.struct("at", "start")).alias("first"), F.max(F.struct("at", "total")).alias("last"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    ends = ends.select("part", F.col("first.start").alias("start"), F.col("last.total").alias("last_total"), "first_at", "last_at")
    each_part = F.broadcast(ends.drop("first_at", "last_at"))  # one row a partition
    edges = written(edges_of(placed.join(each_part, "part"), fanout))
    known, open_ = [edges], edges
    units = (ends.agg(F.max("part")).first()[0] or 0) + 1  # as many as Spark has made
    while True:
        last = units <= MERGED_AT_ONCE
        made = written(_merge_round(open_, fanout, last))
        known.append(made)
        if last:
            break
        open_, units = made.filter("open"), -(-units // MERGED_AT_ONCE)
    tops = known[-1].filter("open").groupBy("grp").agg(F.max(F.struct("level", "hash")).alias("top"), F.max("total").alias("total"))
    roots = tops.select("grp", F.col("top.hash").alias("root"), "total")
    nodes = known[0]
    for more in known[1:]:
        nodes = nodes.unionByName(more)
    outer = runs.join(F.broadcast(ends.select("part", "first_at", "last_at")), "part").filter((F.col("at") == F.col("first_at")) | (F.col("at") == F.col("last_at")))
    wanted = _beside(outer, fanout).join(nodes.select("grp", "level", "idx", "hash").distinct(), ["grp", "level", "idx"])
    carried = [f for f in placed.schema.fields if f.name != "part"]
    runs_of = placed.withColumn("level", F.lit(-1)).withColumn("idx", F.lit(None).cast("long"))
    both = runs_of.join(each_part, "part").unionByName(wanted, allowMissingColumns=True)
    out = StructType([*carried, StructField("path", spark.createDataFrame([], f"p {PATH}").schema["p"].dataType)])
    names = [f.name for f in carried]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        inner = pa.compute.less(table.column("level"), 0)
        side, mine = table.filter(pa.compute.invert(inner)), table.filter(inner).sort_by("at").combine_chunks()
        beside: dict[str, dict[tuple[int, int], str]] = {}
        for g, level, idx, h in zip(*(side.column(c).to_pylist() for c in ("grp", "level", "idx", "hash"))):
            beside.setdefault(g, {})[level, idx] = h
        groups = mine.column("grp").combine_chunks()
        bounds = list(_runs(groups))
        for k, (a, b) in enumerate(bounds):
            start = mine.column("start")[a].as_py() if k == 0 else 0
            total = mine.column("last_total")[a].as_py() if k == len(bounds) - 1 else start + b - a
            hashes = np.array(mine.column("hash").slice(a, b - a).to_pylist(), "S64")
            at = a
            for paths in _paths_of(hashes, start, total, beside.get(groups[a].as_py(), {}), fanout):
                part = mine.slice(at, len(paths)).select(names).combine_chunks()
                at += len(paths)
                yield pa.RecordBatch.from_arrays([*(c.chunk(0) for c in part.columns), paths], names=[*names, "path"])

    paths = both.groupBy("part").applyInArrow(work, out)
    return paths.drop("at", "level", "idx"), roots


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    step = lambda acc, s: F.sha2(
        F.concat(F.array_join(F.slice(s["siblings"], F.lit(1), s["position"]), ""), acc, F.array_join(F.slice(s["siblings"], s["position"] + 1, F.size(s["siblings"])), "")).cast("binary"), 256
    )
    return F.aggregate(path, start, step)


def manifest(table: DataFrame, columns: list[str], group: str, order: list[str], tampered: Column | None = None, keep: list[str] | None = None, fanout: int = 2, partition_rows: int = 1 << 16, broadcast_rows: int = 500_000) -> DataFrame:
    """Every row's leaf, subroot, root and path (to the root) over ``columns``, with the columns to ``keep``.

    ``tampered`` is the leaf of the row as it is now, where that is to be checked against the tree; by default it is the leaf itself.
    """
    kept = keep if keep is not None else order
    own = leaf(*[F.col(c) for c in columns])
    now = own if tampered is None else tampered
    key = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    sorting = [F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]
    hashed = table.select(key.alias("grp"), own.alias("hash"), F.nullif(now, own).alias("changed"), *sorting, *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(kept)])
    hashed = written(hashed)
    by = [F.col(f"order_{i}").asc_nulls_first() for i in range(len(order))]
    below, subroots = tree(hashed, by, fanout, partition_rows)
    subroots = written(subroots)
    above, top = tree(subroots.select(F.lit("").alias("grp"), F.col("root").alias("hash"), F.col("grp").alias("name")), [F.col("name")], fanout, partition_rows)
    above = above.join(F.broadcast(top.select("grp", F.col("root").alias("whole_root"))), "grp")  # one row
    above = written(above.select(F.col("name").alias("grp"), F.col("hash").alias("subroot"), F.col("path").alias("upper_path"), "whole_root"))
    few = above.count() <= broadcast_rows  # groups
    joined = below.join(F.broadcast(above) if few else above, "grp")
    return joined.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(kept)],
        F.col("hash").alias("leaf"),
        F.coalesce("changed", "hash").alias("leaf_now"),
        "subroot",
        F.col("whole_root").alias("root"),
        F.concat("path", "upper_path").alias("path"),
    )


def proofs(found: DataFrame) -> DataFrame:
    """leaf, subroot, root, proof_sha256, folded_root, verified of ``manifest``'s rows, with the columns it kept."""
    path = F.col("path")
    proof = F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: s["siblings"])), "").cast("binary"), 256)
    out = found.withColumn("proof_sha256", proof).withColumn("folded_root", folded(F.col("leaf_now"), path))
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).drop("path", "leaf_now")
