"""Packing of documents into training sequences by the sum-of-squares rule.

A document's ids (with an end id) fill whole windows first.  Its rest goes, as
it comes, to the fill level that leaves the smallest sum of squared counts of
partially filled windows: with N(h) windows filled to h, putting s ids on level
h changes the sum by 1 - 2 N(h) + 1 + 2 N(h + s), a new window by 1 + 2 N(s).
N is a level array of the window's size; no other state decides.

Every partition packs its own documents, in their order, so there is no
shuffle, and a task that runs again gives the same sequences.  Open windows are
bounded by ``max_open``: for each one beyond it the fullest window is filled
exactly with pieces cut from the emptiest, and the level array keeps all others.
So are the windows that are open at the end of the partition, which leaves at
most one partial sequence per partition.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives no sequences; further columns are ignored; a
null doc_id stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from trackforge.llm.common import in_batches
from trackforge.llm.tokens import shared_encoder

#: (doc_id, ids of the document before the piece, ids of the piece, ids of the document)
Piece = tuple[int | None, int, np.ndarray, int]


class SumOfSquares:
    """Online packer; ``add`` and ``close`` return the windows that became final."""

    def __init__(self, size: int, max_open: int = 1024) -> None:
        self.size, self.max_open = size, max_open
        self.count = np.zeros(size, np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(size)]
        self.open = 0

    def level(self, s: int) -> int:
        """The fill level (0: a new window) on which ``s`` ids leave the least sum of squares; ties to the fullest."""
        size, count = self.size, self.count
        levels = np.flatnonzero(count[1 : size - s + 1]) + 1
        if not len(levels):
            return 0
        after = levels + s
        cost = 1 - 2 * count[levels] + np.where(after < size, 1 + 2 * count[np.minimum(after, size - 1)], 0)
        best = len(levels) - 1 - int(np.argmin(cost[::-1]))
        return int(levels[best]) if cost[best] <= 1 + 2 * count[s] else 0

    def _put(self, pieces: list[Piece], level: int) -> None:
        self.windows[level].append(pieces)
        self.count[level] += 1
        self.open += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[list[Piece]]:
        n, full = len(ids), []
        whole = n - n % self.size
        for at in range(0, whole, self.size):
            full.append([(doc_id, at, ids[at : at + self.size], n)])
        if s := n - whole:
            level, pieces = self.level(s), []
            if level:
                pieces = self._take(level)
            pieces.append((doc_id, whole, ids[whole:].copy(), n))
            if level + s == self.size:
                full.append(pieces)
            else:
                self._put(pieces, level + s)
        return full + self._fill(self.max_open)

    def _take(self, level: int) -> list[Piece]:
        self.count[level] -= 1
        self.open -= 1
        return self.windows[level].pop()

    def _fill(self, keep: int) -> list[list[Piece]]:
        """Fill the fullest open windows with pieces cut from the emptiest until ``keep`` are open; the others stay as they are."""
        full = []
        while self.open > max(keep, 1):
            level = int(np.flatnonzero(self.count)[-1])
            pieces = self._take(level)
            while level < self.size and self.open:
                loose = self._take(int(np.flatnonzero(self.count)[0]))
                while loose and level < self.size:
                    doc_id, start, ids, n = loose.pop()
                    room = self.size - level
                    pieces.append((doc_id, start, ids[:room], n))
                    level += min(room, len(ids))
                    if len(ids) > room:
                        loose.append((doc_id, start + room, ids[room:], n))
                if loose:
                    self._put(loose, sum(len(p[2]) for p in loose))
            if level == self.size:
                full.append(pieces)
            else:
                self._put(pieces, level)
        return full

    def close(self) -> list[list[Piece]]:
        return self._fill(1) + [w for level in self.windows for w in level]


PACKED = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


def pack(documents: DataFrame, size: int = 2048, end_id: int = 1, tokenizer_path: str | None = None, max_open: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document; ``with_ids`` adds the ids themselves."""
    schema = PACKED.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else PACKED

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = shared_encoder(tokenizer_path), SumOfSquares(size, max_open)
        context = TaskContext.get()
        next_id = (context.partitionId() if context else 0) << 40
        rows: list[list] = []

        def write(windows: list[list[Piece]]) -> None:
            nonlocal next_id
            for pieces in windows:
                offset = 0
                for doc_id, start, ids, n in pieces:
                    rows.append([doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, next_id, offset, *([ids.tolist()] if with_ids else [])])
                    offset += len(ids)
                next_id += 1

        def take() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
            rows.clear()
            return batch

        for b in (whole.slice(at, 64) for whole in batches for at in range(0, whole.num_rows, 64)):
            encoded = encoder.encode_all([t or "" for t in b.column("text").to_pylist()])
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoded):
                write(packer.add(doc_id, np.append(ids, np.uint32(end_id))))
                if len(rows) >= 4096:
                    yield take()
        write(packer.close())
        if rows:
            yield take()

    types = ", ".join(f"{f.name} long" for f in PACKED) + (", ids array<int>" if with_ids else "")
    return in_batches(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).mapInArrow(work, types)
