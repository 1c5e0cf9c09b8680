"""Small helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a temporary one only where a local session names none."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def in_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """The frame, in a session whose Arrow batches hold at most ``rows`` rows: texts are long, and a batch is held in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_ = int(df.sparkSession.conf.get(name, "10000"))
    if set_ <= 0 or set_ > rows:
        df.sparkSession.conf.set(name, str(rows))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores as it takes for no column of the frame to bear it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder; later reads do not compute them again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, for loops: a checkpoint hands on what the planner knew of the rows, which grows exponentially there."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column one after another, and where each row starts and the last ends; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 18), base, np.uint64)
        known[0] = 1
        _POWERS[base] = known = np.cumprod(known)
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, all at once: differences of one running polynomial, moved to a common place."""
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_PRIME, len(data)), out=running[1:])
    return mixed((running[ends] - running[starts]) * _powers(_INVERSE, len(data) + 1)[starts])


def pieces(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray, size: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Cut the bytes into parts of about ``size`` that end before a blank byte or at the end of a row."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + size, n)
        if end < n:
            row = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            if row > at:
                end = row
            else:
                stop = int(offsets[np.searchsorted(offsets, end, "right")])
                while end < stop and not blank[data[end]]:
                    gap = np.flatnonzero(blank[data[end : min(end + 65536, stop)]])
                    end = end + int(gap[0]) if len(gap) else min(end + 65536, stop)
        yield at, end
        at = end
