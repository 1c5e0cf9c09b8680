"""The cache as keyed streaming state, and as a table that batches are merged into.

Look-ups and writes come as one stream in any order within the watermark's
delay.  Events wait until the watermark has passed them and are then, per key,
taken in the order of the batch form (``cache.lookup_as_of``): by time, at one
time writes before look-ups, of writes the greatest data last.  The key's entry
stays in the state however long it is fresh, over hours, days and restarts, and a
timer removes it when it expires; nothing remains of a key whose entries have
expired and whose events are done.  What one key holds is its entry and its
events of the watermark's delay; the state is kept by buckets of keys.

The table keeps each batch in a folder of its own, named by the batch, so that a
batch that is written again replaces itself, and reads the latest write of each
key.  Merging is a maximum: neither the order of batches nor repeated ones change
it.  Compaction writes a new base with a mark of its last batch; readers take it
only when it is complete.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

EVENT = "key string, at long, ask_id long, data long, ttl long"
ANSWER = "key string, ask_id long, at long, data long"
#: What the state holds of an event, without nulls; kinds in the order in which those of one time are taken: a write without data, a write, a look-up.
_HELD = pa.schema([("key", pa.string()), ("at", pa.int64()), ("kind", pa.int64()), ("id", pa.int64()), ("ttl", pa.int64())])
_BLANK, _WRITE, _ASK = range(3)
#: Rows of one value of the state.
_CHUNK = 10_000
PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def cache_events(asked: DataFrame, writes: DataFrame, key: Column) -> DataFrame:
    """One table of look-ups (ask_id, asked_at) and writes (written_at, data, ttl in seconds)."""
    asks = asked.select(key.cast("string").alias("key"), F.col("asked_at").cast("long").alias("at"), F.col("ask_id").cast("long").alias("ask_id"))
    sets = writes.select(key.cast("string").alias("key"), F.col("written_at").cast("long").alias("at"), F.col("data").cast("long").alias("data"), F.col("ttl").cast("long").alias("ttl"))
    return asks.unionByName(sets, allowMissingColumns=True)


def _packed(rows: pd.DataFrame) -> tuple[bytes]:
    batch = pa.RecordBatch.from_pandas(rows, _HELD, preserve_index=False)
    with pa.BufferOutputStream() as out:
        with pa.ipc.new_stream(out, _HELD) as writer:
            writer.write_batch(batch)
        return (out.getvalue().to_pybytes(),)


def _unpacked(values: Iterable[tuple]) -> pd.DataFrame:
    return pa.concat_tables([_HELD.empty_table(), *(pa.ipc.open_stream(v[0]).read_all() for v in values)]).to_pandas()


class Entries(StatefulProcessor):
    """The fresh entries of a bucket's keys and the events that the watermark has not passed.

    A call to the state costs as much as the work on hundreds of events, so what a
    batch brings to a bucket is one value of packed rows, and the events of all
    its keys are taken in one go.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getValueState("entries", "rows binary")  # the last write of each key
        self.pending = handle.getListState("pending", "rows binary")

    def _wait(self, at: int) -> None:
        self.handle.registerTimer(int(at) * 1000 + 1)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        earliest = []
        for frame in rows:
            self.pending.appendValue(_packed(frame[_HELD.names]))
            earliest.append(frame["at"].min())
        if earliest:
            self._wait(min(earliest))
        return iter([])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        events, held = _unpacked(self.pending.get()), self.entries.get()
        passed = events["at"] * 1000 < now
        rest, answers = events[~passed], []
        rows = pd.concat([_unpacked([held] if held else []), events[passed]])
        code, names = pd.factorize(rows["key"])
        at, kind, id_, ttl = (rows[c].to_numpy() for c in _HELD.names[1:])
        order = np.lexsort((id_, kind, at, code))
        code, at, kind, id_, expires = code[order], at[order], kind[order], id_[order], (at + ttl)[order]
        asks, writes = np.flatnonzero(kind == _ASK), np.flatnonzero(kind != _ASK)
        if len(asks):
            last = np.maximum.accumulate(np.where(kind == _ASK, -1, np.arange(len(kind))))[asks]
            hit = (last >= 0) & (code[last] == code[asks]) & (kind[last] == _WRITE) & (expires[last] > at[asks])
            answers = [pd.DataFrame({"key": names.take(code[asks]), "ask_id": id_[asks], "at": at[asks], "data": pd.arrays.IntegerArray(id_[last], ~hit)})]
        if passed.any():
            self.pending.clear()
            for i in range(0, len(rest), _CHUNK):
                self.pending.appendValue(_packed(rest[i : i + _CHUNK]))
        final = writes[np.append(np.diff(code[writes]) != 0, True)] if len(writes) else writes
        fresh = final[expires[final] * 1000 >= now]
        if len(fresh):
            self.entries.update(_packed(rows.iloc[order[fresh]]))
        elif held:
            self.entries.clear()
        later = [*rest["at"], *expires[fresh]]
        if later:
            self._wait(min(later))
        return iter(answers)

    def close(self) -> None:
        pass


def stream_lookups(events: DataFrame, late: str = "1 hour", buckets: int = 1024) -> DataFrame:
    """key, ask_id, at, data (null: a miss) of every look-up in a stream of ``EVENT`` rows; events later than ``late`` are dropped.

    Keys are held by bucket, of which a task takes one at a time; a stream that
    goes on from a checkpoint needs the number that it began with.  Needs the
    RocksDB state store (``with_rocks``); a null key is the empty one, events
    without a time are dropped.
    """
    timed = events.filter("at IS NOT NULL AND (ask_id IS NOT NULL OR ttl IS NOT NULL)").withColumn("key", F.coalesce("key", F.lit(""))).withColumn("event_time", F.timestamp_seconds("at"))
    kind = F.when(F.col("ask_id").isNotNull(), _ASK).when(F.col("data").isNotNull(), _WRITE).otherwise(_BLANK)
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    whole = timed.select(bucket.alias("bucket"), "key", "at", kind.alias("kind"), F.coalesce("ask_id", "data", F.lit(0)).alias("id"), F.coalesce("ttl", F.lit(0)).alias("ttl"), "event_time")
    return whole.withWatermark("event_time", late).groupBy("bucket").transformWithStateInPandas(Entries(), ANSWER, "Append", "EventTime")


class with_rocks:  # noqa: N801
    """A session whose streams, started inside, keep their state in RocksDB; the session's own setting comes back afterwards."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def __enter__(self) -> SparkSession:
        self.before = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKS)
        return self.spark

    def __exit__(self, *failure: object) -> None:
        if self.before is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.before)


class EntryTable:
    """Entries (``keys``, written_at, data, ttl) in a shared folder; the greatest (written_at, data, ttl) of a key is its entry.

    One stream writes it.  ``upsert`` is what foreachBatch takes.  Readers see
    whole batches only.  A batch may be any DataFrame with these columns.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.schema = StructType([f for f in schema.fields if f.name in (*keys, "written_at", "data", "ttl")])

    def _merged(self, rows: DataFrame) -> DataFrame:
        latest = rows.groupBy(*self.keys).agg(F.max(F.struct("written_at", "data", "ttl")).alias("w"))
        return latest.select(*self.keys, "w.*")

    def _done(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        found = [s.getPath() for s in files.listStatus(folder)]
        return sorted(int(p.getName().split("-")[1]) for p in found if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{kind}-{number:012d}"

    def _write(self, rows: DataFrame, folder: str) -> None:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        self._write(self._merged(batch.select(*self.schema.names)), self._folder("batch", batch_id))

    def _parts(self) -> tuple[int, list[str]]:
        base = max(self._done("base"), default=-1)
        later = [self._folder("batch", n) for n in self._done("batch") if n > base]
        return base, ([self._folder("base", base)] if base >= 0 else []) + later

    def read(self, as_of: int | None = None) -> DataFrame:
        """The entry of each key; with ``as_of`` (seconds) only those that are still fresh then."""
        _, parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        wide = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        rows = self.spark.createDataFrame([], self.schema)
        for p in parts:  # as many as batches since the last compaction
            rows = rows.unionByName(self.spark.read.schema(wide).parquet(p).select(*self.schema.names))
        found = self._merged(rows)
        return found if as_of is None else found.filter(F.col("written_at") + F.col("ttl") > as_of)

    def compact(self, as_of: int | None = None) -> None:
        """Write all batches so far into one base, without what has expired by ``as_of``; repeated, it changes nothing."""
        base, _ = self._parts()
        last = max(self._done("batch"), default=-1)
        if last > base:
            self._write(self.read(as_of), self._folder("base", last))
