"""The cache in streaming state against its batch form, restarts, and the table that batches are merged into."""

import json
import random

import pytest
from pyspark.sql import functions as F

from trackforge.streaming import cache, state

DAY = 86400
START = 1_700_000_000


@pytest.fixture(scope="module")
def tables(spark):
    """A fortnight of writes and look-ups, with ties, repeated rows, entries of seven days and of five minutes."""
    r = random.Random(5)
    at = lambda: START + r.randrange(14 * DAY) // 600 * 600
    writes = [(f"k{r.randrange(12)}", at(), r.randrange(1000), r.choice([300, DAY, 7 * DAY])) for _ in range(160)]
    writes += [("week", START, 7, 7 * DAY), (None, START, 1, DAY), writes[0], (writes[1][0], writes[1][1], 5, DAY), ("never asked", START + 50, 1, 60)]
    asked = [(i, f"k{r.randrange(14)}", at()) for i in range(300)]
    asked += [(900, "week", START + 7 * DAY - 1), (901, "week", START + 7 * DAY), (902, "week", START), (903, None, START + 5), (904, "week", START - 1)]
    return spark.createDataFrame(asked, "ask_id long, key string, asked_at long"), spark.createDataFrame(writes, "key string, written_at long, data long, ttl long")


def run(spark, stream, folder):
    with state.with_rocks(spark):
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def source(spark, folder):
    return spark.readStream.schema(state.EVENT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_stream_equals_the_batch_form_over_restarts(spark, tables, tmp_path):
    asked, writes = tables
    events = state.cache_events(asked, writes, F.col("key")).collect()
    late = 3 * 3600
    r = random.Random(2)
    events = sorted(events, key=lambda e: e["at"] + r.randrange(late))  # out of order, within the delay
    end = [("end", START + 60 * DAY, None, None, 0)]
    parts = [events[i : i + 80] for i in range(0, len(events), 80)]
    half = len(parts) // 2
    write = lambda some: [spark.createDataFrame([tuple(e) for e in part], state.EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in") for part in some]
    write(parts[:half])
    first = run(spark, state.stream_lookups(source(spark, tmp_path), "3 hours"), tmp_path)
    held = json.loads(first.lastProgress.json)["stateOperators"][0]["numRowsTotal"]
    write([*parts[half:], end, [("end", START + 90 * DAY, None, None, 0)]])
    second = run(spark, state.stream_lookups(source(spark, tmp_path), "3 hours"), tmp_path)  # goes on from the checkpoint
    left = json.loads(second.lastProgress.json)["stateOperators"][0]["numRowsTotal"]
    found = {(x.ask_id, x.data) for x in spark.read.parquet(f"{tmp_path}/out").collect()}
    blank = lambda df: df.withColumn("key", F.coalesce("key", F.lit("")))
    want = {(x.ask_id, x.data) for x in cache.lookup_as_of(blank(asked), blank(writes), ["key"]).collect()}
    assert found == want and {(900, 7), (901, None), (902, 7), (903, 1), (904, None)} <= found
    assert spark.read.parquet(f"{tmp_path}/out").count() == asked.count()
    assert held >= 12 and left <= 6  # what is left is the last event's own
    assert state.PROVIDER not in str(spark.conf.get(state.PROVIDER, None)) and spark.conf.get(state.PROVIDER) != state.ROCKS


def test_state_does_not_grow_with_keys_of_a_bucket_and_ids_stay_whole(spark, tmp_path):
    r, big = random.Random(8), 2**53
    asked = [(big + 2 * i + 1, f"k{i % 300}", START + 3600 + r.randrange(7200)) for i in range(12_000)]  # more than a value of the state holds
    writes = [(f"k{i % 300}", START + r.randrange(10_800) // 60 * 60, r.choice([None, -5, big + 2 * i + 1, big + 2 * i + 1]), r.choice([300, 3600])) for i in range(3000)]
    asked, writes = spark.createDataFrame(asked, "ask_id long, key string, asked_at long"), spark.createDataFrame(writes, "key string, written_at long, data long, ttl long")
    state.cache_events(asked, writes, F.col("key")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = lambda: state.stream_lookups(source(spark, tmp_path), "2 hours", buckets=1)
    held = json.loads(run(spark, stream(), tmp_path).lastProgress.json)["stateOperators"][0]["numRowsTotal"]
    assert held <= 20  # not by key or event
    spark.createDataFrame([("end", START + 60 * DAY, None, None, 0)], state.EVENT).write.mode("append").parquet(f"{tmp_path}/in")
    run(spark, stream(), tmp_path)
    found = sorted((x.ask_id, x.key, x.data or 0) for x in spark.read.parquet(f"{tmp_path}/out").collect())
    want = sorted((x.ask_id, x.key, x.data or 0) for x in cache.lookup_as_of(asked, writes, ["key"]).collect())
    assert found == want and {x[2] > 0 for x in found} == {True, False}


def test_table_is_the_same_however_often_batches_come(spark, tables, tmp_path):
    _, writes = tables
    writes = writes.withColumn("key", F.coalesce("key", F.lit("")))
    rows = writes.collect()
    table = state.EntryTable(spark, f"file://{tmp_path}/entries", writes.schema, ["key"], buckets=4)
    assert table.read().count() == 0
    batches = [spark.createDataFrame(rows[i::3], writes.schema) for i in range(3)]
    for i in (0, 1, 2):
        table.upsert(batches[i].withColumn("more", F.lit(1)), i)
    everything = lambda df: sorted(map(tuple, df.select("key", "written_at", "data", "ttl").collect()))
    want = {}
    for k, t, d, ttl in rows:
        want[k] = max(want.get(k, (0, 0, 0)), (t, d, ttl))
    want = sorted((k, *w) for k, w in want.items())
    assert everything(table.read()) == want
    table.upsert(batches[1], 1)
    assert everything(table.read()) == want
    now = START + 10 * DAY
    fresh = [w for w in want if w[1] + w[3] > now]
    assert everything(table.read(now)) == fresh and 0 < len(fresh) < len(want)
    table.compact(now)
    table.compact(now)
    assert everything(table.read()) == fresh
    table.upsert(batches[0], 0)  # a batch that the base has taken in
    assert everything(table.read()) == fresh
    table.upsert(spark.createDataFrame([("new", now, 1, 60)], writes.schema), 3)
    table.upsert(spark.createDataFrame([], writes.schema), 4)
    assert everything(table.read()) == sorted([*fresh, ("new", now, 1, 60)])


def test_table_as_a_sink(spark, tables, tmp_path):
    _, writes = tables
    writes = writes.filter("key IS NOT NULL")
    for part in writes.randomSplit([1.0, 1.0, 1.0], 3):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    table = state.EntryTable(spark, f"file://{tmp_path}/entries", writes.schema, ["key"])
    for _ in range(2):  # the second time from the beginning, into the same table
        stream = spark.readStream.schema(writes.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        stream.writeStream.foreachBatch(table.upsert).option("checkpointLocation", f"{tmp_path}/c{_}").trigger(availableNow=True).start().awaitTermination()
    want = cache.live_entries(writes, F.lit(START + 20 * DAY), ["key"])
    found = table.read(START + 20 * DAY).select("key", "data", (F.col("written_at") + F.col("ttl")).alias("expires"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and table.read().count() == writes.select("key").distinct().count()
