"""Consistent-hash ring with virtual nodes and bounded loads; DataFrame functions only.

Ids and virtual nodes are hashed to cells of a ring; a cell belongs to the next
virtual node clockwise.  A shard may hold at most its share of the rows.  A
shard that is offered more keeps its share, spread evenly over its cells; the
rest overflows and continues clockwise, in ring order, to the first virtual
node of a shard with room (its room is dealt evenly to its nodes).  With the
load factor 1 every shard ends with exactly its share: row counts differ by at
most one.  Adding or removing a shard moves the rows of its own arcs and what
overflows, not the rest.

How many rows overflow where is worked out on the table of cells alone, whose
size is fixed (``cells``): prefix sums and a running maximum give the same
places as walking the ring with each overflowing row in turn.  The rows
themselves are only ranked within their cell: equal rows are counted first, a
cell with many different rows is ranked in parts (by a hash of the row, about
``cell_rows`` each) whose sums are added up, and the copies of a row are
numbered ``chunk`` at a time.  So an id, or a lack of one, that holds a large
part of all rows is spread over the tasks, be its rows equal or not.

Defined results: a null text has no bytes; rows without an id share one place on
the ring, as do rows that repeat an id; equal rows are interchangeable; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from trackforge.llm.common import checkpointed

BITS = 14  # 16,384 cells


def _cell(position: Column) -> Column:
    return F.shiftrightunsigned(position, 64 - BITS).cast("int")


def ring(spark: SparkSession, n_shards: int, n_nodes: int) -> DataFrame:
    """cell, shard, node (whether a virtual node stands there): the owner of every cell."""
    nodes = spark.range(n_shards * n_nodes, numPartitions=1).select(
        (F.col("id") % n_shards).cast("int").alias("at"), _cell(F.xxhash64(F.lit("node"), F.col("id") % n_shards, F.floor(F.col("id") / n_shards))).alias("cell")
    )
    first = nodes.groupBy("cell").agg(F.min("at").alias("at"))
    onward = Window.orderBy("cell").rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = spark.range(1 << BITS, numPartitions=1).select(F.col("id").cast("int").alias("cell")).join(first, "cell", "left")
    owner = F.coalesce(F.first("at", ignorenulls=True).over(onward), F.first("at", ignorenulls=True).over(whole))
    return cells.select("cell", owner.alias("shard"), F.col("at").isNotNull().alias("node"))


def _deal(total: Column, part: Column, whole: Column) -> Column:
    """floor(total * part / whole), exact."""
    wide = "decimal(38,0)"
    return F.floor(total.cast(wide) * part.cast(wide) / F.greatest(whole, F.lit(1)).cast("decimal(19,0)")).cast("long")


def plan(offered: DataFrame, n_shards: int) -> tuple[DataFrame, DataFrame]:
    """From cell, shard, node, n: what each cell keeps, and where its overflow goes.

    Cells: cell, shard, keep, base (the slot of its first kept row).  Segments:
    cell, low, high, to_shard, to_slot (of overflow ranks low to high - 1).
    """
    by_shard, in_shard = Window.partitionBy("shard"), Window.partitionBy("shard").orderBy("cell")
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("n").over(whole)
    cells = (
        offered.withColumn("cap", F.floor(total / n_shards).cast("long") + (F.col("shard") < total % n_shards).cast("long"))
        .withColumn("load", F.sum("n").over(by_shard))
        .withColumn("nodes", F.sum(F.col("node").cast("long")).over(by_shard))
        .withColumn("so_far", F.sum("n").over(in_shard))
        .withColumn("nth", F.sum(F.col("node").cast("long")).over(in_shard))
    )
    over, spare = F.col("load") > F.col("cap"), F.greatest(F.col("cap") - F.col("load"), F.lit(0))
    kept = F.when(over, _deal(F.col("cap"), F.col("so_far"), F.col("load")) - _deal(F.col("cap"), F.col("so_far") - F.col("n"), F.col("load"))).otherwise(F.col("n"))
    room = F.when(F.col("node"), _deal(spare, F.col("nth"), F.col("nodes")) - _deal(spare, F.col("nth") - 1, F.col("nodes"))).otherwise(F.lit(0))
    cells = cells.withColumn("keep", kept).withColumn("room", room.cast("long")).withColumn("out", F.col("n") - F.col("keep"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    cells = cells.withColumn("base", before("keep", in_shard)).withColumn("room_before", before("room", in_shard))
    # the walk begins after the cell where least overflow is under way, so none arrives from before
    cells = cells.withColumn("under_way", F.sum(F.col("out") - F.col("room")).over(Window.orderBy("cell")))
    start = F.first("cell").over(Window.orderBy("under_way", F.desc("cell")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    cells = cells.withColumn("turn", F.pmod(F.col("cell") - start - 1, F.lit(1 << BITS)))
    walk = Window.orderBy("turn")
    cells = cells.withColumn("rank", before("out", walk)).withColumn("place", before("room", walk))
    cells = cells.withColumn("lag", F.max(F.when(F.col("out") > 0, F.col("place") - F.col("rank"))).over(walk))
    cells = checkpointed(cells.select("cell", "shard", "keep", "base", "out", "room", "room_before", "load", "rank", "place", "lag").coalesce(1))
    leaving = cells.filter("out > 0").select((F.col("rank") + F.col("lag")).alias("at"), F.struct(F.col("cell"), (F.col("rank") + F.col("lag")).alias("from"), F.col("out").alias("n")).alias("leaving"))
    taking = cells.filter("room > 0").select(
        F.col("place").alias("at"),
        F.struct(F.col("shard"), F.col("place").alias("from"), F.col("room").alias("n"), (F.col("load") + F.col("room_before")).alias("slot")).alias("taking"),
    )
    marks = leaving.unionByName(taking, allowMissingColumns=True).groupBy("at").agg(F.max("leaving").alias("leaving"), F.max("taking").alias("taking"))
    along = Window.orderBy("at")
    marks = marks.select(
        "at", F.lead("at").over(along).alias("next"), F.last("leaving", ignorenulls=True).over(along).alias("leaving"), F.last("taking", ignorenulls=True).over(along).alias("taking")
    )
    high = F.least(F.col("next"), F.col("leaving.from") + F.col("leaving.n"), F.col("taking.from") + F.col("taking.n"))
    segments = marks.withColumn("high", high).filter(F.col("high") > F.col("at")).select(
        F.col("leaving.cell").alias("cell"),
        (F.col("at") - F.col("leaving.from")).alias("low"),
        (F.col("high") - F.col("leaving.from")).alias("high"),
        F.col("taking.shard").alias("to_shard"),
        (F.col("taking.slot") + F.col("at") - F.col("taking.from")).alias("to_slot"),
    )
    return cells.select("cell", "shard", "keep", "base"), segments


def _ranked(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Different rows with ``first``, the number of rows in their cell before them, copies counted."""
    parted = rows.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.col("parts")))  # 2^BITS rows
    before = lambda w: F.coalesce(F.sum("copies").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sums = parted.groupBy("cell", "part").agg(F.sum("copies").alias("copies"))
    sums = sums.select("cell", "part", before(Window.partitionBy("cell").orderBy("part")).alias("ahead"))
    within = parted.withColumn("nth", before(Window.partitionBy("cell", "part").orderBy("position", "doc_id", "size", "text_crc32")))
    return within.join(sums, ["cell", "part"]).select("cell", "doc_id", "size", "text_crc32", "copies", (F.col("ahead") + F.col("nth")).alias("first"))


def _each(ranked: DataFrame, chunk: int) -> DataFrame:
    """One row with its rank for every copy; a row of more than ``chunk`` copies is dealt over the tasks."""
    step = F.lit(chunk).cast("long")
    few = ranked.filter(F.col("copies") <= step).withColumn("from", F.lit(0).cast("long"))
    many = ranked.filter(F.col("copies") > step).withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, step)))
    many = many.repartition(int(ranked.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "text_crc32", "from")
    copy = F.explode(F.sequence("from", F.least(F.col("from") + step, F.col("copies")) - 1))
    return few.unionByName(many).withColumn("copy", copy).select("cell", "doc_id", "size", "text_crc32", (F.col("first") + F.col("copy")).alias("rank"))


def shard(documents: DataFrame, n_shards: int = 24, n_nodes: int = 128, cell_rows: int = 1 << 18, chunk: int = 1 << 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    ``cell_rows`` is how many different rows of a cell a task ranks, ``chunk``
    how many copies of a row it numbers; both bound tasks, not results.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.xxhash64("doc_id").alias("position"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    rows = rows.groupBy("position", "doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    rows = checkpointed(rows.withColumn("cell", _cell(F.col("position"))))
    counts = rows.groupBy("cell").agg(F.sum("copies").alias("n"), F.ceil(F.count("*") / cell_rows).alias("parts"))
    offered = ring(spark, n_shards, n_nodes).join(counts, "cell", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    offered = checkpointed(offered.coalesce(1))
    cells, segments = plan(offered, n_shards)
    ranked = checkpointed(_ranked(rows, offered.filter("parts > 0").select("cell", "parts")))
    placed = _each(ranked, chunk).join(F.broadcast(cells), "cell")  # 2^BITS rows
    moved = F.broadcast(segments.withColumnRenamed("cell", "from_cell"))  # two rows a cell at most
    beyond = F.col("rank") - F.col("keep")
    placed = placed.join(moved, (F.col("cell") == F.col("from_cell")) & (beyond >= 0) & (beyond >= F.col("low")) & (beyond < F.col("high")), "left")
    stays = F.col("rank") < F.col("keep")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.when(stays, F.col("shard")).otherwise(F.col("to_shard")).cast("int").alias("shard"),
        F.when(stays, F.col("base") + F.col("rank")).otherwise(F.col("to_slot") + beyond - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
