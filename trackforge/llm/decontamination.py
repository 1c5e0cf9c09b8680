"""Benchmark passages in documents, found by winnowing; DataFrame functions only.

A text's words are hashed, every six words in a row make a k-gram hash, and of
each eight k-grams in a row (thirteen words) the least hash is kept as a
fingerprint.  Equal windows of thirteen words keep equal fingerprints, so
joining the documents' fingerprints with the items' misses no shared span of
thirteen words or more.  Items of fewer words are one window of their own
length and are fingerprinted by the hash of all their words; documents are
hashed at that length only where such items exist.  Where a fingerprint is
shared, the hit is extended: whole windows are compared (by 128-bit hashes of
their exact words) and the document words inside any equal window are counted.

Fingerprints may ignore more than the exact words do (they use Unicode lower
case), never less.  The items' fingerprints and windows are broadcast only if
they are at most ``broadcast_rows``; beyond that the joins shuffle.

Defined results: a null text has no words, no hits and is not contaminated;
items without an id or without words take no part; repeated items count once
by id; repeated document rows are reported each; an empty benchmark hits
nothing; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackforge.llm.common import checkpointed

WINDOW, GRAM = 13, 6
#: Words of a text in any case; lower-casing A-Z changes no word's extent.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _shifted(x: Column, by: int) -> Column:
    return F.slice(x, by + 1, F.greatest(F.size(x) - by, F.lit(0)))


def _runs(df: DataFrame, source: str, lengths: set[int], seed: int = 0) -> DataFrame:
    """Adds ``source_n``, the hashes of n items in a row, for each length, by joining runs of powers of two."""
    lengths = {n for n in lengths if n > 1}
    powers = [1 << i for i in range(1, max(lengths, default=1).bit_length())]
    if not lengths:
        return df.withColumn(f"{source}_1", F.col(source))
    name = lambda n: source if n == 1 else f"{source}_{n}"
    joined = lambda a, b, by: F.zip_with(a, _shifted(b, by), lambda x, y: F.xxhash64(x, y, F.lit(seed)))
    for p in powers:
        df = df.withColumn(name(p), joined(F.col(name(p // 2)), F.col(name(p // 2)), p // 2))
    for n in sorted(lengths - set(powers)):
        parts = [p for p in (8, 4, 2, 1) if n & p]
        run, done = F.col(name(parts[0])), parts[0]
        for i, p in enumerate(parts[1:]):
            df = df.withColumn(step := f"{name(n)}_{i}" if i < len(parts) - 2 else name(n), joined(run, F.col(name(p)), done))
            run, done = F.col(step), done + p
    return df.withColumn(f"{source}_1", F.col(source))


def _whole(runs: Column, n_words: Column, length: int) -> Column:
    """Without the runs that reach over the end of the text."""
    return F.slice(runs, 1, F.greatest(n_words - (length - 1), F.lit(0)))


def _minima(df: DataFrame, source: str) -> DataFrame:
    """Adds ``least``: the least k-gram hash of every window."""
    df = df.withColumn("least", _whole(F.col(source), F.col("n_words"), GRAM))
    for p in (1, 2, 4):
        df = df.withColumn("least", F.zip_with("least", _shifted(F.col("least"), p), lambda x, y: F.least(x, y)))
    return df.withColumn("least", _whole(F.col("least"), F.col("n_words"), WINDOW))


def _fingerprints(texts: DataFrame, keep: list[str], short: set[int]) -> DataFrame:
    """``keep``, n_words and ``prints``: fingerprints of windows, and hashes at each short length."""
    hashed = texts.select(*keep, F.transform(words(F.col("text")), lambda w: F.xxhash64(F.lower(w))).alias("h")).withColumn("n_words", F.size("h"))
    found = _minima(_runs(hashed, "h", short | {GRAM}), f"h_{GRAM}")
    parts = [F.col("least"), *(F.when(_if_item(texts, n), _whole(F.col(f"h_{n}"), F.col("n_words"), n)).otherwise(F.array().cast("array<bigint>")) for n in sorted(short))]
    return found.select(*keep, "n_words", F.array_distinct(F.concat(*parts)).alias("prints"))


def _if_item(texts: DataFrame, n: int) -> Column:
    """Items are hashed at their own length only."""
    return (F.col("n_words") == n) if "item_id" in texts.columns else F.lit(True)


def _windows(texts: DataFrame, keep: list[str], short: set[int]) -> DataFrame:
    """``keep``, start, length and 128-bit hash of every window of thirteen words and of each short length."""
    exact = texts.withColumn("w", words(F.translate("text", UPPER, LOWER)))
    exact = exact.select(*keep, F.transform("w", lambda w: F.xxhash64(w)).alias("a"), F.transform("w", lambda w: F.xxhash64(F.lit(7), w)).alias("b")).withColumn("n_words", F.size("a"))
    lengths = short | {WINDOW}
    exact = _runs(_runs(exact, "a", lengths, 1), "b", lengths, 2)
    out = None
    for n in sorted(lengths):
        rows = exact.filter(_if_item(texts, n)) if n < WINDOW else exact
        zipped = F.arrays_zip(_whole(F.col(f"a_{n}"), F.col("n_words"), n).alias("a"), _whole(F.col(f"b_{n}"), F.col("n_words"), n).alias("b"))
        part = rows.select(*keep, F.posexplode(zipped).alias("start", "z")).select(*keep, F.col("start").cast("long"), F.lit(n).alias("length"), F.col("z")["a"].alias("a"), F.col("z")["b"].alias("b"))
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every document row."""
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    short = {r.n for r in items.select(F.size(words(F.col("text"))).alias("n")).filter(f"n > 0 AND n < {WINDOW}").distinct().collect()}

    def small(df: DataFrame) -> DataFrame:
        """Broadcast if it has at most broadcast_rows rows."""
        df = checkpointed(df)
        return F.broadcast(df) if df.count() <= broadcast_rows else df

    item_prints = small(_fingerprints(items, ["item_id"], short).select(F.explode("prints").alias("print")).distinct())
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = _fingerprints(texts.withColumn("row", F.monotonically_increasing_id()), ["row", "doc_id", "text_hash"], short)
    each = rows.select("row", "doc_id", "text_hash", "n_words", F.explode_outer("prints").alias("print"))
    marked = each.join(item_prints.withColumn("shared", F.lit(1)), "print", "left")
    base = checkpointed(marked.groupBy("row", "doc_id", "text_hash", "n_words").agg(F.max("shared").alias("shared")))

    suspects = small(base.filter("shared = 1").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    suspected = texts.join(suspects, same, "left_semi")
    item_windows = small(_windows(items, ["item_id"], short).select("item_id", "length", "a", "b").distinct())
    hits = _windows(suspected, ["doc_id", "text_hash"], short).join(item_windows, ["length", "a", "b"]).select("doc_id", "text_hash", "start", "length", "item_id")
    hits = checkpointed(hits)

    key = ["doc_id", "text_hash"]
    spans = hits.groupBy(*key, "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(F.lit(0).cast("long"), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0).cast("long"))))
    covered = spans.withColumn("fresh", fresh).groupBy(*key).agg(F.sum("fresh").alias("n_hit"))
    held = (
        hits.select(*key, "item_id").distinct().groupBy(*key)
        .agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ","), 256).alias("items_sha256"))
    )
    found = covered.join(held.withColumnsRenamed({"doc_id": "id", "text_hash": "hash"}), same).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "n_hit", "n_items", "items_sha256")
    n_words, n_hit = F.col("n_words").cast("long"), F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.join(found, same, "left").select(
        "doc_id",
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= n_words)).alias("contaminated"),
        "text_hash",
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever these are named; none without id or text is."""
    judged = decontaminate(documents, benchmark, broadcast_rows).filter("contaminated")
    gone = checkpointed(judged.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct())
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone
    return documents.join(gone, documents["doc_id"].eqNullSafe(gone["id"]) & (F.xxhash64(documents["text"]) == gone["hash"]), "left_anti")
