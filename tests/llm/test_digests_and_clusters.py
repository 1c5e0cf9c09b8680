"""Fingerprints, the Merkle manifest and clustering against plain versions, and on awkward tables."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackforge.llm import centroids, fingerprints, manifest, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def prose(r, n, pool=300):
    return " ".join(f"{r.choice('bcdfg')}{r.randrange(pool)}{r.choice(['ing', 'ed', 'lich', 'é'])}" for _ in range(n))


# ---- 11 fingerprints


def plain_entropy(window):
    counts = collections.Counter(window)
    total = sum(round(fingerprints._UNIT * c * math.log2(c)) for c in counts.values())
    return 1000 * (fingerprints._FULL - total) // fingerprints._FULL


def plain_features(data, rank):
    """Every neighbourhood, also those over the ends, names its best window."""
    w, around = fingerprints.WINDOW, fingerprints.AROUND
    if len(data) < w:
        return [data] if data else []
    places = [(rank[plain_entropy(data[i : i + w])], i) for i in range(len(data) - w + 1)]
    votes = collections.Counter(min(places[max(s, 0) : s + around])[1] for s in range(1 - around, len(places)))
    return [data[i : i + w] for i in sorted(votes) if votes[i] >= fingerprints.POPULAR]


def plain_chain(features):
    from trackforge.llm.common import mixed, span_hashes

    filters, held, bits = [], 0, np.zeros(fingerprints.BITS, np.uint8)
    for f in dict.fromkeys(features):
        h = span_hashes(np.frombuffer(f, np.uint8), np.array([0]), np.array([len(f)]))
        for i in range(fingerprints.HASHES):
            bits[int(mixed(h + np.uint64(i * 0x9E3779B97F4A7C15 & (2**64 - 1)))[0]) % fingerprints.BITS] = 1
        held += 1
        if held == fingerprints.PER_FILTER or held >= fingerprints.LEAST and int(h[0]) % fingerprints.MARKED == 0:
            filters.append(np.packbits(bits))
            held, bits = 0, np.zeros(fingerprints.BITS, np.uint8)
    return [*filters, np.packbits(bits)] if held else filters


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    out = [prose(r, n) for n in (3, 8, 40, 120, 700)] + ["", "a", "short one", "x" * 300, "-" * 40 + prose(r, 30), "日本語テキスト " * 9 + "🙂"]
    return out + [out[3], out[4] + " and a tail"]


def test_features_and_chains_equal_a_plain_walk(texts, monkeypatch):
    monkeypatch.setattr(fingerprints, "PIECE", 97)  # many pieces
    counts = collections.Counter(plain_entropy(t.encode()[i : i + fingerprints.WINDOW]) for t in texts for i in range(len(t.encode()) - fingerprints.WINDOW + 1))
    encoded = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, encoded)])
    found = fingerprints.histogram(np.frombuffer(b"".join(encoded), np.uint8), offsets)
    assert {i: int(n) for i, n in enumerate(found) if n} == dict(counts)
    rank = fingerprints.ranks(found)
    values = sorted(range(fingerprints.ENTROPIES), key=lambda v: (v < fingerprints.LOW, counts[v], -v))
    assert [int(rank[v]) for v in values] == list(range(fingerprints.ENTROPIES))
    for text, chain in zip(texts, fingerprints.chains(texts, rank)):
        want = plain_chain(plain_features(text.encode(), rank.tolist()))
        assert len(chain.bits) == len(want) and all((a == b).all() for a, b in zip(chain.bits, want))
        assert chain.text() == fingerprints.chains([text], rank)[0].text() == fingerprints.Chain.parse(chain.text()).text()


def test_likeness_tells_copies_from_others():
    r = random.Random(7)
    texts = [prose(r, 400, 20000) for _ in range(20)]
    rank = fingerprints.ranks(fingerprints.histogram(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])))
    one = fingerprints.chains(texts, rank)
    near = fingerprints.chains([t[: len(t) * 3 // 4] + u[: len(u) // 4] for t, u in zip(texts, texts[1:] + texts[:1])], rank)
    shared = [fingerprints.likeness(a, b) for a, b in zip(one, near)]
    others = [fingerprints.likeness(one[i], one[j]) for i in range(20) for j in range(i)]
    assert min(shared) > 0.55 and max(others) < 0.1
    assert all(fingerprints.likeness(a, b) == fingerprints.likeness(b, a) for a, b in zip(one, near))
    empty = fingerprints.chains([""], rank)[0]
    assert fingerprints.likeness(empty, empty) == 1 and fingerprints.likeness(empty, one[0]) == 0 and all(fingerprints.likeness(c, c) == 1 for c in one)


@pytest.mark.parametrize("partition_rows", [3, 1 << 14])
def test_neighbours_over_partitions(spark, texts, partition_rows):
    table = [(i * 3 % 41, t, None, None, None) for i, t in enumerate(texts)] + [(None, None, None, None, None), (7, texts[4], "x", "y", 1), (7, texts[4], "x", "y", 1)]
    docs = spark.createDataFrame(table, DOCS).withColumn("kind", F.lit(9)).withColumn("part", F.lit("clash"))
    rank = fingerprints.corpus_ranks(docs)
    found = fingerprints.neighbours(docs, rank, partition_rows=partition_rows)
    by_id = collections.defaultdict(set)
    for r in found.collect():
        by_id[r["doc_id"]].add((r["fingerprint"], r["n_chars"]))
    assert found.count() == len(table) and len(by_id[7]) == 1
    unique = [(i, t or "") for i, t, *_ in table if i != 7]
    chain = {t: c for t, c in zip([t for _, t in unique], fingerprints.chains([t for _, t in unique], rank))}
    assert all(by_id[i] == {(chain[t].text(), len(t))} for i, t in unique)
    order = sorted(table, key=lambda r: (r[0] is not None, r[0] or 0))
    follows = {a[0]: (a[1] or "", b[1] or "") for a, b in zip(order, order[1:] + order[:1]) if a[0] != 7}
    for r in found.collect():
        if r["doc_id"] in follows:
            own, after = follows[r["doc_id"]]
            n = len(own) // 4
            changed = own[: len(own) - n] + after[:n]
            a, b, c = fingerprints.chains([own, changed, after], rank)
            assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest() and r["edited_fingerprint"] == b.text()
            assert (r["near_edited"], r["near_next"]) == (fingerprints.likeness(a, b), fingerprints.likeness(a, c))


def test_neighbours_of_few_rows(spark):
    assert fingerprints.neighbours(spark.createDataFrame([], DOCS)).count() == 0
    (alone,) = fingerprints.neighbours(spark.createDataFrame([(5, "one lonely document of some words", None, None, None)], DOCS)).collect()
    assert alone["near_next"] == 1.0 and alone["doc_id"] == 5
    long = prose(random.Random(1), 60000)
    both = fingerprints.neighbours(spark.createDataFrame([(1, long, None, None, None), (2, long[1000:], None, None, None)], DOCS)).collect()
    assert all(r["near_next"] > 0.85 for r in both)


# ---- 12 manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, fanout):
    """The top and each leaf's siblings, level by level."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place // fanout * fanout
            proofs[i] += [x for j, x in enumerate(level[run : run + fanout], run) if j != place]
            at[i] = place // fanout
        level = [h(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], proofs


def plain_manifest(table, fanout):
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in table:
        groups[lang].append((doc_id is not None, doc_id or 0, plain_leaf(doc_id, source, lang, n_chars, text)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])], fanout) for g in names}
    root, above = plain_tree([trees[g][0] for g in names], fanout)
    out = []
    for g, up in zip(names, above):
        out += [(x[1] if x[0] else None, x[2], trees[g][0], root, h(*proof, *up)) for x, proof in zip(sorted(groups[g]), trees[g][1])]
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize(("fanout", "partition_rows", "at_once"), [(2, 5, 2), (2, 1 << 16, 64), (3, 7, 4), (5, 2, 3)])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, fanout, partition_rows, at_once):
    monkeypatch.setattr(manifest, "MERGED_AT_ONCE", at_once)
    r = random.Random(fanout)
    table = [(i * 2, prose(r, 3), r.choice(["en", "de", "", None, "zß", "en"]), "s", 5) for i in range(60)] + [(9, None, "one", None, None), (None, "", None, None, 0)]
    table += [table[5]] * 20 + [(8, "other", "en", "s", 5)]
    docs = spark.createDataFrame(table, DOCS).withColumn("grp", F.lit("clash")).withColumn("hash", F.lit(1))
    found = manifest.proofs(manifest.manifest(docs, COLUMNS, "lang", ["doc_id"], fanout=fanout, partition_rows=partition_rows))
    assert rows(found.select("doc_id", "leaf", "subroot", "root", "proof_sha256")) == plain_manifest(table, fanout)
    assert found.filter("verified and folded_root = root").count() == len(table)


def test_tampering_is_found(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", i if i % 5 else None) for i in range(100)], DOCS)
    docs.write.mode("overwrite").parquet("/tmp/trackforge-tests/tampered/documents.parquet")
    found = queries.op12_merkle_manifest(spark, "/tmp/trackforge-tests/tampered")
    for r in found.collect():
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["doc_id"] % 5
        assert r["verified"] == (not changed) and (r["folded_root"] == r["root"]) == r["verified"]


def test_manifest_of_few_rows(spark):
    assert manifest.proofs(manifest.manifest(spark.createDataFrame([], DOCS), COLUMNS, "lang", ["doc_id"])).count() == 0
    (one,) = manifest.proofs(manifest.manifest(spark.createDataFrame([(1, "t" * 300000, None, None, None)], DOCS), COLUMNS, "lang", ["doc_id"])).collect()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == h() and one["verified"]


def test_range_carries_in_any_base():
    for fanout in (2, 3, 4):
        for start, n in ((0, 1), (0, 30), (1, 1), (5, 23), (8, 8), (7, 2)):
            peaks = manifest.Range(fanout)
            leaves = [h(str(i)) for i in range(n)]
            for i in range(0, n, 4):
                peaks.add(start + i, leaves[i : i + 4])
            at = {(level, i) for level, i, _ in peaks.close()}
            want, here = set(), set(range(start, start + n))
            for level in range(8):
                up = {i // fanout for i in here if all(i // fanout * fanout + j in here for j in range(fanout))}
                want |= {(level, i) for i in here if i // fanout not in up}
                here = up
            assert at == want


# ---- 13 clustering


def plain_clusters(table, k, rounds, dim, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in table if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in first[:k]]
    for step in range(rounds + 1):
        nearest = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at)) for _, v in kept]
        if step < rounds:
            groups = collections.defaultdict(list)
            for (_, v), (_, j) in zip(kept, nearest):
                groups[j].append(v)
            at = [[sum(x) // len(x) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(at)]
    return sorted(((i, j, d) for (i, _), (d, j) in zip(kept, nearest)), key=repr), at


def vectors(spark, table):
    return spark.createDataFrame(table, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash")).withColumn("near", F.lit(2))


@pytest.mark.parametrize(("k", "bounds"), [(1, 4), (3, 4), (16, 4), (16, 1), (16, 0), (40, 4)])
def test_clusters_equal_plain_scans(spark, k, bounds):
    r = np.random.default_rng(k)
    grid = np.round(r.normal(size=(150, 4)) * 2) / 4  # many ties
    table = [(i, [float(x) for x in v]) for i, v in enumerate(grid)] + [(3, [0.0] * 4), (3, [0.0] * 4), (None, [1.0] * 4), (200, None), (201, [1.0] * 3), (202, [1.0, None, 0.0, 0.0])]
    table += [(203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0])]
    state, at = centroids.cluster(vectors(spark, table), k=k, rounds=5, dim=4, scale=8, bounds=bounds)
    want, centres = plain_clusters(table, k, 5, 4, 8)
    assert rows(state.select("vec_id", "cluster", "distance")) == want and at == centres


def test_bounds_save_distances_where_vectors_gather(spark):
    r = np.random.default_rng(1)
    middles = r.normal(size=(16, 8)) * 20
    table = [(i, [float(x) for x in middles[i % 16] + r.normal(size=8)]) for i in range(3000)]
    state, _ = centroids.cluster(vectors(spark, table), k=16, rounds=4, dim=8)
    assert rows(state.select("vec_id", "cluster", "distance")) == plain_clusters([(i, np.float32(v).tolist()) for i, v in table], 16, 4, 8, 64)[0]
    assert state.agg(F.avg("worked_out")).first()[0] < 4


def test_large_components_stay_exact(spark):
    table = [(i, [float(2.0**22 + i), -(2.0**22), float(i % 3)]) for i in range(40)]
    state, at = centroids.cluster(vectors(spark, table), k=5, dim=3)
    assert rows(state.select("vec_id", "cluster", "distance")) == plain_clusters(table, 5, 3, 3, 64)[0]


def test_report_and_empty_tables(spark, sf_dir):
    state, at = centroids.cluster(vectors(spark, []))
    assert at == [] and centroids.report(state, at).count() == 0
    found = queries.op13_drake_clustering(spark, sf_dir).toPandas()
    assert (found.groupby("cluster").distance.sum() == found.groupby("cluster").cluster_inertia.first()).all() and (found.inertia == found.distance.sum()).all()
