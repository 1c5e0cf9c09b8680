"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from page_layouts import LAYOUTS
from secret_examples import HARMLESS, SECRETS
from trackforge.llm import chat, components, decontamination, html_content, near_duplicates, packing, quality, secret_lines, secrets, sharding, tokens, topk, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n, pool=400):
    return " ".join(f"w{r.randrange(pool)}" for _ in range(n))


def awkward(r):
    """Documents with every awkward case once."""
    base = words(r, 60)
    texts = [None, "", "  \n", "!!! ???", "one", "one two three", base, base, base.upper(), base + " tail", words(r, 5000), "日本語 Ünïcode ﬁ ½ 🙂", words(r, 40)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[6], (None, base, None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(random.Random(1)), DOCS).withColumn("n_grams", F.lit("clash")).withColumn("spans", F.lit(1))


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- 1 packing


def test_packing_is_a_partition_of_all_ids(spark, docs):
    found = packing.pack(docs, size=64, with_ids=True).toPandas()
    tokenizer = Tokenizer.from_file(tokens.default_path())
    by_doc = {}
    for d, t, *_ in awkward(random.Random(1)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        by_doc.setdefault(d, []).append(ids)
    assert found.length.sum() == sum(len(i) for x in by_doc.values() for i in x)
    for d, group in found[found.doc_id.notna()].groupby("doc_id"):
        if len(by_doc[d]) == 1:
            pieces = group.sort_values("start")
            assert [i for p in pieces.ids for i in p] == by_doc[d][0]
            assert (pieces.start == pieces.length.cumsum() - pieces.length).all() and (pieces.doc_tokens == len(by_doc[d][0])).all()
    assert all(c == zlib.crc32(np.array(i, "<u4").tobytes()) for c, i in zip(found.ids_crc32, found.ids))
    for _, s in found.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset == s.length.cumsum() - s.length).all() and s.length.sum() <= 64


def test_packing_leaves_little_padding_and_bounds_open_windows():
    r = random.Random(2)
    packer, sizes, done = packing.SumOfSquares(2048, max_open=50), [r.randrange(1, 5000) for _ in range(3000)], []
    for i, n in enumerate(sizes):
        open_ = packer.open
        done += packer.add(i, np.arange(n, dtype=np.uint32))
        assert open_ * 0.6 - 1 <= packer.open <= 50  # one is filled, most others stay
        assert packer.open == packer.count.sum() == sum(map(len, packer.windows))
        assert all(sum(len(p[2]) for p in w) == level for level, ws in enumerate(packer.windows) for w in ws)
    done += packer.close()
    filled = [sum(len(p[2]) for p in w) for w in done]
    assert sum(filled) == sum(sizes) and sum(f < 2048 for f in filled) <= 1
    for i, n in enumerate(sizes):
        own = sorted((start, ids) for w in done for d, start, ids, _ in w if d == i)
        assert np.array_equal(np.concatenate([ids for _, ids in own]), np.arange(n))


def test_packing_of_an_empty_table(spark, no_docs):
    assert packing.pack(no_docs).count() == 0


def test_level_minimises_the_sum_of_squares():
    r = random.Random(3)
    packer = packing.SumOfSquares(32)
    for _ in range(400):
        s = r.randrange(1, 32)
        count = packer.count.copy()

        def after(h):
            c = count.copy()
            if h:
                c[h] -= 1
            if h + s < 32:
                c[h + s] += 1
            return int((c[1:] ** 2).sum())

        options = [h for h in range(0, 33 - s) if h == 0 or count[h]]
        assert after(packer.level(s)) == min(map(after, options))
        packer.add(0, np.zeros(s, np.uint32))


def test_word_encoder_equals_the_tokenizer():
    encoder = tokens.WordEncoder(max_words=20)
    for t in ["don't it'S 's", "½x² __a_b-- 12ab3 €5…—x", "İ Σας é \x1c b", "", "  ", "<|endoftext|> a", "a" * 500, "naïve Ça œuvre ŉ ſ"]:
        assert encoder.encode(t).tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


# ---- 2 quality


def test_resampling_keeps_good_and_drops_junk(spark, no_docs):
    r = random.Random(4)
    good = [(i, words(r, r.randrange(3, 200)), "en", "s", 0) for i in range(600)]
    junk = [(1000 + i, " ".join(f"w{r.randrange(400)}***" for _ in range(r.randrange(20, 200))), "en", "s", 0) for i in range(150)]
    extra = [(5000, None, None, None, None), (5001, "", None, None, None), (None, words(r, 30), None, None, None), good[0]]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(1000 + i, 0, 0) for i in range(60)] + [(None, 1, None), (7, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    all_ = spark.createDataFrame(good + junk + extra, DOCS).withColumn("log_weight", F.lit("clash")).repartition(3)
    kept = [x.doc_id for x in quality.resample(all_, labels).collect()]
    assert sum(d is not None and d < 600 for d in kept) >= 599 and sum(d is not None and 1000 <= d < 1150 for d in kept) <= 3
    assert quality.resample(no_docs, labels).count() == 0
    assert quality.resample(all_, labels.filter("quality = 1")).count() == len(good + junk + extra)


def test_toxic_documents_are_not_good(spark):
    r = random.Random(18)
    good = [(i, words(r, r.randrange(20, 200)), "en", "s", 0) for i in range(600)]
    toxic = [(1000 + i, " ".join(f"w{r.randrange(400)}***" for _ in range(r.randrange(20, 200))), "en", "s", 0) for i in range(150)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(1000 + i, 1, 1) for i in range(60)], "doc_id long, quality int, toxic int")
    kept = [x.doc_id for x in quality.resample(spark.createDataFrame(good + toxic, DOCS), labels).collect()]
    assert sum(d < 600 for d in kept) >= 599 and sum(d >= 1000 for d in kept) <= 3


def test_a_few_toxic_words_tell_of_a_long_text(spark):
    r = random.Random(29)
    docs = []
    for i in range(900):
        w = words(r, r.randrange(100, 400)).split()
        for _ in range(0 if i % 6 else r.randrange(2, 5)):
            w.insert(r.randrange(len(w)), f"slur{r.randrange(4)}")
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs + [(2000, None), (2001, "")], "doc_id long, text string").withColumn("toxic_evidence", F.lit("clash")).repartition(3)
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    kept = {x.doc_id for x in quality.resample(df, labels).collect()}
    assert sum(i in kept for i in range(900) if i % 6 == 0) <= 3 and sum(i not in kept for i in range(900) if i % 6) <= 3 and {2000, 2001} <= kept

    # the filter holds however many are drawn, and the weight knows nothing of it
    everything = quality.resample(df, labels, k=2000).collect()
    assert sum(x.doc_id % 6 == 0 for x in everything if x.doc_id < 900) <= 3 and len(everything) >= 740
    noise = {x.doc_id: x.g for x in df.select("doc_id", quality.gumbel(17).alias("g")).collect()}
    told, scored = [x for x in everything if x.toxic_evidence > 0], [x.log_weight for x in everything if x.doc_id < 900]
    assert np.allclose([x.gumbel_key - noise[x.doc_id] for x in everything], [x.log_weight for x in everything])
    assert all(abs(x.log_weight - np.mean(scored)) < 8 * np.std(scored) for x in told)

    marked = df.filter("doc_id < 600").select("doc_id", "text", (F.col("doc_id") % 6 == 0).cast("int").alias("toxic"), (F.col("doc_id") % 2 == 0).alias("fits"))
    found = dict(zip(*(x.tolist() for x in quality.telling_ngrams(marked, 5.0, 24.0, 2.0))))
    a, n, A, B = {}, {}, 100, 200
    for i, t in docs[:600:2]:
        for x in set(np.concatenate([b for _, b in quality.ngram_buckets(pa.array([t]), quality.FINE_BITS)]).tolist()):
            a[x], n[x] = a.get(x, 0) + (i % 6 == 0), n.get(x, 0) + 1
    want = {}
    for x, k in a.items():
        b = n[x] - k
        g = 2 * sum(c * np.log(c * (A + B) / (n[x] * of)) for c, of in ((k, A), (b, B)) if c)
        if k >= 5 * (b + 1) and k * B > b * A and g >= 24:
            share = 2.0 * n[x] / (A + B)
            want[x] = np.log((k + share) / (A + 2)) - np.log((b + share) / (B + 2))
    assert found.keys() == want.keys() and len(want) >= 4 and np.allclose([found[x] for x in want], list(want.values()))
    assert all(len(x) == 0 for x in quality.telling_ngrams(marked.withColumn("toxic", F.lit(0)), 5.0, 24.0, 2.0))


def test_resampling_equals_a_plain_version(spark):
    r, n = random.Random(23), 400
    docs = [(i, " ".join(("g" if i % 3 else "b") + str(r.randrange(60)) for _ in range(r.choice((0, 1, 30, 200))))) for i in range(n)] + [(7, "g1 g2"), (7, "g1 g2"), (None, None), (None, "b1")]
    labels = [(i, int(i % 3 > 0), int(i % 10 == 1)) for i in range(0, n, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    noise = {x.doc_id: (x.g, x.f) for x in df.select("doc_id", quality.gumbel(17).alias("g"), (F.pmod(F.xxhash64(F.lit(18), "doc_id"), F.lit(2)) == 0).alias("f")).collect()}
    grams = []
    for _, t in docs:
        w = (t or "").split()
        grams.append(w + [("", "") if a == b else (a, b) for a, b in zip(w, w[1:])])
    bucket = {}
    for row, b in ((row, b) for (_, t), own in zip(docs, grams) for row, b in [(own, np.concatenate([x for _, x in quality.ngram_buckets(pa.array([t or ""]), 16)] or [[]]))]):
        bucket.update(zip(row, b.tolist()))
    good = {i for i, q, t in labels if q and not t}
    raw, target = {}, {}
    for (i, _), own in zip(docs, grams):
        for x in own:
            raw[bucket[x]] = raw.get(bucket[x], 0) + 1
            target[bucket[x]] = target.get(bucket[x], 0) + (i in good and noise[i][1])
    all_, known, strength = sum(raw.values()), sum(target.values()), 2.0 * len(raw)
    p = {x: (target[x] + strength * raw[x] / all_) / (known + strength) for x in raw}
    ratio = {x: np.log(p[x] / (raw[x] / all_)) for x in raw}
    mean = sum(p[x] * ratio[x] for x in raw)
    weight = [sum(ratio[bucket[x]] - mean for x in own) / (len(own) + 20) for own in grams]
    held = {}
    for (i, _), w in zip(docs, weight):
        if i in {x[0] for x in labels} and not noise[i][1]:
            held[i] = min(w, held.get(i, w))
    unit = np.std([w for i, w in held.items() if i in good]) / 4
    key = [w / unit + noise[i][0] for (i, _), w in zip(docs, weight)]
    for k in (1, 100, len(docs)):
        least = sorted(key, reverse=True)[k - 1]
        want = sorted(((i, round(x, 3)) for (i, _), x in zip(docs, key) if x >= least - 1e-6), key=repr)
        found = quality.resample(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), k=k).collect()
        found = sorted(((x.doc_id, round(x.gumbel_key, 3)) for x in found), key=repr)
        assert [i for i, _ in found] == [i for i, _ in want] and np.allclose([x for _, x in found], [x for _, x in want], atol=5e-3)
    top = {i for i, _ in sorted(((d[0], w) for d, w in zip(docs, weight)), key=lambda x: -x[1])[:100]}
    drawn = {i for i, _ in sorted(((d[0], x) for d, x in zip(docs, key)), key=lambda x: -x[1])[:100]}
    assert len(top & drawn) < 98  # the draw decides


def test_ngram_buckets_do_not_depend_on_the_cut(monkeypatch):
    r = random.Random(5)
    texts = pa.array([words(r, n) + " x*** a a" for n in (0, 1, 3, 2000, 7)] + [None, "z" * 3000])
    whole = [sorted(zip(*(np.concatenate(x).tolist() for x in zip(*quality.ngram_buckets(texts, 16)))))]
    original = quality.pieces
    monkeypatch.setattr(quality, "pieces", lambda d, o, b: original(d, o, b, 50))
    assert whole[0] == sorted(zip(*(np.concatenate(x).tolist() for x in zip(*quality.ngram_buckets(texts, 16)))))


def test_kth_largest(spark):
    r = random.Random(6)
    values = [r.gauss(0, 1) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 700, 3000):
        assert quality.kth_largest(df, "key", k, enough=200) == sorted(values, reverse=True)[k - 1]
    ties = [float(v > 0) for v in values]
    same = spark.createDataFrame([(v,) for v in ties], "key double")
    assert [quality.kth_largest(same, "key", k, enough=20) for k in (1, 1400, 2900, 3001)] == [1.0, sorted(ties)[-1400], 0.0, None]


# ---- 3 decontamination


def brute_contamination(docs, items):
    import re

    lower = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = lower(t)
        if w and i is not None:
            m = min(13, len(w))
            for k in range(len(w) - m + 1):
                windows.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    out = []
    for d, t, *_ in docs:
        w, hit, held = lower(t), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if own := windows.get(tuple(w[k : k + m])):
                    held |= own
                    hit |= set(range(k, k + m))
        out.append((d, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [500_000, 0])
def test_decontamination_equals_brute_force(spark, no_docs, bound):
    r = random.Random(7)
    items = [(i, words(r, r.choice((1, 4, 12, 13, 14, 30)), 50)) for i in range(12)] + [(20, None), (21, "..."), (None, words(r, 20)), (3, words(r, 15)), (30, "ÄRGER über İstanbul " + words(r, 14))]
    docs = awkward(r)
    for i in range(60):
        t = items[r.randrange(12)][1].split()
        at = r.randrange(len(t))
        docs.append((100 + i, f"{words(r, r.randrange(0, 60), 50)}, {' '.join(t[at // 2:]).upper()}! {words(r, r.randrange(0, 40), 50)} {items[-1][1]}", "en", "s", 0))
    d = spark.createDataFrame(docs, DOCS).withColumn("start", F.lit(1)).withColumn("a", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("print", F.lit(0))
    assert rows(decontamination.decontaminate(d, b, bound).drop("text_hash")) == brute_contamination(docs, items)
    assert decontamination.decontaminate(no_docs, b).count() == 0
    assert decontamination.decontaminate(d, b.limit(0)).filter("n_hit > 0 OR contaminated").count() == 0


# ---- 4 secrets


def test_base_spans_are_those_of_the_patterns():
    import re

    r = random.Random(8)
    for _ in range(300):
        t = "".join(r.choice(["token", "Password", " = ", ":", '"', "abcdef0123456789" * 2, "AKIA", "ABCDEFGHIJKLMNOP", "x" * r.randrange(9), " ", "é", "K", "API_KEY"]) for _ in range(12))
        want = [("assign", *m.span()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert sorted(secrets.base_spans(t)) == sorted(want)


def exact_spans(field, texts):
    return [{s[1:] for s in spans} for spans in field.spans(pa.array(texts), secrets.Shapes())]


def test_random_field_on_held_out_lines_and_its_viterbi():
    import itertools

    field, lines = secrets.trained(), secret_lines.labelled_lines(300, seed=12345)
    found, spans = exact_spans(field, [t for t, _ in lines]), [set(s) for _, s in lines]
    right = sum(len(f & s) for f, s in zip(found, spans))
    assert right >= 0.93 * sum(map(len, found)) and right >= 0.93 * sum(map(len, spans))
    scores = np.random.default_rng(1).normal(size=(5, 3))
    path = lambda p: sum(field.moves[a, b] for a, b in zip((0, *p), (*p, 0))) + sum(scores[i, x] for i, x in enumerate(p))
    assert path(field.decode(scores)) == pytest.approx(max(map(path, itertools.product(range(3), repeat=5))))
    # cutting chains at tokens that must be outside changes no label
    data, offsets = secrets.utf8(pa.array([t for t, _ in lines]))
    tokens = secrets.features(data, offsets, secrets.Shapes())
    scores, labels = field.scores(tokens.codes), field.labels(tokens)
    assert labels.any()
    for line in np.split(np.arange(len(labels)), np.flatnonzero(np.diff(tokens.line)) + 1):
        assert field.decode(scores[line]) == labels[line].tolist()


def test_random_field_on_hand_written_lines(spark):
    rows_ = [(i, t) for i, t in enumerate([t for t, _ in SECRETS] + HARMLESS)]
    clean = {r.doc_id: r.text for r in secrets.redact(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    longest = lambda t: max(t.split(), key=len)
    wanted = [s or ("Tr0ub4dor&3" if "Tr0ub" in t else longest(t)) for t, s in SECRETS]
    assert sum(w not in clean[i] for i, w in enumerate(wanted)) == len(SECRETS)
    found = exact_spans(secrets.trained(), HARMLESS)
    assert sum(map(bool, found)) <= 1


def test_stored_field_labels_as_a_new_fit_does():
    """Sums of another numeric library differ in their last digits, and steps of the fit make more of it: what counts is the labels."""
    again, kept = secret_lines.fit(secret_lines.labelled_lines()), secrets.stored()
    lines = [t for t, _ in secret_lines.labelled_lines(600, seed=777)] + [t for t, _ in SECRETS] + HARMLESS
    one, other = exact_spans(again, lines), exact_spans(kept, lines)
    assert sum(a == b for a, b in zip(one, other)) >= 0.98 * len(lines)


def test_features_do_not_depend_on_the_other_rows():
    texts = [t for t, _ in SECRETS] + [None, "", "é token\u2028=", "a\r\nb"] + HARMLESS
    together, field = secrets.find(pa.array(texts), secrets.trained()), secrets.trained()
    assert together == [secrets.find(pa.array([t], pa.string()), field)[0] for t in texts]
    assert field.spans(pa.array(texts), secrets.Shapes(), 10) == field.spans(pa.array(texts), secrets.Shapes(most=5))


def test_long_texts_take_linear_time():
    for text in ("token" * 200_000, "password is " * 80_000, "x" * 1_000_000, "AKIA " * 100_000, "A1b2C3d4E5f6G7h8I9j0K1l2M3n4 " * 20_000, "secret:" * 100_000):
        began = time.process_time()
        secrets.find(pa.array([text]), secrets.trained())
        assert time.process_time() - began < 5, text[:20]


def test_scan_and_redact(spark, no_docs):
    text = 'key é token = "0123456789abcdef0123456789abcdef" and Authorization: Bearer abcDEF123456789xyzQRS'
    d = spark.createDataFrame([(1, text, "en", "s", 1), (2, None, None, None, None), (3, "", None, None, 0), (4, "x" * 200000, None, None, 0), (1, text, "en", "s", 1)], DOCS).withColumn("spans", F.lit(3))
    found = {r.doc_id: r for r in secrets.scan(d).collect()}
    assert found[1].n_assign == 1 and found[1].n_hex == 1 and found[1].spans.count("crf:") == 1 and found[2].spans == "" and found[4].spans == ""
    assert found[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r for r in secrets.redact(d).collect()}
    assert "0123456789abcdef" not in clean[1].text and "abcDEF" not in clean[1].text and clean[1].text.startswith("key é [secret]") and clean[1].n_chars == len(clean[1].text)
    assert clean[2].text is None and clean[3].text == "" and clean[4].n_chars == 200000
    assert secrets.scan(no_docs).count() == 0 and secrets.redact(no_docs).count() == 0


# ---- 5 pages


def test_main_text_of_labelled_and_broken_pages(spark):
    weights = html_content.fit()
    page = (
        "<head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two <b>th</b>ree.<br>Four<p>Five"
        '<div class="advert"><p>Buy</p></div><p>Six</p><script>if (a<b) "</p>"</script></article><aside>Side</aside><footer>Foot</footer>'
    )
    assert html_content.main_text(page, weights) == "A & B\nOne two three. Four\nFive\nSix"
    for broken in ("", "<", "<p", "<!-- open", "<script>x", "a < b", "</p></div>", "<p>" * 2000 + "x"):
        html_content.main_text(broken, weights)
    assert html_content.main_text("<p>" + "word " * 50000 + "</p>", weights).count("word") == 50000
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (None, "u", ""), (1, "u", page)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert [r.n_chars for r in html_content.extract(df).orderBy("page_id", "n_chars").collect()] == [0, 34, 34, 0]
    assert html_content.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_main_text_of_common_layouts(layout):
    page, want = LAYOUTS[layout]
    assert html_content.main_text(page, html_content.fit()) == want


def test_hostile_markup_takes_linear_time():
    weights = html_content.fit()
    parts = ("<a ", "<b '>'", "<b a='>' ", "<svg>", "<li>", "<!x", "<p class='a b'>x", "<b><div><i></b>", '<a ">', "</script ")
    for page in [p * (400_000 // len(p)) for p in parts] + ["<div>" * 50000 + "</x>" * 50000, "<ul>" + "<b>" * 60000 + "<li>" * 60000, "<script>" + "</script " * 50000]:
        began = time.process_time()
        html_content.main_text(page, weights)
        assert time.process_time() - began < 5, page[:20]


def test_links_and_lists_of_an_article_stay():
    weights = html_content.fit()
    page = "<nav><ul><li><a href=/>Home</a></ul></nav><article><h1>T</h1><ul><li>one<li><a href=x>two</a> three</ul><table><tr><td>c<td>d</table><pre>a  b</pre></article><ol class=comment-list><li class=comment><p>No</p></ol>"
    assert html_content.main_text(page, weights) == "T\none\ntwo three\nc\nd\na b"


def test_best_region_equals_all_regions():
    r = random.Random(9)
    for _ in range(200):
        s = [r.uniform(-3, 3) for _ in range(r.randrange(1, 12))]
        a, b = html_content.best_region(s)
        assert sum(s[a:b]) == pytest.approx(max([0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)]))


# ---- 6 sharding


def test_sharding_walks_the_ring(spark, no_docs):
    rows_ = awkward(random.Random(10)) + [(i, f"t{i % 7}", "en", "s", 1) for i in range(100, 900)]
    d = spark.createDataFrame(rows_, DOCS).withColumn("cell", F.lit("clash")).withColumn("shard", F.lit(0))
    found = sharding.shard(d, 5, 16).toPandas()
    sizes = found.groupby("shard").size()
    assert len(found) == len(rows_) and len(sizes) == 5 and sizes.max() - sizes.min() <= 1
    for _, g in found.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    ring = sharding.ring(spark, 5, 16).toPandas().sort_values("cell").reset_index(drop=True)
    offered = d.groupBy(sharding._cell(F.xxhash64("doc_id")).alias("c")).count().toPandas().set_index("c")["count"]
    ring["n"] = ring.cell.map(offered).fillna(0).astype(int)
    cells, segments = sharding.plan(spark.createDataFrame(ring[["cell", "shard", "node", "n"]]), 5)
    cells, segments = cells.toPandas(), segments.toPandas()
    # the walk, one overflowing row at a time, over the room that each node has
    total, load = ring.n.sum(), ring.groupby("shard").n.sum()
    cap = {s: total // 5 + (s < total % 5) for s in range(5)}
    keep = cells.set_index("cell").keep
    room, nth = {}, dict.fromkeys(range(5), 0)
    per = ring[ring.node].groupby("shard").size()
    for c, s in ring[ring.node][["cell", "shard"]].itertuples(index=False):
        free = max(cap[s] - load[s], 0)
        room[c] = [free * (nth[s] + 1) // per[s] - free * nth[s] // per[s], s]
        nth[s] += 1
    out = {c: n - keep[c] for c, n in zip(ring.cell, ring.n) if n > keep[c]}
    moved, queue = {}, []
    for c in [*ring.cell, *ring.cell]:  # twice round
        if c in out:
            queue += [c] * out.pop(c)
        while c in room and room[c][0] and queue:
            key = (queue.pop(0), room[c][1])
            moved[key] = moved.get(key, 0) + 1
            room[c][0] -= 1
    assert not queue and segments.high.sub(segments.low).sum() == (ring.n - ring.cell.map(keep)).sum()
    segments = segments.assign(n=segments.high - segments.low)
    assert segments.groupby(["cell", "to_shard"]).n.sum().to_dict() == moved
    got = segments.groupby("to_shard").n.sum().to_dict()
    assert got == {s: cap[s] - load[s] for s in range(5) if cap[s] > load[s]}
    assert sharding.shard(no_docs).count() == 0


def test_sharding_splits_hot_ids(spark):
    """An id, or none, that holds many rows, equal ones too; how cells and copies are split changes neither loads nor places."""
    hot = [(None, f"text {i % 90}", "en", "s", 1) for i in range(300)] + [(7, "same", "en", "s", 1)] * 250 + [(8, None, "en", "s", 1)] * 40
    rows_ = hot + [(i, f"t{i}", "en", "s", 1) for i in range(100, 400)]
    d = spark.createDataFrame(rows_, DOCS)
    crc = lambda t: zlib.crc32((t or "").encode())
    loads = []
    for split in ({}, {"cell_rows": 7, "chunk": 5}, {"cell_rows": 1, "chunk": 1}):
        found = sharding.shard(d, 6, 16, **split).toPandas()
        key = lambda i, c: (-1 if pd.isna(i) else int(i), int(c))
        assert sorted(key(i, c) for i, c in zip(found.doc_id, found.text_crc32)) == sorted((-1 if i is None else i, crc(t)) for i, t, *_ in rows_)
        for _, g in found.groupby("shard"):
            assert sorted(g.slot) == list(range(len(g)))
        loads.append(found.groupby("shard").size().to_dict())
        at = {key(i, c): s for i, c, s in zip(found.doc_id, found.text_crc32, found.shard) if i >= 100}
        loads[-1]["single"] = at
    assert max(loads[0][s] for s in range(6)) - min(loads[0][s] for s in range(6)) <= 1
    assert loads[0] == loads[1] == loads[2]


# ---- 7 top-k


def test_topk_equals_brute_force(spark):
    r = np.random.default_rng(11)
    vectors = [(int(i), [float(x) for x in r.normal(size=8).round(1 if i % 2 else 6)]) for i in range(700)]
    vectors += [(800, None), (900, [1.0, None] + [0.0] * 6), (1000, [float("nan")] * 8), (1100, [float("inf")] * 8), (None, [1.0] * 8), (1200, [1.0, 2.0]), (1201, [3.0, 4.0]), (1300, []), (5, vectors[5][1]), (3, [9.0] * 8), (3, [-9.0] * 8), (3, [9.0] * 8), (100, [1.0] * 8), (200, [2.0] * 8), (200, [2.0] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    found = topk.nra_topk(df, F.col("vec_id") % 100 == 0, 10, block_rows=200, query_block_rows=3)
    floors = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in [x for x in floors if x[0] % 100 == 0]:
        best = sorted((-int(a @ b), i) for i, b in floors if i != q and len(a) == len(b))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert topk.nra_topk(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_stop_early_and_stay_exact():
    r = np.random.default_rng(12)
    n = 4000
    flat = (r.normal(size=(n, 3)) * (800, 300, 100)) @ r.normal(size=(3, 16)) + r.normal(size=(n, 16)) * 3  # three axes tell nearly all
    even = r.integers(-1000, 1000, (n, 16))
    for x, stops in ((flat.astype(np.int64), True), (even, False), (even * 10**6, False), (np.ones((n, 4), np.int64), False), (even[:40], True)):
        ids, depths = np.arange(len(x)), []
        assert sorted(q for q, *_ in topk.nra_block(x, ids, x[:40], ids[:40], 10, together=7)) == list(range(40))
        for q, rows_, s, depth in topk.nra_block(x, ids, x[:40], ids[:40], 10):
            exact = x @ x[q]
            order = [j for j in np.lexsort((ids, -exact)) if j != q][:10]
            assert rows_.tolist() == order and s.tolist() == exact[order].tolist()
            depths.append(depth)
        assert not stops or np.mean(depths) < 0.6 * len(x)


# ---- 8 revisits


def test_revisits_equal_brute_force(spark):
    r = random.Random(13)
    spell = [lambda u: u, lambda u: u.upper().replace("/P", "/p"), lambda u: u + "#x", lambda u: u.replace("a.example", "a.example:80")]
    recs = []
    for i in range(400):
        kind = r.choice(("response", "revisit"))
        url, ts = f"http://a.example/p{r.randrange(3)}", r.randrange(0, 20000)
        recs.append((i, r.choice(spell)(url) if r.random() < 0.95 else None, ts if r.random() < 0.95 else None, kind, {"etag": str(r.randrange(2)), "date": str(i), "content-length": "1"} if r.random() < 0.8 else None))
    df = spark.createDataFrame(recs, "record_id long, url string, ts long, type string, headers map<string,string>").withColumn("key", F.lit("clash"))
    found = {x.record_id: x for x in warc.resolve(df).collect()}
    canon = lambda u: u and u.lower().split("#")[0].replace(":80", "")
    for i, url, ts, kind, headers in recs:
        if kind == "revisit":
            earlier = [(t, k, h) for k, u, t, y, h in recs if y == "response" and u and url and canon(u) == canon(url) and t is not None and ts is not None and t < ts]
            best = max(earlier, key=lambda e: e[:2]) if earlier else None
            old, new = (best[2] or {}) if best else {}, headers or {}
            status = "no_response" if not best else "mismatch" if "etag" in old and "etag" in new and old["etag"] != new["etag"] else "resolved"
            assert (found[i].status, found[i].response_id) == (status, best[1] if status == "resolved" else None)
            if status == "resolved":
                assert found[i].headers == old | {k: v for k, v in new.items() if k != "content-length"}
    assert warc.resolve(df.limit(0)).count() == 0


def test_revisits_that_meet_nothing_are_spread(spark):
    """Rows without URL, time, id or anything stay unresolved, each of them, and no key of theirs is shared."""
    one = {"etag": "1"}
    recs = [(None, None, None, "revisit", None)] * 300 + [(None, "http://a/x", None, "revisit", one)] * 50 + [(None, None, 9, "revisit", one)] * 50
    recs += [(1, "http://a/x", 5, "response", one), (2, "http://A/x#y", 9, "revisit", one), (None, "http://a/x", 9, "revisit", one), (3, "http://a/none", 9, "revisit", one)]
    df = spark.createDataFrame(recs, "record_id long, url string, ts long, type string, headers map<string,string>").repartition(3)
    found = warc.resolve(df).groupBy("record_id", "url", "ts", "status", "response_id").count().collect()
    want = {
        (None, None, None, "no_response", None): 300, (None, "http://a/x", None, "no_response", None): 50, (None, None, 9, "no_response", None): 50,
        (2, "http://A/x#y", 9, "resolved", 1): 1, (None, "http://a/x", 9, "resolved", 1): 1, (3, "http://a/none", 9, "no_response", None): 1,
    }
    assert {tuple(r)[:5]: r["count"] for r in found} == want


def test_canonical_urls(spark):
    urls = {
        "HTTP://User@Example.COM.:80/A?b#c": "http://example.com/A?b", "https://a.b:443": "https://a.b/", "https://a.b:8443?x": "https://a.b:8443/?x", "http://[2001:DB8::1]/x": "http://[2001:db8::1]/x",
        "http://[2001:aaaa::9]:8080/x": "http://[2001:aaaa::9]:8080/x", "http://[::1]:80": "http://[::1]/", "mailto:x": "mailto:x",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert dict(map(tuple, df.select("u", warc.canonical(F.col("u"))).collect())) == urls


# ---- 9 near duplicates


def brute_pairs(texts, n=5, similarity=0.8):
    sets = [set(s.tolist()) for s in near_duplicates.shingle_sets(pa.array(texts), n)]
    return {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}


def near_docs():
    r = random.Random(14)
    docs = awkward(r)
    for g in range(8):
        base = words(r, 120).split()
        for c in range(r.randrange(2, 25)):
            t = list(base)
            for _ in range(r.randrange(0, 5)):
                t[r.randrange(len(t))] = f"x{r.randrange(99)}"
            docs.append((1000 + 50 * g + c, " ".join(t), "en", "s", 0))
    return docs


@pytest.mark.parametrize("options", [{}, {"block_rows": 6, "broadcast_rows": 0}])
def test_near_duplicates_equal_brute_force(spark, no_docs, options):
    docs = near_docs()
    df = spark.createDataFrame(docs, DOCS).withColumn("node", F.lit("clash")).repartition(4)
    pairs = brute_pairs([d[1] for d in docs])
    assert rows(near_duplicates.near_duplicates(df, **options).select("doc_id", "n_links")) == sorted(((d[0], sum(p[0] == i for p in pairs)) for i, d in enumerate(docs)), key=repr)
    parent = list(range(len(docs)))
    for _ in docs:
        for i, j in pairs:
            parent[i] = min(parent[i], parent[j])
    groups = {}
    for i, p in enumerate(parent):
        groups.setdefault(p, []).append(docs[i][0])
    least = {p: min((x for x in g if x is not None), default=None) for p, g in groups.items()}
    assert rows(near_duplicates.near_duplicates(df, **options).select("doc_id", "class_id")) == sorted(((docs[i][0], least[p]) for i, p in enumerate(parent)), key=repr)
    kept = near_duplicates.one_of_each(df, **options)
    assert kept.columns == df.columns and kept.count() == len(groups)
    assert near_duplicates.near_duplicates(no_docs).count() == 0 and near_duplicates.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("options", [{}, {"block_rows": 1, "broadcast_rows": 0}])
def test_a_repeated_row_is_one_node(spark, options):
    base = words(random.Random(19), 200)
    docs = [(1, base)] * 3 + [(2, base + " tail"), (None, base + " end"), (None, base + " end")]
    found = near_duplicates.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), **options)
    assert rows(found.select("doc_id", "class_id", "n_links")) == sorted([(d, 1, 5) for d, _ in docs], key=repr)


def test_prefixes_are_shortened_until_the_recall_meets_the_target():
    few = near_duplicates.recalls([(0.97, 10, 40), (0.81, 8, 3)], 30, 10, 0.8, 0.05, 100)
    assert near_duplicates.prefix_depth(few, 0.999) == 7  # too few links near the threshold: as at the threshold
    far = near_duplicates.recalls([(0.97, 10, 4000), (0.83, 9, 600)], 30, 10, 0.8, 0.05, 100)
    close = near_duplicates.recalls([(0.97, 10, 4000), (0.8, 9, 500), (0.8, 6, 100)], 30, 10, 0.8, 0.05, 100)
    assert near_duplicates.prefix_depth(far, 0.99) == 9 and near_duplicates.prefix_depth(close, 0.99) == 6
    assert all(a >= b for a, b in zip(close, close[1:]))


def test_the_sample_tells_links_and_shared_prefixes():
    docs = [d[1] for d in near_docs() if d[1]]
    sets = list(near_duplicates.shingle_sets(pa.array(docs)))
    sample = near_duplicates.Sample(docs[10:40], 10, 30, 5, 3)
    for s in sets[:60]:
        if len(s):
            label = near_duplicates.labels_of([s], 10, 30, 3)[0]
            want = []
            for own, other in zip(sample.sets, sample.labels):
                common, union = len(np.intersect1d(own, s)), len(np.union1d(own, s))
                if 5 * common >= 4 * union and common < union:
                    want.append((common / union, max(next((d for d in range(10) if other[t, d] != label[t, d]), 10) for t in range(30))))
            assert np.allclose(sorted(sample.links(s, label, 0.8)), sorted(want)) if want else not sample.links(s, label, 0.8)


def test_recall_of_links_at_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.82, which are the hardest to meet."""
    r, docs = random.Random(20), []
    for g in range(600):
        base = [f"a{g}x{i}" for i in range(104)]
        other = [*base[:-11], *(f"b{g}x{i}" for i in range(11))]  # 100 n-grams each, 89 in common
        docs += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    r.shuffle(docs)
    sets = list(near_duplicates.shingle_sets(pa.array([t for _, t in sorted(docs)[:2]])))
    assert 0.8 <= len(np.intersect1d(*sets)) / len(np.union1d(*sets)) < 0.82
    found = near_duplicates.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert found.filter("n_links = 1").count() >= 0.99 * len(docs) and found.filter("n_links > 1").count() == 0


def test_a_chain_of_loose_ties_is_compared_prefix_by_prefix(spark, monkeypatch):
    text, docs = words(random.Random(21), 150, 10**6).split(), []
    for i in range(170):  # neighbours are linked, texts further apart less and less
        docs.append((i, " ".join(text)))
        at = 9 * i % 140
        text[at : at + 6] = [f"n{i}x{k}" for k in range(6)]
    docs.append((500, docs[7][1]))
    df = spark.createDataFrame(random.Random(22).sample(docs, len(docs)), "doc_id long, text string").repartition(3)
    pairs = brute_pairs([t for _, t in docs])
    want = {d: sum(p[0] == i for p in pairs) for i, (d, _) in enumerate(docs)}
    trees = []
    original = near_duplicates._placed
    monkeypatch.setattr(near_duplicates, "_placed", lambda *a: (found := original(*a), trees.extend(x.tree for x in found.select("tree").distinct().collect()))[0])
    found = near_duplicates.near_duplicates(df, block_rows=12)
    assert dict(map(tuple, found.select("doc_id", "n_links").collect())) == want
    assert max(trees) > 0


def test_components(spark):
    r = random.Random(15)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(30)]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = components.components(spark.createDataFrame(edges, "u long, v long"))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert dict(map(tuple, found.collect())) == {k: v for k, v in root.items() if k in linked}


# ---- 10 chat


def test_round_trip_of_hostile_texts():
    r = random.Random(16)
    parts = ["<|im_start|>", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|>", "\n", "assistant", "<", "|", "\\", "é", "<|im_end", "user\n", "im_end|>"]
    for _ in range(2000):
        role, text = "".join(r.choices(parts, k=r.randrange(3))), "".join(r.choices(parts, k=r.randrange(8)))
        rendered, start, n = chat.render(role, text)
        other = chat.render("user", text)[0]
        assert [t[:2] for t in chat.parse(rendered + other + rendered)] == [(role, text), ("user", text), (role, text)]
        assert chat.unescape(rendered[start : start + n]) == text
    for bad in ("x", "<|im_start|>user", "<|im_start|>user\nx<|im_end|>", "<|im_start|>u\n<|im_start|>u\n<|im_end|>\n"):
        with pytest.raises(chat.GrammarError):
            chat.parse(bad)


def test_conversations_read_back(spark):
    turns = [(1, 1, "assistant", "b<|im_end|>"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (None, 5, "assistant", "é" * 100000), (1, None, "system", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert found[1].n_turns == 4 and found[1].turns_sha256 == hashlib.sha256(b"system\n\nuser\na\nuser\na\nassistant\nb<|im_end|>\n").hexdigest()
    assert found[1].loss_chars == 11 and found[1].loss_sha256 == hashlib.sha256(b"b<|im_end|>").hexdigest()
    assert found[2].loss_chars == 0 and found[None].loss_chars == 100000
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0
