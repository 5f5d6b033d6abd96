"""LM scoring (1), importance resampling (2), toxicity (4), WARC archives (8), the pipeline and the queries."""

import base64
import gzip
import hashlib
import io
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentlens.llm import lm_scoring, queries, resampling, toxicity, warc
from rentlens.llm.common import NOT_SPACE, text_slices, word_hashes, word_spans

from .conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# --- language models ---------------------------------------------------------------------------


def brute_losses(rows, target_ids, v_words, classes, mix):
    """The models of the docstring with dictionaries."""
    def hashed(w):
        b = w.encode()
        return int(word_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)])).view(np.int64)[0])

    corpus, target = Counter(), Counter()
    for i, t in rows:
        corpus.update(spaced(t))
        if i in target_ids:
            target.update(spaced(t))
    top = sorted(corpus, key=lambda w: (-corpus[w], hashed(w)))[:v_words - 1]
    code = {w: k + 1 for k, w in enumerate(top)}
    out = defaultdict(list)
    models = []
    for count, ids in ((target, target_ids), (corpus, None)):
        uni, pair = Counter(), Counter()
        for w, n in count.items():
            uni[code.get(w, 0)] += n
        for i, t in rows:
            if ids is None or i in ids:
                before = 0
                for w in spaced(t):
                    c = code.get(w, 0)
                    c = c if c < classes else 0
                    pair[before, c] += 1
                    before = c
        models.append((uni, pair))
    for i, t in rows:
        n, loss = len(spaced(t)), [0.0, 0.0]
        for m, (uni, pair) in enumerate(models):
            total = sum(uni.values())
            p1 = {c: (uni[c] + 1) / (total + len(code) + 1) for c in range(len(code) + 1)}
            rest = sum(p for c, p in p1.items() if not 0 < c < classes)
            from_ = Counter()
            for (a, _), k in pair.items():
                from_[a] += k
            before = 0
            for w in spaced(t):
                c = code.get(w, 0)
                k = c if c < classes else 0
                emit = 1.0 if 0 < c < classes else p1[c] / rest
                loss[m] -= math.log(mix * (pair[before, k] + 1) / (from_[before] + classes) * emit + (1 - mix) * p1[c])
                before = k
        out[i].append((n, loss[0] / max(n, 1), loss[1] / max(n, 1)))
    return out


def test_lm(spark, corpus):
    rows, df = corpus
    targets = spark.createDataFrame([(i,) for i in (*range(20), 308, None)], "doc_id long")
    models = lm_scoring.fit(df, targets, v_words=120, classes=16)
    want = brute_losses([(r[0], r[1]) for r in rows], {*range(20), 308}, 120, 16, lm_scoring.MIX)
    got = lm_scoring.score(df, models).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(r["n_words"] == n and r["target_loss"] == pytest.approx(t, rel=1e-4) and r["background_loss"] == pytest.approx(b, rel=1e-4)
                   for n, t, b in want[r["id"]])
        assert r["score"] == pytest.approx(r["target_loss"] - r["background_loss"], abs=1e-9)


@pytest.mark.parametrize("hot", [0, 50])
def test_lm_counts_every_word_and_pair(spark, corpus, monkeypatch, hot):
    """More words than the former 1,023 classes: a full bigram model of every word, with hot pairs looked up apart or not."""
    monkeypatch.setattr(lm_scoring, "HOT", hot)
    monkeypatch.setattr(lm_scoring, "HOT_LEAST", 2)
    rows, df = corpus
    n = len({w for r in rows for w in spaced(r[1])})
    assert n > 1023
    want = brute_losses([(r[0], r[1]) for r in rows], {*range(20), 308}, n + 1, n + 1, lm_scoring.MIX)
    targets = spark.createDataFrame([(i,) for i in (*range(20), 308, None)], "doc_id long")
    got = lm_scoring.score(df, lm_scoring.fit(df, targets)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(r["n_words"] == k and r["target_loss"] == pytest.approx(t, rel=1e-9) and r["background_loss"] == pytest.approx(b, rel=1e-9)
                   for k, t, b in want[r["id"]])


def test_lm_pairs_flush(spark, corpus):
    marked = corpus[1].select(F.col("text").alias("body"), F.lit(True).alias("is_target"))
    whole = {(r["v"], r["w"]): r["corpus"] for r in lm_scoring.count_word_pairs(marked).collect()}
    assert {(r["v"], r["w"]): r["corpus"] for r in lm_scoring.count_word_pairs(marked, flush=5).collect()} == whole
    assert sum(whole.values()) == sum(len(spaced(r[1])) for r in corpus[0])


def test_lm_prefers_the_target(spark):
    rows = [(i, words(i, 200) if i % 2 else " ".join(f"{w}x" for w in words(i, 200).split())) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    models = lm_scoring.fit(df, df.filter("doc_id % 2 = 1 and doc_id < 20").select("doc_id"))
    got = {r["id"]: r["score"] for r in lm_scoring.score(df, models).collect()}
    assert max(got[i] for i in range(21, 40, 2)) < min(got[i] for i in range(20, 40, 2))


def test_lm_flushes(spark, corpus):
    rows, df = corpus
    marked = df.select(F.col("text").alias("body"), F.lit(True).alias("is_target"))
    whole = {r["key"]: r["corpus"] for r in lm_scoring.count_words(marked).collect()}
    assert {r["key"]: r["corpus"] for r in lm_scoring.count_words(marked, flush=5).collect()} == whole
    assert sum(whole.values()) == sum(len(spaced(r[1])) for r in rows)


def test_scorers_empty(nothing, corpus):
    none = nothing.select("doc_id")
    assert lm_scoring.score(nothing, lm_scoring.fit(nothing, none)).count() == 0
    assert resampling.resample(nothing, none).count() == 0
    assert lm_scoring.score(corpus[1], lm_scoring.fit(corpus[1], none)).filter("score is null").count() == 0


# --- resampling --------------------------------------------------------------------------------


def test_resampling(spark, corpus):
    rows, df = corpus
    targets = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    got = resampling.resample(df, targets, fraction=0.3).collect()
    k = round(0.3 * len(rows))
    keys = sorted((r["gumbel_key"] for r in got), reverse=True)
    assert len(got) == len(rows) and {r["gumbel_key"] for r in got if r["selected"]} == set(keys[:k])
    counts = {}
    for wanted in (True, False):
        c = np.ones(resampling.BUCKETS)
        for r in rows:
            if not wanted or (r[0] is not None and r[0] < 60 and r[0] % 2 == 0):
                for b in buckets(r[1]):
                    c[b] += 1
        counts[wanted] = np.log(c / c.sum())
    ratio, want = counts[True] - counts[False], defaultdict(list)
    for r in rows:
        want[r[0]].append((len(buckets(r[1])), float(sum(ratio[b] for b in buckets(r[1])))))
    for r in got:
        assert any(r["n_grams"] == n and r["log_weight"] == pytest.approx(w, abs=1e-6) for n, w in want[r["id"]])
    again = {(r["id"], r["log_weight"]): r["gumbel_key"] for r in resampling.resample(df.repartition(5), targets, fraction=0.3).collect()}
    assert all(again[r["id"], r["log_weight"]] == r["gumbel_key"] for r in got)


def buckets(text):
    import pyarrow as pa
    (_, _, data, off), = text_slices(pa.array([text], pa.string()))
    return resampling.ngrams(data, off)[1].tolist()


def test_buckets_are_words_and_pairs():
    assert len(buckets("a b c d")) == 7 and buckets("A b") == buckets("a\tB") and buckets(None) == buckets("  ") == []


@pytest.mark.parametrize("k", [1, 7, 400, 1000, 1001])
def test_kth_largest(spark, k):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 30, 500), rng.normal(0, 1e-3, 200), np.full(290, 2.5), [0.0, -0.0, 1e300, -1e300, 5e-324, -5e-324, 1, -1, 2, -2]])
    keys = resampling._ordered(x)
    assert (np.argsort(keys, kind="stable")[np.diff(np.sort(x), prepend=-np.inf) > 0] == np.argsort(x, kind="stable")[np.diff(np.sort(x), prepend=-np.inf) > 0]).all()
    df = spark.createDataFrame([(int(v),) for v in keys], "rank_key long")
    got = resampling.kth_largest(df, k)
    assert got is None if k > len(x) else got == sorted(keys.tolist(), reverse=True)[k - 1]


# --- toxicity ----------------------------------------------------------------------------------


def toxic_corpus(spark):
    rows, labels = [], []
    for i in range(900):
        bad = i % 9 == 0
        text = words(i, 40 + i % 200)
        if bad:
            w = text.split()
            for k in range(4):
                w.insert(k * 9 + 3, ("vilewretch", "Foulbrute.", "nastything", "FOULBRUTE")[(i // 9 + k) % 4] + ("", "s", "ling")[k % 3])
            text = " ".join(w)
        rows.append((i, text))
        if i % 2:
            labels.append((i, int(bad)))
    rows += [(5000, words(5000, 20_000)), (5001, None), (5002, ""), (5003, "?!"), (None, words(9, 30)), (9, rows[9][1])]
    labels += [(None, 1), (11, None), (13, 0), (13, 0), (77_777, 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark):
    rows, df, labels = toxic_corpus(spark)
    model = toxicity.fit(df, labels)
    got = toxicity.score(df.withColumn("score", F.lit("own")), model).select("doc_id", "score", "predicted", toxicity.held_out(F.col("doc_id")).alias("out")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900 and r["out"]]
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in held)
    found = [r["predicted"] for r in held if r["doc_id"] % 9 == 0]
    assert sum(found) >= 0.95 * len(found) and not any(r["predicted"] for r in got if r["doc_id"] is None or r["doc_id"] % 9)
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == sum(not r["predicted"] for r in got)


def test_toxicity_driver_gets_kept_features_only(spark, monkeypatch):
    """The sample's features are counted in the cluster; the model is that of the whole table."""
    _, df, labels = toxic_corpus(spark)
    seen, plain = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda rows, *a, **kw: seen.append(rows) or plain(rows, *a, **kw))
    model = toxicity.fit(df, labels)
    rows, prior = toxicity.sample(df, labels, "doc_id", "text", toxicity.N_POSITIVE, toxicity.N_UNLABELLED)
    whole = rows.toArrow()
    want = plain(whole, prior)
    got = {x for r in seen[0].column("features").to_pylist() for x in r}
    assert got == set(np.flatnonzero(want.slot >= 0).tolist()) and seen[0].num_rows == whole.num_rows
    assert (model.slot == want.slot).all() and np.allclose(model.weight, want.weight, atol=1e-9) and np.isclose(model.bias, want.bias)


def test_toxicity_ignores_held_out_labels(spark):
    _, df, labels = toxic_corpus(spark)
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(df, labels), toxicity.fit(df, wrong)
    assert a.bias == b.bias and (a.weight == b.weight).all()


def test_toxicity_without_positives(spark, nothing, corpus):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for model in (toxicity.fit(corpus[1], labels), toxicity.fit(nothing, labels), toxicity.fit(corpus[1], labels.limit(0))):
        assert {(r["score"], r["predicted"]) for r in toxicity.score(corpus[1], model, keep=["doc_id"]).collect()} == {(0.0, 0)}
    assert toxicity.score(nothing, None).count() == 0


def brute_fit_and_score(rows, prior, rounds, rate=0.05, decay=1e-5):
    """Features, risk, steps and scores of the docstring, number by number; rows are (positive, text)."""
    sets = []
    for positive, text in rows:
        ws = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").translate(LOWER).encode())
        signs = set()
        for w in ws:
            for k in (None, *toxicity.STEMS):
                if k is None or len(w) > k:
                    part = w if k is None else w[:k]
                    h = int(word_hashes(np.frombuffer(part, np.uint8), np.array([0]), np.array([len(part)]))[0])
                    signs.add((h ^ (k or 0)) % (1 << toxicity.BUCKET_BITS))
        sets.append((positive, signs, math.log1p(len(ws)) / 5))
    n_p = sum(p for p, _, _ in sets)
    n_u = len(sets) - n_p
    kept = []
    for f in set().union(*(x for _, x, _ in sets)):
        k_p, k_u = sum(p and f in x for p, x, _ in sets), sum(not p and f in x for p, x, _ in sets)
        pooled = (k_p + k_u + 1) / (n_p + n_u + 2)
        clear = (k_p / n_p - k_u / n_u) / math.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
        if clear >= toxicity.SIGNIFICANT and k_p >= toxicity.FEWEST and prior * k_p / n_p >= toxicity.PURE * k_u / n_u:
            kept.append(f)
    names = [*kept, "length", "bias"]
    w, m, v = ({f: 0.0 for f in names} for _ in range(3))
    below = False

    def margin(signs, size):
        return sum(w[f] for f in kept if f in signs) + w["length"] * size + w["bias"]

    def loss(z):
        return math.log1p(math.exp(-z))

    for t in range(1, rounds + 1):
        zs = [margin(x, size) for _, x, size in sets]
        back_risk = sum(loss(-z) for z, r in zip(zs, sets, strict=True) if not r[0]) / n_u - prior * sum(loss(-z) for z, r in zip(zs, sets, strict=True) if r[0]) / n_p
        below |= back_risk < 0
        grad = {f: 0.0 for f in names}
        for z, (p, x, size) in zip(zs, sets, strict=True):
            s = 1 / (1 + math.exp(-z))
            back = -prior * s / n_p if p else s / n_u
            g = (-prior * (1 - s) / n_p if p else 0.0) + back if back_risk >= 0 else -back
            for f in kept:
                grad[f] += g * (f in x)
            grad["length"] += g * size
            grad["bias"] += g
        for f in names:
            d = grad[f] + (decay * w[f] if f != "bias" else 0)
            m[f], v[f] = 0.9 * m[f] + 0.1 * d, 0.999 * v[f] + 0.001 * d * d
            w[f] -= rate * (m[f] / (1 - 0.9**t)) / (math.sqrt(v[f] / (1 - 0.999**t)) + 1e-8)
    return len(kept), below, [1 / (1 + math.exp(-margin(x, size))) for _, x, size in sets]


@pytest.mark.parametrize("prior", [0.2, 0.9])
def test_toxicity_equals_plain_python(spark, prior):
    """Features, non-negative risk, steps and scores; the negative part falls below zero on the way."""
    import pyarrow as pa
    texts = [(1, f"{words(i, 12)} Vilewretch nastyTHINGS") for i in range(20)] + [(0, words(100 + i, 10 + i)) for i in range(60)]
    texts += [(0, None), (0, ""), (0, "?!"), (1, "vilewretchling é"), (0, texts[0][1])]
    column = pa.array([t for _, t in texts])
    lists, counts = [], []
    for i, j, data, off in text_slices(column):
        doc, bucket, n = toxicity._buckets(data, off)
        lists += [sorted(set(bucket[doc == k].tolist())) for k in range(j - i)]
        counts += n.tolist()
    table = pa.table({"positive": pa.array([p for p, _ in texts], pa.int32()), "features": pa.array(lists, pa.list_(pa.int32())), "words": pa.array(counts, pa.int64())})
    model = toxicity.train(table, prior, rounds=40)
    n, below, want = brute_fit_and_score(texts, prior, 40)
    assert n == len(model.weight) > 0 and below
    assert np.allclose(toxicity.scores(model, column), want, atol=1e-9)
    got = toxicity.score(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id long, text string"), model).collect()
    assert np.allclose([r["score"] for r in sorted(got, key=lambda r: r["doc_id"])], want, atol=1e-9)


def test_non_negative_risk():
    """With many positives among few unlabelled rows the negative part would go below zero."""
    import pyarrow as pa
    feature = [[1, 2]] * 40 + [[1, 3]] * 6 + [[4, 5]] * 30
    rows = pa.table({"positive": pa.array([1] * 40 + [0] * 36, pa.int32()), "features": pa.array(feature, pa.list_(pa.int32())), "words": pa.array([9] * 76, pa.int64())})
    model = toxicity.train(rows, prior=0.5)
    assert np.isfinite(model.weight).all() and abs(model.bias) < 50


# --- archives ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://a.b/{i}?q=é x", f"<html>{words(i, 30 + i)}</html>") for i in range(30)]
    rows += [(100, "u", rows[3][2]), (50, "u", rows[3][2]), (101, None, ""), (102, "v", None), (103, "w", "big " + words(5, 30_000) + "\r\n\r\nWARC/1.0\r\n"),
             (104, "w", "big " + words(5, 30_000) + "\r\n\r\nWARC/1.0\r\n"), (None, "n", "no id"), (7, "again", rows[7][2]), (105, "x", "ß" * 5000)]
    rows = [(*r, "response", 3) for r in rows]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, record_type string, payload_bytes int").repartition(4)


def want_records(rows):
    best = {}
    for r in rows:
        p = r[2] or ""
        best[p] = max((x[0] for x in rows if (x[2] or "") == p and x[0] is not None), default=None)
    return best


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 100])
def test_round_trip(pages, chunk_bytes):
    rows, df = pages
    best = want_records(rows)
    got = warc.round_trip(df, chunk_bytes=chunk_bytes).collect()
    assert len(got) == len(rows) and all(r["digest_holds"] for r in got)
    seen = Counter((r["id"], r["payload_bytes"], r["payload_digest"]) for r in got)
    assert seen == Counter((r[0], len((r[2] or "").encode()), base64.b32encode(hashlib.sha1((r[2] or "").encode()).digest()).decode()) for r in rows)
    assert sum(r["record_type"] == "response" for r in got) == len(best)
    by_digest = {base64.b32encode(hashlib.sha1(p.encode()).digest()).decode(): i for p, i in best.items()}
    for r in got:
        first = by_digest[r["payload_digest"]]
        assert r["refers_to"] == (first if r["record_type"] == "revisit" else None) and (r["record_type"] == "revisit" or r["id"] == first)


def test_archives_are_warc(pages, tmp_path):
    rows, df = pages
    manifest = warc.write_archives(df, str(tmp_path / "a"))
    n, bodies = 0, []
    for m in manifest.collect():
        with gzip.open(m["path"]) as f:
            data = f.read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.0\r\n")
            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert rest[size:size + 4] == b"\r\n\r\n"
            if b"WARC-Type: response" in head:
                bodies.append(rest[:size].decode())
            data, n = rest[size + 4:], n + 1
        assert m["records"] > 0
    assert n == len(rows) == sum(m["records"] for m in manifest.collect()) and sorted(bodies) == sorted({r[2] or "" for r in rows})


def test_chunk_table(pages, tmp_path):
    rows, df = pages
    table = warc.read_archives(warc.write_archives(df, str(tmp_path / "a"), min_revisit_bytes=1 << 30), chunk_bytes=1000)
    parts = defaultdict(list)
    for r in table.orderBy("record_id", "chunk").collect():
        parts[r["record_id"], r["url"]].append(r)
    for r in rows:
        if r[0] in (7, None):
            continue
        chunks, p = parts[str(r[0]), r[1] or ""], (r[2] or "").encode()
        assert [c["chunk"] for c in chunks] == list(range(max(1, -(-len(p) // 1000)))) and b"".join(bytes(c["data"]) for c in chunks) == p
        for c in chunks:
            so_far = p[:c["bytes_so_far"]]
            assert bytes(c["sha1_so_far"]) == hashlib.sha1(so_far).digest() and c["is_last"] == (len(so_far) == len(p))


def test_round_trip_reads_the_chunk_table(pages, monkeypatch):
    """The records are made from the whole chunk table, with its data."""
    tables, read = [], warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda *a, **kw: tables.append(read(*a, **kw)) or tables[-1])
    assert warc.round_trip(pages[1], chunk_bytes=1000).count() == len(pages[0])
    (table,) = tables
    assert table.filter("not is_last").count() > 0 and table.filter("data is null").count() == 0
    assert table.agg(F.sum(F.length("data"))).first()[0] == sum(len(p.encode()) for p in want_records(pages[0]))


def test_text_views():
    import pyarrow as pa
    from rentlens.llm.common import text_views
    for kind in (pa.string(), pa.large_string(), pa.binary()):
        column = pa.array(["skipped", "été", None, "", "end"], pa.string()).cast(kind).slice(1)
        assert [bytes(v) for v in text_views(column)] == ["été".encode(), b"", b"", b"end"]
        assert all(v.obj is not None for v in text_views(column)) and list(text_views(column[:0])) == []


def test_broken_archives():
    pack = gzip.compress(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nshort")
    for data in (pack, pack[:-12], gzip.compress(b"HTTP/1.0\r\n\r\n")):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.read_records(io.BytesIO(data)))


def test_archives_empty(pages):
    assert warc.round_trip(pages[1].limit(0)).count() == 0


# --- helpers, queries, pipeline ----------------------------------------------------------------


def test_word_hashes_depend_on_the_word_alone():
    a, b = b"xx one two\tONE \xc3\xa9t\xc3\xa9", b"one"
    s, e, upto = word_spans(np.frombuffer(a, np.uint8), np.array([0, 2, 2, 10, len(a)]), NOT_SPACE)
    assert [a[i:j] for i, j in zip(s, e, strict=True)] == [b"xx", b"one", b"two", b"ONE", b"\xc3\xa9t\xc3\xa9"] and upto.tolist() == [0, 1, 1, 3, 5]
    h = word_hashes(np.frombuffer(a, np.uint8), s, e)
    assert h[1] == word_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([3]))[0] and len(set(h.tolist())) == 5


def test_registered_queries():
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in queries.queries()] == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from rentlens.llm import exact_dedup, jaccard_join
    rows, df, labels = toxic_corpus(spark)
    near = [(6000 + i, words(3, 120) + f" end{i}") for i in range(5)]
    dirty = [(7000, "intro " + words(4242, 30)), (7001, "".join(c.upper() if c.isascii() else c for c in words(3, 120)) + " END0")]
    docs = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 4}", len(t or "")) for i, t in rows + near + dirty],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, words(4242, 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = [name for name, _ in corpus_pipeline.STAGES]
    assert kept == ["toxicity", "exact_dedup", "jaccard_join", "decontaminate", "mix"] and corpus_pipeline.ORACLE_SQL is None
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r["doc_id"] for r in got]
    assert len([i for i in ids if i and 6000 <= i < 7000 or i == 7001]) == 1 and 7000 not in ids
    assert not any(i is not None and i < 900 and i % 9 == 0 for i in ids) and all(r["copies"] in (1, 2) and r["taken"] == r["copies"] * r["size"] for r in got)
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, step, str(tmp_path))
        assert after.columns == docs.columns and after.count() <= step.count()
        step = after
    assert exact_dedup.exact_dedup(step).filter("not kept").count() == 0 and jaccard_join.jaccard_components(step).filter("grouped").count() == 0


def test_pipeline_near_copies(spark):
    """Copies between the rules (four words, 0.85) and (five words, 0.8) go; less similar ones stay."""
    import corpus_pipeline

    def grams(text, n):
        w = spaced(text)
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}

    def similarity(a, b, n):
        a, b = grams(a, n), grams(b, n)
        return len(a & b) / len(a | b)

    def replaced(text, places):
        w = text.split()
        for k in places:
            w[k] = f"changed{k}"
        return " ".join(w)

    base = [words(800 + i, n) for i, n in enumerate((100, 200, 600, 100, 100))]
    between = [replaced(base[0], (30, 60)), replaced(base[1], (30, 70, 110, 150)), replaced(base[2], range(20, 580, 45)),
               base[3] + " " + words(900, 22)]
    apart = replaced(base[4], (20, 50, 80))
    for a, b in zip(base, between, strict=False):
        assert similarity(a, b, 5) >= 0.8 and similarity(a, b, 4) < 0.85
    assert similarity(base[4], apart, 5) < 0.8
    rows = list(enumerate(base)) + [(100 + i, t) for i, t in enumerate(between)] + [(104, apart)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [0, 1, 2, 3, 4, 104]


def brute_pipeline(rows, items):
    """Rows (id, text, lang, source, n_chars) that are not toxic -> the rows of the mix, in plain Python."""
    from .test_joins import brute_contamination
    from .test_mixing_dedup import brute_targets
    last = {}
    for r in rows:
        text = (r[1] or "").translate(LOWER)
        if text not in last or (last[text][0] is None) or (r[0] is not None and r[0] > last[text][0]):
            last[text] = r
    rows, sets = sorted(last.values(), key=lambda r: (r[0] is None, r[0] or 0)), []
    for r in rows:
        w = spaced(r[1])
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 10 * both >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    rows = [r for k, r in enumerate(rows) if root[k] == k]  # in order of id, so a component's first stays
    rows = [r for r, c in zip(rows, brute_contamination([r[1] for r in rows], items), strict=True) if not c[-1]]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes = {s: sum(size(r) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    target, out = brute_targets(sizes), []
    for s, total in sizes.items():
        base, upto, bound = int(target[s] >= total), 0, None
        keyed = sorted((int(hashlib.md5(str(r[1] if r[0] is None else r[0]).encode()).hexdigest()[:9], 16), r) for r in rows if r[3] == s)
        for key, r in keyed:
            budget = target[s] - base * total - upto
            upto += size(r)
            if bound is None and (size(r) >= budget or (key, r) == keyed[-1]):
                bound = key + (2 * budget >= size(r))
        for key, r in keyed:
            copies = base + (key < bound)
            if copies:
                out.append((*r, size(r), total, round(target[s], 6), copies, copies * size(r)))
    return sorted(out, key=str)


def test_pipeline_against_plain_python(spark, tmp_path):
    import corpus_pipeline
    rows, _, labels = toxic_corpus(spark)
    near = [(6000 + i, words(3, 120) + f" end{i}") for i in range(5)]
    between = words(810, 100).split()
    near += [(6100, " ".join(between)), (6101, " ".join("changed" if k in (30, 60) else w for k, w in enumerate(between)))]
    copies = [(7001, "".join(c.upper() if c.isascii() else c for c in words(3, 120)) + " END0"), (7002, words(7, 47).upper()), (7003, words(7, 47).upper())]
    dirty, items = [(7000, "intro " + words(4242, 30)), (7004, words(5, 700) + " " + words(4242, 13))], [(1, words(4242, 30))]
    rows = [(i, t, "en", f"s{(i or 0) % 4}", len(t or "")) for i, t in rows + near + copies + dirty]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    clean = toxicity.score(docs, toxicity.fit(docs, labels), keep=docs.columns).filter("predicted = 0").select(*docs.columns)
    want = brute_pipeline([tuple(r) for r in clean.collect()], items)
    got = corpus_pipeline.run(spark, str(tmp_path)).select(*docs.columns, "size", "source_size", "target", "copies", "taken").collect()
    assert sorted(((*r[:-3], round(r["target"], 6), *r[-2:]) for r in got), key=str) == want
    assert len(want) > 400
