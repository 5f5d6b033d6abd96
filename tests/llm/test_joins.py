"""Jaccard join (3), suffix deduplication (6) and decontamination (10) against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rentlens.llm import decontaminate, jaccard_join, suffix_dedup

from .conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}


def brute_components(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


def check_components(rows, df, **options):
    n, roots = brute_components([r[1] for r in rows])
    want = defaultdict(list)
    for r, size, root in zip(rows, n, roots, strict=True):
        ids = [x[0] for x, y in zip(rows, roots, strict=True) if y == root and x[0] is not None]
        want[r[0]].append((size, min(ids, default=None)))
    got = defaultdict(list)
    for r in jaccard_join.jaccard_components(df, **options).collect():
        got[r["id"]].append((r["n"], r["component_id"]))
    key = lambda v: sorted(v, key=str)
    assert {k: key(v) for k, v in got.items()} == {k: key(v) for k, v in want.items()}
    return len(set(roots))


@pytest.mark.parametrize("long_list", [256, 3])
def test_components(corpus, long_list):
    rows, df = corpus
    parts = check_components(rows, df, long_list=long_list)
    if long_list == 3:
        kept = jaccard_join.keep_one(df)
        assert kept.columns == df.columns and kept.count() == parts


def test_chains_and_rims(spark):
    """Chains of ever more changed copies, whose links hold by some pairs only; and a frequent line in all of them."""
    rng, rows = np.random.default_rng(7), []
    for family in range(6):
        text = words(family + 50, 60 + 25 * family).split()
        for step in range(9):
            rows.append((len(rows) + 1, " ".join(["this", "line", "is", "in", "every", "text", *text])))
            for _ in range(int(rng.integers(1, 4))):
                text[int(rng.integers(len(text)))] = f"new{rng.integers(10**6)}"
            if step % 3 == 2:
                text = text + [f"more{step}"] * 2
    rng.shuffle(rows)
    rows = [(int(a), str(b)) for a, b in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for long_list, group in ((256, 2), (4, 2), (4, 100)):
        check_components(rows, df, long_list=long_list, group=group)


def test_components_empty(nothing):
    assert jaccard_join.jaccard_components(nothing).count() == 0 and jaccard_join.keep_one(nothing).count() == 0


def test_contraction(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102)]
    got = {r["node"]: r["root"] for r in jaccard_join.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert len({got[i] for i in range(41)}) == 1 and len({got[i] for i in (100, 101, 102)}) == 1 and got[0] != got[100]


# --- suffix deduplication --------------------------------------------------------------------


def brute_lost(texts, length):
    seen, out = Counter(), []
    for t in texts:
        seen.update(t[i:i + length] for i in range(len(t) - length + 1))
    for t in texts:
        lost = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                lost[i:i + length] = True
        out.append(lost)
    return out


def check_suffixes(rows, df, length, **options):
    want = defaultdict(list)
    texts = [(r[1] or "").encode() for r in rows]
    for r, t, lost in zip(rows, texts, brute_lost(texts, length), strict=True):
        runs = int((np.diff(np.concatenate([[0], lost.astype(int)])) == 1).sum())
        want[r[0]].append((len(t), int(lost.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~lost].tobytes()).hexdigest()))
    got = defaultdict(list)
    for r in suffix_dedup.suffix_dedup(df, length=length, **options).collect():
        assert hashlib.sha256(r["kept"]).digest() == r["kept_sha"]
        got[r["id"]].append((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_sha"]).hex()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_suffixes(corpus):
    rows, df = corpus
    check_suffixes(rows, df, 200)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_rims(spark, hot):
    """Passages copied to other surroundings, in part, next to each other and with rims of every length."""
    rng = np.random.default_rng(3)
    letters = lambda n, k=26: "".join(chr(97 + int(x)) for x in rng.integers(0, k, n))
    passage = letters(320)
    rows = [(i, letters(int(rng.integers(0, 90))) + passage[int(rng.integers(0, 130)):int(rng.integers(190, 321))] + letters(int(rng.integers(0, 90))))
            for i in range(30)]
    rows += [(100 + i, letters(700, 1 + i % 2)) for i in range(4)] + [(200, "abcdefghij" * 80), (201, "xyz" + "abcdefghij" * 30), (202, passage + passage)]
    check_suffixes(rows, spark.createDataFrame(rows, "doc_id long, text string"), 200, hot=hot)
    check_suffixes(rows[:25], spark.createDataFrame(rows[:25], "doc_id long, text string"), 60, hot=hot)


def test_long_document_in_blocks(spark):
    rng = np.random.default_rng(5)
    text = "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 9000))
    whole = np.frombuffer((text + text[1000:1400]).encode(), np.uint8)
    one = suffix_dedup.segments(whole, np.array([0]), np.array([len(whole)]))
    assert (one[1][:-1] < one[0][1:]).all() and one[0][0] == 0 and one[1][-1] == len(whole) - 200
    rows = [(1, text + text[1000:1400])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from rentlens.llm.common import with_locator
    located = with_locator(df.select(df.text.alias("body")), ["body"], "t")
    table = suffix_dedup.segment_table(located, 200, block=1500).collect()[0]
    ends = [f + s - 200 for f, s in zip(table["first"], table["size"], strict=True)]
    assert table["first"][0] == 0 and ends[-1] == len(whole) - 200 and all(e + 1 == f for e, f in zip(ends[:-1], table["first"][1:], strict=True))
    check_suffixes(rows, df, 200)


def test_blind_tries():
    rng = np.random.default_rng(1)
    for size, letters, depth, shallow in ((3000, 2, 20, 8), (2000, 2, 12, 8), (500, 1, 30, 16), (900, 3, 5, 0), (4000, 2, 33, 32)):
        raw = rng.integers(97, 97 + letters, size).astype(np.uint8)
        at = np.arange(size - depth - 8)
        seen = Counter(raw[i:i + depth].tobytes() for i in at)
        assert suffix_dedup.repeated_suffixes(raw, at, depth, shallow).tolist() == [i for i in at if seen[raw[i:i + depth].tobytes()] > 1]


def test_suffix_empty(nothing):
    assert suffix_dedup.suffix_dedup(nothing).count() == 0


# --- decontamination -------------------------------------------------------------------------


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(texts, items):
    out = []
    for t in texts:
        w = item_words(t)
        hit, names = set(), set()
        for name, text in items:
            v = item_words(text)
            m = min(13, len(v))
            for p in range(len(v) - m + 1 if m else 0):
                for i in range(len(w) - m + 1):
                    if w[i:i + m] == v[p:p + m]:
                        hit |= set(range(i, i + m))
                        names.add("" if name is None else str(name))
        out.append((len(w), len(hit), len(names), ",".join(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.fixture(scope="module")
def bench(spark, corpus):
    rows, _ = corpus
    items = [(10, words(999, 70)), (9, words(999, 30) + " other end"), (8, " ".join(words(4, 40).split()[5:30]).upper()), (7, "one"), (6, None), (5, ""),
             (4, "A-B; c!"), (3, "été " * 13), (3, words(77, 20)), (None, words(308, 9) + " " + words(308, 20)), (2, words(12, 13)), (1, "?? !!"), (9, words(13, 14))]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [1 << 24, 300, 1])
def test_contamination(corpus, bench, block_bytes):
    rows, df = corpus
    items, bdf = bench
    want = defaultdict(list)
    for r, found in zip(rows, brute_contamination([r[1] for r in rows], items), strict=True):
        want[r[0]].append(found)
    got = defaultdict(list)
    for r in decontaminate.contamination(df, bdf, block_bytes=block_bytes).collect():
        got[r["id"]].append((r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    kept = decontaminate.remove_contaminated(df, bdf, block_bytes=block_bytes)
    assert kept.columns == df.columns and kept.count() == sum(not x[-1] for v in want.values() for x in v)


def test_longest_matches(spark):
    text = words(5, 60).split()
    docs = spark.createDataFrame([(1, "before it " + " ".join(text[10:50]) + " after it " + " ".join(text[0:13]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(text))], "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.matches(docs, bench).collect())
    assert got == [(1, 2, "1", 10, 40), (1, 44, "1", 0, 13)]


def test_contamination_empty(nothing, bench, corpus):
    assert decontaminate.contamination(nothing, bench[1]).count() == 0
    assert decontaminate.contamination(corpus[1], bench[1].limit(0)).filter("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.remove_contaminated(corpus[1], bench[1].limit(0)).count() == len(corpus[0])
