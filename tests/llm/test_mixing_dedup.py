"""Mixing (5), exact deduplication (9) and chunk deduplication (7) against plain Python."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentlens.llm.chunking import RUN_BYTES, chunk_dedup, chunks_of, cut_marks
from rentlens.llm.exact_dedup import exact_dedup, keep_last
from rentlens.llm.mixing import mix

from .conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, share=1.5):
    """By repeated resharing, as the rule says."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {}, set(sizes)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        open_ -= set(over)
    return target


def test_mix(corpus):
    rows, df = corpus
    got = mix(df).collect()
    assert len(got) == len(rows) and {"score", "id", "kept", "loc_file"} <= set(got[0].asDict())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += n_words(r[1])
    target, taken = brute_targets(dict(sizes)), defaultdict(int)
    for r in got:
        assert r["size"] == n_words(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]]) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for s, words_ in sizes.items():
        largest = max(n_words(r[1]) for r in rows if r[3] == s)
        largest += largest * (s == "s4")  # two rows of one id go together
        assert abs(taken[s] - target[s]) <= largest
    again = {(r["doc_id"], r["text"]): r["taken"] for r in mix(df.repartition(7)).collect()}
    assert all(again[r["doc_id"], r["text"]] == r["taken"] for r in got)


def test_mix_empty(nothing):
    assert mix(nothing).count() == 0
    assert [r["taken"] for r in mix(nothing.sparkSession.createDataFrame([(1, None, "a")], "doc_id long, text string, source string")).collect()] == [0]


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_exact_dedup(corpus, digest_bytes):
    """Short digests collide, so that texts must be compared."""
    rows, df = corpus
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    got = exact_dedup(df, digest_bytes=digest_bytes).collect()
    assert len(got) == len(rows)
    assert sum(r["kept"] for r in got) == len(groups)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[bytes(r["sha"]).hex()]
        assert r["id"] in ids and r["group_size"] == len(ids)
        assert r["keep"]["id"] == max((i for i in ids if i is not None), default=None)


def test_keep_last(corpus, nothing):
    rows, df = corpus
    got = keep_last(df)
    assert got.columns == df.columns
    assert got.count() == len({(r[1] or "").translate(LOWER) for r in rows})
    assert keep_last(nothing).count() == 0 and exact_dedup(nothing).count() == 0


def test_state_goes_on(spark, tmp_path):
    """A second run over the same state folder adds new files to the groups of the first."""
    from rentlens.llm.exact_dedup import digests, keyed_state
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    for k, ids in enumerate(([1, 2], [5, 9])):
        df = spark.createDataFrame([(i, "Same") for i in ids], "id long, body string").withColumns({"loc_file": F.lit(f"f{k}"), "loc_row": F.col("id")})
        d = digests(df)
        d.coalesce(1).write.mode("append").parquet(table)
        found = keyed_state(table, d.schema, spark, state).collect()
    assert [(r["n"], r["keep"]["id"]) for r in found] == [(4, 9)]


def brute_chunks(texts, least):
    seen, out = set(), []
    for t in texts:
        b, cut, kept, run = t.encode(), 0, b"", b""
        raw = np.frombuffer(b, np.uint8)
        for e in chunks_of(cut_marks(raw).tolist() if len(raw) else [], 0, len(b)):
            if b[cut:e] in seen:
                run += b[cut:e]
            else:
                kept += (run if len(run) < least else b"") + b[cut:e]
                run = b""
            seen.add(b[cut:e])
            cut = e
        out.append(kept + (run if len(run) < least and len(run) < len(b) else b""))
    return out


@pytest.mark.parametrize("least", [0, 100, RUN_BYTES])
def test_chunks(corpus, nothing, least):
    rows, df = corpus
    named = [r for r in rows if r[0] is not None]
    order = sorted(range(len(named)), key=lambda i: named[i][0])
    kept = brute_chunks([named[i][1] or "" for i in order], least)
    got = defaultdict(list)
    for r in chunk_dedup(df.filter("doc_id is not null").withColumn("digest", F.lit(1)).withColumn("start", F.lit("x")), least=least).collect():
        got[r["id"]].append(bytes(r["kept"]))
        assert hashlib.sha256(r["kept"]).digest() == r["kept_sha"] and r["n_bytes"] - r["n_removed"] == len(r["kept"])
    want = defaultdict(list)
    for i, k in zip(order, kept, strict=True):
        want[named[i][0]].append(k)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert chunk_dedup(df).count() == len(rows) and chunk_dedup(nothing).count() == 0


def test_chunks_resist_insertions(spark):
    text = words(5, 800)
    df = spark.createDataFrame([(1, text), (2, text[:2500] + " inserted words " + text[2500:])], "doc_id long, text string")
    got = {r["id"]: r for r in chunk_dedup(df).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] > 0.9 * got[2]["n_bytes"] and got[2]["n_spans"] == 2


def test_short_runs_stay(spark):
    """A phrase that two texts share stays; a short text that is a copy as a whole goes."""
    phrase = words(7, 15)
    df = spark.createDataFrame([(1, words(8, 200) + " " + phrase + " " + words(9, 200)), (2, words(10, 200) + " " + phrase + " " + words(11, 200)),
                                (3, "a short text"), (4, "a short text")], "doc_id long, text string")
    got = {r["id"]: r for r in chunk_dedup(df).collect()}
    assert len(phrase) < RUN_BYTES and [got[i]["n_removed"] for i in (1, 2, 3, 4)] == [0, 0, 0, 12] and got[4]["n_spans"] == 1


def test_passages_across_documents(spark):
    """A passage of over 50 words goes whole from later documents; phrases and what a text repeats of itself stay."""
    passage, phrase, own = words(71, 52), words(72, 40), words(73, 60)
    spaceless = "".join(chr(0x4E00 + (i * i * 37 + i * 11) % 5003) for i in range(300))
    rows = [(i, f"{words(500 + i, 90)} {passage} {words(600 + i, 90)}") for i in range(5)]
    rows += [(10 + i, f"{words(700 + i, 90)} {phrase} {words(800 + i, 90)}") for i in range(5)]
    rows += [(20, f"{own} {words(74, 30)} {own} {own}"), (30, f"été {spaceless}終"), (31, f"hiver {spaceless}末")]
    got = {r["id"]: r for r in chunk_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = len(passage.encode())
    assert len(phrase.encode()) > RUN_BYTES
    assert got[0]["n_removed"] == 0 and all(n <= got[i]["n_removed"] <= n + 20 and got[i]["n_spans"] == 1 for i in range(1, 5))
    assert not any(got[i]["n_removed"] for i in (10, 11, 12, 13, 14, 20, 30)) and got[31]["n_removed"] >= 512
    assert all(bytes(r["kept"]).decode() is not None for r in got.values())  # no character is cut
