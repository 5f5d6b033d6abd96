"""Merkle manifest (11), token files (12) and the prefix trie (13) against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentlens.llm import prefix_trie as T
from rentlens.llm import token_files as B
from rentlens.llm.merkle import fold, grow, merkle_manifest, n_levels, siblings

from .conftest import words

public_tokenizers = pytest.importorskip("public_tokenizers")
FIELDS = ["doc_id", "source", "lang", "size", "text"]


# --- Merkle manifest ----------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def brute_steps(levels, i, fanout):
    """(left siblings, right siblings) up to the last level."""
    out = []
    for nodes in levels[:-1]:
        a = i - i % fanout
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + fanout])))
        i //= fanout
    return out


def brute_manifest(rows, changed, fanout):
    """Rows are dictionaries of FIELDS; ``changed`` gives a row's replacement or None."""
    def leaf(r):
        return sha(*[encoded(r[f]) for f in FIELDS])

    by = defaultdict(list)
    for r in rows:
        other = changed(r)
        by[r["lang"]].append((r["doc_id"], leaf(r), leaf(other) if other else None))
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups:
        by[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] is not None, x[2] or ""))
    trees = {g: brute_levels([x[1] for x in by[g]], fanout) for g in groups}
    top = brute_levels([trees[g][-1][0] for g in groups], fanout)
    root, out = top[-1][0], []
    for k, g in enumerate(groups):
        for i, (doc, own, other) in enumerate(by[g]):
            steps = brute_steps(trees[g], i, fanout) + brute_steps(top, k, fanout)
            value = other or own
            for left, right in steps:
                value = sha(left, value, right)
            out.append((doc, own, trees[g][-1][0], root, sha(*[a + b for a, b in steps]), value, value == root))
    return out


@pytest.mark.parametrize(("fanout", "block"), [(2, 256), (2, 2), (3, 9), (5, 4)])
def test_manifest(corpus, fanout, block):
    rows, docs = corpus
    names = docs.columns
    docs = docs.withColumn("size", F.when(F.col("doc_id") % 4 != 3, F.col("doc_id")))
    records = [dict(zip(names, r, strict=True)) | {"size": r[0] if r[0] is not None and r[0] % 4 != 3 else None} for r in rows]

    def changed(r):
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["size"] is not None
        return r | {"size": r["size"] + 1} if hit else None

    condition = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("size").isNotNull()
    got = merkle_manifest(docs, "doc_id", FIELDS, "lang", condition, {"size": F.col("size") + 1}, fanout, block)
    key = lambda r: tuple(map(str, r))
    want = brute_manifest(records, changed, fanout)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert 0 < sum(not r[-1] for r in want) < len(want)


def test_manifest_of_one_and_none(spark, nothing):
    one = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, text string, lang string, source string, size long")
    (r,) = merkle_manifest(one, "doc_id", FIELDS, "lang").collect()
    assert r.leaf == r.subroot == r.root == r.folded_root == sha("1:1", "-" * 4) and r.verified and r.proof_sha256 == sha()
    assert merkle_manifest(nothing, "doc_id", FIELDS, "lang").count() == 0


def test_midstates():
    leaves = [sha(str(i)).encode() for i in range(23)]
    for fanout in (2, 3, 7):
        tree, top = grow(leaves, fanout, n_levels(len(leaves), fanout))
        levels = brute_levels([x.decode() for x in leaves], fanout)
        assert top[0].decode() == levels[-1][0]
        for i in range(len(leaves)):
            assert fold(tree, i, leaves[i], fanout) == top[0] != fold(tree, i, sha("other").encode(), fanout)
            assert [(a.decode(), b.decode()) for a, b in siblings(tree, i, fanout)] == brute_steps(levels, i, fanout)


# --- token files --------------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Don't STOP!!! it's <|endoftext|> a<|ENDOFTEXT|>b x<|endoftext|>. J̌ Á. İstanbul ΟΔΟΣ. a b c \x1c\x1d d\x85e",
       "3.14 a1b2,, (x). 'S 'll I'LL. we'LL K ﬁn .́ a.́ ́x \x00 a\x00b. ẞ STRASSE ǅ ²³ ½ ४५ 中文。 \U0001f600",
       "don't... \n\t\r\x0b\x0c--__ a_b A_B. Été, ü×÷; naïve: x​. " + "y" * 3000, "", " ", "<|startoftext|>", "ß.,;:!?ß"]


def encode_plainly(texts, path=PATH):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_words_are_encoded_as_in_whole_texts(monkeypatch):
    texts = ODD + [words(i, 200).title() for i in range(30)]
    with open(PATH, encoding="utf-8") as f:
        tokenizer = f.read()
    assert B.works_by_words(tokenizer)
    for size in (250_000, 40):  # words of two generations come and go
        monkeypatch.setattr(B, "CACHE_WORDS", size)
        monkeypatch.setattr(B, "_KEPT", [None, None])
        encode = B.encoder(tokenizer, 2, True)
        got = [encode([t.encode()])[0] for t in texts] + encode([t.encode() for t in texts])
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == encode_plainly(texts) * 2
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        assert not B.works_by_words(f.read())


@pytest.mark.parametrize(("name", "end", "width"), [("word_bpe_49k.json", 1, 2), ("byte_bpe_50k.json", 70_000, 4)])
def test_round_trip(spark, corpus, tmp_path, name, end, width):
    rows, docs = corpus
    path = public_tokenizers.path(name)
    odd = [(1000 + i, t, *[None] * (len(docs.columns) - 2)) for i, t in enumerate(ODD)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).repartition(3)
    manifest = B.write_token_files(docs, f"file://{tmp_path}/ids", path, end)
    got = B.read_token_files(manifest, with_tokens=True).orderBy("start").collect()
    pairs = sorted([(r[0], r[1]) for r in [*rows, *odd]], key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.id for r in got] == [p[0] for p in pairs]
    want = Counter((i, *ids, end) for (i, _), ids in zip(pairs, encode_plainly([p[1] for p in pairs], path), strict=True))
    assert Counter((r.id, *r.tokens) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.tokens)
        assert r.ids_crc32 == zlib.crc32(np.array(r.tokens, "<u4").tobytes())
        at += r.n_tokens
    for m in manifest.collect():
        assert m.width == width
        shard = B.Shard(m.path, m.width, m.docs, m.tokens)
        assert isinstance(shard.offsets, np.memmap) and int(shard.offsets[-1]) == m.tokens
        assert (tmp_path / "ids" / (m.path.rpartition("/")[2] + ".bin")).stat().st_size == m.tokens * width


def test_token_files_empty(nothing):
    assert B.token_round_trip(nothing, PATH, 1).count() == 0


# --- prefix trie --------------------------------------------------------------------------------


def brute_trie(built):
    """Rows of the nodes of {conv: ((role, text), ...)}."""
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    return [(m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
             sha(",".join(str(c) for c in m if built[c] == p))) for p, m in members.items()]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, key), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    return out


def talk():
    rows = []
    for c in range(60):
        if c % 10 == 5:
            continue  # a family without its first conversation
        for t in range(c % 12):
            rows.append((c, t, "user" if t % 2 else "system", "Hello." if t < 2 else f"{c % 3} été {t // 2}"))
    rows += [(7, None, None, None), (7, None, None, None), (11, 3, "user", ""), (11, 3, "user", ""), (11, 3, None, "b"), (None, 1, "user", "lost"),
             (61, 1, "user", "x" * 70_000), (62, 1, "user", "x" * 70_000), (10**12, 1, "a", "bc"), (10**12 + 1, 1, "ab", "c")]
    rows += [(100, t, "user", "again") for t in range(90)] + [(c, t, "user", "again") for c in (101, 102) for t in range(70 + c % 2)]
    return rows


@pytest.mark.parametrize(("shard_rows", "band"), [(1 << 11, 1 << 16), (40, 7), (1, 1)])
def test_trie(spark, shard_rows, band):
    rows = talk()
    table = spark.createDataFrame([(*r, 9, True) for r in rows], "conv_id long, turn long, role string, text string, depth int, last boolean").repartition(3)
    if band == 1:  # every depth a band of its own: fewer rows
        rows = [r for r in rows if r[0] is None or r[0] < 12]
        table = table.filter("conv_id is null or conv_id < 12")
    got = T.prefix_trie(T.with_shared_starts(T.placed_turns(table)), shard_rows, band)
    key = lambda r: (r[0], r[1], r[-1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_trie(rebuilt(rows)), key=key)


def test_trie_empty(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.prefix_trie(T.with_shared_starts(T.placed_turns(table))).count() == 0


def test_colliding_digests_are_found(spark):
    """Digests of one bit at first: the nodes are made with another seed."""
    rows = [(c, t, "user", f"{c % 2} {t}") for c in range(6) for t in range(3)]
    paths = T.with_shared_starts(T.placed_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    seeds = []

    def digests(p, seed):
        seeds.append(seed)
        d = T._digested(p, seed)
        return d if seed else d.withColumns({"na": F.lit(0).cast("long"), "nb": F.lit(0).cast("long")})

    _, nodes = T._nodes(paths, digests)
    assert seeds == [0, 1] and nodes.count() == len(brute_trie(rebuilt(rows)))


def test_minimal_hash():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 30_000):
        a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for _ in range(2))
        h = T.MinimalHash(a, b)
        assert sorted(h.slots(a, b).tolist()) == list(range(n))
    a = np.zeros(50, np.uint64)
    assert sorted(T.MinimalHash(a, np.arange(50, dtype=np.uint64)).slots(a, np.arange(50, dtype=np.uint64)).tolist()) == list(range(50))
    with pytest.raises(ValueError, match="equal"):
        T.NodeTable(a[:2], a[:2], a[:2], a[:2], np.zeros(2, np.int64))
