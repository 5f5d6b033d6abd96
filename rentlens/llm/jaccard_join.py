"""Exact n-gram Jaccard self-join into components, with set-relation skipping.

A document's set holds the 64-bit hashes of its distinct word 4-grams. Two sets
link when 100 * intersection >= 85 * union; the result is each document's
component under these links.

1. One pass makes a slim row per document: set size, digest of the set, and the
   head of the set, its smallest hashes. Documents with equal sets are one
   class, whose first document stands for it.
2. Prefix filter: two linked sets share a token among their first
   ``n - ceil(0.85 n) + 1`` in any order that all sets have in common. The order
   is by hash, with frequent tokens last; which tokens are frequent is counted
   over all heads, and only steers the cost, not the result. Sets whose head
   runs out of other tokens are read again in full.
3. Index-level skipping: an index list is split into blocks by set size, and an
   entry is paired with its own and the next smaller block's first entry only,
   if sizes and positions in the prefix still allow a link. These pairs are
   verified on the full sets and give components. Long lists that still hold
   several components get other leaders and go again.
4. Answer-level skipping: every linked set x has an anchor a, a verified partner
   at distance d(x, a) = 1 - Jaccard, if that is one of many members. What is left are pairs of different
   components that share a token. They are first compared by anchor: since
   Jaccard distance is a metric, x and y cannot link if
   d(a, b) > 0.15 + d(x, a) + d(y, b), so the answer of a highly similar set
   settles its neighbours; 256 parities of each set bound d(a, b) from below
   within the join, before any pair is made. Pairs of members are verified only where that bound
   leaves the question open, a few of each group first: groups that these link are one
   component and need no more. No list or group is paired with itself in full.

Defined results: null and empty texts have an empty set (size 0) and link with
nothing; a text of one to three words is one shingle; rows with the same id are
separate documents; a null id is no candidate for the smallest id; an empty
table gives an empty result. A very long text has the set of all its shingles.
Only id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import NOT_SPACE, in_arrow, join_small, located_whole, lowered, mix64, saved, text_slices, with_locator, without_places, word_hashes, word_spans

#: Fixed values of the contract.
WORDS, PART, WHOLE = 4, 85, 100
#: A token in more sets than this is a frequent one; so many of them are fetched at a time (8 bytes each).
LONG_LIST, MOST_FREQUENT = 100, 200_000
#: Tokens that a task holds before it sums them (8 bytes each).
FLUSH_TOKENS = 1 << 21
#: An anchor speaks for its members if it has so many.
GROUP = 16
#: So often the entries of long lists are paired with a leader, another one each time.
ROUNDS = 3
#: About how many members of a group are compared in each round before all of them are.
MEMBERS = (16, 128)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(data: bytes, off: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    raw = lowered(data)
    s, e, upto = word_spans(raw, off, NOT_SPACE)
    n = len(s)
    out = [np.zeros(0, np.int64)] * (len(off) - 1)
    if not n:
        return out
    h = word_hashes(raw, s, e)
    grams = np.zeros(n, np.uint64)
    end = np.repeat(upto[1:], np.diff(upto))
    at = np.arange(n)
    for k in range(words):
        inside = at + k < end  # only short documents are cut off here
        grams[inside] += h[at[inside] + k] * (_FACTORS[k % len(_FACTORS)] + np.uint64(2 * (k // len(_FACTORS))))
    count = np.repeat(np.diff(upto), np.diff(upto))
    grams = mix64(grams + np.minimum(count, words).astype(np.uint64)).view(np.int64)
    for d in range(len(out)):
        a, b = upto[d], upto[d + 1]
        if b > a:
            out[d] = np.unique(grams[a:max(a + 1, b - words + 1)])
    return out


def parity_bits(x: np.ndarray) -> np.ndarray:
    """Parities of a set's tokens in 256 classes, as four longs: two sets differ in as many tokens as in parities, or more."""
    odd = np.bincount(x >> 8 & 255, minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_length(n, part: int = PART, whole: int = WHOLE):
    """Tokens of which linked sets share one: n - ceil(part n / whole) + 1."""
    return n - -(-n * part // whole) + 1


def _head_length(n: int, part: int, whole: int) -> int:
    p = prefix_length(n, part, whole)
    return min(n, p + p // 2 + 2)


def shapes(located: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """node, id, loc_file, loc_row, n, digest, head, bits of rows (body, id, loc_file, loc_row)."""
    schema = StructType().add("node", "long")
    for f in located.drop("body").schema.fields:
        schema = schema.add(f)
    schema = schema.add("n", "integer").add("digest", "binary").add("head", ArrayType(LongType())).add("bits", ArrayType(LongType()))

    def run(batches):
        node = TaskContext.get().partitionId() << 40
        for batch in batches:
            n, digest, head, bits = [], [], [], []
            for _, _, data, off in text_slices(batch.column(0)):
                for x in shingle_sets(data, off, words):
                    n.append(len(x))
                    digest.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                    head.append(x[:_head_length(len(x), part, whole)])
                    bits.append(parity_bits(x))
            nodes = np.arange(node, node + len(n))
            node += len(n)
            cut = np.concatenate([[0], np.cumsum([len(x) for x in head])]).astype(np.int32)
            flat = np.concatenate([*head, np.zeros(0, np.int64)])
            four = pa.array(np.arange(0, 4 * len(n) + 1, 4, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), *batch.columns[1:], pa.array(n, pa.int32()), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(flat)),
                 pa.ListArray.from_arrays(four, pa.array(np.concatenate([*bits, np.zeros(0, np.int64)])))], names=schema.names)

    return located.transform(in_arrow, run, schema)


def full_sets(located: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, tokens (sorted) of the rows of ``nodes`` (node, loc_file, loc_row), read again from their texts."""
    rows = join_small(located.select("body", "loc_file", "loc_row"), nodes.select("node", "loc_file", "loc_row"),
                      ["loc_file", "loc_row"]).select("body", "node")

    def run(batches):
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(0)):
                sets = shingle_sets(data, off, words)
                cut = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, j - i), pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(sets)))],
                    names=["node", "tokens"])

    return rows.transform(in_arrow, run, "node long, tokens array<long>")


def _ordered_prefix(frequent, part: int, whole: int):
    """The Arrow step (node, n, sorted tokens) -> (node, n, prefix): by hash, frequent tokens last.

    A head without enough other tokens has no prefix (null), unless it is the whole set.
    """

    def prefix(x: np.ndarray, n: int) -> np.ndarray | None:
        f, p = frequent.value, prefix_length(n, part, whole)
        last = f[np.minimum(np.searchsorted(f, x), len(f) - 1)] == x if len(f) else np.zeros(len(x), bool)
        first = x[~last]
        if len(first) >= p:
            return first[:p]
        return np.concatenate([first, x[last]])[:p] if len(x) == n else None

    def run(batches):
        for batch in batches:
            sizes, cut, flat = batch.column(1).to_pylist(), np.asarray(batch.column(2).offsets), np.asarray(batch.column(2).values)
            found = [prefix(flat[i:j], n) for i, j, n in zip(cut[:-1].tolist(), cut[1:].tolist(), sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.int64()))], names=["node", "n", "prefix"])

    return run


def token_counts(sets: DataFrame, column: str) -> DataFrame:
    """token, size (sets that have it): summed in the tasks first, so that tokens of many copies are few rows."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            lists = batch.column(0)
            held.append(np.asarray(lists.flatten()))
            n += len(held[-1])
            if n >= FLUSH_TOKENS:
                yield _summed(held)
                held, n = [], 0
        if n:
            yield _summed(held)

    def _summed(held):
        token, size = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(size.astype(np.int64))], names=["token", "size"])

    return sets.select(column).transform(in_arrow, run, "token long, size long").groupBy("token").agg(F.sum("size").alias("size"))


def _frequent(counts: DataFrame, long_list: int) -> np.ndarray:
    """The most frequent tokens of (token, size) beyond ``long_list``: at most ``MOST_FREQUENT`` are fetched."""
    rows = counts.filter(F.col("size") > long_list).orderBy(F.desc("size"), "token").limit(MOST_FREQUENT).select("token").collect()
    return np.array([r[0] for r in rows], np.int64)


def prefixes(reps: DataFrame, counts: DataFrame, located: DataFrame, words: int, part: int, whole: int, long_list: int) -> tuple[DataFrame, DataFrame | None]:
    """(node, n, prefix) of all sets, in one order for all; those that were read again in full apart.

    Frequent tokens are found by their counts in all heads. Sets that hold
    little else in their head are read again and counted in full, so that the
    frequent tokens behind their heads are known as well.
    """
    cast, schema = reps.sparkSession.sparkContext.broadcast, "node long, n int, prefix array<long>"
    frequent, full = np.sort(_frequent(counts, long_list)), None
    for again in range(2):
        headed = saved(reps.select("node", "n", "head").transform(in_arrow, _ordered_prefix(cast(frequent), part, whole), schema), "jaccard-prefix")
        short = saved(headed.filter("prefix is null").select("node"), "jaccard-short")
        if not short.limit(1).count():
            return headed, None
        places = saved(join_small(reps.select("node", "loc_file", "loc_row"), short, "node"), "jaccard-short-places")
        full = saved(full_sets(located, places, words), "jaccard-short-sets")
        if again:
            break
        more = np.union1d(frequent, _frequent(token_counts(full, "tokens"), long_list))
        if len(more) == len(frequent):
            break
        frequent = more
    reread = full.select("node", F.size("tokens").alias("n"), "tokens").transform(in_arrow, _ordered_prefix(cast(frequent), part, whole), schema)
    return headed.filter("prefix is not null"), saved(reread, "jaccard-reread")


def _postings(prefix: DataFrame) -> DataFrame:
    return prefix.select("node", "n", F.posexplode("prefix").alias("pos", "token"))


def _may_link(n1, pos1, n2, pos2, part: int, whole: int):
    """Sizes allow a link, and so do the tokens left after the shared one."""
    left = F.least(n1 - pos1, n2 - pos2)
    return (F.least(n1, n2) * whole >= F.greatest(n1, n2) * part) & (left * (whole + part) >= (n1 + n2) * part)


def _stars(index: DataFrame, leads: DataFrame, part: int, whole: int) -> DataFrame:
    """Distinct pairs (a, b) of entries with the first of their own and of the next smaller block, if of another component."""
    own = index.join(leads.filter("size > 1").select("token", "block", "lead"), ["token", "block"])
    next_ = index.join(leads.select("token", (F.col("block") + 1).alias("block"), "lead"), ["token", "block"])
    return (own.unionByName(next_).where((F.col("node") != F.col("lead.node")) & (F.col("c") != F.col("lead.c")))
            .where(_may_link(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"), part, whole))
            .select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, root: components of the edges (a, b) by contraction; a constant part of the labels goes in each round."""
    edges = edges.select("a", "b").where("a <> b")
    now = saved(edges.distinct(), "components-edges", edges.count())
    label, n = None, now.count()
    for round_ in range(200):
        if not n:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(round_)).alias("h"), F.col(c).alias("v"))
        best = both.groupBy("a").agg(F.least(F.min(rank("b")), F.first(rank("a"))).alias("m")).select(F.col("a").alias("v"), F.col("m.v").alias("to"))
        best = saved(best, "components-step", 2 * n)
        if label is None:
            label, nodes = best, 2 * n
        else:
            label = saved(label.join(best.select(F.col("to").alias("to2"), F.col("v").alias("to")), "to", "left")
                          .select("v", F.coalesce("to2", "to").alias("to")), "components-labels", nodes)
        step = best.select(F.col("v").alias("a"), F.col("to").alias("a2"))
        now = saved(now.join(step, "a").join(step.select(F.col("a").alias("b"), F.col("a2").alias("b2")), "b")
                    .where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "components-edges", n)
        n = now.count()
    if not n:
        return (now.select("a", "b") if label is None else label.select("v", "to")).toDF("node", "root")
    raise RuntimeError("components did not converge")


def _contracted(root: DataFrame, links: DataFrame) -> DataFrame:
    """``root`` (node, root) after more links (a, b): only the links between components are contracted."""
    named = links.join(root.toDF("a", "ra"), "a", "left").join(root.toDF("b", "rb"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    step = components(saved(named.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-crossing"))
    new = step.select("node", F.col("node").alias("root")).join(root, "node", "left_anti")
    return saved(root.unionByName(new).join(step.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "jaccard-roots")


class _Verifier:
    """Exact intersections of the pairs of nodes that may be near enough.

    Heads settle most pairs: if two sets share ``need`` tokens, then the first
    ``n - need + k`` tokens of both share ``k``. Full sets are made only for
    what is left, once for every node that is asked for.
    """

    def __init__(self, located: DataFrame, reps: DataFrame, words: int, part: int, whole: int):
        self.located, self.reps, self.words, self.least, self.sets, self.known = located, reps, words, part / whole, None, None

    def _possible(self, pairs: DataFrame) -> DataFrame:
        head = lambda c: self.reps.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("head").alias(f"h{c}"))
        t = F.lit(self.least) - F.col("slack") - 1e-9
        need = F.ceil(t / (t + 1) * (F.col("na") + F.col("nb")))
        k = F.least(F.size("ha") - F.col("na"), F.size("hb") - F.col("nb")) + need
        return saved(pairs.join(head("a"), "a").join(head("b"), "b").where((k <= 0) | (F.size(F.array_intersect("ha", "hb")) >= k))
                     .select("a", "b"), "jaccard-possible", 4 * pairs.count())

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """a, b, both (intersection size), na, nb of those of the distinct pairs (a, b, slack) whose distance may be within the limit plus slack."""
        pairs = self._possible(pairs)
        n = pairs.count()
        asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        if self.known is not None:
            asked = asked.join(self.known, "node", "left_anti")
        asked = saved(asked, "jaccard-asked", 2 * n)
        places = saved(join_small(self.reps.select("node", "loc_file", "loc_row"), asked, "node"), "jaccard-places")
        new = saved(full_sets(self.located, places, self.words), "jaccard-sets")
        self.sets = new if self.sets is None else self.sets.unionByName(new)
        self.known = asked if self.known is None else self.known.unionByName(asked)
        sa = self.sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
        sb = self.sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
        return saved(pairs.join(sa, "a").join(sb, "b").select(
            "a", "b", F.size(F.array_intersect("ta", "tb")).alias("both"), F.size("ta").alias("na"), F.size("tb").alias("nb")), "jaccard-verified", 10 * n)


def _linked(part: int, whole: int):
    return F.col("both") * whole >= (F.col("na") + F.col("nb") - F.col("both")) * part


def _at_least(bits1: str, bits2: str, n1: str, n2: str):
    """A lower bound of the distance of two sets, from their parities and sizes."""
    differ = sum(F.bit_count(F.col(bits1)[i].bitwiseXOR(F.col(bits2)[i])) for i in range(4))
    return differ * 2 / (F.col(n1) + F.col(n2) + differ)


def _distance():
    return 1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, part: int = PART,
                       whole: int = WHOLE, long_list: int = LONG_LIST, group: int = GROUP) -> DataFrame:
    """id, loc_file, loc_row, n (set size), class_id (smallest id with this set), component_id, component, grouped.

    One row per document. ``component`` tells components apart where ids repeat
    or are null; ``grouped`` says that the component has other documents.
    """
    rows = docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id"))
    return _joined(with_locator(rows, ["body", "id"], "jaccard-rows"), words, part, whole, long_list, group)


def _joined(located: DataFrame, words: int = WORDS, part: int = PART, whole: int = WHOLE, long_list: int = LONG_LIST, group: int = GROUP) -> DataFrame:
    shape = saved(shapes(located, words, part, whole), "jaccard-shapes")
    slim = shape.filter("n > 0").select("id", "loc_file", "loc_row", "node", "digest")

    classes = saved(slim.groupBy("digest").agg(F.min("id").alias("class_id"), F.min("node").alias("rep"), F.count(F.lit(1)).alias("size")), "jaccard-classes")
    several = saved(classes.filter("size > 1").select("digest", "rep"), "jaccard-several")
    copies = saved(join_small(slim, several, "digest").filter("node <> rep").select("node"), "jaccard-copies")
    reps = join_small(shape.filter("n > 0").select("node", "loc_file", "loc_row", "n", "head", "bits"), copies, "node", "left_anti")

    root = _component_roots(located, reps, words, part, whole, long_list, group)
    linked = classes.join(root.withColumnRenamed("node", "rep"), "rep").select("digest", "class_id", "root")
    smallest = linked.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = linked.join(smallest, "root")
    # sets of one document without links are named by their own id; only the others are looked up
    names = saved(classes.filter("size > 1").select("digest", "class_id", "rep").join(named.select("digest", "root", "component_id"), "digest", "left")
                  .select("digest", "class_id", F.coalesce("root", "rep").alias("component"), F.coalesce("component_id", "class_id").alias("component_id"))
                  .unionByName(named.join(classes.filter("size = 1").select("digest"), "digest", "left_semi")
                               .select("digest", "class_id", F.col("root").alias("component"), "component_id")), "jaccard-names")
    out = join_small(shape.select("id", "loc_file", "loc_row", "n", "node", F.when(F.col("n") > 0, F.col("digest")).alias("digest")), names, "digest", "left")
    return out.select("id", "loc_file", "loc_row", F.col("n").cast("long").alias("n"), F.coalesce("class_id", "id").alias("class_id"),
                      F.coalesce("component_id", "id").alias("component_id"), F.coalesce("component", "node").alias("component"),
                      F.col("component").isNotNull().alias("grouped"))


def _component_roots(located: DataFrame, reps: DataFrame, words: int, part: int, whole: int, long_list: int, group: int) -> DataFrame:
    """node, root of every representative that is linked with another one."""
    counts = saved(token_counts(reps, "head").filter("size > 1"), "jaccard-counts")
    normal, reread = prefixes(reps, counts, located, words, part, whole, long_list)
    shared = counts.select("token")
    index = _postings(normal)
    if reread is not None:  # their later tokens have not been counted
        shared = saved(shared.unionByName(_postings(reread).select("token")).distinct(), "jaccard-tokens")
        index = index.unionByName(_postings(reread))
    index = saved(index.join(shared, "token", "left_semi"), "jaccard-index")
    n_index = index.count()

    verify = _Verifier(located, reps, words, part, whole)
    block = F.floor(F.log(F.col("n").cast("double")) / np.log(whole / part)).cast("int")
    index = index.withColumn("block", block)
    first = saved(index.groupBy("token", "block").agg(F.min(F.struct("node", "n", "pos", F.col("node").alias("c"))).alias("lead"), F.count(F.lit(1)).alias("size")),
                  "jaccard-leads", n_index)
    tested = saved(_stars(index.withColumn("c", F.col("node")), first, part, whole), "jaccard-star", n_index)
    checked = verify(tested.withColumn("slack", F.lit(0.0)))
    links = checked.filter(_linked(part, whole))
    root = components(links)
    for again in range(1, ROUNDS):  # long lists of several components: other entries lead
        named = index.join(root, "node", "left").withColumn("c", F.coalesce("root", "node")).drop("root")
        busy = named.groupBy("token").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.count(F.lit(1)).alias("size")).where(
            (F.col("c1") != F.col("c2")) & (F.col("size") >= group)).select("token")
        rest = saved(named.join(saved(busy, "jaccard-busy", n_index), "token", "left_semi"), "jaccard-rest", n_index)
        lead = rest.groupBy("token", "block").agg(F.min(F.struct(F.xxhash64("node", F.lit(again)).alias("h"), "node", "n", "pos", "c")).alias("lead"), F.count(F.lit(1)).alias("size"))
        new = saved(_stars(rest, saved(lead, "jaccard-leads", n_index), part, whole).join(tested, ["a", "b"], "left_anti"), "jaccard-star", n_index)
        if not new.limit(1).count():
            break
        got = verify(new.withColumn("slack", F.lit(0.0)))
        tested, checked = tested.unionByName(new), checked.unionByName(got)
        more = got.filter(_linked(part, whole))
        if not more.limit(1).count():
            break
        links = links.unionByName(more)
        root = _contracted(root, more)
    n_links = links.count()

    # anchor: the nearest verified partner; a set without one is its own anchor
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("to"), _distance().alias("d")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("to"), _distance().alias("d")))
    lead = first.select(F.col("lead.node").alias("to")).distinct().withColumn("leads", F.lit(0))
    anchor = saved(ends.join(lead, "to", "left").groupBy("node").agg(F.min(F.struct(F.coalesce("leads", F.lit(1)), "d", "to")).alias("m"))
                   .select("node", F.col("m.to").alias("anchor"), F.col("m.d").alias("d")).join(root, "node"), "jaccard-anchored", 2 * n_links)
    large = anchor.groupBy("anchor").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= group).select("anchor", F.lit(True).alias("large"))
    # the members of a small group are compared themselves: their own distances are sharper than an anchor's radius
    anchor = saved(anchor.join(large, "anchor", "left").select(
        "node", F.when(F.col("large"), F.col("anchor")).otherwise(F.col("node")).alias("anchor"),
        F.when(F.col("large"), F.col("d")).otherwise(0.0).alias("d"), "root"), "jaccard-anchors", 2 * n_links)
    entry = (index.join(anchor, "node", "left")
             .groupBy("token", F.coalesce("anchor", "node").alias("x"), F.coalesce("root", "node").alias("c"))
             .agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("pos")))
    open_ = saved(entry, "jaccard-entries", n_index)
    mixed = open_.groupBy("token").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select("token")
    # an anchor's radius: its farthest member. Members of a are sets anchored at a, and a itself
    member = anchor.select("node", F.col("anchor").alias("x"), "d", F.col("root").alias("c"))
    member = saved(member.unionByName(anchor.select("node", F.col("node").alias("x"), F.lit(0.0).alias("d"), F.col("root").alias("c"))), "jaccard-members", 4 * n_links)
    reach = member.groupBy("x").agg(F.max("d").alias("r"))
    about = reps.select(F.col("node").alias("x"), F.col("n").alias("nx"), "bits").join(reach, "x", "left").withColumn("r", F.coalesce("r", F.lit(0.0)))
    open_ = saved(open_.join(mixed, "token", "left_semi").join(about, "x"), "jaccard-open", n_index)
    e, f, limit = open_.alias("e"), open_.alias("f"), 1 - part / whole
    # with sizes lo..hi, the least that both groups must share against the most tokens that are left
    possible = ((F.col("e.hi") * whole >= F.col("f.lo") * part) & (F.col("f.hi") * whole >= F.col("e.lo") * part)
                & (F.least(F.col("e.hi") - F.col("e.pos"), F.col("f.hi") - F.col("f.pos")) * (whole + part) >= (F.col("e.lo") + F.col("f.lo")) * part))
    # anchors that differ in many parities are too far apart for any of their members
    near_enough = _at_least("e.bits", "f.bits", "e.nx", "f.nx") <= limit + F.col("e.r") + F.col("f.r") + 1e-9
    pairs = saved(e.join(f, (F.col("e.token") == F.col("f.token")) & (F.col("e.x") < F.col("f.x")) & (F.col("e.c") != F.col("f.c")) & possible & near_enough)
                  .select(F.col("e.x").alias("a"), F.col("f.x").alias("b"), (F.col("e.r") + F.col("f.r")).alias("slack")).distinct(), "jaccard-anchor-pairs", n_index)
    fresh = pairs.join(checked, ["a", "b"], "left_anti")
    fresh = saved(fresh.filter("slack > 0").unionByName(fresh.filter("slack = 0").join(tested, ["a", "b"], "left_anti")), "jaccard-fresh", pairs.count())
    of_pairs = checked.select("a", "b", "both", "na", "nb")
    if fresh.limit(1).count():
        of_pairs = of_pairs.unionByName(verify(fresh))
    of_pairs = of_pairs.join(pairs, ["a", "b"])
    more = of_pairs.filter(_linked(part, whole)).select("a", "b")
    near = of_pairs.withColumn("far", _distance()).where((F.col("slack") > 0) & (F.col("far") <= limit + F.col("slack") + 1e-9)).select("a", "b", "far")
    near = saved(near, "jaccard-near", pairs.count())
    if more.limit(1).count():
        root = _contracted(root, more)
    return _member_links(near, member, reps, root, verify, tested.unionByName(fresh.select("a", "b")), part, whole)


def _member_links(near: DataFrame, member: DataFrame, reps: DataFrame, root: DataFrame, verify: _Verifier, tested: DataFrame, part: int, whole: int) -> DataFrame:
    """``root`` after the links between members of the near groups (a, b, far) of different components.

    In rounds: of each group first about ``MEMBERS[0]`` members are compared,
    then more, then all. Components that a round has linked need no more pairs, so
    the last round only meets groups of which nothing has been found near enough.
    """
    limit = 1 - part / whole
    sizes = reps.select("node", "n", "bits")
    lone = near.select(F.col("a").alias("x")).unionByName(near.select(F.col("b").alias("x"))).distinct().join(member, "x", "left_anti")
    member = member.select("x", "node", "d").join(near.select(F.col("a").alias("x")).unionByName(near.select(F.col("b").alias("x"))).distinct(), "x", "left_semi")
    member = member.unionByName(lone.select("x", F.col("x").alias("node"), F.lit(0.0).alias("d"))).groupBy("x", "node").agg(F.min("d").alias("d"))
    group = member.groupBy("x").agg(F.count(F.lit(1)).alias("of"), F.max("d").alias("r"))
    # place: about how many members of the group come before this one, in an order by hash
    place = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) / F.lit(1 << 30) * F.col("of")
    member = saved(member.join(group, "x").join(sizes, "node").withColumn("place", place), "jaccard-member-sizes")
    about = saved(member.filter("node = x").select("x", "r", "n", "bits"), "jaccard-member-anchors")
    done = 0.0
    for upto in (*MEMBERS, None):
        now = near.join(root.toDF("a", "ca"), "a", "left").join(root.toDF("b", "cb"), "b", "left").where(
            F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b", "far")
        near = saved(now.join(about.toDF("a", "ra", "na", "bita"), "a").join(about.toDF("b", "rb", "nb", "bitb"), "b"), "jaccard-near-open")
        if not near.limit(1).count():
            break
        chosen = member if upto is None else member.filter(F.col("place") < upto)
        mx = chosen.select(F.col("x").alias("a"), F.col("node").alias("x_"), F.col("d").alias("dx"), F.col("n").alias("nx"), F.col("bits").alias("bx"), F.col("place").alias("px"))
        my = chosen.select(F.col("x").alias("b"), F.col("node").alias("y_"), F.col("d").alias("dy"), F.col("n").alias("ny"), F.col("bits").alias("by"), F.col("place").alias("py"))
        # a member is compared with the other anchor first, within the join: the farthest member there is rb off
        left = near.join(mx, (near["a"] == mx["a"]) & (F.col("far") <= limit + F.col("dx") + F.col("rb") + 1e-9)
                         & (_at_least("bx", "bitb", "nx", "nb") <= limit + F.col("rb") + 1e-9)).drop(mx["a"])
        cross = (left.join(my, (left["b"] == my["b"]) & ((F.col("px") >= done) | (F.col("py") >= done))
                           & (F.col("far") <= limit + F.col("dx") + F.col("dy") + 1e-9) & (F.least("nx", "ny") * whole >= F.greatest("nx", "ny") * part)
                           & (_at_least("bita", "by", "na", "ny") <= limit + F.col("dx") + 1e-9) & (_at_least("bx", "by", "nx", "ny") <= limit + 1e-9))
                 .select(F.least("x_", "y_").alias("a"), F.greatest("x_", "y_").alias("b")).distinct())
        cross = saved(cross.join(tested, ["a", "b"], "left_anti").withColumn("slack", F.lit(0.0)), "jaccard-cross")
        if cross.limit(1).count():
            links = saved(verify(cross).filter(_linked(part, whole)).select("a", "b"), "jaccard-member-links")
            if links.limit(1).count():
                root = _contracted(root, links)
        near, done = near.select("a", "b", "far"), float(upto or 0)
    return root


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of which one per component stays (its smallest id, then file order), with all their columns."""
    located = located_whole(docs, "jaccard-docs")
    found = _joined(located.select(F.col(f"whole.`{text_col}`").alias("body"), F.col(f"whole.`{id_col}`").alias("id"), "loc_file", "loc_row"), **options)
    group = saved(found.filter("grouped").select("component", F.struct(F.col("id").isNull().alias("no"), "id", "loc_file", "loc_row").alias("me")), "jaccard-groups")
    first = group.groupBy("component").agg(F.min("me").alias("stays"))
    dropped = group.join(first, "component").where(F.col("me") != F.col("stays")).select("me.loc_file", "me.loc_row")
    return without_places(located, saved(dropped, "jaccard-dropped"))
