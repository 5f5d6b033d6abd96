"""Trie of conversation prefixes: shared turns, counted and summed over subtrees.

A node is a distinct sequence of first turns. Its digest is a sum of hashes of
(place, turn) over the sequence, so that all prefixes of all conversations come
from distributed running sums, however long one conversation is. Grouping by
digest enumerates the nodes; that all rows of a digest agree in parent, depth and
last turn is checked (by induction they are then the same sequence), and if
they ever do not, everything is done again with another seed.

Subtree sums use the table of a shard: whole paths of a set of conversations
(those that may share a start stay together), so a hot first turn is spread
over all shards. A shard's digests get slots from a minimal perfect hash; the
stored digest at a slot confirms it. Weights are scattered into flat numpy arrays
by slot: what a node adds to its ancestors is put in one shard only, that of
its smallest member. Each depth, from the deepest up, is added to the slots of
its parents. Shards emit one row a node, and these rows add up.

Bounds: a shard has about ``SHARD_ROWS`` rows. Conversations deeper than ``BAND``
turns are done in bands, from the deepest up, so the rows of a shard in a
band are bounded by its conversations times ``BAND``; a band hands the sums of its
top nodes to the next one. The ids of the conversations that end in a node are
put together in runs of at most 65,536 and hashed as a stream.

Defined results: a null role or text is empty; null turns come first; rows with
equal turns are ordered by the hash of role and text, and repeated rows are turns
of their own; turns without a conversation id belong to no conversation. Very
long texts are hashed where they are read and never shuffled. Remainders take
the sign of the id. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.operators.ranking import prefix_sums

from .common import in_arrow, join_small, mix64, saved

#: Rows (nodes of conversations) that a shard has on average.
SHARD_ROWS = 1 << 11
#: Turns of a conversation that one shard takes at once.
BAND = 1 << 16
#: Bits of a conversation id inside a run of ids.
RUN_BITS = 16
#: The digest of a node, and that of its parent.
NODE, PARENT = ["na", "nb"], ["pa", "pb"]
HALF = 0xFFFFFFFF
#: Levels of a minimal perfect hash after which only equal keys can be left (each takes over half of the keys that are left).
MOST_LEVELS = 256


class MinimalHash:
    """Slots 0 to n - 1 for n different 128-bit keys (two uint64 arrays), in levels.

    On each level the keys that are alone at their place of a bit array stay
    there; the rest goes on with another seed. A slot is the number of set bits
    before that place.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []  # size, and slots by place (-1: nobody's)
        used, seed = 0, 0
        while len(a):
            size = 2 * len(a) + 1
            at = self._place(a, b, seed, size)
            alone = np.bincount(at, minlength=size) == 1
            slots = np.where(alone, used + np.cumsum(alone) - 1, -1)
            used += int(alone.sum())
            self.levels.append((size, slots))
            left = ~alone[at]
            a, b, seed = a[left], b[left], seed + 1
            if seed >= MOST_LEVELS:
                raise ValueError("two keys are equal")

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, seed: int, size: int) -> np.ndarray:
        mixed = mix64(a ^ mix64(b + np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))))
        return (mixed % np.uint64(size)).astype(np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of keys; of a key that is not in the table any slot or -1, so compare the stored key."""
        out = np.full(len(a), -1, np.int64)
        for seed, (size, slots) in enumerate(self.levels):
            open_ = np.flatnonzero(out < 0)
            if not len(open_):
                break
            out[open_] = slots[self._place(a[open_], b[open_], seed, size)]
        return out


class NodeTable:
    """Nodes of one shard by slot, and the slots of their parents (-1 if the parent is not here)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, parent_a: np.ndarray, parent_b: np.ndarray, depth: np.ndarray):
        self.hash = MinimalHash(a, b)
        self.slot = self.hash.slots(a, b)  # by row
        self.a, self.b = self.scattered(a), self.scattered(b)
        self.depth = self.scattered(depth)
        up = self.hash.slots(parent_a, parent_b)
        here = (up >= 0) & (self.a[up] == parent_a) & (self.b[up] == parent_b) & (depth > 0)
        self.parent = self.scattered(np.where(here, up, -1))
        order = np.argsort(self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        self.by_depth = np.split(order, cuts)

    def scattered(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), rows.dtype)
        out[self.slot] = rows
        return out

    def add_up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees, in place: from the deepest nodes up, each is added to its parent."""
        for nodes in reversed(self.by_depth):
            nodes = nodes[self.parent[nodes] >= 0]
            np.add.at(values, self.parent[nodes], values[nodes])
        return values


def _shard(t: pa.Table, top: int) -> pa.Table:
    """Partial sums of the nodes of a shard; ``top`` is the depth of the band's first nodes.

    Nodes above it are there as parents: what they gather goes on to the next band.
    """
    get = {c: t.column(c).to_numpy() for c in ("na", "nb", "pa", "pb", "depth", "own", "first", "leaf", "saved", "more_leaves", "more_saved")}
    table = NodeTable(*(get[c].view(np.uint64) for c in ("na", "nb", "pa", "pb")), get["depth"])
    own, first = table.scattered(get["own"]), table.scattered(get["first"])
    counted = own & (table.depth >= top)
    leaves = table.add_up(np.where(counted, table.scattered(get["leaf"]), 0) + table.scattered(get["more_leaves"]))
    saved_ = table.add_up(np.where(counted, table.scattered(get["saved"]), 0) + table.scattered(get["more_saved"]))
    children = np.zeros(len(own), np.int64)
    kids = np.flatnonzero(counted & (table.parent >= 0))
    np.add.at(children, table.parent[kids], 1)
    keep = np.flatnonzero(counted | (leaves > 0) | (saved_ > 0) | (children > 0))
    has_parent = counted[keep] & (table.parent[keep] >= 0)
    parent = first[table.parent[keep]]
    shard = t.column("shard")[0].as_py()
    return pa.table({
        "shard": pa.array(np.full(len(keep), shard, np.int64)), "na": table.a[keep].view(np.int64), "nb": table.b[keep].view(np.int64),
        "depth": table.depth[keep], "n_children": children[keep], "n_leaves": leaves[keep], "saved_tokens": saved_[keep],
        "parent_conv_id": pa.array(parent, mask=~has_parent)})


def _shard_from(top: int):
    return lambda t: _shard(t, top)


def _end_hashes(batches):
    """SHA-256 over the runs of ids of each node; rows come sorted by node and run."""
    last, h = None, hashlib.sha256()
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if (a, b) != last:
                if last is not None:
                    out.append((*last, h.hexdigest()))
                last, h = (a, b), hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids.encode())
        yield _rows(out)
    if last is not None:
        yield _rows([(*last, h.hexdigest())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, sha = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sha, pa.string())], names=[*NODE, "ends_sha256"])


# --- conversations ------------------------------------------------------------------------------


def placed_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, pos (from 0), n_turns, sha (of role and text), n_bytes (of the text) of every turn; saved."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("sha"), F.lit(1).cast("long").alias("one"))
    # the hash is compared as hex text, as SQL has it
    return saved(prefix_sums(slim, "turn", {"upto": "one"}, ties=[F.col("sha").asc()], by=["conv"], total="n_turns").select(
        "conv", (F.col("upto") - 1).alias("pos"), "n_turns", F.unhex("sha").alias("sha"), "n_bytes"), "trie-turns")


def with_shared_starts(placed: DataFrame, family: int = 5, period: int = 9) -> DataFrame:
    """conv, family, depth, sha, n_bytes, last of every conversation as it is rebuilt, depth 0 included.

    Conversation c gets the first crc32(c) % ``period`` turns of conversation
    c - c % ``family`` in place of as many of its own.
    """
    convs = placed.filter("pos = 0").select("conv", "n_turns")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % period).alias("h")
    convs = convs.select("conv", "n_turns", h, (F.col("conv") - F.col("conv") % family).alias("family"))
    starts = convs.select(F.col("conv").alias("family"), F.col("n_turns").alias("n_family"))
    convs = saved(convs.join(starts, "family", "left").select(
        "conv", "family", "h", F.least("h", F.coalesce("n_family", F.lit(0))).alias("n_head"), "n_turns")
        .withColumn("total", F.col("n_head") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))), "trie-convs")
    plan = convs.select("conv", "family", "h", "n_head", "total")
    heads = placed.filter(F.col("pos") < period - 1).select(F.col("conv").alias("family"), "pos", "sha", "n_bytes").join(plan, "family").where(
        "pos < h").withColumn("depth", F.col("pos") + 1)
    tails = join_small(placed.select("conv", "pos", "sha", "n_bytes"), plan, "conv").where("pos >= h").withColumn(
        "depth", F.col("n_head") + F.col("pos") - F.col("h") + 1)
    roots = plan.select("conv", "family", "total", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("sha"), F.lit(0).cast("long").alias("n_bytes"))
    columns = ["conv", "family", F.col("depth").cast("long").alias("depth"), "sha", "n_bytes", (F.col("depth") == F.col("total")).alias("last")]
    return heads.select(*columns).unionByName(tails.select(*columns)).unionByName(roots.select(*columns))


def _digested(paths: DataFrame, seed: int) -> DataFrame:
    """Adds the digests of every node and its parent, running sums over a conversation; saved."""
    half = {}
    for k in range(2):
        h = F.xxhash64(F.lit(seed), F.lit(k), "depth", "sha")
        half |= {f"h{2 * k}": F.shiftrightunsigned(h, 32), f"h{2 * k + 1}": h.bitwiseAND(HALF)}
    sums = {f"s{k}": f"h{k}" for k in range(4)}
    d = prefix_sums(paths.withColumns(half), "depth", sums, by=["conv"])

    def packed(high: Column, low: Column) -> Column:
        return F.shiftleft(high.bitwiseAND(HALF), 32).bitwiseOR(low.bitwiseAND(HALF))

    s, before = [F.col(f"s{k}") for k in range(4)], [F.col(f"s{k}") - F.col(f"h{k}") for k in range(4)]
    return saved(d.select("conv", "family", "depth", "sha", "n_bytes", "last", packed(s[0], s[1]).alias("na"), packed(s[2], s[3]).alias("nb"),
                          packed(before[0], before[1]).alias("pa"), packed(before[2], before[3]).alias("pb")), "trie-paths")


def _nodes(paths: DataFrame, digests=_digested) -> tuple[DataFrame, DataFrame]:
    """Paths with digests, and the distinct nodes: n_convs, n_ends, first (smallest member), n_bytes, depth; both saved."""
    seed = 0
    while True:
        own = digests(paths, seed)
        nodes = saved(own.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.count_if("last").alias("n_ends"), F.min("conv").alias("first"),
            F.first("n_bytes").alias("n_bytes"), F.min("depth").alias("depth"), F.max("depth").alias("depth_2"),
            *[f(c).alias(f"{c}_{k}") for c in ("sha", *PARENT) for k, f in enumerate((F.min, F.max))]), "trie-nodes")
        alike = F.col("depth") == F.col("depth_2")
        for c in ("sha", *PARENT):
            alike &= F.col(f"{c}_0").eqNullSafe(F.col(f"{c}_1"))
        if nodes.filter(~alike).isEmpty():
            return own, nodes.select(*NODE, "n_convs", "n_ends", "first", "n_bytes", "depth")
        seed += 1


def _subtrees(paths: DataFrame, nodes: DataFrame, shard_rows: int, band: int) -> DataFrame:
    """na, nb, n_children, n_leaves, saved_tokens, parent_conv_id of every node; partial rows of the shards, summed."""
    shards = max(1, -(-paths.count() // shard_rows))
    shard = F.pmod(F.xxhash64("family"), F.lit(shards)).alias("shard")
    mine = paths.groupBy(shard, *NODE, *PARENT).agg(F.min("conv").alias("here"))
    weight = (F.col("n_convs") - 1) * F.col("n_bytes")
    rows = saved(mine.join(nodes, NODE).select(
        "shard", *NODE, *PARENT, "depth", "first", (F.col("here") == F.col("first")).alias("own"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"), weight.cast("long").alias("saved")), "trie-shards")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    schema = "shard long, na long, nb long, depth long, n_children long, n_leaves long, saved_tokens long, parent_conv_id long"
    done, carry = [], None
    for top in range(deepest // band * band, -1, -band):
        part = rows if top == 0 and deepest < band else rows.filter((F.col("depth") >= top - 1) & (F.col("depth") < top + band))
        if carry is None:
            part = part.withColumns({"more_leaves": F.lit(0).cast("long"), "more_saved": F.lit(0).cast("long")})
        else:
            part = part.join(carry, ["shard", *NODE], "left").na.fill(0, ["more_leaves", "more_saved"])
        sums = saved(part.groupBy("shard").applyInArrow(_shard_from(top), schema), "trie-sums")
        over = F.col("depth") < top  # parents of the band's first nodes: their sums go on
        carry = sums.filter(over).select("shard", *NODE, F.col("n_leaves").alias("more_leaves"), F.col("saved_tokens").alias("more_saved"))
        done.append(sums.withColumns({c: F.when(over, 0).otherwise(F.col(c)) for c in ("n_leaves", "saved_tokens")}))
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")], F.max("parent_conv_id").alias("parent_conv_id"))


def _ends(paths: DataFrame) -> DataFrame:
    """na, nb, ends_sha256 of the nodes in which conversations end."""
    runs = paths.filter("last").groupBy(*NODE, F.shiftright("conv", RUN_BITS).alias("run")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    return runs.repartition(*NODE).sortWithinPartitions(*NODE, "run").select(*NODE, "ids").transform(
        in_arrow, _end_hashes, "na long, nb long, ends_sha256 string")


def prefix_trie(paths: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``paths`` has a row for each depth of each conversation: conv, family
    (conversations of one family share a shard), depth from 0, sha, n_bytes, last.
    A node's conv_id is its smallest member; ``saved_tokens`` are the bytes that
    its subtree has only once but its conversations hold again.
    """
    own, nodes = _nodes(paths)
    found = nodes.join(_subtrees(own, nodes, shard_rows, band), NODE, "left").join(_ends(own), NODE, "left")
    nothing = hashlib.sha256().hexdigest()
    return found.select(F.col("first").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
                        F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
