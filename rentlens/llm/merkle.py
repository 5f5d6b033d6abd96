"""Merkle manifest of a table: leaves, subroots, one root, and folding from retained hash states.

A row's leaf is the SHA-256 of its fields. The leaves of a group, in order, are
hashed in runs of ``fanout`` until one node remains, the subroot; the subroots,
ordered by group, are hashed in the same way to the root.

The tree is built in blocks. Positions in a group come from distributed running
sums, and the nodes of a level are dealt into blocks of ``fanout ** depth``
consecutive ones (256 by default), which are whole subtrees: a block is hashed in
one task to one node of the next table, which is that many times smaller. A
parent keeps, for each child slot, a copy of its hash state as it was before
that child was read. The way down hands every block its path (the digests
before and after it in each run up to the root). A changed leaf is then
folded: at each level the state before its slot is resumed and gets the replacement
and the siblings to the right only. States above a block are made once for
the block and resumed by all of its rows.

No task holds more than a block, and only the sizes of the largest group reach
the driver.

Defined results: a null field is hashed as ``-``; a null group is a group of
its own, before all others; null order keys come first; rows with equal keys are
ordered by leaf, and repeated rows are leaves of their own. A very long field is
hashed by Spark as one value and never shuffled. An empty table has no rows and
no root. Columns that are not named as fields are not read, whatever their names are.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.operators.ranking import prefix_sums

from .common import in_arrow, join_small, saved

#: Nodes of a block, at most (one subtree that a task hashes at once).
BLOCK_NODES = 256
PATH = "path array<struct<before: binary, after: binary>>"


def field_bytes(c: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else its number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_bytes(c) for c in fields]), 256))


# --- one block, in a task ---------------------------------------------------------------------


def n_levels(nodes: int, fanout: int) -> int:
    """Levels of hashing until one of ``nodes`` nodes remains."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def grow(digests: list[bytes], fanout: int, levels: int) -> tuple[list[tuple[list[bytes], list]], list[bytes]]:
    """(children, state before each child) of every level, and the nodes on top. Digests are hex text."""
    tree = []
    for _ in range(levels):
        states, parents = [], []
        for at in range(0, len(digests), fanout):
            h = hashlib.sha256()
            for d in digests[at:at + fanout]:
                states.append(h.copy())
                h.update(d)
            parents.append(h.hexdigest().encode())
        tree.append((digests, states))
        digests = parents
    return tree, digests


def siblings(tree: list, i: int, fanout: int) -> list[tuple[bytes, bytes]]:
    """(digests before, digests after) child i in its run, and those of its ancestors, level by level."""
    out = []
    for children, _ in tree:
        first = i - i % fanout
        out.append((b"".join(children[first:i]), b"".join(children[i + 1:first + fanout])))
        i //= fanout
    return out


def fold(tree: list, i: int, value: bytes, fanout: int) -> bytes:
    """The node on top if child i had the digest ``value``: retained states are resumed, right siblings read."""
    for children, states in tree:
        h = states[i].copy()
        h.update(value)
        for d in children[i + 1:i - i % fanout + fanout]:
            h.update(d)
        value = h.hexdigest().encode()
        i //= fanout
    return value


def resume(path: list, value: bytes) -> bytes:
    """``fold`` above a block, along (state before, digests after)."""
    for state, after in path:
        h = state.copy()
        h.update(value)
        h.update(after)
        value = h.hexdigest().encode()
    return value


def _hex(values: pa.Array) -> list[bytes | None]:
    return [None if v is None else v.hex().encode() for v in values.to_pylist()]


def _blocks_of(batch: pa.RecordBatch):
    """(row, first item, end item) of the block rows of a batch."""
    at = batch.column("items").offsets.to_pylist()
    return zip(range(batch.num_rows), at[:-1], at[1:], strict=True)


def _items(batch: pa.RecordBatch) -> pa.StructArray:
    return batch.column("items").values


def _tops(batches, fanout: int):
    """grp, pos, digest of the node on top of every block."""
    for batch in batches:
        digests, levels, tops = _hex(_items(batch).field("digest")), batch.column("levels").to_pylist(), []
        for row, a, b in _blocks_of(batch):
            tops.append(bytes.fromhex(grow(digests[a:b], fanout, levels[row])[1][0].decode()))
        yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("block"), pa.array(tops, pa.binary())], names=["grp", "pos", "digest"])


def _path_of(entry: list[dict]) -> list[tuple[bytes, bytes]]:
    return [(x["before"].hex().encode(), x["after"].hex().encode()) for x in entry]


def _paths(batches, fanout: int):
    """The paths of all nodes in the blocks, from the paths of the blocks."""
    for batch in batches:
        items = _items(batch)
        digests, levels = _hex(items.field("digest")), batch.column("levels").to_pylist()
        above, subroots = batch.column("path").to_pylist(), batch.column("subroot").to_pylist()
        grp, block, path, sub = [], [], [], []
        groups, inner, places = batch.column("grp").to_pylist(), items.field("sub").to_pylist(), items.field("pos").to_pylist()
        for row, a, b in _blocks_of(batch):
            tree, _ = grow(digests[a:b], fanout, levels[row])
            for i in range(b - a):
                own = [{"before": bytes.fromhex(x.decode()), "after": bytes.fromhex(y.decode())} for x, y in siblings(tree, i, fanout)]
                # a subroot of the tree over groups leads on to the last block of its group
                over = inner[a + i] is not None
                grp.append(inner[a + i] if over else groups[row])
                block.append(0 if over else places[a + i])
                path.append(own + above[row])
                sub.append(bytes.fromhex(digests[a + i].decode()) if over else subroots[row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(grp, pa.string()), pa.array(block, pa.int64()),
             pa.array(path, pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))), pa.array(sub, pa.binary())],
            names=["grp", "block", "path", "subroot"])


def _leaves(batches, fanout: int):
    """Every leaf with its proof and the root folded from its replacement, or from itself."""
    for batch in batches:
        items = _items(batch)
        digests, changed = _hex(items.field("digest")), _hex(items.field("changed"))
        levels, above, subroots = batch.column("levels").to_pylist(), batch.column("path").to_pylist(), batch.column("subroot").to_pylist()
        proofs, folded, sub = [], [], []
        for row, a, b in _blocks_of(batch):
            tree, top = grow(digests[a:b], fanout, levels[row])
            path = _path_of(above[row])
            upper = b"".join(x + y for x, y in path)
            states = [(hashlib.sha256(x), y) for x, y in path]
            for i in range(b - a):
                proofs.append(hashlib.sha256(b"".join(x + y for x, y in siblings(tree, i, fanout)) + upper).hexdigest())
                value = fold(tree, i, changed[a + i] or digests[a + i], fanout)
                folded.append(resume(states, value).decode())
            sub += [(subroots[row].hex() if subroots[row] is not None else top[0].decode())] * (b - a)
        first, end = batch.column("items").offsets[0].as_py(), batch.column("items").offsets[-1].as_py()
        yield pa.RecordBatch.from_arrays(
            [items.field("id").slice(first, end - first), pa.array([d.decode() for d in digests[first:end]], pa.string()),
             pa.array(sub, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
            names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])


# --- the tree over the table ------------------------------------------------------------------


def _dealt(nodes: DataFrame, sizes: DataFrame, fanout: int, depth: int, name: str) -> DataFrame:
    """A row for each block: grp, block, items (in order), levels to hash."""
    size = fanout ** depth
    deep = F.lit(0)
    for levels in range(1, depth + 1):  # levels until one node remains, and those of a block at most
        deep = F.when(F.col("n") > fanout ** (levels - 1), F.lit(levels)).otherwise(deep)
    rows = nodes.groupBy("grp", F.floor(F.col("pos") / size).cast("long").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", *[c for c in nodes.columns if c not in ("grp", "pos")]))).alias("items"))
    return saved(join_small(rows, sizes.select("grp", "n"), "grp").withColumn("levels", deep).drop("n"), name)


def _reduced(nodes: DataFrame, fanout: int, depth: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The tables of blocks from the nodes up, and the one node (grp, digest) that each group comes to."""
    size = fanout ** depth
    sizes = saved(nodes.groupBy("grp").agg((F.max("pos") + 1).alias("n")), f"{name}-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    stages = []
    while True:
        stages.append(_dealt(nodes, sizes, fanout, depth, f"{name}-blocks"))
        nodes = stages[-1].transform(in_arrow, partial(_tops, fanout=fanout), "grp string, pos long, digest binary")
        if most <= size:
            return stages, saved(nodes.select("grp", "digest"), f"{name}-tops")
        sizes, most = sizes.withColumn("n", F.ceil(F.col("n") / size)), -(-most // size)


def merkle_manifest(table: DataFrame, id_col: str, fields: list[str], group_col: str, changed_if: Column | None = None,
                    changes: dict[str, Column] | None = None, fanout: int = 2, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    Rows for which ``changed_if`` holds are folded with the leaf that they have
    when ``changes`` (field to new value) are made; all others with their own.
    Digests are lower-case hex text. ``proof_sha256`` is the hash of a leaf's
    siblings, level by level up to the root.
    """
    if fanout < 2:
        raise ValueError("a node needs at least two children")
    depth = max(1, n_levels(block_nodes + 1, fanout) - 1)
    changes, leaf = changes or {}, leaf_digest([F.col(f) for f in fields])
    other = F.lit(None).cast("binary") if changed_if is None else F.when(
        changed_if, leaf_digest([changes.get(f, F.col(f)) for f in fields]))
    grp = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    rows = table.select(F.col(id_col).alias("id"), grp.alias("grp"), leaf.alias("digest"), other.alias("changed"), F.lit(1).cast("long").alias("one"))
    placed = prefix_sums(rows, "id", {"pos": "one"}, ties=[F.col("digest").asc(), F.col("changed").asc()], by=["grp"])
    nodes = placed.select("grp", (F.col("pos") - 1).alias("pos"), "id", "digest", "changed")

    stages, subroots = _reduced(nodes, fanout, depth, "merkle")
    ranked = prefix_sums(subroots.select(F.lit("").alias("all"), F.col("grp").alias("sub"), "digest", F.lit(1).cast("long").alias("one")),
                         "sub", {"pos": "one"}, by=["all"])
    tops, root = _reduced(ranked.select(F.col("all").alias("grp"), (F.col("pos") - 1).alias("pos"), "digest", "sub"), fanout, depth, "merkle-top")

    paths = root.select("grp", F.lit(0).cast("long").alias("block"), F.from_json(F.lit("[]"), PATH.removeprefix("path ")).alias("path"),
                        F.lit(None).cast("binary").alias("subroot"))
    schema = f"grp string, block long, {PATH}, subroot binary"
    below = [s if "sub" in s.schema["items"].dataType.elementType.names else _with_sub(s) for s in [*stages[1:], *tops]]
    for blocks in reversed(below):
        paths = saved(join_small(blocks, paths, ["grp", "block"]).transform(in_arrow, partial(_paths, fanout=fanout), schema), "merkle-paths")
    found = join_small(stages[0], paths, ["grp", "block"]).transform(
        in_arrow, partial(_leaves, fanout=fanout),
        rows.select("id").schema.add("leaf", "string").add("subroot", "string").add("proof_sha256", "string").add("folded_root", "string"))
    whole = root.select(F.lower(F.hex("digest")).alias("root"))  # one row, none for an empty table
    return found.join(F.broadcast(whole), F.lit(True), "left").select(
        "id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _with_sub(blocks: DataFrame) -> DataFrame:
    """Blocks inside a group, whose nodes lead on to blocks of the same group."""
    return blocks.withColumn("items", F.transform("items", lambda x: x.withField("sub", F.lit(None).cast("string"))))
