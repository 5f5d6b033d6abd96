"""Removal of repeated byte strings by sparse, distributed suffix sorting.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere
else is removed. Matches never cross documents.

Which suffixes are sorted. In each window of ``LENGTH`` bytes the leftmost of
the 32-byte strings with the smallest hash is its anchor; equal windows have
equal anchors at the same place, so windows are only compared under the same
anchor. Neighbouring windows mostly share their anchor: such a run of windows is
a segment, a row of a few numbers (place, hash of the anchor, 128-bit digest of
all bytes it spans). Three steps, each with a partial aggregate before its
shuffle, settle nearly all of the text without moving any of it:

- an anchor that occurs once has no repeated window;
- a segment whose bytes occur twice is repeated in full;
- one of each group of equal segments stands for it in what follows.

What is left are anchors with different segments around them, such as the rims
of copied passages. Their bytes are fetched and dealt by anchor, and the
suffixes at their windows are sorted to ``LENGTH`` bytes: a multikey quicksort
takes eight bytes a step to the shallow depth, then the groups that still have a
long common prefix are ordered as by blind tries: the members of a group are
compared with its first suffix, split by length of the common prefix and the
byte after it, and so on within the parts; only branching bytes are looked at.
Suffixes that agree to the full depth are repeated windows.

An anchor with more than ``HOT`` different segments is never dealt to one task:
its segments are cut in two by the windows' distance from the anchor, each part
is named by the longer string that all windows at these distances have in
common, and the three steps run again on the parts, with half the range of
distances each time. A part of one window is equal to its name, so this ends.

Defined results: null is empty; texts shorter than ``LENGTH`` lose nothing;
overlapping strings count (a run of one byte is repeated within itself); rows
with the same id are separate documents; repeated rows lose everything if they
have ``LENGTH`` bytes; an empty table gives an empty result. A very long text is
cut into segments like any other. Only id and text are read, so other columns
may have any names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from .chunking import rebuilt
from .common import BROADCAST_ROWS, Roller, in_arrow, join_small, saved, text_slices, with_locator

#: Fixed value of the contract.
LENGTH = 200
ANCHOR = 32
SHALLOW, HOT = 32, 4_000
#: Segment or span entries in all up to which a table of lists is broadcast.
BROADCAST_ENTRIES = 2_000_000
_PLACE_BITS = 22
_ROLL, _ROLL2 = Roller(0x9E3779B97F4A7C15), Roller(0xC2B2AE3D27D4EB4F)


def segments(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(first window, last window, distance of the anchor from the first, anchor hash, digest, digest) of every segment of the documents raw[begin:end].

    Places are relative to ``raw``, which has fewer than 2**22 bytes.
    """
    k = min(ANCHOR, length)
    n = len(raw)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums = _ROLL.sums(raw)
    at = np.arange(n - k + 1)
    h = _ROLL.hashes(sums, at, at + k)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    best = (h & ~low) | at.astype(np.uint64)
    width, wanted = 1, length - k + 1
    while 2 * width <= wanted:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if wanted > width:
        best = np.minimum(best[:len(best) - (wanted - width)], best[wanted - width:])
    anchor = (best & low).astype(np.int64)  # of the window at each place
    stop = np.zeros(n + 1, np.int64)
    count = np.maximum(end - begin - length + 1, 0)
    some = count > 0
    np.add.at(stop, begin[some], 1)
    np.add.at(stop, begin[some] + count[some], -1)
    window = np.flatnonzero(np.cumsum(stop)[:len(anchor)] > 0)
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    new = np.ones(len(window), bool)
    new[1:] = (np.diff(window) != 1) | (np.diff(anchor[window]) != 0)
    head = np.flatnonzero(new)
    first, last = window[head], window[np.append(head[1:], len(window)) - 1]
    a = anchor[first]
    return first, last, a - first, h[a].view(np.int64), *digest(raw, first, last + length, sums)


def digest(raw: np.ndarray, first: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest, in two longs, of each byte range."""
    one = _ROLL.hashes(_ROLL.sums(raw) if sums is None else sums, first, end)
    return one.view(np.int64), _ROLL2.hashes(_ROLL2.sums(raw), first, end).view(np.int64)


_INTS = ("first", "size", "d")
_LISTS = (*_INTS, "key", "h1", "h2")


def _list_schema(fields) -> StructType:
    schema = StructType(list(fields))
    for name in _LISTS:
        schema = schema.add(name, ArrayType(IntegerType() if name in _INTS else LongType()))
    return schema


def segment_table(located: DataFrame, length: int = LENGTH, block: int = 1 << 19) -> DataFrame:
    """node, loc_file, loc_row and the segments of every row (body, loc_file, loc_row), as lists."""
    schema = _list_schema([StructType().add("node", "long")[0], located.schema["loc_file"], located.schema["loc_row"]])

    def run(batches):
        node = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(0), block):
                raw = np.frombuffer(data, np.uint8)
                parts = []
                # a long document goes in blocks of windows; a segment may end at a block's end
                for at in range(0, max(len(raw), 1), block):
                    to = min(len(raw), at + block + (length - 1 if j - i == 1 else 0))
                    if j - i > 1:
                        at, to = 0, len(raw)
                    begin = np.maximum(off[:-1], at) - at
                    end = np.minimum(off[1:], to) - at
                    first, last, d, key, h1, h2 = segments(raw[at:to], begin, np.maximum(end, begin), length)
                    doc = np.searchsorted(off, first + at, "right") - 1
                    parts.append((doc, first + at - off[doc], last - first + length, d, key, h1, h2))
                    if j - i > 1:
                        break
                doc, *columns = (np.concatenate(x) for x in zip(*parts, strict=True))
                cut = pa.array(np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(c.astype(np.int32) if name in _INTS else c))
                         for name, c in zip(_LISTS, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(node, node + j - i)), *(batch.column(c).slice(i, j - i) for c in (1, 2)), *lists],
                                                 names=schema.names)
                node += j - i

    return located.select("body", "loc_file", "loc_row").transform(in_arrow, run, schema)


def halves(located: DataFrame, lists: DataFrame, width: int, length: int) -> DataFrame:
    """node, first, size, d, key, h1, h2, n of the parts of every listed segment, ``width`` distances from the anchor each."""
    names = ["node", "first", "size", "d", "key", "h1", "h2", "n"]

    def run(batches):
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(0)):
                whole = np.frombuffer(data, np.uint8)
                for k in range(i, j):
                    raw = whole[off[k - i]:off[k - i + 1]]
                    first, size, d, n = (batch.column(c)[k].values.to_numpy().astype(np.int64) for c in (2, 3, 4, 5))
                    anchor, last = first + d, d - (size - length)  # the distance falls from d to last
                    near = np.maximum(d // width * width, last)  # of the last window of the first part
                    two = near > last
                    far, near, at, n = (np.concatenate(x) for x in ((d, near[two] - 1), (near, last[two]), (anchor, anchor[two]), (n, n[two])))
                    low = far // width * width
                    high = np.minimum(low + width - 1, length - min(ANCHOR, length))
                    sums = _ROLL.sums(raw)
                    key = _ROLL.hashes(sums, at - low, at - high + length) + low.astype(np.uint64)  # what all windows at low..high cover
                    a, e = at - far, at - near + length
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(a), batch.column(1)[k].as_py())), *(pa.array(x.astype(np.int32)) for x in (a, e - a, far)),
                         pa.array(key.view(np.int64)), *(pa.array(x) for x in digest(raw, a, e, sums)), pa.array(n)], names=names)

    return (_with_lists(located, lists, ["first"]).select("body", "node", "first", "size", "d", "n")
            .transform(in_arrow, run, "node long, first int, size int, d int, key long, h1 long, h2 long, n long"))


def _with_lists(located: DataFrame, lists: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Rows with their lists (a saved table by loc_file, loc_row), broadcast only if rows and entries are few."""
    entries = lists.agg(F.coalesce(F.sum(F.size(names[0])), F.lit(0))).first()[0]
    return join_small(located, lists, ["loc_file", "loc_row"], how, BROADCAST_ROWS if entries <= BROADCAST_ENTRIES else 0)


def fetch(located: DataFrame, lists: DataFrame, length: int) -> DataFrame:
    """key, node, first, n, piece: the bytes of every listed segment."""

    def run(batches):
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(0)):
                rows = [(batch.column(1)[d].as_py(), *(batch.column(c)[d].values.to_numpy() for c in (2, 3, 4, 5)), off[d - i]) for d in range(i, j)]
                node = np.concatenate([np.full(len(r[1]), r[0]) for r in rows])
                first, size, key, n = (np.concatenate([r[c] for r in rows]) for c in (1, 2, 3, 4))
                base = np.concatenate([np.full(len(r[1]), r[5]) for r in rows])
                pieces = [data[a:a + s] for a, s in zip((base + first).tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(first), pa.array(n.astype(np.int64)), pa.array(pieces, pa.binary())],
                                                 names=["key", "node", "first", "n", "piece"])

    return (_with_lists(located, lists, ["first"]).select("body", "node", "first", "size", "key", "n")
            .transform(in_arrow, run, "key long, node long, first int, n long, piece binary"))


# --- sorting within a task ---------------------------------------------------------------------


def _groups(order: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of runs of two or more (``same`` says that an element belongs with the one before), and their group numbers."""
    head = np.flatnonzero(~same)
    size = np.diff(np.append(head, len(order)))
    keep = np.repeat(size > 1, size)
    return order[keep], np.repeat(np.arange(int((size > 1).sum())), size[size > 1])


def repeated_suffixes(raw: np.ndarray, suffix: np.ndarray, depth: int = LENGTH, shallow: int = SHALLOW) -> np.ndarray:
    """Those of the suffix places whose first ``depth`` bytes are those of another of the places."""
    member, group = suffix, np.zeros(len(suffix), np.int64)
    shallow = min(shallow, depth) // 8 * 8
    for level in range(0, shallow, 8):  # multikey quicksort, eight bytes a step
        word = np.zeros(len(member), np.uint64)
        for b in range(8):
            word = (word << np.uint64(8)) | raw[member + level + b]
        order = np.argsort(word, kind="stable")
        order = order[np.argsort(group[order], kind="stable")]
        same = np.zeros(len(order), bool)
        same[1:] = (word[order][1:] == word[order][:-1]) & (group[order][1:] == group[order][:-1])
        member, group = _groups(member[order], same)
    sums = _ROLL.sums(raw)
    found, known = [], np.full(len(member), shallow)
    while len(member):  # blind tries: one branching per round and group, all groups at once
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(head, len(member)))
        leader = np.repeat(member[head], size)
        equal = _ROLL.hashes(sums, member, member + depth) == _ROLL.hashes(sums, leader, leader + depth)
        twin = np.repeat(np.add.reduceat(equal.astype(np.int64), head) > 1, size)
        found.append(member[equal & twin])
        rest = ~equal
        member, group, leader, low = member[rest], group[rest], leader[rest], known[rest]
        high = np.full(len(member), depth - 1)
        while True:  # longest common prefix with the leader, by halving
            todo = low < high
            if not todo.any():
                break
            mid = (low + high + 1) // 2
            agree = _ROLL.hashes(sums, member, member + mid) == _ROLL.hashes(sums, leader, leader + mid)
            low, high = np.where(todo & agree, mid, low), np.where(todo & ~agree, mid - 1, high)
        branch = raw[member + low].astype(np.int64)
        order = np.lexsort((branch, low, group))
        g, lcp, c = group[order], low[order], branch[order]
        same = np.zeros(len(order), bool)
        same[1:] = (g[1:] == g[:-1]) & (lcp[1:] == lcp[:-1]) & (c[1:] == c[:-1])
        head = np.flatnonzero(~same)
        several = np.repeat(np.diff(np.append(head, len(order))) > 1, np.diff(np.append(head, len(order))))
        known = lcp[several]
        member, group = _groups(member[order], same)
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def sort_pieces(pieces: DataFrame, length: int, batch_bytes: int = 1 << 20) -> DataFrame:
    """node, first, size of the repeated runs in pieces (key, node, first, n, piece) that are dealt and sorted by key.

    Anchors are gathered to about ``batch_bytes`` and sorted together; one anchor is never split over two sorts.
    """

    def spans(keys, nodes, firsts, ns, chunks):
        size = np.array([len(x) for x in chunks])
        raw = np.frombuffer(b"".join(chunks), np.uint8)
        begin = np.cumsum(size) - size
        windows = size - length + 1
        suffix = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(begin, windows)
        hit = repeated_suffixes(raw, suffix, length)
        piece = np.searchsorted(begin, hit, "right") - 1
        keep = ns[piece] == 1  # the others are known to be repeated in full
        hit, piece = hit[keep], piece[keep]
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (np.diff(piece) != 0)
        head = np.flatnonzero(new)
        last = hit[np.append(head[1:], len(hit)) - 1] if len(head) else hit
        p = piece[head]
        return pa.RecordBatch.from_arrays([pa.array(nodes[p]), pa.array((hit[head] - begin[p] + firsts[p]).astype(np.int32)),
                                           pa.array((last - hit[head] + length).astype(np.int32))], names=["node", "first", "size"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(4).nbytes
            if size < batch_bytes:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last anchor may go on in the next batch
            if cut:
                yield spans(*_columns(table.slice(0, cut)))
                rest = table.slice(cut)
                held, size = rest.to_batches(), rest.column(4).nbytes if rest.num_rows else 0
        if held:
            yield spans(*_columns(pa.Table.from_batches(held)))

    def _columns(table):
        return (*(table.column(c).to_numpy() for c in range(4)), table.column(4).to_pylist())

    return pieces.repartition("key").sortWithinPartitions("key").transform(in_arrow, run, "node long, first int, size int")


# --- the job -----------------------------------------------------------------------------------


def repeated_spans(located: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """loc_file, loc_row, spans (start, size; sorted, may overlap) of the rows (body, loc_file, loc_row) that lose bytes."""
    table = saved(segment_table(located, length), "suffix-segments")
    place = table.select("node", "loc_file", "loc_row")
    rows = table.select("node", F.explode(F.arrays_zip(*_LISTS)).alias("s")).select("node", *[f"s.{c}" for c in _LISTS], F.lit(1).cast("long").alias("n"))
    covered, width = [], 1 << 8  # more than the distances that there are
    while True:
        # saved, so that the join's two sides are shuffles that adaptive execution can split at a hot key
        live = saved(rows.groupBy("key").agg(F.sum("n").alias("m")).filter("m > 1").select("key"), "suffix-live-keys")
        rows = saved(rows.join(live, "key", "left_semi"), "suffix-live")
        sets = saved(rows.groupBy("key", "h1", "h2").agg(F.sum("n").alias("n"), F.min(F.struct("node", "first", "size", "d")).alias("rep")), "suffix-sets")
        covered.append(rows.join(sets.filter("n > 1").select("key", "h1", "h2"), ["key", "h1", "h2"], "left_semi").select("node", "first", "size"))
        names = saved(sets.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1"), "suffix-names")
        reps = saved(sets.join(names, "key").select("rep.*", "key", "n", "sets"), "suffix-reps")
        lists = lambda part, names: saved(part.groupBy("node").agg(*[F.collect_list(c).alias(c) for c in names]).join(place, "node"), "suffix-lists")
        pieces = fetch(located, lists(reps.filter(F.col("sets") <= hot), ("first", "size", "key", "n")), length)
        covered.append(saved(sort_pieces(pieces, length), "suffix-sorted"))
        large = reps.filter(F.col("sets") > hot)
        if not large.limit(1).count():
            break
        width //= 2
        rows = saved(halves(located, lists(large, ("first", "size", "d", "n")), width, length), "suffix-halves")
    every = reduce(DataFrame.unionByName, covered)
    merged = _merged(every.groupBy("node").agg(F.collect_list("first").alias("first"), F.collect_list("size").alias("size")))
    return saved(merged.join(place, "node").select("loc_file", "loc_row", "spans"), "suffix-spans")


def _merged(lists: DataFrame) -> DataFrame:
    """node, spans: the maximal runs of each row's intervals."""
    item = StructType().add("start", "integer").add("size", "integer")
    schema = StructType().add("node", "long").add("spans", ArrayType(item))

    def run(batches):
        for batch in batches:
            starts, sizes, cut = [], [], [0]
            for k in range(batch.num_rows):
                first, size = batch.column(1)[k].values.to_numpy(), batch.column(2)[k].values.to_numpy()
                order = np.argsort(first, kind="stable")
                first, end = first[order], (first + size)[order]
                reach = np.maximum.accumulate(end)
                head = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
                starts.append(first[head].astype(np.int32))
                sizes.append((reach[np.append(head[1:], len(first)) - 1] - first[head]).astype(np.int32))
                cut.append(cut[-1] + len(head))
            runs = pa.StructArray.from_arrays([pa.array(np.concatenate([*x, np.zeros(0, np.int32)])) for x in (starts, sizes)], names=["start", "size"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs)], names=["node", "spans"])

    return lists.select("node", "first", "size").transform(in_arrow, run, schema)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT,
                 with_kept: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal removed runs), kept (bytes), kept_sha: one row per document."""
    rows = docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id"))
    located = with_locator(rows, ["body", "id"], "suffix-rows")
    spans = repeated_spans(located.select("body", "loc_file", "loc_row"), length, hot)
    return rebuilt(_with_lists(located, spans, ["spans"], "left"), with_kept)
