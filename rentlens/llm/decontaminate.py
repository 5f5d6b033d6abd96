"""Benchmark decontamination with suffix arrays over shards of the training text.

Each task builds suffix arrays over shards (slices of its Arrow batches) of the
training documents. A suffix is the run of words from one position to the end
of its document, compared word by word by vocabulary code and sorted to the
window length. Suffixes whose first two words are not neighbours anywhere in
the benchmark cannot hold a window and are left out before sorting. Every test
suffix (each window of each benchmark item) is then binary-searched in every
shard; the equal range gives all its places, and places that go on from one
window to the next of the same item make up the longest verbatim matches.

The benchmark is a stated query set: it is read in blocks of about
``BLOCK_BYTES`` of text, each broadcast as it is made, so the driver holds one
block at a time. ``BLOCKS_A_PASS`` of them are searched against all documents in
one pass and then freed; the results of several passes are united per document.
The training text is never shuffled.

Defined results: a null or empty text has no words and no hits; an item without
words has no window; an item of fewer than 13 words is one window; items are
named by their id as text, an item without id by an empty name, items with one
id are one item; without benchmark items nothing is hit. A word is compared by
its 64-bit hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from .common import WORD_CHAR, in_arrow, located_whole, lowered, saved, text_slices, with_locator, without_places, word_hashes, word_spans

#: Fixed values of the contract: words in a window; hit words times this at least the words of a contaminated document.
WINDOW = 13
HIT_FACTOR = 20
BLOCK_BYTES, BLOCKS_A_PASS = 4 << 20, 8
#: Suffixes whose keys are made at once.
_KEY_ROWS = 1 << 17
_FILTER_BITS = 20


@dataclass
class Block:
    """Test suffixes of a block of items: unique windows in sorted order, and what holds them."""

    vocab: np.ndarray  # sorted word hashes; code = place + 1
    seen: np.ndarray  # bitmap over the low bits of the hashes
    pairs: np.ndarray  # sorted codes of neighbouring words
    single: bool  # some window has one word only
    low: np.ndarray  # first key of each unique window
    high: np.ndarray  # last key that begins with it
    length: np.ndarray  # words of each unique window
    first: np.ndarray  # CSR over windows: (item, place in the item) of each occurrence
    item: np.ndarray
    place: np.ndarray
    names: np.ndarray
    window: int


def _keys(codes: np.ndarray, at: np.ndarray, room: np.ndarray, window: int) -> np.ndarray:
    """Sort keys (big-endian codes) of the suffixes at ``at``, cut off after ``room`` words."""
    step, out = np.arange(window), np.empty((len(at), window), ">u4")
    for i in range(0, len(at), _KEY_ROWS):
        part = slice(i, i + _KEY_ROWS)
        grid = codes[np.minimum(at[part, None] + step, len(codes) - 1)]
        grid[step >= room[part, None]] = 0
        out[part] = grid
    return out.view(f"S{4 * window}").ravel()


def make_block(names: list[str], texts: list[str], window: int = WINDOW) -> Block | None:
    """Test suffixes of the items; None if there are none."""
    words, counts = [], []
    for _, _, data, off in text_slices(pa.array(texts, pa.large_string())):
        raw = lowered(data)
        s, e, upto = word_spans(raw, off, WORD_CHAR)
        words.append(word_hashes(raw, s, e))
        counts.append(np.diff(upto))
    words, counts = np.concatenate(words), np.concatenate(counts)
    if not len(words):
        return None
    vocab = np.unique(words)
    codes = (np.searchsorted(vocab, words) + 1).astype(np.uint32)
    begin = np.concatenate([[0], np.cumsum(counts)])
    item_of = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - begin[:-1][item_of]
    left = counts[item_of] - place
    starts = np.flatnonzero((left >= window) | (place == 0))
    length = np.minimum(left[starts], window)
    keys, back = np.unique(_keys(codes, starts, length, window), return_inverse=True)
    order = np.argsort(back, kind="stable")
    size = np.zeros(len(keys), np.int64)
    size[back] = length
    short = np.flatnonzero(size < window)
    high = keys  # a whole window is its own last key
    if len(short):
        high = keys.copy()
        grid = high.view(np.uint8).reshape(len(high), 4 * window)
        grid[short] = np.where(np.arange(4 * window) >= 4 * size[short, None], 255, grid[short])
    inner = left[:-1] > 1
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[(vocab & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    return Block(vocab, seen, np.unique((codes[:-1][inner].astype(np.uint64) << np.uint64(32)) | codes[1:][inner]), bool((size == 1).any()),
                 keys, high, size, np.searchsorted(back[order], np.arange(len(keys) + 1)),
                 item_of[starts][order], place[starts][order], np.array(names, object), window)


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def shard_words(data: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a shard, and the words before each document."""
    raw = lowered(data)
    s, e, upto = word_spans(raw, off, WORD_CHAR)
    return (word_hashes(raw, s, e) if len(s) else np.zeros(0, np.uint64)), upto


def search_shard(block: Block, h: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word places and windows (one pair per occurrence) found among the words of a shard."""
    none = np.zeros(0, np.int64)
    if not len(h):
        return none, none
    maybe = np.flatnonzero(block.seen[(h & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
    codes = np.zeros(len(h), np.uint32)
    code = np.minimum(np.searchsorted(block.vocab, h[maybe]), len(block.vocab) - 1)
    codes[maybe] = np.where(block.vocab[code] == h[maybe], code + 1, 0)
    end = np.repeat(upto[1:], np.diff(upto))
    at = np.flatnonzero(codes)
    if not block.single:
        at = at[at + 1 < end[at]]
        at = at[_member(block.pairs, (codes[at].astype(np.uint64) << np.uint64(32)) | codes[at + 1])]
    if not len(at):
        return none, none
    keys = _keys(codes, at, np.minimum(end[at] - at, block.window), block.window)
    order = np.argsort(keys, kind="stable")
    keys, suffix = keys[order], at[order]
    lo, hi = np.searchsorted(keys, block.low, "left"), np.searchsorted(keys, block.high, "right")
    n = hi - lo
    window = np.repeat(np.arange(len(n)), n)
    place = suffix[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    return place, window


def longest_matches(block: Block, upto: np.ndarray, place: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first word, item, first word in the item, words) of every maximal verbatim match of a window or more."""
    n = np.diff(block.first)[window]
    at = np.repeat(block.first[:-1][window], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    item, there, here, size = block.item[at], block.place[at], np.repeat(place, n), block.length[np.repeat(window, n)]
    doc = np.searchsorted(upto, here, "right") - 1
    order = np.lexsort((here, here - there, item, doc))
    item, there, here, size, doc = item[order], there[order], here[order], size[order], doc[order]
    new = np.ones(len(here), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(here - there) != 0) | (np.diff(here) != 1)
    head = np.flatnonzero(new)
    run = np.diff(np.append(head, len(here)))
    return doc[head], here[head] - upto[doc[head]], item[head], there[head], run + size[head] - 1


def _blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int):
    names, texts, size = [], [], 0
    for row in bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("body")).toLocalIterator():
        names.append(row["id"])
        texts.append(row["body"] or "")
        size += len(texts[-1])
        if size >= block_bytes:
            yield names, texts
            names, texts, size = [], [], 0
    if names:
        yield names, texts


def _items_of(block: Block, upto: np.ndarray, place: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, item) of every item that has a window at ``place``, each pair once and in order of documents."""
    pair = np.unique((np.searchsorted(upto, place, "right") - 1) * len(block.low) + window)
    doc, win = pair // len(block.low), pair % len(block.low)
    n = np.diff(block.first)[win]
    held = block.item[np.repeat(block.first[:-1][win], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    pair = np.unique(np.repeat(doc, n) * len(block.names) + held)
    return pair // len(block.names), pair % len(block.names)


def _by_document(doc: np.ndarray):
    """(document, first place, end) of every run of equal values in the sorted ``doc``."""
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    yield from zip(doc[first].tolist(), first.tolist(), [*first[1:].tolist(), len(doc)], strict=True)


def _search(located: DataFrame, blocks: list, keys: list[str]) -> DataFrame:
    """keys, n_words, spans (packed hit words), items of every row, for broadcast blocks searched in one pass."""
    schema = StructType(located.select(*keys).schema.fields).add("n_words", "long").add("spans", "binary").add("items", ArrayType(StringType()))

    def run(batches):
        held = [b.value for b in blocks]
        for batch in batches:
            n_words, spans, items = [], [], []
            for i, j, data, off in text_slices(batch.column(0)):
                h, upto = shard_words(data, off)
                n_words += np.diff(upto).tolist()
                got_spans, got_items = [b""] * (j - i), [()] * (j - i)
                edge = None
                for b in held:
                    place, window = search_shard(b, h, upto)
                    if len(place):
                        edge = np.zeros(upto[-1] + 1, np.int64) if edge is None else edge
                        np.add.at(edge, place, 1)
                        np.add.at(edge, place + b.length[window], -1)
                        doc, item = _items_of(b, upto, place, window)
                        for d, x, y in _by_document(doc):
                            got_items[d] = sorted({*got_items[d], *b.names[item[x:y]]})
                if edge is not None:
                    hit = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
                    for d, x, y in _by_document(np.searchsorted(upto, hit, "right") - 1):
                        got_spans[d] = (hit[x:y] - upto[d]).astype("<u4").tobytes()
                spans += got_spans
                items += got_items
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(n_words, pa.int64()), pa.array(spans, pa.binary()),
                                              pa.array(items, pa.list_(pa.string()))], names=schema.names)

    return located.transform(in_arrow, run, schema)


def _passes(bench: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int):
    """Lists of broadcast blocks, at most ``BLOCKS_A_PASS`` each; blocks without words are left out."""
    cast, held = bench.sparkSession.sparkContext.broadcast, []
    for names, texts in _blocks(bench, item_col, item_text_col, block_bytes):
        block = make_block(names, texts, window)
        if block is not None:
            if len(held) == BLOCKS_A_PASS:
                yield held
                held = []
            held.append(cast(block))
    if held:
        yield held


def _found(located: DataFrame, bench: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int) -> DataFrame:
    """id, loc_file, loc_row, n_words, n_hit, items of rows (body, id, loc_file, loc_row), over all blocks of the benchmark."""
    places = ["loc_file", "loc_row"]
    keys = ["id", *places]
    passes, parts = _passes(bench, item_col, item_text_col, window, block_bytes), []
    blocks, later = next(passes, []), next(passes, None)
    if later is None:
        return _search(located.select("body", *keys), blocks, keys).withColumn("n_hit", (F.octet_length("spans") / 4).cast("long"))
    while blocks:
        parts.append(saved(_search(located.select("body", *keys), blocks, keys), "decontaminate-pass"))
        for block in blocks:
            block.unpersist()
        blocks, later = later, next(passes, None)

    @F.pandas_udf("long")
    def distinct_words(lists):
        return lists.map(lambda x: len(np.unique(np.frombuffer(b"".join(x), "<u4"))))

    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    merged = (hits.filter(F.octet_length("spans") > 0).groupBy(*places)
              .agg(F.collect_list("spans").alias("all_spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("all_items"))
              .select(*places, distinct_words("all_spans").alias("n_hit"), "all_items"))
    return parts[0].join(merged, places, "left").select(
        *keys, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("all_items", "items").alias("items"))


def _contaminated():
    return (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_FACTOR >= F.col("n_words"))


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, loc_file, loc_row, n_words, n_hit, n_items, items (sorted as strings), contaminated: one row per document."""
    located = with_locator(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")), ["body", "id"], "decontaminate-rows")
    return _found(located, bench, item_col, item_text_col, window, block_bytes).select(
        "id", "loc_file", "loc_row", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.array_sort("items").alias("items"), _contaminated().alias("contaminated"))


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, word, item_id (as text), item_word, n_words: every longest verbatim match of a window or more."""
    spark = docs.sparkSession
    source = docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id"))
    schema = StructType([source.schema["id"]]).add("word", "long").add("item_id", "string").add("item_word", "long").add("n_words", "long")
    out = None
    for blocks in _passes(bench, item_col, item_text_col, window, block_bytes):

        def run(batches, blocks=blocks):
            held = [b.value for b in blocks]
            for batch in batches:
                for i, _, data, off in text_slices(batch.column(0)):
                    h, upto = shard_words(data, off)
                    for b in held:
                        place, win = search_shard(b, h, upto)
                        if len(place):
                            doc, word, item, there, n = longest_matches(b, upto, place, win)
                            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(doc + i)), pa.array(word), pa.array(list(b.names[item]), pa.string()),
                                                              pa.array(there), pa.array(n)], names=schema.names)

        part = source.transform(in_arrow, run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def remove_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Rows are told apart by their place, so ids may be null or repeated; only
    the places of contaminated rows are joined.
    """
    located = located_whole(docs, "decontaminate-docs")
    slim = located.select(F.col(f"whole.`{text_col}`").alias("body"), F.lit(None).cast("string").alias("id"), "loc_file", "loc_row")
    bad = saved(_found(slim, bench, item_col, item_text_col, window, block_bytes).filter(_contaminated()).select("loc_file", "loc_row"),
                "decontaminate-bad")
    return without_places(located, bad)
