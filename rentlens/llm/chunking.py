"""Substring deduplication by content-defined chunks.

Texts are cut where a gear rolling hash over the last 32 bytes has ``BITS`` zero
bits at the top, at least ``MIN_BYTES`` and at most ``MAX_BYTES`` apart. A cut
depends on the bytes before it alone, so an insertion moves the cuts around it
and the chunks after it are the same again. Chunks are told apart by a 128-bit
digest; of equal chunks the first one stays (by id, then place) and the others
are copies. Copies that follow one another are a run. A chunk begins and ends at a
cut, so a run is shorter than the passage it comes from: the bytes beside it are
compared with those beside the first one, up to ``CONTEXT`` on each side. What
they share is the passage. It is removed if it has ``PASSAGE_WORDS`` whole words or
``PASSAGE_BYTES`` (a run of so many goes as it is), or the run makes up the whole text; shorter ones are common
phrases and stay. What a document repeats of itself alone stays as well.

With ``least`` bytes are counted instead: runs of chunks stay if they are shorter,
nothing beside them is looked at, and copies within a document count too.

The chunk table is written once. Digests are counted with a partial sum before
the shuffle, so a chunk that a third of the documents share costs a row per
task. Only repeated chunks are joined back. Joins are left to adaptive
execution, which broadcasts a side by its measured size or splits hot keys.

Defined results: null and empty texts have no chunks; a text shorter than
``MIN_BYTES`` is one chunk; a last piece is a chunk whatever its length; rows
with the same id are separate documents; a null id comes first; an empty table gives an empty result;
a very long text is cut like any other, its places counted from its first byte;
other columns are not read, whatever their names.
What is left of a text is bytes; passages end between characters, while with
``least`` a cut may fall within one and its bytes are kept or removed as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import in_arrow, mix64, saved, text_slices, with_locator

MIN_BYTES, BITS, MAX_BYTES = 32, 5, 512
#: A passage that is removed has so many whole words, or so many bytes (scripts without spaces).
PASSAGE_WORDS, PASSAGE_BYTES = 50, 512
#: Bytes beside a run of copies that are compared with the first occurrence.
CONTEXT = 384
#: A usual value of ``least``.
RUN_BYTES = 160
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def cut_marks(raw: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places after which the gear hash of the 32 bytes before asks for a cut."""
    h = GEAR[raw]
    width = 1
    while width < 32:  # the hash over 2 * width bytes from two over width bytes
        later = h.copy()
        later[width:] += h[:-width] << np.uint32(width) if len(h) > width else 0
        h = later
        width *= 2
    return np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1


def chunks_of(marks: list[int], begin: int, end: int, low: int = MIN_BYTES, high: int = MAX_BYTES) -> list[int]:
    """Ends of the chunks of one document, from the marks within it."""
    ends, at = [], begin
    for m in marks:
        while m - at > high:
            at += high
            ends.append(at)
        if m - at >= low:
            at = m
            ends.append(at)
    while end - at > high:
        at += high
        ends.append(at)
    if at < end:
        ends.append(end)
    return ends


def chunk_table(located: DataFrame, low: int = MIN_BYTES, bits: int = BITS, high: int = MAX_BYTES) -> DataFrame:
    """digest, id, loc_file, loc_row, start, size of every chunk of rows (body, id, loc_file, loc_row)."""
    fields = [located.schema[c] for c in ("id", "loc_file", "loc_row")]
    schema = StructType(fields).add("start", "integer").add("size", "integer").add("digest", "binary")

    def run(batches):
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(0)):
                raw, view = np.frombuffer(data, np.uint8), memoryview(data)
                marks = cut_marks(raw, bits)
                place = np.searchsorted(marks, off, "right")
                marks = marks.tolist()
                row, start, size, digest = [], [], [], []
                edges = off.tolist()
                for d in range(j - i):
                    at = a = edges[d]
                    ends = chunks_of(marks[place[d]:place[d + 1]], a, edges[d + 1], low, high)
                    row += [i + d] * len(ends)
                    for e in ends:
                        start.append(at - a)
                        size.append(e - at)
                        digest.append(hashlib.blake2b(view[at:e], digest_size=16).digest())
                        at = e
                at = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in (1, 2, 3)), pa.array(start, pa.int32()), pa.array(size, pa.int32()),
                                                  pa.array(digest, pa.binary())], names=schema.names)

    return located.select("body", "id", "loc_file", "loc_row").transform(in_arrow, run, schema)


def copy_runs(copies: DataFrame) -> DataFrame:
    """loc_file, loc_row, begin, end of every run of copies, twice: ``before`` or after it, with the place src_file, src_row, at
    where the first occurrence of its first chunk begins or that of its last chunk ends."""
    at = Window.partitionBy("loc_file", "loc_row").orderBy("start")
    end, first = F.col("start") + F.col("size"), F.col("first")
    rows = copies.select("loc_file", "loc_row", "start", end.alias("stop"), first["loc_file"].alias("src_file"), first["loc_row"].alias("src_row"),
                         first["start"].alias("src_start"), (first["start"] + F.col("size")).alias("src_stop"))
    heads = rows.withColumn("head", F.when(F.coalesce(F.lag("stop").over(at) != F.col("start"), F.lit(True)), F.col("start")))
    runs = heads.withColumn("begin", F.max("head").over(at.rowsBetween(Window.unboundedPreceding, 0))).groupBy("loc_file", "loc_row", "begin").agg(
        F.max("stop").alias("end"), F.min(F.struct("start", "src_file", "src_row", F.col("src_start").alias("at"))).alias("left"),
        F.max(F.struct("start", "src_file", "src_row", F.col("src_stop").alias("at"))).alias("right"))
    sides = F.array(*[F.struct(F.lit(before).alias("before"), F.col(c)["src_file"].alias("src_file"), F.col(c)["src_row"].alias("src_row"),
                               F.col(c)["at"].alias("at")) for before, c in ((True, "left"), (False, "right"))])
    return runs.select("loc_file", "loc_row", "begin", "end", F.inline(sides))


def with_context(runs: DataFrame, located: DataFrame, long: int = PASSAGE_BYTES, width: int = CONTEXT) -> DataFrame:
    """``copy_runs`` with ``context``, the bytes before or after the first occurrence (null for runs of ``long`` bytes)."""
    place, body = ["src_file", "src_row", "at", "before"], F.col("body").cast("binary")
    places = runs.filter(F.col("end") - F.col("begin") < long).select(*place).distinct()
    texts = located.select(body.alias("body"), F.col("loc_file").alias("src_file"), F.col("loc_row").alias("src_row")).join(places, ["src_file", "src_row"])
    begin = F.when(F.col("before"), F.greatest(F.col("at") - width, F.lit(0))).otherwise(F.col("at"))
    size = F.when(F.col("before"), F.col("at") - begin).otherwise(F.lit(width))
    contexts = texts.select(*place, F.col("body").substr(begin + 1, size).alias("context"))
    return runs.join(contexts, place, "left").select("loc_file", "loc_row", "begin", "end", "before", "context")


def chunk_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: int = MIN_BYTES, bits: int = BITS, high: int = MAX_BYTES,
                least: int | None = None, with_kept: bool = True, words: int = PASSAGE_WORDS, long: int = PASSAGE_BYTES) -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal removed runs), kept (bytes), kept_sha: one row per document."""
    if low < 32:  # the hash before the first cut would reach into the document before
        raise ValueError("chunks are at least as long as the window of the hash, 32 bytes")
    rows = docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id"))
    located = with_locator(rows, ["body", "id"], "chunk-rows")
    table = saved(chunk_table(located, low, bits, high), "chunk-table")
    me = F.struct("id", "loc_file", "loc_row", "start")
    several = saved(table.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("first")).filter("n > 1").drop("n"), "chunk-several")
    copies = table.join(several, "digest").where(me != F.col("first"))
    if least is None:
        elsewhere = (F.col("first.loc_file") != F.col("loc_file")) | (F.col("first.loc_row") != F.col("loc_row"))
        runs = saved(copy_runs(copies.where(elsewhere)), "chunk-runs")
        spans, of = with_context(runs, located, long), F.struct("begin", "end", "before", "context")
    else:
        spans, of = copies, F.struct("start", "size")
    removed = saved(spans.groupBy("loc_file", "loc_row").agg(F.array_sort(F.collect_list(of)).alias("spans")), "chunk-removed")
    marked = located.join(removed, ["loc_file", "loc_row"], "left")
    return rebuilt(marked, with_kept, least) if least is not None else without_passages(marked, with_kept, words, long)


def _shared(a: bytes, b: bytes, at_end: bool) -> int:
    """Bytes that two texts share at their ends or beginnings."""
    n = min(len(a), len(b))
    x, y = (np.frombuffer(t[len(t) - n:] if at_end else t[:n], np.uint8) for t in (a, b))
    other = np.flatnonzero(x != y)
    return n if not len(other) else n - 1 - int(other[-1]) if at_end else int(other[0])


def whole_words(text: bytes, a: int, b: int) -> int:
    """Words of the text that lie wholly within [a, b)."""
    inside = text[a:b]
    n = len(inside.split())
    if n and a and not text[a - 1:a].isspace() and not inside[:1].isspace():
        n -= 1
    if n and b < len(text) and not text[b:b + 1].isspace() and not inside[-1:].isspace():
        n -= 1
    return n


def passage(text: bytes, begin: int, end: int, left: bytes | None, right: bytes | None, words: int, long: int) -> tuple[int, int] | None:
    """Where the passage around the run [begin, end) of copies lies; None if it is too short to be removed."""
    if end - begin == len(text):
        return begin, end
    a = begin - (_shared(text[max(0, begin - len(left)):begin], left, True) if left else 0)
    b = end + (_shared(text[end:end + len(right)], right, False) if right else 0)
    while 0 < a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return (a, b) if b - a >= long or whole_words(text, a, b) >= words else None


def _result_schema(source: DataFrame) -> StructType:
    return StructType([source.schema["id"]]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary").add("kept_sha", "binary")


def without_passages(marked: DataFrame, with_kept: bool = True, words: int = PASSAGE_WORDS, long: int = PASSAGE_BYTES) -> DataFrame:
    """Texts less their copied passages, from rows (body, id, spans of ``with_context``); without ``with_kept`` only their digests."""
    source = marked.select("body", "id", *[F.col(f"spans.{c}").alias(c) for c in ("begin", "end", "before", "context")])
    schema = _result_schema(source)

    def run(batches):
        for batch in batches:
            spans, out = batch.columns[2:], ([], [], [], [], [])
            for i, _, data, off in text_slices(batch.column(0)):
                for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True), i):
                    text, sides = data[a:b], {}
                    for begin, end, before, context in zip(*(c[k].as_py() or () for c in spans), strict=True):
                        sides.setdefault((begin, end), {})[before] = context
                    lost = np.zeros(b - a, bool)
                    for (begin, end), beside in sides.items():
                        found = passage(text, begin, end, beside.get(True), beside.get(False), words, long)
                        if found:
                            lost[slice(*found)] = True
                    gone = int(lost.sum())
                    kept = np.frombuffer(text, np.uint8)[~lost].tobytes() if gone else text
                    runs = int(np.count_nonzero(np.diff(lost, prepend=False) & lost))
                    for column, value in zip(out, (b - a, gone, runs, kept if with_kept else None, hashlib.sha256(kept).digest()), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], names=schema.names)

    return source.transform(in_arrow, run, schema)


def rebuilt(marked: DataFrame, with_kept: bool = True, least: int = 0) -> DataFrame:
    """Texts less their spans, from rows (body, id, spans); without ``with_kept`` only their digests.

    Runs of spans of fewer than ``least`` bytes stay, unless they are the whole text.
    """
    source = marked.select("body", "id", F.col("spans.start").alias("starts"), F.col("spans.size").alias("sizes"))
    schema = _result_schema(source)

    def run(batches):
        for batch in batches:
            starts, sizes = batch.column(2), batch.column(3)
            out = ([], [], [], [], [])
            for i, _, data, off in text_slices(batch.column(0)):
                for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True), i):
                    kept, runs, gone = data[a:b], 0, 0
                    if starts[k].is_valid:
                        s, n = starts[k].values.to_numpy(), sizes[k].values.to_numpy()
                        edge = np.zeros(b - a + 1, np.int32)
                        np.add.at(edge, s, 1)
                        np.add.at(edge, s + n, -1)
                        lost = np.cumsum(edge)[:-1] > 0
                        turns = np.flatnonzero(np.diff(lost, prepend=False, append=False))
                        first, end = turns[::2], turns[1::2]
                        short = (end - first < least) & (end - first < b - a)
                        for x, y in zip(first[short].tolist(), end[short].tolist(), strict=True):
                            lost[x:y] = False
                        gone, runs = int(lost.sum()), int((~short).sum())
                        kept = np.frombuffer(kept, np.uint8)[~lost].tobytes()
                    for column, value in zip(out, (b - a, gone, runs, kept if with_kept else None, hashlib.sha256(kept).digest()), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], names=schema.names)

    return source.transform(in_arrow, run, schema)
