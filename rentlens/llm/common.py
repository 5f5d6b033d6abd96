"""Helpers shared by the operators of this subpackage.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir`` (every executor sees it), so a lost executor costs the
tasks it ran and nothing else. Text helpers work on the value buffer of a whole
Arrow column: bytes A-Z never occur inside a multi-byte UTF-8 sequence, so
lower-casing, splitting and hashing are vectorised over many documents at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.session import checkpoint_dir

#: A side of a join is broadcast only if it has been counted to have no more rows.
BROADCAST_ROWS = 200_000
ROWS_PER_FILE = 50_000
#: Bytes of text that the vectorised steps hold at once (one longer document is held alone).
SLICE_BYTES = 1 << 19
#: Bytes of an Arrow batch, so that long texts do not add up (Spark counts rows only up to 64 MB).
BATCH_BYTES = 4 << 20

#: Fixed values of the contracts, as byte classes: white space that splits words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
#: Digits, a-z (A-Z before lower-casing) and every byte of a non-ASCII character.
WORD_CHAR = np.zeros(256, bool)
WORD_CHAR[0x30:0x3A] = True
WORD_CHAR[0x41:0x5B] = True
WORD_CHAR[0x61:0x7B] = True
WORD_CHAR[0x80:] = True
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again (cuts the lineage).

    ``rows``, about how many there are if that is known, keeps small results in
    few files: a task for every ``ROWS_PER_FILE``.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join that broadcasts ``small`` only if it is counted to have at most ``max_rows`` rows.

    Beyond that the join shuffles and adaptive execution splits skewed keys.
    ``small`` should be a saved table, as it is read for the count as well.
    """
    fits = small.limit(max_rows + 1).count() <= max_rows
    return big.join(F.broadcast(small) if fits else small, on, how)


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_BYTES``, unless the session has a limit of its own."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(key) == "67108864b":  # Spark's default
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def with_locator(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``columns`` of ``df`` with ``loc_file`` and ``loc_row``, the place of each row in its file.

    A table that does not come straight from files is written to the shared
    folder first; the place must be the same each time the rows are read.
    """
    place = [F.col("_metadata.file_path").alias("loc_file"), F.col("_metadata.row_index").alias("loc_row")]
    try:
        return df.select(*columns, *place)
    except AnalysisException:
        return saved(df.select(*columns), name).select(*columns, *place)


def located_whole(docs: DataFrame, name: str) -> DataFrame:
    """Every row as one struct ``whole`` with its place; see ``with_locator``."""
    return with_locator(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")), ["whole"], name)


def without_places(located: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``located_whole`` that are not at ``places`` (a saved table), as they were."""
    return join_small(located, places, ["loc_file", "loc_row"], "left_anti").select("whole.*")


# --- Arrow columns as byte buffers ------------------------------------------------------------


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, end row, bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        yield i, j, bytes(view[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i]
        i = j


def text_views(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each value of a string or binary column, as views of its buffer; null counts as empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].tolist()
    data = column.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    for a, b, there in zip(at[:-1], at[1:], column.is_valid().to_pylist(), strict=True):
        yield view[a:b] if there else view[:0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the words before each document (length: documents + 1)."""
    m = inside[raw]
    if not len(m):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = m.copy()
    first[1:] &= ~m[:-1]
    last = m.copy()
    last[:-1] &= ~m[1:]
    at = offsets[:-1][(offsets[:-1] < len(m))]
    first[at] = m[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = m[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Roller:
    """64-bit hashes of byte ranges from running polynomial sums modulo 2**64, for an odd base."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):  # the tables are made where they are used
        return Roller, (self.bases[0],)

    def _tables(self, n: int) -> list[np.ndarray]:
        if len(self.powers[0]) < n:
            for k, base in enumerate(self.bases):
                steps = np.full(max(n, 1 << 16), base, np.uint64)
                steps[0] = 1
                self.powers[k] = np.multiply.accumulate(steps)
        return self.powers

    def sums(self, raw: np.ndarray) -> np.ndarray:
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._tables(len(raw) + 1)[0][:len(raw)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each byte range [start, end), from its bytes and length alone."""
        h = (sums[ends] - sums[starts]) * self._tables(len(sums))[1][starts]
        return mix64(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


_WORDS = Roller(0x9E3779B97F4A7C15)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Running sums of bytes; see ``range_hash``."""
    return _WORDS.sums(raw)


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range [start, end)."""
    return _WORDS.hashes(sums, starts, ends)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_sums(raw), starts, ends)


def lowered(data: bytes) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return np.frombuffer(data.translate(LOWER), np.uint8)
