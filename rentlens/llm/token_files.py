"""Token ids of a corpus as flat binary files with 64-bit document offsets, written and read back.

Documents are dealt by ranges of their ids (the whole order, places in the
files included, so equal ids fill no range) and sorted inside a range. Each task
encodes its documents and streams them into a shard of two files:

* ``NAME.bin``: the ids of all documents one after the other, little-endian
  unsigned, 16 bits wide if the vocabulary and the end id fit, else 32;
* ``NAME.idx``: the documents in order: n + 1 offsets in ids from the start of
  the shard (64 bits), n document ids (64 bits), n bytes that are 0 where the
  document has no id.

A shard has a name of its own for each task attempt; only those that the
written manifest names count. The manifest has the sizes of the shards, and their
prefix sums are the bases: the first document and the first id of a shard in
the whole corpus, so an offset in the corpus is base + offset in the shard.

Reading maps the files into memory (other stores than a file system are read
through an input file) and touches the ranges of ids that are asked for.

Encoding: a byte-pair tokenizer of the kind ``WORD_KIND`` drops white space and
never joins across it, so a text has the ids of its words one after the other.
Each different word is encoded once and kept by the worker as long as it is met
again among the last ``CACHE_WORDS`` different ones. This also bounds the memory
of very long texts. Other tokenizers are handed whole texts.

Defined results: a null text is empty, an empty text has the end id alone;
null ids come first and read back as null; repeated rows are documents of their
own; an empty table gives no shard and no rows; columns other than id and text
are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_arrow, saved, shared_path, text_slices, with_locator
from .warc import _store

#: Words that a worker keeps in each of two generations (about 100 MB in all); cores without their TAILS as many.
CACHE_WORDS = 250_000
#: Letters that lower-casing and composition map one to one, and marks that the tokenizer splits from such a letter before them.
PLAIN, TAILS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"), ".,;:!?"
#: The parts of a tokenizer file that ``WordIds`` is right for.
WORD_KIND = {
    "truncation": None, "padding": None, "post_processor": None,
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
ROWS_PER_BATCH = 20_000
MANIFEST = "shard int, path string, width int, docs long, tokens long"


class WordIds(dict):
    """Ids as bytes of words (as they stand between ASCII white space), each different one encoded once."""

    def __init__(self, tokenizer, code: str):
        super().__init__()
        self.own, self.code, self.cores, self.older = tokenizer, code, {}, {}
        # what the tokenizer's byte level makes of each plain letter, so that a plain word is one piece of its model
        self.letters = {ord(c): tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x61, 0x100)) if PLAIN.fullmatch(c) and c == c.lower()}

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def piece(self, text: str, plain: bool) -> bytes:
        found = self.cores.get(text)
        if found is None:
            found = self.cores[text] = self.packed([t.id for t in self.own.model.tokenize(text.translate(self.letters))] if plain else
                                                   self.own.encode(text, add_special_tokens=False).ids)
        return found

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.older.get(word) or self.encoded(word)
        return ids

    def encoded(self, word: bytes) -> bytes:
        text = word.decode()
        core = text.rstrip(TAILS)
        if PLAIN.fullmatch(core):  # its own piece, whatever of TAILS follows
            ids = self.piece(core.lower(), True)
            return ids + self.piece(text[len(core):], False) if len(core) < len(text) else ids
        return self.packed(self.own.encode(text, add_special_tokens=False).ids)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        if len(self.cores) > CACHE_WORDS:
            self.cores.clear()
        return [b"".join(map(self.__getitem__, t.split())) for t in texts]


#: The encoder of this worker, kept for its next tasks: (tokenizer's file, width, by words) and the encoder.
_KEPT: list = [None, None]


def works_by_words(tokenizer: str) -> bool:
    """Whether a tokenizer is of the kind that never joins across white space (see the module's text)."""
    parts = json.loads(tokenizer)
    return {k: parts.get(k) for k in WORD_KIND} == WORD_KIND and parts["model"]["type"] == "BPE" and not any(
        " " in t["content"] or t["lstrip"] or t["rstrip"] or PLAIN.fullmatch(t["content"]) for t in parts["added_tokens"])


def encoder(tokenizer: str, width: int, by_words: bool) -> Callable[[list[bytes]], list[bytes]]:
    """From texts to their ids as bytes; ``tokenizer`` is the text of its file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    if _KEPT[0] != (tokenizer, width, by_words):
        own, code = Tokenizer.from_str(tokenizer), {2: "H", 4: "I"}[width]
        _KEPT[:] = (tokenizer, width, by_words), WordIds(own, code) if by_words else (
            lambda texts: [array(code, e.ids).tobytes() for e in own.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)])
    return _KEPT[1]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Writes the shards under ``folder``; the manifest (shard, path, width, docs, tokens, first_doc, first_id).

    ``docs`` has integer ids. Shards follow the session's shuffle partitions (adaptive execution joins small ones).
    """
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    width = 2 if max(Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    by_words = works_by_words(tokenizer)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(tokenizer)  # the tokenizer's file, of fixed size
    located = with_locator(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body")), ["id", "body"], "token-docs")
    order = [F.col("id").asc_nulls_first(), F.col("loc_file").asc(), F.col("loc_row").asc()]
    rows = located.repartitionByRange(*order).sortWithinPartitions(*order).select("body", "id")
    end = end_id.to_bytes(width, "little")

    def run(batches):
        encode, name = encoder(model.value, width, by_words), f"{uuid.uuid4().hex}"
        store, base = _store(folder)
        out, at, ids = None, array("q", [0]), []
        try:
            for batch in batches:
                for i, j, data, offsets in text_slices(batch.column(0)):
                    if out is None:
                        store.create_dir(base, recursive=True)
                        out = store.open_output_stream(f"{base}/{name}.bin", compression=None)
                    cut = offsets.tolist()
                    for packed in encode([data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]):
                        out.write(packed)
                        out.write(end)
                        at.append(at[-1] + len(packed) // width + 1)
                    ids.append(batch.column(1).slice(i, j - i))
        finally:
            if out is not None:
                out.close()
        if ids:
            own = pa.chunked_array(ids).combine_chunks()
            with store.open_output_stream(f"{base}/{name}.idx", compression=None) as index:
                index.write(np.asarray(at, "<i8").tobytes())
                index.write(own.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                index.write(own.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([width], pa.int32()),
                 pa.array([len(own)], pa.int64()), pa.array([at[-1]], pa.int64())], names=["shard", "path", "width", "docs", "tokens"])

    shards = saved(rows.transform(in_arrow, run, MANIFEST), "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each pair of files
    return saved(shards.withColumns({"first_doc": F.coalesce(F.sum("docs").over(before), F.lit(0)),
                                     "first_id": F.coalesce(F.sum("tokens").over(before), F.lit(0))}), "token-manifest")


def _mapped(path: str, dtype: str, count: int, offset: int = 0) -> np.ndarray:
    """``count`` numbers of a file from byte ``offset``, mapped where it is a local one."""
    store, name = _store(path)
    if not count:
        return np.zeros(0, dtype)
    if store.type_name == "local":
        return np.memmap(name, dtype, "r", offset, (count,))
    with store.open_input_file(name) as f:
        return np.frombuffer(f.read_at(count * np.dtype(dtype).itemsize, offset), dtype)


class Shard:
    """One shard of the files: document ids, offsets, and the token ids of any document."""

    def __init__(self, path: str, width: int, docs: int, tokens: int):
        self.path, self.kind, self.docs, self.tokens = path, f"<u{width}", docs, tokens
        self.offsets = _mapped(f"{path}.idx", "<i8", docs + 1)
        self.ids = _mapped(f"{path}.idx", "<i8", docs, 8 * (docs + 1))
        self.has_id = _mapped(f"{path}.idx", "u1", docs, 8 * (2 * docs + 1))

    def tokens_of(self, first: int, end: int) -> np.ndarray:
        """The ids of documents first to end - 1."""
        a, b = int(self.offsets[first]), int(self.offsets[end])
        return _mapped(f"{self.path}.bin", self.kind, b - a, a * np.dtype(self.kind).itemsize)


def read_token_files(manifest: DataFrame, with_tokens: bool = False) -> DataFrame:
    """id, start, n_tokens, ids_crc32 (and tokens) of every document in the shards, a task for each shard."""
    spark: SparkSession = manifest.sparkSession
    n = manifest.count()
    schema = "id long, start long, n_tokens long, ids_crc32 long" + ", tokens array<long>" * with_tokens

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"], row["width"], row["docs"], row["tokens"])
                for a in range(0, shard.docs, ROWS_PER_BATCH):
                    b = min(shard.docs, a + ROWS_PER_BATCH)
                    at = np.asarray(shard.offsets[a:b + 1])
                    sums, lists = [], []
                    for k in range(a, b):
                        ids = shard.tokens_of(k, k + 1)
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        if with_tokens:
                            lists.append(pa.array(ids.astype(np.int64)))
                    columns = [pa.array(np.asarray(shard.ids[a:b]), mask=np.asarray(shard.has_id[a:b]) == 0), pa.array(at[:-1] + row["first_id"]),
                               pa.array(np.diff(at)), pa.array(sums, pa.int64())]
                    if with_tokens:
                        columns.append(pa.ListArray.from_arrays(pa.array((at - at[0]).astype(np.int32)), pa.concat_arrays(lists)))
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n_tokens", "ids_crc32", "tokens"][:len(columns)])

    rows = manifest.repartition(max(1, n)) if n > 1 else manifest
    return rows.select("path", "width", "docs", "tokens", "first_id").transform(in_arrow, run, schema)


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                     folder: str | None = None) -> DataFrame:
    """Documents encoded to files under ``folder`` (a new shared one by default) and described from those files."""
    folder = folder or shared_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id, id_col, text_col))
