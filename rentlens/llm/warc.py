"""WARC archives written from a table, and read back as a table of record chunks.

Writing: a slim pass takes the SHA-1 of every payload; of records with equal
payloads the one with the largest id is the response and the others are
revisits that refer to it. Each task then streams its rows into one gzip'd
archive (a gzip member per record) in a shared folder. A payload is fed to the
compressor in pieces of ``CHUNK_BYTES``, views of the Arrow buffer that Spark
handed over (which holds whole payloads); nothing more of a record is copied. An archive has a name of its own for
each task attempt; only those that the written manifest names count, so what a
lost executor left behind is ignored.

Reading: every archive of the manifest is decompressed as a stream and comes
out as rows (record id, chunk number, data) of at most ``CHUNK_BYTES`` bytes,
each with the bytes and the SHA-1 of its record so far. A record of any size is
a run of rows and never one value; its last chunk has its digest and length.

Defined results: a null payload is empty; a revisit has no payload block and
takes its length and digest from the response it refers to; payloads below
``min_revisit_bytes`` are always responses; of records with equal payload and
id the one last in file order is the response; null ids and urls are written
as empty headers; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, join_small, saved, shared_path, text_views, with_locator

CHUNK_BYTES = 1 << 20
#: Fixed values of the format.
CRLF, VERSION, DATE = "\r\n", "WARC/1.0", "1970-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _digest(sha: bytes) -> str:
    return base64.b32encode(sha).decode()


def payload_digests(located: DataFrame) -> DataFrame:
    """id, loc_file, loc_row, n_bytes, sha of rows (body, id, loc_file, loc_row)."""
    schema = located.select("id", "loc_file", "loc_row").schema.add("n_bytes", "long").add("sha", "binary")

    def run(batches):
        for batch in batches:
            n, sha = [], []
            for view in text_views(batch.column(0)):
                sha.append(hashlib.sha1(view).digest())
                n.append(len(view))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(n, pa.int64()), pa.array(sha, pa.binary())], names=schema.names)

    return located.select("body", "id", "loc_file", "loc_row").transform(in_arrow, run, schema)


def revisits(slim: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """loc_file, loc_row, refers_to of the records that are revisits."""
    several = saved(slim.filter(F.col("n_bytes") >= min_revisit_bytes).groupBy("sha")
                    .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "loc_file", "loc_row")).alias("first")).filter("n > 1"), "warc-several")
    return saved(join_small(slim, several, "sha").where(F.struct("id", "loc_file", "loc_row") != F.col("first"))
                 .select("loc_file", "loc_row", F.col("first.id").alias("refers_to")), "warc-revisits")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop-style address, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _headers(kind: str, record: str, url: str, extra: list[tuple[str, str]], length: int) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{record}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {urllib.parse.quote(url, safe=':/?&=#%@+,;~')}", *[f"{k}: {v}" for k, v in extra],
             "Content-Type: text/html", f"Content-Length: {length}"]
    return (CRLF.join(lines) + CRLF * 2).encode()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
                   min_revisit_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Writes one archive per task under ``folder``; the manifest (path, records) of the archives that count."""
    located = with_locator(pages.select(F.col(payload_col).cast("string").alias("body"), F.col(id_col).alias("id"),
                                        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("address")),
                           ["body", "id", "address"], "warc-pages")
    again = revisits(saved(payload_digests(located), "warc-digests"), min_revisit_bytes)
    rows = join_small(located, again.withColumn("is_revisit", F.lit(True)), ["loc_file", "loc_row"], "left").select(
        "body", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "address",
        F.coalesce("is_revisit", F.lit(False)).alias("again"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")).alias("refers"))

    def run(batches):
        store, base = _store(folder)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, n = None, 0
        try:
            for batch in batches:
                ids, urls, agains, refers = (batch.column(k).to_pylist() for k in (1, 2, 3, 4))
                for k, view in enumerate(text_views(batch.column(0))):
                    if out is None:
                        store.create_dir(base, recursive=True)
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    extra = [("WARC-Payload-Digest", f"sha1:{_digest(hashlib.sha1(view).digest())}")]
                    if agains[k]:
                        extra += [("WARC-Refers-To", f"<urn:record:{refers[k]}>"), ("WARC-Profile", IDENTICAL)]
                        view = view[:0]
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(pack.compress(_headers("revisit" if agains[k] else "response", ids[k], urls[k], extra, len(view))))
                    for at in range(0, len(view), chunk_bytes):
                        out.write(pack.compress(view[at:at + chunk_bytes]))
                    out.write(pack.compress((CRLF * 2).encode()) + pack.flush())
                    n += 1
        finally:
            if out is not None:
                out.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n])], names=["path", "records"])

    return saved(rows.transform(in_arrow, run, "path string, records long"), "warc-manifest")


def read_members(stream, chunk_bytes: int = CHUNK_BYTES):
    """(is start of a member, bytes) pieces of at most ``chunk_bytes`` of a gzip'd stream."""
    pending, unpack, fresh = b"", zlib.decompressobj(31), True
    while True:
        if not pending:
            pending = bytes(stream.read(chunk_bytes))
            if not pending:
                break
        piece = unpack.decompress(pending, chunk_bytes)
        pending = unpack.unconsumed_tail
        if piece:
            yield fresh, piece
            fresh = False
        if unpack.eof:
            pending, unpack, fresh = unpack.unused_data, zlib.decompressobj(31), True
    if not fresh:
        raise ValueError("archive ends within a record")


def read_records(stream, chunk_bytes: int = CHUNK_BYTES):
    """(record headers, chunk number, payload chunk, bytes so far, SHA-1 so far, is last) of an archive."""
    head, meta, left, number, size, sha, held = b"", None, 0, 0, 0, None, []
    for fresh, piece in read_members(stream, chunk_bytes):
        if fresh:
            if left:
                raise ValueError("record is shorter than its Content-Length")
            head, meta = b"", None
        if meta is None:
            head += piece
            end = head.find(b"\r\n\r\n")
            if end < 0:
                if len(head) > 1 << 20:
                    raise ValueError("record header too long")
                continue
            lines = head[:end].decode().split(CRLF)
            if lines[0] != VERSION:
                raise ValueError("not a WARC record")
            meta = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            left, number, size, sha, held = int(meta["Content-Length"]), 0, 0, hashlib.sha1(), []
            piece = head[end + 4:]
            if not left:
                yield meta, 0, b"", 0, sha.digest(), True
                continue
        part = piece[:left]
        while part:
            # full chunks only, but for the last one of the record
            room = chunk_bytes - sum(map(len, held))
            held.append(part[:room])
            got = min(len(part), room)
            part, left = part[got:], left - got
            if not left or sum(map(len, held)) == chunk_bytes:
                data = b"".join(held)
                held = []
                sha.update(data)
                size += len(data)
                yield meta, number, data, size, sha.digest(), not left
                number += 1
    if left:
        raise ValueError("archive ends within a record")


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the archives: record_id, chunk, data, bytes_so_far, sha1_so_far, is_last, and the record's headers."""
    schema = ("record_id string, chunk int, data binary, bytes_so_far long, sha1_so_far binary, is_last boolean, "
              "record_type string, url string, declared_digest string, refers_to string")

    def name(x: str | None) -> str | None:
        return None if x is None else x.removeprefix("<urn:record:").removesuffix(">")

    def run(batches):
        names = [x.split(" ")[0] for x in schema.split(", ")]
        types = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.bool_(), *[pa.string()] * 4]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inner = _store(path)
                rows, size = [], 0
                with store.open_input_stream(inner, compression=None) as stream:
                    for meta, k, data, so_far, sha, last in read_records(stream, chunk_bytes):
                        rows.append((name(meta["WARC-Record-ID"]), k, data, so_far, sha, last, meta["WARC-Type"],
                                     urllib.parse.unquote(meta["WARC-Target-URI"]), meta["WARC-Payload-Digest"].removeprefix("sha1:"),
                                     name(meta.get("WARC-Refers-To"))))
                        size += len(data) + 100
                        if size >= 4 * chunk_bytes or len(rows) >= 10_000:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    # the paths are dealt out one per row, so archives are read side by side
    paths = manifest.select("path")
    return paths.repartition(max(1, min(manifest.count(), 10_000)), F.xxhash64("path")).transform(in_arrow, run, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
               min_revisit_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Writes the archives and reads them back: id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    folder = shared_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, id_col, payload_col, url_col, min_revisit_bytes, chunk_bytes)
    records = saved(read_archives(manifest, chunk_bytes).filter("is_last").drop("data"), "warc-records")  # one chunk row of each record has it all
    kind = pages.schema[id_col].dataType
    own = records.filter("record_type = 'response'").select(
        "record_id", "bytes_so_far", "sha1_so_far", "declared_digest", F.lit(None).cast("string").alias("refers_to"), F.lit("response").alias("record_type"))
    # the length of a revisit's payload is read from the response it refers to; both are found by the digest they share
    again = records.filter("record_type = 'revisit'").select("record_id", "declared_digest", "refers_to")
    referred = saved(own.join(again.select(F.col("refers_to").alias("record_id"), "declared_digest").distinct(), ["record_id", "declared_digest"], "left_semi")
                     .groupBy("record_id", "declared_digest").agg(F.max("bytes_so_far").alias("bytes_so_far"), F.max("sha1_so_far").alias("sha1_so_far")), "warc-referred")
    again = join_small(again, referred.withColumnRenamed("record_id", "refers_to"), ["refers_to", "declared_digest"], "left").select(
        "record_id", "bytes_so_far", "sha1_so_far", "declared_digest", "refers_to", F.lit("revisit").alias("record_type"))

    @F.pandas_udf("string")
    def base32(column):
        return column.map(lambda x: _digest(bytes(x)))

    found = own.unionByName(again)
    out = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    return found.select(out("record_id").alias("id"), F.col("bytes_so_far").alias("payload_bytes"), base32("sha1_so_far").alias("payload_digest"),
                        "record_type", out("refers_to").alias("refers_to"),
                        (base32("sha1_so_far") == F.col("declared_digest")).alias("digest_holds"))
