"""Exact deduplication with a streaming, disk-backed keyed state.

1. One pass lower-cases A-Z and takes SHA-256 and length of every whole text
   (vectorised per Arrow batch). The digest table, with the place of each row
   (file and row number), is written to the shared folder.
2. A Structured Streaming query reads the digest table file by file and keeps,
   per digest, the number of rows and the largest (id, locator) in a RocksDB
   state without expiry. Rows are pre-aggregated before they are shuffled, so
   a group of copies costs one row per task whatever its size. The state's
   checkpoint is in the shared folder: a lost executor reloads it, and
   ``state_dir`` makes later runs go on with new files only.
3. Hits, that is digests with more than one row, are checked byte for byte:
   the rows at the hit locators are read again and compared with the text of
   the row that stays. Texts that share a digest but differ are grouped anew
   by their full bytes.

Defined results: null and empty texts are equal; of rows with equal text and
equal id the one last in file order stays; a null id is the smallest; an empty
table gives an empty result. Very long texts are compared in full. Clashing
column names are no matter, since only id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import LOWER, in_arrow, join_small, located_whole, saved, shared_path, text_slices, with_locator, without_places

#: Files of the digest table in one micro-batch.
FILES_PER_BATCH = 4096
#: Rows of one digest that are compared with the kept text in one task.
SALT_ROWS = 256
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # small states: no file space is reserved ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def digests(located: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """id, loc_file, loc_row, n_bytes, digest, sha of rows (id, body, loc_file, loc_row), over the normalised text.

    ``digest`` is the first ``digest_bytes`` of the SHA-256; fewer make collisions for tests.
    """
    fields = located.drop("body").schema.fields
    schema = StructType(fields).add("n_bytes", "long").add("digest", "binary").add("sha", "binary")

    def run(batches):
        for batch in batches:
            sizes, shas = [], []
            for _, _, data, off in text_slices(batch.column(1)):
                view = memoryview(data.translate(LOWER))
                shas += [hashlib.sha256(view[a:b]).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                sizes.append(np.diff(off))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3),
                 pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64)),
                 pa.array([s[:digest_bytes] for s in shas], pa.binary()), pa.array(shas, pa.binary())],
                names=schema.names)

    return located.transform(in_arrow, run, schema)


def keyed_state(table_path: str, schema: StructType, spark, state_dir: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """digest, n, keep struct<id, loc_file, loc_row> from the streaming state over the digest table."""
    conf = spark.conf
    before = {k: conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        conf.set(k, v)
    try:
        stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(table_path)
                  .groupBy("digest")
                  .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "loc_file", "loc_row")).alias("keep")))
        query = (stream.writeStream.format("noop").outputMode("update").option("checkpointLocation", state_dir)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").load(state_dir)
        value = state.schema["value"].dataType.names
        return saved(state.select("key.digest", F.col(f"value.`{value[0]}`").alias("n"),
                                  F.col(f"value.`{value[1]}`").alias("keep")), "dedup-state")
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32,
                state_dir: str | None = None) -> DataFrame:
    """id, loc_file, loc_row, n_bytes, sha, keep (struct of the row that stays), group_size, kept: one row per row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    return _dedup(with_locator(rows, ["id", "body"], "dedup-rows"), digest_bytes, state_dir)


def keep_last(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of which one per normalised text stays (its largest id), with all their columns."""
    located = located_whole(docs, "dedup-docs")
    found = _dedup(located.select(F.col(f"whole.`{id_col}`").alias("id"), F.col(f"whole.`{text_col}`").alias("body"), "loc_file", "loc_row"))
    return without_places(located, saved(found.filter("not kept").select("loc_file", "loc_row"), "dedup-dropped"))


def _dedup(located: DataFrame, digest_bytes: int = 32, state_dir: str | None = None) -> DataFrame:
    spark = located.sparkSession
    table = digests(located, digest_bytes)
    path, schema = shared_path(spark, "dedup-digests"), table.schema
    table.write.parquet(path)
    slim = spark.read.schema(schema).parquet(path)
    state_dir = state_dir or shared_path(spark, "dedup-stream")
    state = keyed_state(path, schema, spark, state_dir) if slim.limit(1).count() else _empty_state(slim)
    several = saved(state.filter("n > 1"), "dedup-several")
    hits = saved(join_small(slim, several, "digest"), "dedup-hits")
    odd = _differing(located, hits)
    me = F.struct("id", "loc_file", "loc_row")
    single = (join_small(slim, several, "digest", "left_anti")
              .select("id", "loc_file", "loc_row", "n_bytes", "sha", me.alias("keep"), F.lit(1).cast("long").alias("group_size")))
    group = hits.select("id", "loc_file", "loc_row", "n_bytes", "sha", "keep", F.col("n").alias("group_size"), "digest")
    if odd is not None:
        group = join_small(group, odd.select("digest").distinct(), "digest", "left_anti").drop("digest").unionByName(odd.drop("digest"))
    else:
        group = group.drop("digest")
    return single.unionByName(group).withColumn("kept", F.col("keep").eqNullSafe(me))


def _empty_state(slim: DataFrame) -> DataFrame:
    return slim.select("digest", F.lit(0).cast("long").alias("n"), F.struct("id", "loc_file", "loc_row").alias("keep"))


def _differing(located: DataFrame, hits: DataFrame) -> DataFrame | None:
    """Compares every hit with the kept text, byte for byte; the classes of digests that hold different texts, or None."""
    lower = F.translate(F.coalesce(F.col("body"), F.lit("")), _UPPER, _SMALL)
    located = located.select("body", "loc_file", "loc_row")
    parts = F.ceil(F.col("n") / SALT_ROWS).cast("int")  # a hot digest is dealt to as many tasks, the kept text to each of them
    places = hits.select("loc_file", "loc_row", "digest", "id", "sha", "n_bytes", F.col("keep").alias("keep_"), parts.alias("parts"))
    text = join_small(located, places, ["loc_file", "loc_row"]).withColumn("body", lower)
    first = (text.filter((F.col("loc_file") == F.col("keep_.loc_file")) & (F.col("loc_row") == F.col("keep_.loc_row")))
             .select("digest", F.col("body").alias("kept_body"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")))
    salted = text.select("digest", "body", F.pmod(F.xxhash64("loc_file", "loc_row"), F.col("parts")).cast("int").alias("salt"))
    bad = saved(salted.join(first, ["digest", "salt"]).filter("body <> kept_body").select("digest").distinct(), "dedup-differing")
    if not bad.limit(1).count():
        return None
    again = text.join(bad, "digest")
    classes = again.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "loc_file", "loc_row")).alias("keep"))
    return again.join(classes, ["digest", "body"]).select("id", "loc_file", "loc_row", "n_bytes", "sha", "keep", "group_size", "digest")
