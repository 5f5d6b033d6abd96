"""Quality selection by importance resampling over hashed n-grams.

The target (documents of high quality) and the raw corpus each have a
generative bag model: word unigrams and bigrams hashed into ``BUCKETS`` buckets,
with add-one smoothing. A document's weight is the log-likelihood ratio of the
two models over its n-grams. Adding Gumbel noise to the weights and keeping the
``k`` largest draws k documents without replacement in proportion to them.

The noise comes from a hash of id and seed, so reruns agree. The k-th largest
key is found exactly and without a sort: keys become 64-bit integers of the
same order, and four histograms of 16 bits each narrow down the one bucket that
holds the k-th (at most 65,536 sums are read per step).

Counting hands on at most ``BUCKETS`` rows per task; only the finished models,
whose size is fixed, are broadcast.

Defined results: null and empty texts have no n-grams and weight 0; a one-word
text has one unigram; rows with the same key (the same id and text) stand or
fall together, so a tie at the bound is taken whole; a null id counts as an
empty one; without target documents both models differ by smoothing only; an
empty table gives an empty result. A very long text is weighed as a whole. Only
id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import NOT_SPACE, in_arrow, join_small, lowered, mix64, saved, text_slices, word_hashes, word_spans

BUCKETS = 10_000
#: Share of the rows that are drawn.
FRACTION = 0.25
SEED = 17
_STEP = 16


def ngrams(data: bytes, off: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every unigram and bigram."""
    raw = lowered(data)
    s, e, upto = word_spans(raw, off, NOT_SPACE)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = word_hashes(raw, s, e)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(upto))
    inner = doc[:-1] == doc[1:]
    two = mix64(h[:-1][inner] * np.uint64(0x9E3779B97F4A7C15) + h[1:][inner])
    return np.concatenate([doc, doc[:-1][inner]]), (np.concatenate([h, two]) % np.uint64(buckets)).astype(np.int64)


def fit(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """log P(bucket | target) - log P(bucket | raw)."""
    ids = saved(targets.select(F.col(id_col).alias("id")).dropna().distinct(), "resample-targets")
    marked = join_small(docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id")), ids.withColumn("t", F.lit(True)), "id", "left").select(
        "body", F.coalesce("t", F.lit(False)).alias("is_target"))

    def run(batches):
        target, raw = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            wanted = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for i, _, data, off in text_slices(batch.column(0)):
                doc, bucket = ngrams(data, off, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[wanted[doc + i]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(target[at]), pa.array(raw[at])], names=["bucket", "target", "raw"])

    sums = marked.transform(in_arrow, run, "bucket long, target long, raw long").groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()  # at most ``buckets`` rows
    out = []
    for name in ("target", "raw"):
        c = np.ones(buckets)
        c[sums["bucket"].to_numpy(dtype=np.int64)] += sums[name].to_numpy()
        out.append(np.log(c / c.sum()))
    return out[0] - out[1]


def _ordered(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits >= 0, bits, bits ^ np.int64(0x7FFFFFFFFFFFFFFF))


def weigh(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """id, n_grams, log_weight, gumbel_key, rank_key (an integer in the order of gumbel_key) of every document."""
    body = F.col(text_col)
    noise = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(seed))
    source = docs.select(body.alias("body"), F.col(id_col).alias("id"), noise.alias("noise"))
    schema = StructType([source.schema["id"]]).add("n_grams", "long").add("log_weight", "double").add("gumbel_key", "double").add("rank_key", "long")
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for batch in batches:
            n, w = [np.zeros(0, np.int64)], [np.zeros(0)]
            for i, j, data, off in text_slices(batch.column(0)):
                doc, bucket = ngrams(data, off, len(shared.value))
                n.append(np.bincount(doc, minlength=j - i))
                w.append(np.bincount(doc, weights=shared.value[bucket], minlength=j - i))
            n, w = np.concatenate(n), np.concatenate(w)
            u = (mix64(batch.column(2).to_numpy().astype(np.int64).view(np.uint64)) >> np.uint64(11)).astype(np.float64)
            key = w - np.log(-np.log((u + 0.5) / 2.0**53))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n.astype(np.int64)), pa.array(w), pa.array(key), pa.array(_ordered(key))], names=schema.names)

    return source.transform(in_arrow, run, schema)


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest value of the long column ``rank_key`` (a saved table); None if there are fewer rows."""
    low, high, left = None, None, k
    for level in range(64 // _STEP):
        shift = 64 - _STEP * (level + 1)
        inside = keys if low is None else keys.where((F.col("rank_key") >= F.lit(low)) & (F.col("rank_key") <= F.lit(high)))
        sums = inside.groupBy(F.shiftright("rank_key", shift).alias("b")).count().orderBy(F.desc("b")).collect()  # at most 2 ** 16 rows
        for row in sums:
            if row["count"] >= left:
                low = row["b"] << shift
                high = low + (1 << shift) - 1
                break
            left -= row["count"]
        else:
            return None
    return low


def resample(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """id, n_grams, log_weight, gumbel_key, selected of every document."""
    weighed = saved(weigh(docs, fit(docs, targets, id_col, text_col, buckets), id_col, text_col, seed), "resample-weights")
    k = round(fraction * weighed.count())
    bound = kth_largest(weighed, k) if k else None
    chosen = F.lit(bool(k)) if bound is None else F.col("rank_key") >= F.lit(bound)
    return weighed.select("id", "n_grams", "log_weight", "gumbel_key", chosen.alias("selected"))
