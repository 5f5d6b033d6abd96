"""Toxicity by non-negative positive-unlabelled learning.

A linear numpy classifier is trained from confirmed toxic documents and
unlabelled ones. With class prior p, positives P and unlabelled U, the risk is

    p * E_P[l(z)] + max(0, E_U[l(-z)] - p * E_P[l(-z)])

with the logistic loss l. Where the corrected negative part falls below zero, a
step is taken against it, so the classifier does not over-fit the positives.
The prior is the share of toxic rows among the labelled training rows.

Features are the distinct words of the text (lower case, digits, letters and
non-ASCII characters) and their first 4, 5 and 6 bytes, hashed into 2**20
buckets. A feature is kept if its share among P is above that among U by
``SIGNIFICANT`` standard errors and the prior makes it a sign of toxicity in
``PURE`` of the documents that have it, the ``n_features`` clearest at most.
Each counts once per document. The logarithm of the number of words is a feature
too: among many words some signs turn up by chance.

Only the fit is made from a bounded sample, ``n_positive`` and ``n_unlabelled``
documents of the training rows, dealt by a hash of the id. Its features are
counted in the cluster; the driver gets the counts of possible signs and, per
document, the features that are kept. Every whole text is scored, in one pass
without shuffle. Labels come from training rows only, those
whose crc32 of the id as text, modulo ``folds``, is not ``held_out_fold``.
Labels, language, source and id are no inputs of a score.

Defined results: null and empty texts have no words and get the score of the
bias alone; labels of one id that differ count as toxic; without a toxic
training row every score is 0; an empty table gives an empty result; columns of
the input named like the results are replaced; a very long text is scored as a
whole; repeated rows get the same score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WORD_CHAR, in_arrow, lowered, prefix_sums, range_hash, saved, text_slices, word_spans

#: Fixed values of the contract.
FOLDS, HELD_OUT_FOLD, THRESHOLD = 3, 1, 0.7
#: Bounds of the training sample, and the size of the model.
N_POSITIVE, N_UNLABELLED, N_FEATURES = 4000, 10_000, 4096
SIGNIFICANT, PURE, FEWEST = 6.0, 0.7, 3
BUCKET_BITS = 20
STEMS = (4, 5, 6)


@dataclass
class Model:
    slot: np.ndarray  # bucket -> feature, or -1
    weight: np.ndarray
    length: float  # weight of the logarithm of the words
    bias: float


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT_FOLD) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _buckets(data: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every word and stem, repeats included; words of each document."""
    raw = lowered(data)
    s, e, upto = word_spans(raw, off, WORD_CHAR)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.diff(upto)
    sums = prefix_sums(raw)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(upto))
    docs, hashes = [doc], [range_hash(sums, s, e)]
    for k in STEMS:
        longer = e - s > k
        docs.append(doc[longer])
        hashes.append(range_hash(sums, s[longer], s[longer] + k) ^ np.uint64(k))
    return np.concatenate(docs), (np.concatenate(hashes) & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64), np.diff(upto)


def _size(words: np.ndarray) -> np.ndarray:
    return np.log1p(words) / 5


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, n_positive: int, n_unlabelled: int) -> tuple[DataFrame, float]:
    """(positive, features, words) of the bounded training sample, and the class prior."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(~held_out(F.col("id")))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    prior = marks.agg(F.avg("toxic")).first()[0]
    train = docs.select(F.col(id_col).alias("id")).filter(~held_out(F.col("id")) & F.col("id").isNotNull())
    toxic = marks.filter("toxic = 1").select("id")
    dealt = F.xxhash64("id", F.lit("toxicity"))
    p = toxic.orderBy(dealt, "id").limit(n_positive).select("id", F.lit(1).alias("positive"))
    u = train.distinct().orderBy(dealt, "id").limit(n_unlabelled).select("id", F.lit(0).alias("positive"))
    ids = saved(p.unionByName(u), "toxicity-sample")  # at most n_positive + n_unlabelled rows
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")).join(F.broadcast(ids), "id")
             .dropDuplicates(["id", "positive"]).select("body", "positive"))

    def run(batches):
        for batch in batches:
            out, words = [], []
            for i, j, data, off in text_slices(batch.column(0)):
                doc, bucket, n = _buckets(data, off)
                words.append(n)
                key = np.unique(doc << BUCKET_BITS | bucket)
                cut = np.searchsorted(key, np.arange(j - i + 1) << BUCKET_BITS)
                value = (key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(value)))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.concat_arrays(out), pa.array(np.concatenate(words))], names=["positive", "features", "words"])

    return texts.transform(in_arrow, run, "positive int, features array<int>, words long"), prior


def _clearest(k_p: np.ndarray, k_u: np.ndarray, n_p: int, n_u: int, prior: float, n_features: int) -> np.ndarray:
    """Places of the features to keep, the clearest first, from the documents of P and U that have each."""
    in_p, in_u, pooled = k_p / max(n_p, 1), k_u / max(n_u, 1), (k_p + k_u + 1) / (n_p + n_u + 2)
    clear = (in_p - in_u) / np.sqrt(pooled * (1 - pooled) * (1 / max(n_p, 1) + 1 / max(n_u, 1)))
    best = np.flatnonzero((clear >= SIGNIFICANT) & (k_p >= FEWEST) & (prior * in_p >= PURE * in_u))
    return best[np.argsort(-clear[best], kind="stable")][:n_features]


def choose(rows: DataFrame, prior: float, n_features: int = N_FEATURES) -> np.ndarray:
    """The buckets of the features to keep, the clearest first, from saved rows (positive, features)."""
    n_p, n_u = rows.agg(*[F.count(F.when(F.col("positive") == k, 1)) for k in (1, 0)]).first()
    counts = rows.select("positive", F.explode("features").alias("bucket")).groupBy("bucket").agg(
        F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u"))
    # what cannot be kept stays in the cluster; the margin is for rounding, as the rule itself is applied below
    signs = counts.filter((F.col("p") >= FEWEST) & (prior * F.col("p") / max(n_p, 1) >= (PURE - 1e-6) * F.col("u") / max(n_u, 1)))
    found = signs.toArrow().sort_by("bucket")
    bucket, k_p, k_u = (found.column(c).to_numpy() for c in ("bucket", "p", "u"))
    return bucket[_clearest(k_p, k_u, n_p, n_u, prior, n_features)]


def only(rows: DataFrame, buckets: np.ndarray) -> DataFrame:
    """The rows with those of their features that are among the buckets."""
    wanted = np.zeros(1 << BUCKET_BITS, bool)
    wanted[buckets] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches):
        kept = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            lists = batch.column(1)
            cut = np.asarray(lists.offsets)
            value = np.asarray(lists.values)[cut[0]:cut[-1]]
            keep = kept[value]
            upto = np.concatenate([[0], np.cumsum(keep)])[cut - cut[0]]
            features = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(value[keep]))
            yield pa.RecordBatch.from_arrays([batch.column(0), features, batch.column(2)], names=["positive", "features", "words"])

    return rows.select("positive", "features", "words").transform(in_arrow, run, "positive int, features array<int>, words long")


def train(rows: pa.Table, prior: float, n_features: int = N_FEATURES, rounds: int = 300, rate: float = 0.05, decay: float = 1e-5,
          best: np.ndarray | None = None) -> Model:
    """Fits the classifier with full-batch Adam on the non-negative risk; ``best`` are its features, if they have been chosen."""
    positive = rows.column("positive").combine_chunks().to_numpy()
    lists = rows.column("features").combine_chunks()
    cut = np.asarray(lists.offsets)
    bucket, row = np.asarray(lists.values)[cut[0]:cut[-1]], np.repeat(np.arange(len(positive)), np.diff(cut))
    size = 1 << BUCKET_BITS
    n_p, n_u = int(positive.sum()), int((1 - positive).sum())
    if best is None:
        k_p, k_u = (np.bincount(bucket[positive[row] == k], minlength=size) for k in (1, 0))
        best = _clearest(k_p, k_u, n_p, n_u, prior, n_features)
    slot = np.full(size, -1, np.int32)
    slot[best] = np.arange(len(best), dtype=np.int32)
    feature = slot[bucket]
    row, feature = row[feature >= 0], feature[feature >= 0]
    is_p, size = positive == 1, _size(rows.column("words").to_numpy())
    w = np.zeros(len(best) + 2)  # features, length, bias
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[feature], minlength=len(positive)) + w[-2] * size + w[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        negative_part = np.logaddexp(0, z[~is_p]).mean() - prior * np.logaddexp(0, z[is_p]).mean()
        g = np.where(is_p, -prior * (1 - s) / n_p, 0.0)  # p E_P[l(z)]
        back = np.where(is_p, -prior * s / n_p, s / max(n_u, 1))  # E_U[l(-z)] - p E_P[l(-z)]
        g = g + back if negative_part >= 0 else -back
        grad = np.append(np.bincount(feature, weights=g[row], minlength=len(best)), [(g * size).sum(), g.sum()])
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(slot, w[:-2], float(w[-2]), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_positive: int = N_POSITIVE,
        n_unlabelled: int = N_UNLABELLED, n_features: int = N_FEATURES) -> Model | None:
    """The classifier; None if no training row is toxic."""
    rows, prior = sample(docs, labels, id_col, text_col, n_positive, n_unlabelled)
    if not prior:
        return None
    rows = saved(rows, "toxicity-rows")
    best = choose(rows, prior, n_features)
    table = only(rows, best).toArrow()  # at most n_positive + n_unlabelled rows, of the features that are kept
    if not table.num_rows or not np.asarray(table.column("positive")).any():
        return None
    return train(table, prior, n_features, best=best)


def scores(model: Model | None, column: pa.Array) -> np.ndarray:
    out = [np.zeros(0)]
    for i, j, data, off in text_slices(column):
        if model is None:
            out.append(np.zeros(j - i))
            continue
        doc, bucket, words = _buckets(data, off)
        feature = model.slot[bucket]
        doc, feature = doc[feature >= 0], feature[feature >= 0].astype(np.int64)
        n = max(1, len(model.weight))
        key = np.unique(doc * n + feature)
        z = np.bincount(key // n, weights=model.weight[key % n], minlength=j - i) + model.length * _size(words) + model.bias
        out.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
    return np.concatenate(out)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` (default: all) of every document with score and predicted."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    source = docs.select(F.col(f"`{text_col}`").alias("body"), *[F.col(f"`{c}`") for c in keep])
    schema = StructType(docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields).add("score", "double").add("predicted", "integer")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = scores(shared.value, batch.column(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return source.transform(in_arrow, run, schema)


def drop_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns and in one pass."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(shared.value, batch.column(at)) < threshold))

    return docs.transform(in_arrow, run, docs.schema)
