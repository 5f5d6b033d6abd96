"""Explanations of the tree models (§2.11): contributions and permutation importance.

Contributions are path-dependent Shapley values: where a feature is left out, a
tree is followed down both sides by the shares of the training rows that went
there.  A leaf counts the features of its path only, so for a leaf the value of
a set of features is a product with a factor per feature: 1 or 0 where the row
agrees with the path, the share of training rows where the feature is left out.
The Shapley values of such a product follow from the coefficients of a
polynomial, and a row picks them by the pattern of features it agrees with:
a table per leaf of 2^depth patterns, made once in each worker from the nodes.
The tables of the leaves below one node are added up by the answers to all splits
above and below it, at most ``GROUP_BITS`` of them: a row looks up once per node
instead of once per leaf, and answers each split of the ensemble once.
Scoring is one Arrow pass over the rows.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators import ranking
from rentlens.session import scratch_path

#: Deepest trees that contributions take: a leaf has a table of 2^depth patterns.
MAX_DEPTH = 8
#: Splits that a group of leaves is looked up by (a table has a place for each of their answers), not below ``MAX_DEPTH``.
GROUP_BITS = 8
#: Rows that a worker scores at once.
ROWS = 4096
#: The same for permuted values, which are compared in fewer bytes.
SCORED_ROWS = 16384
#: Rows of a block that permuted values are dealt to.
DEALT_ROWS = 1 << 17


class Paths:
    """The leaves of an ensemble: for each, the splits from the root, and its weighted value.

    Arrays are (leaves, depth), padded with splits that every row agrees with.
    """

    def __init__(self, feature, threshold, left, slot, share, slot_feature, value, n_features: int, bias: float = 0.0):
        self.feature, self.threshold, self.left, self.slot = feature, threshold, left, slot
        self.share, self.slot_feature, self.value, self.n_features, self.bias = share, slot_feature, value, n_features, bias
        self.table = self.grouped = None

    def __reduce__(self):  # the tables are made where they are used
        return Paths, (self.feature, self.threshold, self.left, self.slot, self.share, self.slot_feature, self.value, self.n_features, self.bias)

    @property
    def base(self) -> float:
        """The prediction with every feature left out."""
        return float((self.value * self.share.prod(axis=1)).sum() + self.bias)

    def tables(self) -> np.ndarray:
        """(leaves, patterns, depth): contributions of a leaf's features by which of them agree."""
        if self.table is None:
            leaves, d = self.share.shape
            weight = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
            self.table = np.zeros((leaves, 1 << d, d))
            for pattern in range(1 << d):
                agrees = [float(pattern >> j & 1) for j in range(d)]
                for i in range(d):
                    poly = np.zeros((d, leaves))
                    poly[0] = 1.0
                    for j in range(d):
                        if j != i:  # times (share + agrees z)
                            poly[1:] = poly[1:] * self.share[:, j] + agrees[j] * poly[:-1]
                            poly[0] *= self.share[:, j]
                    self.table[:, pattern, i] = self.value * (agrees[i] - self.share[:, i]) * np.tensordot(weight, poly, 1)
        return self.table

    def asked(self, i: int) -> list[tuple[int, float]]:
        """(feature, threshold) of the splits that lead to a leaf."""
        return [(int(f), float(t)) for f, t in zip(self.feature[i], self.threshold[i], strict=True) if t < np.inf]

    def runs(self) -> list[tuple[list[int], dict[tuple[int, float], int]]]:
        """(leaves, place of each split) of runs of leaves that ask at most ``GROUP_BITS`` different splits."""
        runs, run, splits = [], [], {}
        for i in range(len(self.value)):
            mine = self.asked(i)
            more = [q for q in dict.fromkeys(mine) if q not in splits]
            if run and len(splits) + len(more) > GROUP_BITS:
                runs.append((run, splits))
                run, splits, more = [], {}, list(dict.fromkeys(mine))
            for q in more:
                splits[q] = len(splits)
            run.append(i)
        if run:
            runs.append((run, splits))
        return runs

    def groups(self) -> list[tuple[np.ndarray, np.ndarray, list[int], np.ndarray]]:
        """(features, thresholds, features that get a share, (those, patterns) contributions) of runs of leaves.

        Leaves come from ``_walk``, so those below a node follow one another; a run ends
        where its leaves ask more than ``GROUP_BITS`` different splits."""
        tables, d = self.tables(), self.share.shape[1]
        made = []
        for run, splits in self.runs():
            answers = np.arange(1 << len(splits))
            total: dict[int, np.ndarray] = {}
            for i in run:
                differs = np.zeros(len(answers), np.int64)
                for k, q in enumerate(self.asked(i)):
                    differs |= ((answers >> splits[q] & 1) != self.left[i, k]).astype(np.int64) << self.slot[i, k]
                found = tables[i, ((1 << d) - 1) ^ differs]
                for j in {int(self.slot[i, k]) for k in range(len(self.asked(i)))}:
                    f = int(self.slot_feature[i, j])
                    total[f] = total.get(f, 0.0) + found[:, j]
            if splits:
                made.append((np.array([f for f, _ in splits]), np.array([t for _, t in splits]), list(total), np.stack(list(total.values()))))
        return made

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) of a matrix of rows."""
        out = np.zeros((self.n_features, len(x)))
        if not self.share.size:
            return out.T
        if self.grouped is None:
            self.grouped = self.groups()
            self.table = None
        for i in range(0, len(x), ROWS):
            columns, part = np.ascontiguousarray(x[i:i + ROWS].T), out[:, i:i + ROWS]
            for features, thresholds, shared, table in self.grouped:
                answers = np.zeros(columns.shape[1], np.uint8)
                for bit, (f, t) in enumerate(zip(features.tolist(), thresholds.tolist(), strict=True)):
                    answers |= (columns[f] <= t).view(np.uint8) << np.uint8(bit)
                at = answers.astype(np.intp)
                for f, values in zip(shared, table, strict=True):
                    part[f] += values.take(at)
        return out.T


def _walk(nodes: dict, weight: float) -> Iterator[tuple[list, float]]:
    """(splits from the root: feature, threshold, left, share of the training rows; weighted value) of every leaf."""
    pending = [(0, [])]
    while pending:
        k, splits = pending.pop()
        n = nodes[k]
        if n["leftChild"] < 0:
            yield splits, weight * n["prediction"]
            continue
        split = n["split"]
        if split["numCategories"] != -1:
            raise ValueError("categorical splits are not supported")
        for child, left in ((n["leftChild"], True), (n["rightChild"], False)):
            share = nodes[child]["rawCount"] / n["rawCount"]
            pending.append((child, [*splits, (split["featureIndex"], split["leftCategoriesOrThreshold"][0], left, share)]))


def tree_paths(model) -> Paths:
    """The leaves of a fitted Spark tree ensemble (boosted or forest), at most ``MAX_DEPTH`` deep.

    The nodes are read from the model's own saved form; their number is that of
    the model, not of the data."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    path = scratch_path(spark, f"trees-{uuid.uuid4().hex}")
    stage.write().save(path)
    weights = list(stage.treeWeights)
    if not hasattr(stage, "getMaxIter"):  # a forest is a mean
        weights = [w / sum(weights) for w in weights]
    trees: dict[int, dict] = {}
    for r in spark.read.parquet(f"{path}/data").collect():  # the model's nodes
        n = r["nodeData"].asDict(recursive=True)
        trees.setdefault(r["treeID"], {})[n["id"]] = n
    leaves = [leaf for t in sorted(trees) for leaf in _walk(trees[t], weights[t])]
    d = max((len(s) for s, _ in leaves), default=0)
    if d > MAX_DEPTH:
        raise ValueError(f"trees of depth {d} are not supported, {MAX_DEPTH} at most")
    shape = (len(leaves), d)
    feature, slot, slot_feature = (np.zeros(shape, np.int64) for _ in range(3))
    threshold, left, share = np.full(shape, np.inf), np.ones(shape, bool), np.ones(shape)
    for i, (splits, _) in enumerate(leaves):
        slots: dict[int, int] = {}
        for k, (f, t, is_left, part) in enumerate(splits):
            j = slots.setdefault(f, len(slots))
            feature[i, k], threshold[i, k], left[i, k], slot[i, k] = f, t, is_left, j
            share[i, j] *= part
            slot_feature[i, j] = f
    return Paths(feature, threshold, left, slot, share, slot_feature, np.array([v for _, v in leaves]), stage.numFeatures)


def tree_contributions(model, feats: DataFrame, names: list[str], features: str = "features") -> DataFrame:
    """listing_id, base, contributions (feature, value, contribution) of every row:
    base and contributions add up to the prediction.

    ``names`` are the features in the order of the vector."""
    paths = tree_paths(model)
    if len(names) != paths.n_features:
        raise ValueError("a name for each feature is needed")
    shared = feats.sparkSession.sparkContext.broadcast(paths)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
            c = shared.value.contributions(x)
            offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * c.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.ListArray.from_arrays(offsets, pa.array(c.ravel()))], names=["listing_id", "x", "c"])

    rows = feats.select("listing_id", vector_to_array(features).alias("x"))
    found = rows.mapInArrow(run, f"listing_id {rows.schema['listing_id'].dataType.simpleString()}, x array<double>, c array<double>")
    return found.select("listing_id", F.lit(paths.base).alias("base"), F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col("x")[i].alias("value"), F.col("c")[i].alias("contribution")) for i, n in enumerate(names)]).alias("contributions"))


class Scores:
    """Predictions of an ensemble, and those with one feature's values replaced by others.

    Leaves are looked up in groups, as in ``Paths.groups``, by their answers to at most ``GROUP_BITS`` splits; a
    replaced feature changes its own answers only, so groups that do not ask it keep what they add."""

    def __init__(self, paths: Paths):
        self.n_features, self.bias, self.groups = paths.n_features, paths.bias, []
        for run, splits in paths.runs():
            answers, table = np.arange(1 << len(splits)), np.zeros(1 << len(splits))
            for i in run:
                agrees = np.ones(len(answers), bool)
                for q, left in zip(paths.asked(i), paths.left[i], strict=False):
                    agrees &= (answers >> splits[q] & 1) == left
                table += agrees * paths.value[i]
            if splits:
                masks: dict[int, int] = {}
                for bit, (f, _) in enumerate(splits):
                    masks[f] = masks.get(f, 0) | 1 << bit
                self.groups.append((list(splits), [(f, np.uint8(~m & 0xFF)) for f, m in masks.items()], table))
            else:
                self.bias += float(table[0])
        # values are compared by their place among the thresholds that the ensemble asks
        asked = {q for splits, _, _ in self.groups for q in splits}
        self.cuts = [np.array(sorted(t for g, t in asked if g == f)) for f in range(self.n_features)]
        self.kind = np.min_scalar_type(max((len(c) for c in self.cuts), default=0))
        self.groups = [([(f, self.kind.type(np.searchsorted(self.cuts[f], t))) for f, t in splits], masks, table) for splits, masks, table in self.groups]

    def _places(self, x: np.ndarray) -> np.ndarray:
        return np.array([np.searchsorted(c, x[:, f]) for f, c in enumerate(self.cuts)]).astype(self.kind)

    def replaced(self, x: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows) predictions of ``x``, (features, rows) predictions of ``x`` with a feature's column from ``other``."""
        whole, changed = np.full(len(x), self.bias), np.zeros((self.n_features, len(x)))
        for i in range(0, len(x), SCORED_ROWS):
            n = len(x[i:i + SCORED_ROWS])
            both = np.concatenate([self._places(x[i:i + n]), self._places(other[i:i + n])], axis=1)
            value, found, at = np.empty(n), np.empty(n), np.empty(n, np.intp)
            said, bit = np.empty(2 * n, np.uint8), np.empty(2 * n, np.bool_)
            for splits, masks, table in self.groups:
                said[:] = 0
                for k, (f, place) in enumerate(splits):
                    np.less_equal(both[f], place, out=bit)
                    np.bitwise_or(said, np.left_shift(bit.view(np.uint8), np.uint8(k)), out=said)
                mine, theirs = said[:n], said[n:]
                at[:] = mine
                whole[i:i + n] += table.take(at, out=value, mode="clip")
                mine ^= theirs  # the answers that differ
                for f, others in masks:
                    at[:] = (mine & others) ^ theirs
                    table.take(at, out=found, mode="clip")
                    found -= value
                    changed[f, i:i + n] += found
        return whole, changed + whole


def _dealt(row: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Where the values of rows 0 to n - 1 go: a seeded permutation (invertible steps over a power of two, walked until below n)."""
    bits = max(2, int(n - 1).bit_length())
    mask, half = np.uint64((1 << bits) - 1), np.uint64(bits // 2)
    salts = np.random.SeedSequence(salt).generate_state(8, np.uint64)
    out, open_ = np.empty(len(row), np.uint64), np.arange(len(row))
    at = row.astype(np.uint64)
    while len(open_):
        for a, b in salts.reshape(4, 2):
            at = (at * (a | np.uint64(1)) + b) & mask
            at ^= at >> half
        done = at < np.uint64(n)
        out[open_[done]] = at[done]
        open_, at = open_[~done], at[~done]
    return out.astype(np.int64)


def permutation_importance(model, feats: DataFrame, names: list[str], label: str = "log_price", seed: int = 42, features: str = "features") -> DataFrame:
    """feature, rmse (with its values dealt anew), rise (over the model as it is) and r2_drop, a row per feature.

    Values are permuted without collecting or sorting them: rows are numbered, and a seeded permutation of the
    numbers says for every feature and row which row its value goes to. Values travel to blocks of ``DEALT_ROWS``
    rows, where a block is scored for all features at once and only its sums leave."""
    spark, width = feats.sparkSession, len(names)
    kept = scratch_path(spark, f"permuted-{uuid.uuid4().hex}")
    base = ranking.row_rank(feats.select("listing_id", F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")), "listing_id", "row",
                            ties=[F.asc("y"), F.asc("x")])
    base.select("row", "y", "x").write.parquet(kept)
    base = spark.read.parquet(kept)
    n, variance = base.agg(F.count(F.lit(1)), F.var_pop("y")).first()
    shared = spark.sparkContext.broadcast(Scores(tree_paths(model)))

    def deal(batches):
        for batch in batches:
            row = batch.column(0).to_numpy() - 1
            y, x = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            parts: dict[int, list] = {}
            for c in range(-1, width):  # -1: the row itself
                to = row if c < 0 else _dealt(row, n, seed * 1000 + c)
                order = np.argsort(to // DEALT_ROWS, kind="stable")
                blocks, starts = np.unique(to[order] // DEALT_ROWS, return_index=True)
                for block, some in zip(blocks.tolist(), np.split(order, starts[1:]), strict=True):
                    parts.setdefault(block, []).append((c, (to[some] - block * DEALT_ROWS).astype(np.int32), (y[some], x[some]) if c < 0 else x[some, c]))
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([pickle.dumps(p, 5) for p in parts.values()], pa.binary())], names=["block", "b"])

    def score(key, found):
        block = key[0].as_py()
        size = min(DEALT_ROWS, n - block * DEALT_ROWS)
        y, x, other = np.empty(size), np.empty((size, width)), np.empty((size, width))
        for b in found.column("b"):
            for c, at, values in pickle.loads(b.as_py()):
                if c < 0:
                    y[at], x[at] = values
                else:
                    other[at, c] = values
        whole, changed = shared.value.replaced(x, other)
        e = [float(((y - p) ** 2).sum()) for p in (whole, *changed)]
        return pa.table({"c": pa.array(range(-1, width), pa.int32()), "e": e})

    sums = base.mapInArrow(deal, "block long, b binary").groupBy("block").applyInArrow(score, "c int, e double")
    by = _kept(sums.groupBy("c").agg(F.sum("e").alias("e")), "permuted-errors")
    rmse, r2 = F.sqrt(F.col("e") / n), 1 - F.col("e") / (F.lit(n) * F.lit(variance))
    whole = by.where("c = -1").select(rmse.alias("rmse0"), r2.alias("r20"))  # one row
    names_of = F.array(*[F.lit(x) for x in names])
    return by.where("c >= 0").join(F.broadcast(whole)).select(
        names_of[F.col("c")].alias("feature"), rmse.alias("rmse"), (rmse - F.col("rmse0")).alias("rise"), (F.col("r20") - r2).alias("r2_drop"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
