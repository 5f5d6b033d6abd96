"""Language-model scoring by cross-entropy difference.

Two bigram models of the same form, one of the target documents and one of the
whole corpus (the background), share one vocabulary: every word of the corpus.
A word w after v costs

    -log( k * P(w | v) + (1 - k) * P(w) )

with add-one smoothed parts, and one entry more for a word that was never seen.
A document's score is the target's mean loss less the background's mean loss
over its words; the lower, the more like the target.

Counting: each task counts the word pairs of the documents it reads and hands
on one row per distinct pair, at the latest when it holds ``FLUSH`` of them;
Spark sums them. All pairs, and the counts of all words, which follow from them,
are saved tables that grow with the corpus; nothing is cut off.

Scoring: every pair gets its two losses by joins with the counts of its words.
Each document's distinct pairs are joined to these and summed. The most
frequent pairs, ``HOT`` at most, are looked up in a broadcast instead, so that
no key is in a large part of the rows; that changes the cost, not the result.

With ``v_words`` and ``classes`` the models are class bigram models of fixed
size instead: the ``v_words - 1`` most frequent words and one entry for all
others; the ``classes - 1`` most frequent words are classes of their own, all
others one class, and P(w | v) is P(class w | class v) * P(w | class w). With as
many classes as words both forms are the same.

Words are known by 64-bit hashes, and pairs in the last join by a 64-bit hash of
both. Defined results: a null or empty text has no words, losses and score 0;
without target documents the target model is the uniform one; ties in the
vocabulary go by hash; repeated rows count as often as they occur; an empty
table gives an empty result; labels without id or quality are no labels. A very
long text is counted as a whole, like any other. Only id and text are read, so
other columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import NOT_SPACE, in_arrow, join_small, lowered, mix64, saved, text_slices, with_locator, word_hashes, word_spans

MIX = 0.7
#: Distinct words or pairs that a task holds before it hands them on.
FLUSH = 1_000_000
#: So many pairs are looked up in a broadcast, if they occur so often at least.
HOT, HOT_LEAST = 50_000, 200
_COUNTS = "key long, target long, corpus long"


def _words(data: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = lowered(data)
    s, e, upto = word_spans(raw, off, NOT_SPACE)
    return (word_hashes(raw, s, e).view(np.int64) if len(s) else np.zeros(0, np.int64)), upto


def _rows(keys: np.ndarray, target: np.ndarray, corpus: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(target), pa.array(corpus)], names=["key", "target", "corpus"])


def count_words(marked: DataFrame, flush: int = FLUSH) -> DataFrame:
    """key (word hash), target, corpus: occurrences, over rows (body, is_target)."""

    def run(batches):
        parts, held = [], 0

        def summed():
            keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return [keys, *(np.bincount(back, weights=np.concatenate([p[k] for p in parts]), minlength=len(keys)).astype(np.int64) for k in (1, 2))]

        for batch in batches:
            wanted = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for i, j, data, off in text_slices(batch.column(0)):
                h, upto = _words(data, off)
                keys, back = np.unique(h, return_inverse=True)
                own = np.repeat(wanted[i:j], np.diff(upto))
                parts.append((keys, np.bincount(back, weights=own, minlength=len(keys)), np.bincount(back, minlength=len(keys))))
                held += len(keys)
                if held > 2 * flush:
                    parts = [summed()]
                    held = len(parts[0][0])
                    if held > flush:
                        yield _rows(*parts[0])
                        parts, held = [], 0
        if held:
            yield _rows(*summed())

    return marked.transform(in_arrow, run, _COUNTS).groupBy("key").agg(F.sum("target").alias("target"), F.sum("corpus").alias("corpus"))


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The distinct rows of ``keys`` in order, with their sums of ``values``."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) if len(at) else v for v in values]


def _word_pairs(data: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word before every word (0 at the beginning of a document), the words, and the words before each document."""
    h, upto = _words(data, off)
    before = np.zeros(len(h), np.int64)
    before[1:] = h[:-1]
    before[upto[:-1][np.diff(upto) > 0]] = 0
    return before, h, upto


def count_word_pairs(marked: DataFrame, flush: int = FLUSH) -> DataFrame:
    """v, w (hashes of a word and the next), target, corpus: occurrences, over rows (body, is_target)."""
    names = ["v", "w", "target", "corpus"]

    def run(batches):
        parts, held = [], 0

        def summed():
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            keys, values = _summed(columns[:2], columns[2:])
            return [*keys, *values]

        for batch in batches:
            wanted = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for i, j, data, off in text_slices(batch.column(0)):
                v, w, upto = _word_pairs(data, off)
                keys, values = _summed([v, w], [np.repeat(wanted[i:j], np.diff(upto)).astype(np.int64), np.ones(len(w), np.int64)])
                parts.append([*keys, *values])
                held += len(keys[0])
                if held > 2 * flush:
                    parts = [summed()]
                    held = len(parts[0][0])
                    if held > flush:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=names)
                        parts, held = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed()], names=names)

    return marked.transform(in_arrow, run, "v long, w long, target long, corpus long").groupBy("v", "w").agg(
        F.sum("target").alias("target"), F.sum("corpus").alias("corpus"))


@dataclass
class Vocabulary:
    words: np.ndarray  # sorted hashes
    code: np.ndarray  # their codes; 0 is every other word, the lowest codes are the most frequent words

    def codes(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.code[at], 0)


def _pairs(code: np.ndarray, upto: np.ndarray, classes: int) -> np.ndarray:
    """previous class * classes + class of every word; a document begins after class 0."""
    c = np.where(code < classes, code, 0)
    before = np.zeros(len(c), np.int64)
    before[1:] = c[:-1]
    first = upto[:-1][np.diff(upto) > 0]
    before[first] = 0
    return before * classes + c


def count_pairs(marked: DataFrame, vocabulary, classes: int) -> DataFrame:
    """key (class pair), target, corpus: occurrences."""

    def run(batches):
        v = vocabulary.value
        target, corpus = np.zeros(classes * classes), np.zeros(classes * classes, np.int64)
        for batch in batches:
            wanted = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for i, j, data, off in text_slices(batch.column(0)):
                h, upto = _words(data, off)
                pair = _pairs(v.codes(h), upto, classes)
                corpus += np.bincount(pair, minlength=classes * classes)
                own = pair[np.repeat(wanted[i:j], np.diff(upto))]
                target += np.bincount(own, minlength=classes * classes)
        at = np.flatnonzero(corpus)
        if len(at):
            yield _rows(at, target[at].astype(np.int64), corpus[at])

    return marked.transform(in_arrow, run, _COUNTS).groupBy("key").agg(F.sum("target").alias("target"), F.sum("corpus").alias("corpus"))


@dataclass
class Models:
    vocabulary: Vocabulary
    classes: int
    word: np.ndarray  # (2, words): log P(w) parts, target and corpus
    emit: np.ndarray  # (2, words): P(w | class w)
    step: np.ndarray  # (2, classes * classes): P(class | class before)


def _model(words: np.ndarray, pairs: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = (words + 1) / (words.sum() + len(words))
    own = np.arange(len(words)) < classes
    own[0] = False
    emit = np.where(own, 1.0, word / max(word[~own].sum(), 1e-300))
    table = pairs.reshape(classes, classes)
    step = (table + 1) / (table.sum(axis=1, keepdims=True) + classes)
    return word, emit, step.ravel()


@dataclass
class Tables:
    """The full models: saved counts of all pairs and all words."""
    pairs: DataFrame  # v, w, target, corpus
    words: DataFrame  # word, target, corpus, and target_from, corpus_from: pairs that it begins
    n_words: int
    total: tuple[int, int]  # occurrences of all words


def _tables(marked: DataFrame) -> Tables:
    pairs = saved(count_word_pairs(marked), "lm-pairs")
    none = F.lit(0).cast("long")
    ends = pairs.groupBy(F.col("w").alias("word")).agg(F.sum("target").alias("target"), F.sum("corpus").alias("corpus"))
    begins = pairs.groupBy(F.col("v").alias("word")).agg(F.sum("target").alias("target_from"), F.sum("corpus").alias("corpus_from"))
    words = saved(ends.join(begins, "word", "full").select("word", *[F.coalesce(c, none).alias(c) for c in ("target", "corpus", "target_from", "corpus_from")]), "lm-words")
    n, target, corpus = words.agg(F.count(F.when(F.col("corpus") > 0, 1)), F.coalesce(F.sum("target"), none), F.coalesce(F.sum("corpus"), none)).first()
    return Tables(pairs, words, n, (target, corpus))


def fit(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", v_words: int | None = None,
        classes: int | None = None) -> Tables | Models:
    """Both models; ``targets`` has the distinct ids of the target documents."""
    if (v_words is None) != (classes is None):
        raise ValueError("v_words and classes go together")
    ids = saved(targets.select(F.col(id_col).alias("id")).dropna().distinct(), "lm-targets")
    marked = join_small(docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id")), ids.withColumn("t", F.lit(True)), "id", "left").select(
        "body", F.coalesce("t", F.lit(False)).alias("is_target"))
    if classes is None:
        return _tables(marked)
    counts = saved(count_words(marked), "lm-words")
    total = counts.agg(F.coalesce(F.sum("target"), F.lit(0)), F.coalesce(F.sum("corpus"), F.lit(0))).first()
    top = counts.orderBy(F.desc("corpus"), "key").limit(v_words - 1).toPandas()  # at most v_words rows
    order = np.argsort(top["key"].to_numpy(), kind="stable")
    vocabulary = Vocabulary(top["key"].to_numpy()[order].astype(np.int64), order.astype(np.int64) + 1)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    pairs = count_pairs(marked, shared, classes).toPandas()  # at most classes ** 2 rows
    parts = []
    for k, name in enumerate(("target", "corpus")):
        words = np.concatenate([[0], top[name].to_numpy()]).astype(float)
        words[0] = total[k] - words.sum()
        table = np.zeros(classes * classes)
        table[pairs["key"].to_numpy(dtype=np.int64)] = pairs[name].to_numpy()
        parts.append(_model(words, table, classes))
    return Models(vocabulary, classes, *(np.stack([p[i] for p in parts]).astype(np.float32) for i in range(3)))


def losses(models: Models, data: bytes, off: np.ndarray, mix: float = MIX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, and summed loss under the target and the corpus model, of each document."""
    h, upto = _words(data, off)
    code = models.vocabulary.codes(h)
    pair = _pairs(code, upto, models.classes)
    n, out = np.diff(upto), []
    doc = np.repeat(np.arange(len(n)), n)
    for k in range(2):
        p = mix * models.step[k][pair] * models.emit[k][code] + (1 - mix) * models.word[k][code]
        out.append(np.bincount(doc, weights=-np.log(p.astype(np.float64)), minlength=len(n)))
    return n, out[0], out[1]


def _pair_losses(models: Tables, mix: float) -> DataFrame:
    """v, w, pair (hash of both), corpus, t, b: the loss of w after v under the target and the corpus model."""
    begins = models.words.select(F.col("word").alias("v"), "target_from", "corpus_from")
    ends = models.words.select(F.col("word").alias("w"), F.col("target").alias("target_w"), F.col("corpus").alias("corpus_w"))
    entries = models.n_words + 1

    def loss(name: str, total: int):
        step = (F.col(name) + 1.0) / (F.col(f"{name}_from") + entries)
        return -F.log(mix * step + (1 - mix) * (F.col(f"{name}_w") + 1.0) / (total + entries))

    return models.pairs.join(begins, "v").join(ends, "w").select(
        "v", "w", F.xxhash64("v", "w").alias("pair"), "corpus", loss("target", models.total[0]).alias("t"), loss("corpus", models.total[1]).alias("b"))


def _pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(mix64(v.astype(np.int64).view(np.uint64)) + w.astype(np.int64).view(np.uint64))


def _score_by_tables(source: DataFrame, models: Tables, mix: float) -> DataFrame:
    located = with_locator(source, ["body", "id"], "lm-rows").select("body", "id", F.xxhash64("loc_file").alias("file"), F.col("loc_row").alias("row"))
    priced = saved(_pair_losses(models, mix), "lm-losses")
    top = priced.filter(F.col("corpus") >= HOT_LEAST).orderBy(F.desc("corpus"), "v", "w").limit(HOT).toPandas()  # at most HOT rows
    keys = _pair_keys(top["v"].to_numpy(), top["w"].to_numpy())
    order = np.argsort(keys)
    shared = source.sparkSession.sparkContext.broadcast(tuple(np.asarray(x)[order] for x in (keys, top["v"], top["w"], top["t"], top["b"])))

    def found(v, w):
        """Place among the hot pairs, and whether it is one."""
        key, v_, w_ = shared.value[:3]
        if not len(key):
            return np.zeros(len(v), np.int64), np.zeros(len(v), bool)
        at = np.minimum(np.searchsorted(key, _pair_keys(v, w)), len(key) - 1)
        return at, (v_[at] == v) & (w_[at] == w)

    def asked(batches):
        for batch in batches:
            file, row = (batch.column(k).to_numpy() for k in (1, 2))
            for i, _, data, off in text_slices(batch.column(0)):
                v, w, upto = _word_pairs(data, off)
                doc = np.repeat(np.arange(i, i + len(upto) - 1), np.diff(upto))
                rest = ~found(v, w)[1]
                (doc, v, w), (n,) = _summed([doc[rest], v[rest], w[rest]], [np.ones(int(rest.sum()), np.int32)])
                yield pa.RecordBatch.from_arrays([pa.array(file[doc]), pa.array(row[doc]), pa.array(v), pa.array(w), pa.array(n.astype(np.int32))],
                                                 names=["file", "row", "v", "w", "n"])

    def hot(batches):
        for batch in batches:
            parts = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))]
            for _, _, data, off in text_slices(batch.column(0)):
                v, w, upto = _word_pairs(data, off)
                doc = np.repeat(np.arange(len(upto) - 1), np.diff(upto))
                at, is_hot = found(v, w)
                parts.append((np.diff(upto), *(np.bincount(doc[is_hot], weights=x[at[is_hot]], minlength=len(upto) - 1) for x in shared.value[3:])))
            n, t, b = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(n.astype(np.int64)), pa.array(t), pa.array(b)], names=["id", "file", "row", "n_words", "t0", "b0"])

    rows = located.select("body", "file", "row").transform(in_arrow, asked, "file long, row long, v long, w long, n int")
    sums = (rows.select("file", "row", F.xxhash64("v", "w").alias("pair"), "n").join(priced.select("pair", "t", "b"), "pair")
            .groupBy("file", "row").agg(F.sum(F.col("n") * F.col("t")).alias("t"), F.sum(F.col("n") * F.col("b")).alias("b")))
    schema = StructType([source.schema["id"]]).add("file", "long").add("row", "long").add("n_words", "long").add("t0", "double").add("b0", "double")
    mean = lambda c: (F.col(f"{c}0") + F.coalesce(c, F.lit(0.0))) / F.greatest("n_words", F.lit(1))
    out = located.transform(in_arrow, hot, schema).join(sums, ["file", "row"], "left").select(
        "id", "n_words", mean("t").alias("target_loss"), mean("b").alias("background_loss"))
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def score(docs: DataFrame, models: Tables | Models, id_col: str = "doc_id", text_col: str = "text", mix: float = MIX) -> DataFrame:
    """id, n_words, target_loss, background_loss (per word) and score, their difference, of every document."""
    source = docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id"))
    if isinstance(models, Tables):
        return _score_by_tables(source, models, mix)
    schema = StructType([source.schema["id"]]).add("n_words", "long").add("target_loss", "double").add("background_loss", "double").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            parts = [losses(shared.value, data, off, mix) for _, _, data, off in text_slices(batch.column(0))]
            n, t, b = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in range(3))
            some = np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n.astype(np.int64)), pa.array(t / some), pa.array(b / some),
                                              pa.array((t - b) / some)], names=schema.names)

    return source.transform(in_arrow, run, schema)
