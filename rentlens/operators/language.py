"""Language detection by character n-grams (§2.9).

A naive Bayes model: n-grams of one to three characters of the lower-cased
letters, words set apart by one space, are hashed into a table of fixed size; its
counts per language come from labelled rows, summed in the tasks and then by
Spark.  Any set of labels can be learnt, so languages are not listed in the code.
Scoring is one Arrow pass over whole texts.

A text (without line breaks and edge spaces) shorter than ``MIN_LANG_CHARS``,
null, or without letters is 'unknown'; so is every text if nothing was learnt.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.functions.text import BREAKS, MIN_LANG_CHARS, UNKNOWN

BUCKETS = 1 << 16
LONGEST = 3


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    out = np.zeros(0x110000, bool)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):  # surrogates are none
        for run in regex.finditer(r"\p{L}+", "".join(map(chr, range(low, high)))):
            out[low + run.start():low + run.end()] = True
    return out


def _clean(text: str | None) -> str:
    text = text or ""
    for b in BREAKS:
        text = text.replace(b, " ")
    return text.strip()


def ngram_buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of a text, nothing if it has no letters."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _letters()[c]
    if not inside.any():
        return np.zeros(0, np.int64)
    kept = inside.copy()  # letters, and the first of the signs after each word
    kept[1:] |= inside[:-1]
    words = np.where(inside, c, ord(" "))[kept]
    c = np.full(len(words) + 2 - (words[-1] == ord(" ")), ord(" "), np.uint64)  # a space before, between and after the words
    c[1:len(words) + 1] = words
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(1, LONGEST + 1):
        h = h[:len(c) - n + 1] * np.uint64(0x100000001B3)
        h ^= c[n - 1:] + np.uint64(n << 32)
        at = h * np.uint64(0x9E3779B97F4A7C15)
        at >>= np.uint64(48)
        out.append(at.view(np.int64))
    return np.concatenate(out)


def count_ngrams(labelled: DataFrame) -> DataFrame:
    """language, bucket, n over rows (language, comments); each task sums its own rows first."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                np.add.at(sums[lang], ngram_buckets(_clean(text)), 1)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["language", "bucket", "n"])

    rows = labelled.where(F.col("language").isNotNull()).select("language", "comments")
    return rows.mapInArrow(run, "language string, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    languages: list[str]  # in order
    table: np.ndarray  # (BUCKETS, languages): log probabilities
    columns: np.ndarray | None = field(default=None, repr=False, compare=False)  # made where texts are scored

    def language(self, text: str | None) -> str:
        text = _clean(text)
        at = ngram_buckets(text) if len(text) >= MIN_LANG_CHARS and self.languages else ()
        if not len(at):
            return UNKNOWN
        if self.columns is None:
            self.columns = np.ascontiguousarray(self.table.T)  # a language's numbers lie together
        return self.languages[int(np.argmax([column.take(at).sum() for column in self.columns]))]


def fit(labelled: DataFrame, languages: int = 64) -> Model:
    """The model of the ``languages`` most frequent labels of rows (language, comments): at most
    that many times ``BUCKETS`` counts come to the driver.  All languages are taken as equally likely."""
    top = labelled.where(F.col("language").isNotNull()).groupBy("language").agg(F.count(F.lit(1)).alias("rows"))
    top = top.orderBy(F.desc("rows"), "language").limit(languages)
    names = sorted(r["language"] for r in top.collect())
    table = np.zeros((BUCKETS, len(names)))
    if names:
        for r in count_ngrams(labelled.where(F.col("language").isin(names))).groupBy("language").agg(
                F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).toLocalIterator():  # BUCKETS entries at most each
            table[np.array(r["b"]), names.index(r["language"])] = r["n"]
    return Model(names, np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * BUCKETS)))


def detect(model: Model, text: Column) -> Column:
    """The language of a text column."""
    @F.pandas_udf("string")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(model.language)

    return found(text)


def held_out(key: Column, every: int = 5) -> Column:
    """Whether a row is kept from training: one in ``every`` by the CRC of its id."""
    return F.crc32(key.cast("string")) % every == 0


def accuracy(model: Model, labelled: DataFrame) -> DataFrame:
    """n, n_correct and n_unknown of rows (language, comments), by language."""
    d = labelled.select("language", detect(model, F.col("comments")).alias("_found"))
    return d.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_found") == F.col("language")).alias("n_correct"),
                                     F.count_if(F.col("_found") == UNKNOWN).alias("n_unknown"))
