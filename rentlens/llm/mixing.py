"""Mixing sources to target weights by hash-threshold histograms (DataFrame operations only).

Every document gets a 36-bit hash of its id. Words are summed by source and by
the top 12 bits of the hash; the bucket in which a source's budget runs out is
found from these sums, and only that bucket is summed again by the next 12
bits, and once more. The result is one hash bound per source: documents below
it are taken. Nothing is sorted, a hot source is pre-aggregated to 4,096 sums,
and a document's decision depends on its own row and its source's bound alone.

Sources in code point order, null last, weigh ``weights`` in turn. Together the
targets are ``share`` times all words; a target stops at ``max_copies`` times
its source's words and the excess goes to the others by weight, which is the
water level found below from running sums over the sources.

Defined results: null text has size 0, and so has an empty one; a source of
size 0 has target 0; rows without id are dealt by a hash of their text; rows
with the same id are one document and are taken alike; an empty table gives an
empty result. Columns of the input with the names of the results are replaced.
A very long text counts with all its words and may exceed a small target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import join_small, saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
LEVELS, BITS = 3, 12


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    squeezed = F.regexp_replace(text, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), F.length(F.regexp_extract(text, r"^([\x20\x09-\x0D]+)", 1))).otherwise(F.lit(0))
    return F.coalesce((F.length(squeezed) - lead).cast("long"), F.lit(0).cast("long"))


def hash_key(doc_id: Column, text: Column) -> Column:
    """The first 36 bits of an MD5 as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), text, F.lit(""))), 1, 9), 16, 10).cast("long")


def targets(slim: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: one row per source."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    src = (slim.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("nth", F.row_number().over(by_name))
           .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("nth") - 1) % len(weights) + 1).cast("int")))
           .withColumn("cap", F.col("source_size").cast("double") * max_copies))
    fill = W.orderBy(F.col("cap") / F.col("weight"), "nth")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    src = (src.withColumn("place", F.row_number().over(fill))
           .withColumn("level", (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
           .withColumn("free", F.col("cap") > F.col("weight") * F.col("level")))
    water = F.min(F.when(F.col("free"), F.struct("place", "level"))).over(every)
    return (src.withColumn("water", water)
            .select("source", "source_size",
                    F.when(F.col("water").isNull() | (F.col("place") < F.col("water.place")), F.col("cap"))
                    .otherwise(F.col("weight") * F.col("water.level")).alias("target")))


def bounds(slim: DataFrame, goal: DataFrame) -> DataFrame:
    """``goal`` with ``base`` (whole copies of all documents) and ``bound``: keys below it get one more copy."""
    width = LEVELS * BITS
    at = saved(goal.withColumn("base", F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0))
               .withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
               .withColumn("prefix", F.lit(0).cast("long")), "mix-goal")
    for level in range(1, LEVELS + 1):
        low = width - level * BITS
        here = at.select(F.col("source").alias("s_"), "budget", "prefix")
        inside = slim if level == 1 else join_small(
            slim, here.select("s_", F.col("prefix").alias("p_")),
            F.col("source").eqNullSafe(F.col("s_")) & (F.shiftright("key", low + BITS) == F.col("p_")), "left_semi")
        sums = inside.groupBy("source", F.shiftright("key", low).alias("bucket")).agg(F.sum("size").alias("words"))
        run = sums.withColumn("upto", F.sum("words").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)))
        # the first bucket in which the budget is reached; a budget above all sums ends in the last bucket
        met = (join_small(run, here, F.col("source").eqNullSafe(F.col("s_")))
               .groupBy("source").agg(
                   F.min(F.when(F.col("upto") >= F.col("budget"), F.struct("bucket", "words", "upto"))).alias("hit"),
                   F.max(F.struct("bucket", "words", "upto")).alias("end"))
               .select(F.col("source").alias("s_"), F.coalesce("hit", "end").alias("m")))
        keep = [c for c in at.columns if c not in ("budget", "prefix", "words")]
        at = saved(at.join(met, F.col("source").eqNullSafe(F.col("s_")))
                   .select(*keep, (F.col("budget") - (F.col("m.upto") - F.col("m.words"))).alias("budget"),
                           F.col("m.bucket").alias("prefix"), F.col("m.words").alias("words")), f"mix-level{level}")
    # the last bucket is one key: it is taken if that comes nearer to the target
    return at.select("source", "source_size", "target", "base",
                     (F.col("prefix") + F.when(F.col("budget") * 2 >= F.col("words"), 1).otherwise(0)).alias("bound"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """The documents with size, source_size, target, copies (0, 1 or 2) and taken (words, repeats counted)."""
    if max_copies != 2 or not 0 < share <= max_copies:
        raise ValueError("copies are one or two; share is above 0 and at most 2")
    results = ("size", "source_size", "target", "copies", "taken", "key", "source_")
    size, key = word_count(F.col(text_col)), hash_key(F.col(id_col), F.col(text_col))
    slim = saved(docs.select(F.col(source_col).alias("source"), size.alias("size"), key.alias("key")), "mix-slim")
    bound = bounds(slim, targets(slim, weights, share, max_copies)).withColumnRenamed("source", "source_")
    full = docs.select(*[c for c in docs.columns if c not in results], size.alias("size"), key.alias("key"))
    return (join_small(full, bound, F.col(source_col).eqNullSafe(F.col("source_")), "left")
            .withColumn("copies", (F.col("base") + F.when(F.col("key") < F.col("bound"), 1).otherwise(0)).cast("int"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("source_", "base", "bound", "key"))
