"""Amenity tokens, cosine similarity and recommendations.

Listings are binary amenity vectors; cosine(a, b) = |A ∩ B| / sqrt(|A| |B|).
Similarity is computed from the query side: the query listing's tokens (one
listing's list, bounded by its own amenity field) are broadcast and joined
to the inverted index (listing, token), the overlap is counted per candidate
and every other listing without overlap scores 0.  One pass over the index
per query listing, linear in the data; no pair table of all listings is ever
built (the reference's n x n matrix is quadratic by nature, since every pair
sharing a common amenity has a non-zero score).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions import text as TX
from rentlens.operators import ranking
from rentlens.operators.warehouse import Warehouse
from rentlens.session import scratch_path

FRAME_COLUMNS = ["listing_id", "name", "amenities", "neighbourhood", "neighbourhood_group", "room_type",
                 "accommodates", "price", "review_scores_rating", "bedrooms", "bathrooms"]
#: A best match below this is a weak one; the thresholds by which best matches are looked for.
LOW_MATCH = 0.5
MATCH_THRESHOLDS = (0.9, 0.7, 0.5, 0.3)
#: Sets of at most so many tokens may be matched by their pairs of tokens.
PAIRED_TOKENS = 64


def amenity_frame(wh: Warehouse) -> DataFrame:
    """Listings with an amenity field and a positive price."""
    s = wh.stg_listings
    return (s.where(F.col("amenities").isNotNull() & F.col("price").isNotNull() & (F.col("price") > 0))
            .select(F.col("id").alias("listing_id"), "name", "amenities",
                    F.col("neighbourhood_cleansed").alias("neighbourhood"),
                    F.col("neighbourhood_group_cleansed").alias("neighbourhood_group"), "room_type", "accommodates",
                    "price", "review_scores_rating", "bedrooms", "bathrooms"))


def amenity_tokens(frame: DataFrame) -> DataFrame:
    """Parsed, normalised amenity list and its length (repeats counted)."""
    return (frame.withColumn("amenity_list", TX.parse_amenities(F.col("amenities")))
            .withColumn("n_amenities", F.size("amenity_list").cast("bigint")))


def binary_matrix(tokens: DataFrame) -> DataFrame:
    """Long form of the 0/1 matrix: distinct (listing_id, token) pairs."""
    return tokens.select("listing_id", F.explode("amenity_list").alias("token")).distinct()


def amenity_counts(tokens: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` most common tokens with the share of listings having them."""
    n = tokens.agg(F.count(F.lit(1))).scalar()
    b = binary_matrix(tokens)
    g = b.groupBy("token").agg(F.count(F.lit(1)).alias("n_listings"))
    return (g.orderBy(F.desc("n_listings"), F.asc("token")).limit(top)
            .withColumn("pct_listings", (F.col("n_listings") * 100.0 / n).cast("double")))


def amenity_summary(tokens: DataFrame) -> DataFrame:
    """Describe of list length and the number of distinct tokens."""
    c = F.col("n_amenities")
    q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    d = binary_matrix(tokens).agg(F.count_distinct("token").alias("n_tokens"))
    return tokens.agg(F.count(F.lit(1)).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                      F.min(c).alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"),
                      F.max(c).alias("max")).withColumn("n_tokens", d.scalar())


def _norms(b: DataFrame) -> DataFrame:
    return b.groupBy("listing_id").agg(F.count(F.lit(1)).alias("n_tok"))


def similarity_row(tokens: DataFrame, listing_id: int) -> DataFrame:
    """Cosine of one listing with every listing (itself included: 1, or 0
    for an empty list).  One row per listing of the frame."""
    b = binary_matrix(tokens)
    qt = b.where(F.col("listing_id") == listing_id).select("token")  # one listing's tokens
    nq = qt.agg(F.count(F.lit(1))).scalar()
    overlap = b.join(F.broadcast(qt), "token").groupBy("listing_id").agg(F.count(F.lit(1)).alias("overlap"))
    base = tokens.select("listing_id").join(_norms(b), "listing_id", "left")
    s = base.join(overlap, "listing_id", "left")
    score = F.when(F.coalesce("overlap", F.lit(0)) == 0, F.lit(0.0)).otherwise(
        F.col("overlap") / F.sqrt(F.col("n_tok").cast("double") * nq))
    return s.select("listing_id", score.alias("similarity_score"))


def cosine_pair(tokens: DataFrame, a: int, b_id: int) -> DataFrame:
    """Cosine of two given listings (a look-up of one cell of the matrix)."""
    b = binary_matrix(tokens)
    ta = b.where(F.col("listing_id") == a).select("token")
    tb = b.where(F.col("listing_id") == b_id).select("token")
    na, nb = ta.agg(F.count(F.lit(1))), tb.agg(F.count(F.lit(1)))
    ov = ta.join(tb, "token").agg(F.count(F.lit(1)))
    return (na.select(F.lit(a).cast("bigint").alias("listing_a"), F.lit(b_id).cast("bigint").alias("listing_b"))
            .withColumn("overlap", ov.scalar()).withColumn("n_a", na.scalar()).withColumn("n_b", nb.scalar())
            .withColumn("similarity_score", F.when(F.col("overlap") == 0, F.lit(0.0)).otherwise(
                F.col("overlap") / F.sqrt(F.col("n_a").cast("double") * F.col("n_b")))))


def recommend_similar(tokens: DataFrame, listing_id: int, n: int = 5, exclude_same_neighbourhood: bool = False,
                      digits: int = 4, check: bool = True) -> DataFrame:
    """Top-n most similar other listings (score desc, then listing id).

    ``exclude_same_neighbourhood`` drops candidates in the query listing's
    area (the reference names this flag 'exclude_same_host' but compares
    areas).  An unknown id raises ``ValueError`` as in the reference."""
    if check and tokens.where(F.col("listing_id") == listing_id).limit(1).count() == 0:
        raise ValueError(f"listing_id {listing_id} not found in dataset")
    row = similarity_row(tokens, listing_id)
    cand = tokens.join(row, "listing_id").where(F.col("listing_id") != listing_id)
    if exclude_same_neighbourhood:
        area = tokens.where(F.col("listing_id") == listing_id).select("neighbourhood")
        cand = cand.join(area, cand.neighbourhood.eqNullSafe(area.neighbourhood), "left_anti")
    return (cand.orderBy(F.desc("similarity_score"), F.asc("listing_id")).limit(n)
            .select("listing_id", F.substring(F.col("name").cast("string"), 1, 60).alias("name"), "neighbourhood",
                    "room_type", F.col("accommodates").cast("int").alias("accommodates"), "price",
                    F.col("review_scores_rating").alias("rating"), "n_amenities",
                    F.round("similarity_score", digits).alias("similarity_score")))


def describe_listing(tokens: DataFrame, listing_id: int) -> DataFrame:
    """Key attributes of one listing as display lines."""
    r = tokens.where(F.col("listing_id") == listing_id)
    return r.select(
        "listing_id",
        F.format_string("#%d %s", F.col("listing_id"), F.substring(F.col("name").cast("string"), 1, 70))
        .alias("title"),
        F.format_string("%s, %s", "neighbourhood", "neighbourhood_group").alias("area"),
        F.format_string("%s for %d", "room_type", "accommodates").alias("room"),
        F.format_string("%.2f a night, rated %s", "price",
                        F.coalesce(F.col("review_scores_rating").cast("string"), F.lit("-"))).alias("price_line"),
        F.format_string("%d amenities, such as %s", "n_amenities",
                        F.substring(F.array_join("amenity_list", ", "), 1, 120)).alias("amenities_line"))


def example_query(tokens: DataFrame, room_type: str, price_range=None, group: str | None = None,
                  position: int = 5) -> DataFrame:
    """The listing at ``position`` (0-based, by listing id) among those of a
    room type in a price range or area group: a reproducible query listing."""
    f = F.col("room_type") == room_type
    if price_range is not None:
        f = f & F.col("price").between(*price_range)
    if group is not None:
        f = f & (F.col("neighbourhood_group") == group)
    return tokens.where(f).orderBy("listing_id").offset(position).limit(1).select("listing_id")


# --- best matches of all listings -----------------------------------------------------

def _token_sets(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(listing_id, set_id) and (set_id, n, size, items) of the distinct token sets, tokens as numbers from the rarest on."""
    b = binary_matrix(tokens)
    freq = b.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    nth = ranking.row_rank(freq, "freq", "nth", ties=[F.col("token").asc()]).select("token", F.col("nth").cast("int").alias("nth"))
    listed = _kept(b.join(nth, "token").groupBy("listing_id").agg(F.array_sort(F.collect_list("nth")).alias("items")), "match-listed")
    sets = listed.groupBy("items").agg(F.count(F.lit(1)).alias("size"))
    # the numbers hold once they are stored
    sets = _kept(sets.select(F.monotonically_increasing_id().alias("set_id"), "size", "items", F.size("items").cast("long").alias("n")), "match-sets")
    return listed.join(sets, "items").select("listing_id", "set_id"), sets


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _by_one_token(index: DataFrame) -> DataFrame:
    """set_id, score: the best cosine that one shared token alone gives, from the smallest other set that has it."""
    first = index.groupBy("token").agg(F.min(F.struct("n", "set_id")).alias("first"))
    marked = index.join(first, "token")
    second = marked.where(F.col("set_id") != F.col("first.set_id")).groupBy("token").agg(F.min("n").alias("second"))
    other = F.when(F.col("set_id") == F.col("first.set_id"), F.col("second")).otherwise(F.col("first.n"))
    return marked.join(second, "token").groupBy("set_id").agg(F.max(1 / F.sqrt(F.col("n") * other)).alias("score"))


def _round(pending: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """set_id, score: the best cosine of at least ``least`` of each pending set with another set.

    Linked sets share ``ceil(least^2 n)`` tokens or more, and so one among the
    first ``n - ceil(least^2 n) + 1`` of each; at ``least`` 0 all that share
    two tokens or more do so before the last of each.
    """
    n = F.col("n")
    upto = (n - 1) if least == 0 else n - F.greatest(F.ceil(F.lit(least * least) * n - 1e-9), F.lit(1)) + 1
    def entries(d):
        return d.select("set_id", "n", "items", F.explode(F.slice("items", 1, F.greatest(upto, F.lit(0)).cast("int"))).alias("token"))
    a, b = entries(pending).alias("a"), entries(sets).alias("b")
    sizes = (F.col("b.n") >= F.lit(least * least) * F.col("a.n") - 1e-9) & (F.col("a.n") >= F.lit(least * least) * F.col("b.n") - 1e-9)
    # a set that is still open is beaten only by a score above what it has
    better = F.least("a.n", "b.n") / F.sqrt(F.col("a.n") * F.col("b.n")) > F.lit(least) - 1e-9
    # both sets come with their tokens: a pair is scored where it is found and only the best per set leaves the task
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.set_id") != F.col("b.set_id")) & sizes & better)
    score = F.size(F.array_intersect("a.items", "b.items")) / F.sqrt(F.col("a.n") * F.col("b.n"))
    return pairs.select("a.set_id", score.alias("score")).groupBy("set_id").agg(F.max("score").alias("score")).where(F.col("score") >= least - 1e-9)


def _few_pairs(sets: DataFrame) -> bool:
    """Whether the sets have fewer pairs of tokens than pairs of sets share a token: short sets, rare tokens."""
    n = F.col("n").cast("double")
    longest, pairs = sets.agg(F.max("n"), F.sum(n * (n - 1) / 2)).first()
    if longest is None or longest > PAIRED_TOKENS:
        return False
    shared = sets.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).cast("double").alias("f"))
    return pairs <= (shared.agg(F.sum(F.col("f") * F.col("f"))).first()[0] or 0.0)


def _by_two_tokens(pending: DataFrame, sets: DataFrame, one: DataFrame) -> DataFrame:
    """set_id, score: the best cosine of each pending set with a set that shares two tokens or more, where it is above ``one``.

    Sets meet at the pairs of tokens that they share; pairs of tokens of one set alone are left out before the sets
    come with their tokens, and a pair of sets is scored where it is found."""
    x = F.col("items")
    keys = F.flatten(F.transform(x, lambda t, i: F.transform(F.slice(x, i + 2, F.size(x)), lambda u: F.shiftleft(t.cast("bigint"), 32) + u)))
    entries = sets.where("n > 1").select("set_id", F.explode(keys).alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where("f > 1").select("key")
    met = _kept(entries.join(shared, "key", "left_semi").join(sets.select("set_id", "n", "items"), "set_id"), "match-met")
    a = met.join(pending.select("set_id"), "set_id", "left_semi").join(one, "set_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0))).alias("a")
    b = met.alias("b")
    root = F.sqrt(F.col("a.n") * F.col("b.n"))
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.set_id") != F.col("b.set_id")) & (F.least("a.n", "b.n") / root > F.col("a.score")))
    return pairs.select("a.set_id", (F.size(F.array_intersect("a.items", "b.items")) / root).alias("score")).groupBy("set_id").agg(F.max("score").alias("score"))


def best_matches(tokens: DataFrame, thresholds: tuple = MATCH_THRESHOLDS) -> DataFrame:
    """listing_id, best_score: the highest cosine of every listing with another one (0 if nothing is shared).

    An all-nearest-neighbour join without a pair table. Listings with equal
    token sets are one set, which has its match (1) if it is shared. The others
    go through falling thresholds: at each, sets are joined over the rarest
    tokens only, and a set that has found a match leaves. A token that all
    listings have is in no prefix until the last round, and not even there:
    what one shared token gives comes from the smallest set that has it. Short sets
    of rare tokens need no thresholds: what two shared tokens or more give comes
    from the pairs of tokens that sets have in common.
    """
    of, sets = _token_sets(tokens)
    found = sets.where("size > 1").select("set_id", F.lit(1.0).alias("score"))
    pending, done = sets.where("size = 1"), [found]
    if _few_pairs(sets):
        index = sets.select("set_id", "n", F.explode("items").alias("token"))
        one = _kept(_by_one_token(index).join(pending.select("set_id"), "set_id", "left_semi"), "match-one")
        done.append(one.unionByName(_by_two_tokens(pending, sets, one)).groupBy("set_id").agg(F.max("score").alias("score")))
        thresholds = None
    for least in (*thresholds, 0.0) if thresholds is not None else ():
        got = _kept(_round(pending, sets, least), "match-round")
        if least == 0.0:
            index = sets.select("set_id", "n", F.explode("items").alias("token"))
            one = _by_one_token(index).join(pending.select("set_id"), "set_id", "left_semi")
            got = got.unionByName(one).groupBy("set_id").agg(F.max("score").alias("score"))
        done.append(got)
        pending = _kept(pending.join(got.select("set_id"), "set_id", "left_anti"), "match-pending")
        if least and pending.isEmpty():
            break
    scores = done[0]
    for d in done[1:]:
        scores = scores.unionByName(d)
    return (tokens.select("listing_id").distinct().join(of.join(scores, "set_id"), "listing_id", "left")
            .select("listing_id", F.coalesce("score", F.lit(0.0)).alias("best_score")))


def best_match_stats(matches: DataFrame) -> DataFrame:
    """Describe of the best scores and the share of listings below ``LOW_MATCH``, one row."""
    q = ranking.quantiles(matches, "best_score", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    c = F.col("best_score")
    rest = matches.agg(F.count(F.lit(1)).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"),
                       F.max(c).alias("max"), (F.count_if(c < LOW_MATCH) * 100.0 / F.count(F.lit(1))).alias("pct_below_half"))
    return rest.join(F.broadcast(q))  # one row each


def best_match_histogram(matches: DataFrame, bins: int = 50) -> DataFrame:
    """Listings per bin of equal width between the least and the highest score (the last one closed)."""
    ends = matches.agg(F.min("best_score").alias("lo"), F.max("best_score").alias("hi"))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("best_score") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return matches.join(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n_listings"))
