"""Column expressions shared by the cleaning jobs and the queries.

Every function here returns a ``Column`` so that it compiles into the
surrounding whole-stage-codegen span; none of them is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Text read as missing by the pandas CSV reader with default settings
# (pandas.read_csv, ``na_values`` default list).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Plausible coordinate box of the market (inclusive bounds).
LAT_BOUNDS = (41.2, 41.6)
LON_BOUNDS = (1.9, 2.3)
# Columns that are always empty in the listings export.
DEAD_COLUMNS = [
    "neighborhood_overview", "host_since", "host_response_time",
    "host_thumbnail_url", "host_acceptance_rate", "host_response_rate",
    "host_verifications", "neighbourhood", "host_total_listings_count",
    "host_neighbourhood", "calendar_updated", "instant_bookable",
]
PRICE_COLUMNS = ["price", "price_quote_price_per_night", "price_quote_total_price"]
LISTING_DATE_COLUMNS = ["last_scraped", "first_review", "last_review", "calendar_last_scraped"]
# -----------------------------------------------------------------------------

# A decimal or scientific number, optionally signed; or an infinity.  Anything
# else (``12d``, ``1_000``, ``0x10``, ``(5.00)``) is not a number for pandas.
_NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INF_RE = r"^(?i)[+-]?inf(inity)?$"
_WS_EDGES = r"^\s+|\s+$"


def strip_ws(c: Column) -> Column:
    """Strip all leading/trailing whitespace (``str.strip``), not only spaces."""
    return F.regexp_replace(c, _WS_EDGES, "")


def na_to_null(c: Column) -> Column:
    """Turn the default CSV missing-value tokens into NULL."""
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast(T.StringType())).otherwise(c)


def clean_price(c: Column) -> Column:
    """Money text such as ``$1,250.00`` to double; anything unparsable to NULL."""
    s = strip_ws(F.regexp_replace(c.cast("string"), r"[$,]", ""))
    ok = s.rlike(_NUMBER_RE) | s.rlike(_INF_RE)
    return F.when(ok, s.try_cast(T.DoubleType()))


def flag_price_valid(price: Column) -> Column:
    return F.coalesce(price >= 0, F.lit(False))


def flag_location_valid(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(*LAT_BOUNDS) & lon.between(*LON_BOUNDS), F.lit(False))


def flag_has_reviews(n: Column) -> Column:
    return F.coalesce(n > 0, F.lit(False))


def parse_date(c: Column) -> Column:
    """Text to date; unparsable text becomes NULL (``errors='coerce'``)."""
    s = strip_ws(c.cast("string"))
    # the form of the text picks one format, so a row is parsed once
    forms = [(r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{4}-\d{2}-\d{2} ", "yyyy-MM-dd HH:mm:ss"),
             (r"^\d{4}-\d{2}-\d{2}T", "yyyy-MM-dd'T'HH:mm:ss"), (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd")]
    out = F.lit(None).cast(T.DateType())
    for pattern, fmt in reversed(forms):
        out = F.when(s.rlike(pattern), F.try_to_timestamp(s, F.lit(fmt)).cast(T.DateType())).otherwise(out)
    return out


def map_available(c: Column) -> Column:
    """'t' -> true, 'f' -> false, anything else -> NULL."""
    return F.when(c == "t", F.lit(True)).when(c == "f", F.lit(False))


def day_of_week(d: Column) -> Column:
    """Day of week with Sunday = 0 (SQL ``dow``); Spark's own starts at 1."""
    return (F.dayofweek(d) - 1).cast("bigint")


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday; a NULL date is not a weekend (CASE falls to false)."""
    return F.coalesce(day_of_week(d).isin(0, 6), F.lit(False))


def clip_lower(c: Column, lower: float) -> Column:
    """``Series.clip(lower=…)``: NULL stays NULL (``greatest`` would skip it)."""
    return F.when(c.isNull(), None).otherwise(F.greatest(c, F.lit(lower)))


def to_flag_int(cond: Column) -> Column:
    """Boolean condition to 0/1 with NULL counted as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def demand_segment(n_reviews: Column, occupancy: Column) -> Column:
    """Three-way demand segment; NULL inputs fall through to 'active'."""
    return (F.when((n_reviews == 0) & (occupancy == 0), "never_active")
            .when((n_reviews > 0) & (occupancy == 0), "dormant_with_history")
            .otherwise("active"))


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``round(part * 100.0 / whole, d)`` as double; NULL when whole is 0."""
    return F.round(part.cast("double") * 100 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def null_count_exprs(df: DataFrame, cols: list[str] | None = None) -> list[Column]:
    cols = cols or df.columns
    return [F.count_if(F.col(c).isNull()).alias(c) for c in cols]


def all_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
