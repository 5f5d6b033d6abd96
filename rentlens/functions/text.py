"""Text rules as column expressions, and the text scorer.

Licence classification and number extraction, amenity list parsing, and a
scorer for sentiment and language that stands in for the reference's per-row
libraries.  The scorer is one Arrow-batched pass over the byte buffers of whole
texts: words are cut, looked up and weighed as arrays, without a loop over words,
and a document is scored where it is read, without explode or shuffle.  Its word
tables are arguments.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Licence patterns and categories.
LICENSE_RULES_V1 = [("genuine_hut_number", "rlike", r"HUTB\d+"), ("exempt_declared", "contains", "Exempt"),
                    ("genuine_national_number", "rlike", r"ESFCNT\d+")]
LICENSE_RULES_V2 = [("genuine_hut_number", "rlike", r"HUTB-?\d+"), ("exempt_declared", "contains", "Exempt"),
                    ("genuine_national_number", "rlike", r"ESFCNT\d+")]
LICENSE_NUMBER_PATTERN = r"HUTB-?\d+"
NO_LICENSE, OTHER = "no_license", "other"

# HTML line breaks in review text.
BREAKS = ["<br/>", "<br>"]

# Sentiment words by strength: a hand-made table of words that reviews use, each
# graded from 1 (mild) to 3 (strong) for this project; no published lexicon
# was used.  The compound score is s / sqrt(s^2 + ALPHA) of the summed strengths.
SENTIMENT_GRADES = {
    3: "amazing awesome best excellent fabulous fantastic love loved perfect perfectly stunning wonderful",
    2: ("beautiful charming delightful enjoy enjoyed friendly good great happy helpful ideal impeccable lovely nice "
        "pleasant relaxing spotless super welcoming"),
    1: "clean comfortable convenient cosy cozy easy highly peaceful quiet recommend recommended spacious thank thanks warm",
    -1: "cold expensive issue issues noise noisy small smell unfortunately",
    -2: "avoid bad broken complaint dirty disappointed disappointing mess poor problem problems rude sad smelly ugly uncomfortable wrong",
    -3: "awful cockroaches disgusting hate horrible scam terrible unsafe worst",
}
SENTIMENT_WEIGHTS = {w: float(grade) for grade, words in SENTIMENT_GRADES.items() for w in words.split()}
NEGATIONS = ["not", "no", "never", "nothing", "nowhere", "neither", "nor", "none", "hardly", "without",
             "don't", "doesn't", "didn't", "isn't", "wasn't", "aren't", "weren't", "won't", "can't", "cannot",
             "couldn't", "wouldn't", "shouldn't"]
# Rules of context, made for this project.  All factors are binary fractions, so
# that sums do not depend on their order.
NEGATION_SCALE = -0.5
BOOSTERS = ["absolutely", "completely", "especially", "extremely", "incredibly", "really", "so", "totally", "truly", "very"]
DAMPENERS = ["almost", "barely", "fairly", "partly", "quite", "rather", "slightly", "somewhat"]
BOOST_BY_DISTANCE = [0.5, 0.25, 0.125]  # the word before, two before, three before
CONTRASTS = ["but", "however", "yet"]
BEFORE_CONTRAST, AFTER_CONTRAST = 0.75, 1.25
CAPITALS_SCALE = 1.25
BANG_STEP, MOST_BANGS = 0.125, 3
# Typographic signs that part words, and the typographic apostrophe.
PARTING = "\u00a0\u00a1\u00ab\u00b7\u00bb\u00bf\u2013\u2014\u201c\u201d\u201e\u2022\u2026"
APOSTROPHE = "\u2019"
ALPHA = 20.0
POSITIVE_CUT, NEGATIVE_CUT = 0.05, -0.05

# Function words used to vote for a language (this project's own short
# lists); a text shorter than MIN_LANG_CHARS or with no vote is 'unknown'.
LANGUAGE_WORDS = {
    "en": ["the", "and", "is", "of", "to", "in", "it", "was", "with", "for", "this", "that", "we", "very",
           "are", "on", "at", "from", "by", "as", "an", "be", "were", "had", "our"],
    "es": ["el", "los", "las", "y", "es", "muy", "con", "para", "por", "una", "del", "que", "lo", "pero",
           "todo", "fue", "está", "como", "su", "al", "nos", "más", "este", "sin", "hay"],
    "fr": ["le", "les", "et", "est", "très", "avec", "pour", "une", "des", "du", "que", "qui", "nous",
           "dans", "pas", "au", "aux", "était", "sur", "mais", "ce", "cette", "tout", "il", "elle"],
    "de": ["der", "die", "das", "und", "ist", "sehr", "mit", "für", "ein", "eine", "wir", "nicht", "auf",
           "den", "dem", "zu", "war", "sich", "auch", "es", "von", "wie", "aber", "im", "bei"],
    "it": ["il", "gli", "della", "che", "è", "molto", "con", "per", "una", "di", "non", "sono", "anche",
           "ci", "nel", "alla", "stato", "questo", "più", "ma", "tutto", "noi", "dal", "ed", "era"],
    "pt": ["o", "os", "as", "e", "é", "muito", "com", "para", "uma", "não", "que", "do", "da", "nos",
           "mas", "foi", "em", "no", "na", "mais", "tudo", "este", "são", "ao", "bem"],
    "nl": ["het", "een", "en", "is", "zeer", "met", "voor", "van", "niet", "wij", "dat", "op", "aan",
           "te", "ook", "naar", "heel", "maar", "bij", "was", "zijn", "uit", "om", "deze", "onze"],
}
LANGUAGE_ORDER = ["en", "es", "fr", "de", "it", "pt", "nl"]  # tie-break order of the votes
MIN_LANG_CHARS = 10
UNKNOWN = "unknown"
# -----------------------------------------------------------------------------

def license_category(c: Column, version: int = 2, rules=None) -> Column:
    """Priority classification: first matching rule wins; empty -> no_license."""
    rules = rules or (LICENSE_RULES_V1 if version == 1 else LICENSE_RULES_V2)
    out = F.when(c.isNull() | (c == ""), F.lit(NO_LICENSE))
    for label, kind, pat in rules:
        out = out.when(c.rlike(pat) if kind == "rlike" else c.contains(pat), F.lit(label))
    return out.otherwise(F.lit(OTHER))


def license_number(c: Column, pattern: str = LICENSE_NUMBER_PATTERN) -> Column:
    """First match of the pattern with dashes removed; NULL when none."""
    return F.nullif(F.replace(F.regexp_extract(c, pattern, 0), F.lit("-"), F.lit("")), F.lit(""))


def parse_amenities(c: Column) -> Column:
    """JSON-like list text -> normalised items; bad or empty text -> [].

    Items blank before normalising are dropped; an item that becomes empty
    after removing symbols is kept (as the reference does)."""
    arr = F.from_json(c, "array<string>", {"allowSingleQuotes": "true"})
    arr = F.coalesce(arr, F.array().cast("array<string>"))
    kept = F.filter(arr, lambda x: x.isNotNull() & (F.regexp_replace(x, r"^\s+|\s+$", "") != ""))
    return F.transform(kept, lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), r"^\s+|\s+$", ""),
                                                        "[^a-z0-9 ]", ""))


def _runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of ``inside``; a run ends with its document."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = off[:-1][off[:-1] < len(inside)]
    first[at] = inside[at]
    at = off[1:][off[1:] > 0] - 1
    last[at] = inside[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _byte_class(data: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(data, np.uint8)] = True
    return out


_WORD = _byte_class(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'" + bytes(range(128, 256)))
_END, _SMALL = _byte_class(b".!?"), _byte_class(b"abcdefghijklmnopqrstuvwxyz")
_ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _prepared(text: str | None) -> str:
    """The text without line breaks, with plain apostrophes, and with spaces for typographic signs."""
    text = text or ""
    for b in BREAKS:
        text = text.replace(b, " ")
    if not text.isascii():
        for sign in PARTING:  # a search for each sign; ``translate`` would look up every character
            text = text.replace(sign, " ")
        text = text.replace(APOSTROPHE, "'")
    return text


def _lower(text: str) -> bytes:
    """Lower case in the same number of bytes; where that cannot be, only A-Z change."""
    raw, low = text.encode(), text.lower().encode()
    return low if len(low) == len(raw) else raw.translate(_ASCII_LOWER)


class _Tables:
    """What a word stands for, as arrays over the known words; the last place is for all others."""

    def __init__(self, weights: dict, negations: list, languages: dict, order: list):
        known = sorted({*weights, *negations, *BOOSTERS, *DAMPENERS, *CONTRASTS, *(w for lang in order for w in languages[lang])})
        self.known = known
        self.weight = np.array([*(weights.get(w, 0.0) for w in known), 0.0])
        self.negation = np.array([*(w in set(negations) for w in known), False])
        self.boost = np.array([*((w in BOOSTERS) * 1.0 - (w in DAMPENERS) for w in known), 0.0])
        self.contrast = np.array([*(w in CONTRASTS for w in known), False])
        self.votes = np.array([[*(w in set(languages[lang]) for w in known), False] for lang in order], bool)


def _score(texts: list[str], t: _Tables, order: list) -> tuple[np.ndarray, ...]:
    """neg, neu, pos, compound, language of each prepared text; see ``scores``."""
    docs = len(texts)
    raw, low = b"".join(x.encode() for x in texts), b"".join(map(_lower, texts))
    off = np.cumsum([0, *(len(x.encode()) for x in texts)])
    plain, data = np.frombuffer(raw, np.uint8), np.frombuffer(low, np.uint8)
    inside = _WORD[data]
    s, e = _runs(inside, off)
    n = len(s)
    words = pa.StringArray.from_buffers(n, pa.py_buffer(np.concatenate([[0], np.cumsum(e - s)]).astype(np.int32)), pa.py_buffer(data[inside].tobytes()))
    at = pc.fill_null(pc.index_in(words, value_set=pa.array(t.known, pa.string())), len(t.known)).to_numpy()
    doc = np.searchsorted(off, s, "right") - 1
    # sentences: the words up to a run of end marks or the end of the document
    mark, mark_end = _runs(_END[data], off)
    before = np.searchsorted(mark, s)
    sentence = before + doc  # grows with either
    new = np.flatnonzero(np.diff(sentence, prepend=-1))
    number = np.repeat(np.arange(len(new)), np.diff([*new, n]))
    graded = np.flatnonzero(t.weight[at])
    v = t.weight[at[graded]]
    turned, boost, reached = np.zeros(len(graded), bool), np.ones(len(graded)), np.ones(len(graded), bool)
    for distance, step in enumerate(BOOST_BY_DISTANCE, 1):
        near = np.maximum(graded - distance, 0)
        reached &= (graded >= distance) & (sentence[near] == sentence[graded]) & ~t.contrast[at[near]]
        turned |= reached & t.negation[at[near]]
        boost += np.where(reached, t.boost[at[near]] * step, 0.0)
    v = v * boost * np.where(turned, NEGATION_SCALE, 1.0)
    turn = np.full(len(new), -1)
    here = np.flatnonzero(t.contrast[at])
    np.maximum.at(turn, number[here], here)
    turn = turn[number[graded]]
    v = v * np.where(turn < 0, 1.0, np.where(graded < turn, BEFORE_CONTRAST, AFTER_CONTRAST))
    small = np.concatenate([[0], np.cumsum(_SMALL[plain], dtype=np.int32)])
    loud = (small[e[graded]] == small[s[graded]]) & (small[off[1:]] > small[off[:-1]])[doc[graded]]
    v = v * np.where(loud, CAPITALS_SCALE, 1.0)
    bangs = np.concatenate([[0], np.cumsum(data == ord("!"), dtype=np.int32)])
    bangs = np.append(np.minimum(bangs[mark_end] - bangs[mark], MOST_BANGS), 0)
    owner = np.append(np.searchsorted(off, mark, "right") - 1, -1)
    ending = before[graded]
    v = v * (1.0 + BANG_STEP * np.where(owner[ending] == doc[graded], bangs[ending], 0))
    of = doc[graded]
    total = np.bincount(of, weights=v, minlength=docs)
    up = np.bincount(of, weights=np.where(v > 0, v + 1, 0.0), minlength=docs)
    down = np.bincount(of, weights=np.where(v < 0, 1 - v, 0.0), minlength=docs)
    neutral = np.bincount(doc, minlength=docs) - np.bincount(of, minlength=docs)
    share = np.maximum(up + down + neutral, 1.0)
    votes = np.stack([np.bincount(doc[x], minlength=docs) for x in t.votes[:, at]])
    short = np.array([len(x.strip()) < MIN_LANG_CHARS for x in texts], bool)
    language = np.where(short | (votes.max(axis=0) == 0), UNKNOWN, np.array(order, object)[votes.argmax(axis=0)])
    return down / share, neutral / share, up / share, total / np.sqrt(total * total + ALPHA), language


def scores(c: Column, weights: dict = SENTIMENT_WEIGHTS, negations: list = NEGATIONS,
           languages: dict = LANGUAGE_WORDS, order: list = LANGUAGE_ORDER) -> Column:
    """struct(neg, neu, pos, compound, language) of a text.

    Words are runs of a-z, apostrophes and non-ASCII characters (but PARTING
    signs) in lower case; a run of . ! ? ends a sentence.  A graded word's
    strength is multiplied by NEGATION_SCALE if a negation is among the three
    words before it, by one plus (boosters) or minus (dampeners)
    BOOST_BY_DISTANCE of those words (neither reaches over a contrast word), by
    BEFORE_CONTRAST or AFTER_CONTRAST around the last contrast word, all within
    its sentence; by CAPITALS_SCALE if it is in capitals in a text that is not;
    and by BANG_STEP more for each exclamation mark at the end of its sentence,
    MOST_BANGS at most.

    neg/neu/pos are the shares of (1 - strength), 1 and (strength + 1) over
    words; the compound score is s / sqrt(s^2 + ALPHA) of the summed strengths.
    The language is the one with most function words, ties by ``order``; short
    texts (without line breaks and edge spaces) and texts without votes are
    'unknown'.  NULL or empty text scores zeros."""
    tables, slice_chars = _Tables(weights, negations, languages, order), 1 << 20
    schema = "neg double, neu double, pos double, compound double, language string"

    @F.pandas_udf(schema)
    def score(texts: pd.Series) -> pd.DataFrame:
        parts, held, size = [], [], 0
        for text in map(_prepared, texts):
            held.append(text)
            size += len(text)
            if size >= slice_chars:
                parts.append(_score(held, tables, order))
                held, size = [], 0
        if held or not parts:
            parts.append(_score(held, tables, order) if held else [np.zeros(0)] * 5)
        return pd.DataFrame(dict(zip(["neg", "neu", "pos", "compound", "language"], map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    return score(c)


def add_sentiment(df: DataFrame, text_col: str, **tables) -> DataFrame:
    """Add neg, neu, pos and compound; see ``scores``."""
    d = df.withColumn("_scores", scores(F.col(text_col), **tables))
    return d.withColumns({k: F.col(f"_scores.{k}") for k in ("neg", "neu", "pos", "compound")}).drop("_scores")


def sentiment_label(compound: Column) -> Column:
    return (F.when(compound > POSITIVE_CUT, "positive").when(compound < NEGATIVE_CUT, "negative")
            .otherwise("neutral"))


def add_language(df: DataFrame, text_col: str, out: str = "language", **tables) -> DataFrame:
    """Add the most-voted language; see ``scores``."""
    return df.withColumn(out, scores(F.col(text_col), **tables)["language"])
