import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session", autouse=True)
def _workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


WORDS = ("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo "
         "sierra tango uniform victor whiskey xray yankee zulu été naïve größe señor").split()


def words(seed: int, n: int, sep: str = " ") -> str:
    """A repeatable text of n words."""
    out, x = [], seed * 2654435761 % 2**32 + 1
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % 2**32
        out.append(WORDS[x >> 16 & 31 if (x >> 16 & 31) < len(WORDS) else x % len(WORDS)] + str(x >> 8 & 63))
    return sep.join(out)


@pytest.fixture(scope="session")
def corpus(spark):
    """(rows, DataFrame): nulls, empty, very long, repeated, near-copied and passage-sharing texts, with clashing columns."""
    passage = words(999, 70)
    rows = [(i, words(i, 20 + i % 90), "en", f"s{i % 5}") for i in range(60)]
    rows += [(100 + i, words(3, 23 + 60) + f" tail{i}" * (i % 3), "en", "s0") for i in range(12)]  # near copies
    rows += [(200 + i, f"{words(300 + i, 9)} {passage}\n{words(400 + i, 5)}", "fr", "s1") for i in range(8)]  # a shared passage
    rows += [(300, None, None, None), (301, "", "en", "s2"), (302, " \t\r\n", "en", None), (303, "One", "en", "s2"), (304, "one", "en", "s2"),
             (305, "a b c", "en", "s3"), (306, "a" * 700, "en", "s3"), (307, "A" * 650, "en", "s3"), (308, words(7, 6000), "en", "s4"),
             (308, words(7, 6000), "en", "s4"), (None, "null id text of some words", "en", "s4"), (None, None, "de", "s4"),
             (310, "été " * 120, "fr", None), (311, "ÉTÉ été İstanbul ß " * 30, "fr", "s2")]
    rows = [(*r, "x", 1.5, 7, True, "y") for r in rows]
    schema = ("doc_id long, text string, lang string, source string, score string, size double, id int, kept boolean, loc_file string")
    return rows, spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus[1].limit(0)
