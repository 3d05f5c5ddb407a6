from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, hash string, key int, node int, "
          "block string, h int, n int, class string, score string, held_out string, bands int, gone int, row int")


def frame(spark, rows):
    """documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "x", 1, 2, "b", 3, 4, "c", "d", "e", 5, 6, 7)
                                  for i, t, lang in rows], SCHEMA)


def prose(seed: int, words: int, stock: int = 400) -> str:
    rng = random.Random(seed)
    sound = ["ka", "lo", "mi", "ter", "un", "sa", "vo", "né", "ri", "do"]
    bag = random.Random(1)
    known = ["".join(bag.choice(sound) for _ in range(bag.randint(1, 4))) for _ in range(stock)]
    return " ".join(rng.choice(known) for _ in range(words))


def awkward():
    """Nulls, empty and very long texts, ties, repeated rows."""
    passage = prose(5, 60)
    base = prose(9, 120)
    near = base.replace(base.split()[60], "changed", 1)
    return [(None, prose(2, 40), "en"), (1, None, "en"), (2, "", None), (3, " \n\t ", "fr"), (4, "!!! 42", "en"),
            (5, "one two", "fr"), (5, "one two", "fr"), (6, prose(3, 30_000), "en"), (7, base, "en"), (8, near, "fr"),
            (9, base, "en"), (10, passage + "\n" + prose(6, 50), "fr"), (11, prose(7, 30) + " " + passage, "en"),
            (12, "é" * 50, "fr"), (13, "word " * 500, "en"), (14, passage + " " + passage, None),
            (5, prose(8, 25), "en"), (1 << 60, prose(10, 22), "fr")]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, awkward())


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0, "x") for i in range(15)] + [(3, None, None, "x"),
                                 (None, 1, 1, "x"), (7, 0, 1, "x")], "doc_id long, quality int, toxic int, text string")
