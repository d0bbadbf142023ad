from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
PROSE = ("the cat of the house sat on a mat and the dog was in the garden for a while because it is warm "
         "der hund und die katze sind in dem haus mit der frau auf dem weg nicht zu spaet "
         "le chat est dans la maison et les enfants sont avec une amie pour la nuit ").split()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, and columns whose
    names clash with working names of the operators."""
    rng = random.Random(7)
    text = " ".join(rng.choice(PROSE) for _ in range(400))
    long_text = " ".join(f"{PROSE[i % len(PROSE)]}{i % 977}" for i in range(60_000))
    rows = [
        (1, text, "en", "a", 1, "x"), (1, text, "en", "a", 1, "x"), (2, text + " end", "en", "a", 2, None),
        (3, None, "en", "b", None, "x"), (4, "", None, None, 0, "x"), (5, " \n\t ", "de", "b", 4, "x"),
        (None, "a null id with some words in it", "en", "b", 7, "x"), (None, None, None, None, None, None),
        (6, long_text, "fr", "c", 9, "x"), (7, "one", "en", "c", 3, "x"), (8, "1 2 3 4 5 6", "en", "c", 3, "x"),
        (9, "日本語 の テキスト", "ja", "c", 3, "x"), (10, "mail bob@example.org or +1 (042) 555-7845", "en", "a", 3, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string")
    # clashing names
    for name in ("size", "fp", "sign", "done", "target", "score", "start", "length", "kept", "votes", "range",
                 "base", "spans", "component_id", "copies", "turn", "piece", "rank", "t", "who", "__text"):
        df = df.withColumn(name, df["extra"])
    return df


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
