import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, source string, label string, count long, kept string, n_words string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéßо") for _ in range(rng.randint(1, 9))) for _ in range(n))


def edge_rows():
    """(doc_id, text, source): nulls, empty and long texts, ties, repeated rows, near copies, shared passages."""
    rng = random.Random(5)
    passage, long_text = prose(rng, 60), prose(rng, 4000)
    near = prose(rng, 200).split()
    rows = [(1, None, "a"), (2, "", "a"), (None, "", None), (3, " \n\t ", "b"), (4, "one two", "b"), (None, None, None),
            (5, long_text, "a"), (6, long_text, "c"), (6, long_text, "c"), (7, "a " * 400, "b"), (8, "x" * 700, "c"),
            (9, "Line of text here\nLine of text here\nother\n", None), (10, prose(rng, 30) + passage, "a"),
            (11, passage + prose(rng, 30), "b"), (12, prose(rng, 5) + passage + prose(rng, 9), "d"),
            (13, "ALL RIGHTS Reserved. cc-by, General  Public\nLicense all rights", "a"),
            (14, "Licensed under the Apache License, Version 2.0. no Known word", "a")]
    for i in range(40):
        words = list(near)
        words[rng.randrange(200)] = f"w{i}"
        rows.append((100 + i, " ".join(words), "a"))
    for i in range(30):
        rows.append((200 + i, prose(rng, rng.randint(5, 120)), rng.choice(["a", "b", "c", "d", None])))
    for i in range(25):
        rows.append((300 + i, "the same text in many rows " * 3, "a"))
    return rows


@pytest.fixture(scope="session")
def rows():
    return edge_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns whose names clash with those that operators use or return."""
    data = [(d, t, s, "x", 1, "k", "w") for d, t, s in rows]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    return df.withColumnsRenamed({"label": "anchor", "count": "n"}).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, extra string")


@pytest.fixture(scope="session", autouse=True)
def small_tables(spark):
    return "/root/testdata/sf0.001"
