import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, key long"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x{seed % 7}" for _ in range(n)) + "."


BASE = prose(1, 120, 4000)
PASSAGE = prose(2, 60, 4000)


def edited(text, seed, n):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def texts():
    rows = [
        None, "", "   \n\t ", "one", "Two words", "a b c", BASE, BASE, edited(BASE, 3, 1), edited(BASE, 4, 2),
        edited(BASE, 5, 40), prose(6, 50) + "\n" + PASSAGE + "\n" + prose(7, 30),
        PASSAGE + "\n" + prose(8, 40), prose(9, 4000), "menu | home | login | search\n" + prose(10, 80),
        "All rights reserved.\n" + prose(11, 40), "###  ***\n" * 12, ("again and again we go on " * 20).strip(),
        "Released under the MIT License.\nIt is CC BY, or the GNU General  Public LICENSE; apache-license",
        "é ß 日本 😀 it's  don't\r\n\r\n  x y  " + prose(12, 12), "x" * 30000, "Zürich\x0bist\x0cschön\x85ok",
    ]
    return rows + [prose(100 + i, 20 + 7 * i, 3000) for i in range(20)]


def table(spark, rows):
    made = [(i, t, "en", s, None if t is None else len(t), 1, "r", 2) for i, t, s in rows]
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture(scope="session")
def rows():
    found = [(3 * i, t, None if i % 11 == 5 else f"s{i % 3}") for i, t in enumerate(texts())]
    return found + [found[8], found[8]]  # repeated rows


@pytest.fixture(scope="session")
def documents(spark, rows):
    return table(spark, rows).repartition(5).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, among them ids."""
    return table(spark, [(None, None, None), (None, "some words here", "s"), (7, None, None), (7, None, None)])


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
