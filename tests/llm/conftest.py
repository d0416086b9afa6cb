import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """The given small table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def sentence(rng, n):
    return " ".join("".join(rng.choice(("ka", "lo", "mi", "ter", "un")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    common = sentence(rng, 80)
    near = common.split()
    near[40] = "zzz"
    return [
        (1, common, "en", "s", 3),
        (2, common, "en", None, None),
        (2, common, "en", None, None),
        (3, " ".join(near), None, "s", 1),
        (4, None, "en", "s", 0),
        (5, "", None, None, 0),
        (6, " \n\t ", "en", "s", 4),
        (None, common, "en", "s", 2),
        (None, None, None, None, None),
        (7, sentence(rng, 40_000), "en", "s", 9),
        (8, "same " * 500, "de", "s", 9),
        (9, "ééé 日本語   <|endoftext|> #*$ \x00 'll", "ja", "s", 9),
        (10, "one two", "en", "s", 7),
        (11, "One TWO", "en", "s", 7),
        (12, "line of text\n" * 60, "en", "s", 7),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns named like results."""
    rows = [(*r, True, 5, "x", 7.5, 1, 2) for r in odd_rows()]
    extra = ", kept boolean, n_words long, `_row` string, `the score` double, `_gone` int, `_h1` int"
    return spark.createDataFrame(rows, DOCS + extra).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
