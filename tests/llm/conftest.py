import os

import pytest

SF_DIR = "/root/testdata/sf0.001"

ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, score string, shard string, slot int, place string, key string, number int, label string, fingerprint string, "
    "item_id string, held_out int, document string, `first` string"
)


def odd_rows():
    long_text = "word " * 3000 + "token = aaaaaaaaaaaaaaaa " + "end\n" * 500
    rows = [
        (1, "plain words of a text with more than ten of them in a row", "en", "a"),
        (1, "plain words of a text with more than ten of them in a row", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (None, "no id here but still a text", "en", "b"),
        (None, None, None, None),
        (4, long_text, "en", ""),
        (5, " \t\n ", "en", "b"),
        (5, "same id and another text", "de", "b"),
        (6, "x" * 50_000, "en", "a"),
        (7, "é日本 \U0001f600 token=éé password: abcdefghijkl", "en", "c"),
    ]
    extra = ("r", "s", "sh", 9, "p", "k", 1, "l", "f", "i", 0, "d", "fi")
    return [(*r, len(r[1] or ""), *extra) for r in rows]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 40)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return SF_DIR
