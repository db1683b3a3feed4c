import random

import pytest

SF = "/root/testdata/sf0.01"
EXTRA = ["row", "name", "class", "group", "size", "h", "hits", "tokens", "_text", "score", "shard_", "target", "norm"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in EXTRA)


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and long texts, repeated rows and ids, ties, odd characters."""
    long = words(1, 30_000)
    texts = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "x", "de", None), (3, "x", "de", None), (4, long, "en", "b"),
        (5, long, "en", "a"), (6, long[:-1] + "q", "en", "b"), (None, "no id at all", None, "b"), (None, None, None, None),
        (7, "héllo \U0001F600 世界 \n\t\r\n  password = 'abc123XYZ'  ", "fr", "\U0001F600"), (8, "   ", "en", "a"),
        (9, "1234 5678 !!!", "en", "a"), (10, "UPPER case ÉTÉ", "fr", "b"), (11, "upper CASE ÉTÉ", "fr", "b"),
        (12, "\n\n\n", None, "c"), (3, "another text of id three", "de", "c"), (9007199254740993, "large id", "en", "c"),
        (9007199254740992, "large id", "en", "c"), (-5, words(2, 300), "en", "b"), (20, words(2, 300), "en", "a"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *[None if k % 2 else "x" for k in range(len(EXTRA))])
            for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]
