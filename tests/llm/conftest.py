from __future__ import annotations

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENT = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


def prose(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(count))


BASE = prose(1, 120)
LONG = prose(2, 30_000)
ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n ", None, None),
    (4, BASE, "en", "a"),
    (5, BASE, "en", "a"),
    (5, BASE, "en", "a"),
    (6, BASE.replace("a", "b", 1), "fr", "b"),
    (7, LONG, "en", "b"),
    (8, "x" * 50_000, "de", None),
    (9, "uno dos", "es", "c"),
    (10, BASE + "\n" + BASE, "en", "c"),
    (11, "a,b " * 200, "en", "a"),
    (None, "no id at all but some words in it", "en", "a"),
    (12, "ünïcode ▁ 日本 🙂\x00 é", "fr", "b"),
    (13, "call +1 (269) 555-3296 4524132264652876 now", "en", "a"),
]


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text, lang, source) tuples."""

    def make(rows):
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCUMENT)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return documents(ODD)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, 1, int(i in (9, 11))) for i in range(1, 13)] + [(None, 1, 1), (4, None, None)],
        "doc_id long, quality int, toxic int",
    )


def clashing(df):
    """The table with further columns, named like those that operators make."""
    from pyspark.sql import functions as F

    for name in ("kept", "fp", "size", "spans", "score", "gram", "_bucket", "next", "rank", "ids", "_size", "_number", "_copy", "_own", "_no", "_own0", "a.b"):
        df = df.withColumn(name, F.lit("own"))
    return df
