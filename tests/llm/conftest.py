from __future__ import annotations

import random

import pytest

from tests.conftest import SF_DIR

# Column names that operators use themselves.
CLASHING = "row found kept spans starts sig node h n key size target block body component position stratum score".split()


@pytest.fixture(scope="session")
def here(spark):
    """The folder of this repository, for the Python workers."""
    from timelegs.llm.queries import table

    table(spark, SF_DIR, "documents")


def odd_rows() -> list[tuple]:
    """Nulls, empty, blank and very long texts, repeated rows, ties, and near and exact copies."""
    rng = random.Random(3)
    names = ["alpha", "beta", "Gamma", "délta", "épsilon", "zeta", "x1", "日本", "ß", "q#"]

    def prose(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(names) + str(r.randrange(400)) for _ in range(n))

    base, passage = prose(300, 1), prose(60, 2)
    near = base.split()
    near[100] = "changed"
    texts = [None, "", " \n\t ", "one", "one", "ONE", "two words", base, base, base.upper(), " ".join(near), passage]
    texts += [f"{prose(50, 10 + k)} {passage} {prose(30, 90 + k)}" for k in range(3)]
    texts += [prose(30_000, 5), "a" * 5_000, "line one is here\n" * 40, "\U0001f600" * 300, prose(49, 6), "!!! ??? ### $$$", "ab " * 200]
    rows = [(k, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None]), None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[7], rows[12], (None, base, "en", None, None), (None, "no id here", None, "s1", 10)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark, here):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"mine {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark, here):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, here):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [r.asDict() for r in documents.collect()]
