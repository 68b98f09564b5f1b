"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

import pytest

#: Names the operators use inside; extra columns of the inputs carry them.
CLASHING = ["_id", "_text", "_key", "_range", "_row", "node", "sig", "label", "score", "kept", "size", "target", "_h", "_size"]


def prose(rng, words):
    return " ".join("".join(rng.choice(["an", "er", "tion", "ß", "é", "st", "o"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.replace(" ", "  ", 3) + " one more"
    rows = [
        (7, base, "en", "a", 1), (7, base, "en", "a", 1), (7, prose(rng, 50), "en", "b", 2), (8, base, "de", None, 3), (9, near, "de", "b", 4),
        (10, None, None, None, None), (11, "", "fr", "c", 0), (12, " \n\t ", "fr", "c", 4), (None, "a b", "fr", "é", 3), (None, None, None, "é", None),
        (13, prose(rng, 30_000), "en", "long", 5), (14, ("x y z " * 400).strip(), "en", "b", 6), (15, "one", "en", "b", 3), (16, "one\nline\none\nline", "en", "b", 3),
        (17, "日本 𝒳 \u2003wide\u00a0space <|endoftext|> don't!!,", "xx", "b", 9), (18, base.upper() + " ***", "en", "a", 5),
    ]
    return rows + [(20 + i, prose(rng, rng.randint(1, 90)), "en", rng.choice("abcd"), i) for i in range(40)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from pyspark.sql import functions as F

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(odd_rows, schema).withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
