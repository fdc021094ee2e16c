"""Documents with everything unusual at once, for the operators on training data."""

import random

import pytest

WORDS = "the of and river stone light to under a music garden, window. Blue café naïve straße run ran running".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(30)) if rng.random() < 0.3 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """``(doc_id, text, lang, source)``: nulls, empty and long texts, copies, near copies."""
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 200)), "en", f"src{i % 4}") for i in range(60)]
    base = prose(rng, 150)
    words = base.split(" ")
    for i in range(60, 90):
        changed = list(words)
        changed[rng.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(changed), "en", "src0"))
    rows += [(i, base, "en", "src0") for i in range(90, 110)]
    passage = prose(rng, 30)
    rows += [(i, f"{prose(rng, 40)}\n{passage}\n{prose(rng, 40)}", None, None) for i in range(110, 140)]
    rows += [
        (140, None, "en", "src1"),
        (141, "", "en", "src1"),
        (142, "   \n\t ", "en", None),
        (143, prose(rng, 30_000), "en", "src2"),
        (144, "one two", "en", "src2"),
        (145, "ONE two", "en", "src2"),
        (146, "word " * 500, "en", "src3"),
        (147, "aaaa" * 300, "en", "src3"),
        (147, "aaaa" * 300, "en", "src3"),
        (148, "日本語 \U0001F600 \x00 end", "ja", "src3"),
        (None, "no id at all, but a text of some length that others may share as well", "en", "src1"),
        (None, base, "en", "src1"),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows as a table with columns whose names the operators use themselves."""
    df = spark.createDataFrame(odd_rows, SCHEMA).selectExpr(
        "*", "'c' AS content", "1 AS size", "2 AS node", "'x' AS kept", "3 AS score", "4 AS bin", "5 AS part",
        "6 AS cover", "7 AS doc_hash", "8 AS row", "9 AS n_tokens", "10 AS `a.b`", "11 AS text_sha256", "12 AS place"
    )
    return df.repartition(5)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
