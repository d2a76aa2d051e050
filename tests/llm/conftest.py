import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, node string, bucket int, size string, label string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeiou") for _ in range(rng.randrange(1, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Ids and texts with nulls, empties, copies, near copies, ties, other scripts and one very long text."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    passage = words(rng, 90)
    twice = words(rng, 50), words(rng, 50)
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "one"), (7, "ONE"), (8, "a b c d"),
        (9, "é ß 日本 🙂 İstanbul"), (10, words(rng, 30_000)), (11, passage + " " + words(rng, 40)), (12, words(rng, 40) + " " + passage),
        (13, "\n".join(["same line"] * 30)), (14, " \t\n "), (15, "x" * 700), (16, "l1\nl2\nl3\nl4\nl5\nl6"), (17, "l1\nl2\nl3\nl4\nl5\nl6\nl7"),
        (None, base), (None, None), (18, twice[0]), (18, twice[1]), (19, base), (19, base),
        (30, twice[0].replace(" ", "\t", 3)), (31, twice[1] + " end"), (17, twice[1].upper()),
        (20, "<|endoftext|> don't stop <|ENDOFTEXT|> it's"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, k, "n", 1, "s", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
