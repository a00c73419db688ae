import random

import pytest

# more columns than the operators read, some named as their own working columns
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, predicted bigint, size bigint, "
    "row string, runs string, grp string, label string, sig string, host string, n bigint, spans string, "
    "target string, extra int, full int, below int, cut string, k int, data string"
)
EXTRA = (0.5, 1, 3, "r", "x", "g", "l", "s", "h", 2, "sp", "t", 1, 2, 3, "c", 4, "d")


def sentence(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abdeghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """(doc_id, text, source): nulls, empty, long, ties, repeated rows, near and exact copies."""
    r = random.Random(4)
    base = sentence(r, 120)
    shared = sentence(r, 30)
    long = " ".join(sentence(r, 400) for _ in range(60))
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "a"), (2, base, "b"), (3, " ".join(near), "a"), (4, None, "a"), (5, "", None), (6, " \n\t ", "a"),
        (7, "one two", "b"), (8, "One TWO", "b"), (9, long, "c"), (9, long, "c"), (10, long + " tail", "a"),
        (11, sentence(r, 20) + " " + shared + " " + sentence(r, 20), None), (12, shared, "b"), (13, sentence(r, 15) + " " + shared, "c"),
        (14, "x " * 300, "a"), (15, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" é 🎉 " + sentence(r, 40) + ".", "b"),
        (16, "don't we've 'tis 12　x\n\n  y", "a"), (17, base.upper(), "a"), (18, "a\x85b c", "a"), (19, sentence(r, 3), "a"),
        (20, sentence(r, 3), "a"), (None, base, "a"), (None, None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(d, t, "en", s, len(t) if t else None, *EXTRA) for d, t, s in odd_rows()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
