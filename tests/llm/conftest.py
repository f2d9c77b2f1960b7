from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def odd_rows():
    """Texts with nulls, blanks, copies, near copies, shared passages, repeats and long runs."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage, long = text(150), text(90), text(3000)
    rows = [
        (1, base),
        (2, base),
        (2, base),
        (3, base.upper()),
        (4, base.replace(" ", "\n", 5)),
        (5, base + " " + text(8)),
        (6, " ".join(base.split()[:-9])),
        (7, text(60) + " " + passage + " " + text(40)),
        (8, text(20) + " " + passage + " " + text(70)),
        (9, passage[11:]),
        (10, None),
        (11, ""),
        (12, " \t\n "),
        (13, "one two three"),
        (14, "One TWO\vthree"),
        (15, "one two three four"),
        (16, "a" * 1500),
        (17, "ab " * 700),
        (18, long),
        (19, long[:9000] + text(5) + long[9000:]),
        (None, text(30)),
        (None, base),
        (20, text(25)),
    ]
    rows += [(100 + k, text(4) + " " + base + " " + text(k % 5)) for k in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The same as documents, with columns that bear names the operators use themselves."""
    return as_docs(spark, odd_rows)


def as_docs(spark, rows):
    clash = "n long, size long, key string, spans string, rank string, severity string, copies long, hash string, _copies long"
    data = [
        (i, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), 1, 2, "k", "x", "r", "y", 3, "h", 4)
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {clash}")


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.limit(0)
