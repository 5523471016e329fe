"""Small corpora with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words long, rid string, word string, "
        "length string, text_key string, term string, label string, key string, host string")
#: Values of the columns whose names the operators use inside.
CLASH = (True, 7, "r", "w", "l", "k", "t", "x", "y", "h")

WORDS = ("river stone lamp cloud bread wheel garden silver paper winter mountain copper island marble engine forest "
         "window harbor candle bridge meadow pocket ribbon saddle timber velvet walnut yellow anchor basket").split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "a", "er", "ing", "ly"]) for _ in range(n))


def awkward(extra=()):
    base = prose(1, 120)
    words = base.split()
    changed = " ".join(words[:60] + ["changed"] + words[61:])
    texts = [None, "", " \n\t ", "one", "Two words", base, base, base.upper(), changed, prose(2, 40), prose(3, 5000),
             "same line here\nsame line here\nother", "spam### $$$ | <b> &amp; 100%", "naïve café — 東京 😀 \x1c\u2003x", "x" * 5000, *extra]
    rows = [(i * 5, t, "en" if i % 2 else "fr", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(25, base, "en", "s1", len(base)), (25, prose(4, 30), "en", "s1", 1), (None, base, "en", "s1", 1), (None, None, None, None, None)]
    return [(*r, *CLASH) for r in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(0, None, 0), (25, 1, 0), (25, 1, 0), (60, 0, 1), (45, 1, 0), (None, 1, None), (999, 0, 0)], "doc_id long, quality int, toxic int")


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
