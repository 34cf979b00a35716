"""Documents with nulls, empty and very long texts, ties and repeated rows."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

WORDS = {
    "en": "the house stands on a green hill and many people walk there with their dogs every day".split(),
    "de": "das alte Haus steht auf einem grünen Hügel und viele Leute gehen dort mit ihren Hunden".split(),
}


def prose(seed, n, lang="en"):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ",", "."]) + str(rng.randint(0, 99)) * (rng.random() < 0.3) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, prose(1, 120), "en", "b", 5),
        (2, prose(1, 120), "en", "b", 5),
        (2, prose(1, 120), "en", "b", 5),
        (3, "", "en", "a", 0),
        (4, None, "de", "a", None),
        (5, "   \n\t ", "de", None, 6),
        (6, prose(2, 30000, "de"), "de", "c", 1),
        (None, prose(3, 90), "en", "c", 1),
        (None, None, None, None, None),
        (7, prose(4, 70, "de"), None, "é", 1),
        (8, "12 34 !!", "en", "", 8),
        (9, "word", "en", "a", 4),
        (-3, prose(1, 119) + " other", "en", "b", 5),
        (10, prose(5, 1500), "en", "b", 5),
    ]
    rows += [(20 + i, prose(50 + i, 40 + i, "de" if i % 2 else "en"), "de" if i % 2 else "en", "abc"[i % 3], i) for i in range(40)]
    return rows
