"""Small documents with every oddity, and clashing extra columns."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "h long, row string, set_id string, score string, copy string, lang_pred string, term string"
)


def odd_docs(spark, more=()):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = [
        (1, base, "en"),
        (2, base, "en"),
        (3, base.replace("w1 ", "x1 ", 1), "en"),
        (4, None, None),
        (5, "", "en"),
        (6, " \n\t ", "de"),
        (7, "One line.\nOne line.\nOther line here", "en"),
        (7, "One line.\nOne line.\nOther line here", "en"),
        (None, "text without an id", "fr"),
        (None, base, None),
        (8, "?!", "en"),
        (9, " ".join(rng.choice(vocabulary) for _ in range(30_000)), "en"),
        (10, "é" * 5000 + " \U0001f600", "fr"),
        *more,
    ]
    rows = [
        (i, t, l, None if i == 3 else f"s{(i or 0) % 3}", len(t or ""), 1, "r", "s", "x", "c", "p", "t")
        for i, t, l in texts
    ]
    return spark.createDataFrame(rows, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
