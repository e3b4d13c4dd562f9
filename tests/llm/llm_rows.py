"""Rows of odd kinds, shared by the tests of this folder."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, n long"


def doc(doc_id, text, source="s"):
    """A document with extra columns whose names operators use themselves."""
    return (doc_id, text, "en", source, None if text is None else len(text), 0.5, 7, 8)


def docs(spark, rows):
    return spark.createDataFrame([doc(*r) for r in rows], DOCS)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join("w%d" % (rng.random() ** 2 * words) for _ in range(n))
