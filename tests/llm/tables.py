"""Small tables with the driver's columns, and rows that are meant to be awkward."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use within.
EXTRA = ["row_key", "score", "size", "taken", "words", "rank", "hash", "fingerprint", "_id", "n", "place", "bucket"]


def documents(spark, rows, extra=False, partitions=3):
    """Rows of (doc_id, text[, lang, source]); ``extra`` adds columns with clashing names."""
    full = [
        (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]))
        for r in rows
    ]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        df = df.selectExpr("*", *(f"'x' AS {name}" for name in EXTRA))
    return df.repartition(partitions) if rows else df


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def awkward():
    """Nulls, empty and long texts, ties, repeated rows, odd white space and characters."""
    long_text = prose(1, 60_000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "Word"), (5, "word"), (6, "WORD\x1fÉ word"), (7, "word\x1fÉ WORD"),
        (8, long_text), (9, long_text), (10, long_text + " end"), (11, "a b"), (11, "a b"), (12, "A b"), (12, "c d e"),
        (None, "a b"), (None, "no id"), (None, "no id"), (13, "日本語 😀 text", None, None), (14, "x" * 50_000, "de", ""),
        (15, "  word  ", "fr", "s"), (2**62, "far id", "en", "t"), (-5, "negative id", "en", None),
    ]
