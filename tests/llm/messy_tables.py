"""Small tables with the cases every operator must stand."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, ids int, key string, n_words int, score string"
PAGES = "page_id long, url string, html string, text int, host string, digest string, payload string"


def words(n, seed=0, stem="word"):
    r = random.Random(seed)
    return " ".join(f"{stem}{r.randrange(10_000)}" for _ in range(n))


def documents(spark, extra=()):
    rows = [
        (1, "one two three four five six seven eight nine ten eleven", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, "  \n\t ", "de", "a"),
        (5, words(20_000, 5), "en", "a"),
        (6, words(60, 6), "en", None),
        (7, words(60, 6), "fr", "b"),
        (8, words(60, 6), "fr", "b"),
        (None, words(30, 9), None, "b"),
        (None, None, None, None),
        (9, words(30, 9), "es", "b"),
        (9, words(30, 9), "es", "b"),
        (10, "### $$$ &&& " * 40, "es", "b"),
        (11, "don't  stop\n\n now   <|endoftext|> naïve – ﬁn 🙂 'll 12,345", "en", "b"),
        (12, "ab", "en", "b"),
        *extra,
    ]
    return spark.createDataFrame([(*r, 0, "x", 1, "y", 2, "z") for r in rows], DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
