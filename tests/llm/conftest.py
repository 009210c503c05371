import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """Small documents with copies, near copies, blanks, a very long text and personal data."""
    rng = random.Random(5)
    words = {"en": "the of and house water stone running light every small".split(), "de": "der die und haus wasser stein laufen licht jede klein".split()}
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "er", "ung"]) for _ in range(rng.randint(20, 60)))
        rows.append((i, text, lang, "hot" if i % 3 else f"s{i % 5}", len(text)))
    base = rows[4][1].split()
    for i in range(60, 70):
        near = list(base)
        near[rng.randrange(len(near))] = f"other{i}"
        rows.append((i, " ".join(near), "en", "hot", 0))
    for i in range(70, 75):
        rows.append((i, rows[7][1], "de", "hot", 0))
    long = " ".join(rng.choice(words["en"]) + str(rng.randrange(50)) for _ in range(60_000))
    rows += [
        (80, None, None, None, None),
        (81, "", "en", "s1", 0),
        (82, " \t\n ", "en", "s1", 4),
        (83, "two words", "en", "s1", 9),
        (84, "Two WORDS", "en", "s1", 9),
        (85, long, "en", None, len(long)),
        (86, "7" * 30_000 + " a@b.cc 1.2.3.4 + 4111 1111 1111 1111 +49 (30) 1234-567", "en", "s2", 0),
        (87, "müde   Straße 😀 ÄÖ\nÉ!", "de", "s2", 0),
        (88, "12345 !!! 678", "en", "s2", 0),
        (None, "a row without an id but with words in it", "en", "s2", 0),
        (3, rows[3][1], rows[3][2], rows[3][3], rows[3][4]),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(corpus, DOCS).repartition(3)
    # Extra columns whose names clash with results and inner names.
    for clash in ("score", "component_id", "kept", "ids", "base", "n_tokens", "_row", "place", "n", "rep", "u", "segment", "decoded", "epoch"):
        frame = frame.withColumn(clash, F.lit("clash"))
    return frame


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
