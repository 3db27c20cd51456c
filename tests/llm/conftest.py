import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def vocabulary():
    r = random.Random(5)
    return ["".join(r.choice("abcdefghijklmnopé") for _ in range(r.randint(1, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def awkward(spark, vocabulary):
    """Documents with nulls in any column, empty and very long texts, repeats, ties, and columns named like the operators' own."""
    r = random.Random(9)
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base = text(60)
    near = base.split()
    near[30] = "changed"
    rows = [
        (1, base, "en", "a"), (1, base, "en", "a"), (2, base, "de", "b"), (3, " ".join(near), "en", "a"), (4, None, "en", "b"), (5, "", None, "a"),
        (6, " \t\r\n ", "en", None), (None, text(30), "fr", "c"), (None, None, None, None), (7, text(40000), "en", "c"), (8, "one two three", "en", "b"),
        (9, "ONE two THREE", "en", "b"), (10, "x", "en", "a"), (11, "é" * 300, "fr", "c"), (12, "a" * 5000, "en", "a"),
    ] + [(20 + i, text(r.randint(1, 120)), "en", "abc"[i % 3]) for i in range(40)]
    d = spark.createDataFrame([(*x, len(x[1]) if x[1] is not None else None) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("key", "n", "h", "size", "ids", "bucket", "rank", "weight", "slice", "cid", "score", "label", "rows", "target", "_doc", "_key", "_row", "toxicity", "tail_probability", "_id", "head"):
        d = d.withColumn(c, d["lang"])
    return d


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
