import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from watchloom.llm import variants


def one_edit(x, y):
    """Whether exactly one inserted, deleted or replaced code point parts two words."""
    if len(x) > len(y):
        x, y = y, x
    if x == y or len(y) - len(x) > 1:
        return False
    i = next((k for k in range(len(x)) if x[k] != y[k]), len(x))
    return x[i + 1 :] == y[i + 1 :] if len(x) == len(y) else x[i:] == y[i + 1 :]


def brute(counts):
    """word -> (form, root, n, n_near, form_n)."""
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def spelled(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def table(df):
    rows = df.collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


def random_words(seed, letters, number, most=9):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(5, most))): r.choice([3, 4, 9, 20, 50, 200]) for _ in range(number)}


@pytest.mark.parametrize(("letters", "most"), [("ab", 2048), ("abcé", 2048), ("abc", 20), ("ab", 3)])
def test_against_all_pairs(spark, letters, most):
    """Small alphabets: many pairs, ambiguous places, chains of forms; with a small `most` regions are halved down to one letter."""
    counts = random_words(4, letters, 900)
    counts |= {"x" * 400 + w: 3 for w in list(counts)[:40]}
    vocab = spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(3)
    assert table(variants.variants(vocab, most)) == brute(counts)


def test_a_third_share_a_beginning(spark):
    r = random.Random(2)
    hot = {"commonbeginning" + "".join(r.choice("abcdefgh") for _ in range(4)): r.randint(3, 90) for _ in range(1500)}
    counts = hot | random_words(3, "abcdefghijkl", 1500)
    vocab = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    assert table(variants.variants(vocab, 200)) == brute(counts)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abA", min_size=5, max_size=8), min_size=1, max_size=60), st.integers(2, 40))
def test_bins(words, most):
    """Groups of halves by hand, packed into bins: each pair once."""
    rows = []
    for w in sorted(words):
        for m in {len(w), max(5, len(w) - 1)}:
            for lo, hi in ((0, m // 2), (m // 2, m)):
                rows.append(((m, lo, hi, w[:lo], w[len(w) - (m - hi) :]), w, 3, m, lo, hi))
    found = Counter()
    for ws, count, _, _ in variants.partners(iter(sorted(rows)), most):
        for w, c in zip(ws, count, strict=True):
            found[w] += c
    assert dict(found) == {w: n for w in words if (n := sum(one_edit(w, v) for v in words))}


def test_words_of_texts(spark, awkward, nothing):
    docs = awkward.select("doc_id", "text")
    r = random.Random(6)
    more = [(i, " ".join(r.choice(["Spelling", "spéllings", "Variant,variants", "groups×group", "naïveté"]) for _ in range(60))) for i in range(300, 360)]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    counts = spelled((x["doc_id"], x["text"]) for x in docs.collect())
    assert {x["word"]: x["n"] for x in variants.vocabulary(variants.spelled(docs)).collect()} == counts
    assert table(variants.variants(variants.vocabulary(variants.spelled(docs)))) == brute(counts)
    assert variants.variants(variants.vocabulary(variants.spelled(nothing))).collect() == []


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = variants.op13_spelling_variants(spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted(["word", "form", "root", "n", "n_near", "form_n"])
    assert table(got) == brute(spelled(map(tuple, rows)))
