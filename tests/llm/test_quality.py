import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from watchloom.llm import quality
from watchloom.llm.words import BYTE_CODE, mix64

SF = "/root/testdata/sf0.01"


def test_four_grades_are_told_apart():
    r = np.random.default_rng(2)
    n, dims = 2000, 32
    x = r.normal(size=(n, dims))
    true = r.normal(size=dims)
    grade = np.digitize(x @ true + r.logistic(size=n) * 0.3, [-4, 0, 4])
    row, col = np.repeat(np.arange(n), dims), np.tile(np.arange(dims), n)
    w, t = quality.fit(row, col, x.ravel(), grade, dims=dims)
    assert (np.diff(t) > 0).all()
    tails = quality.sigmoid((x @ w)[:, None] - t)
    assert np.abs(tails.sum(axis=1) - grade).mean() < 0.35
    assert (np.diff(tails, axis=1) <= 1e-12).all()


@pytest.mark.parametrize("grades", [[], [1, 1, 1], [0, 0]])
def test_nothing_to_learn(grades):
    w, t = quality.fit(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.array(grades, int))
    assert not w.any() and (quality.sigmoid(-t) > 0.99).all()


def test_features_know_documents_apart():
    both = quality.hashed(pa.array(["a b b C!!", None, "", "x y"]))
    alone = [quality.hashed(pa.array([t], pa.string()))[0] for t in ("a b b C!!", None, "", "x y")]
    assert np.array_equal(both[0], np.concatenate(alone)) and both[1].tolist() == [0, 4, 4, 4, 6]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 1
    found = quality.score(docs, quality.train(docs, labels.where(~fold)))
    rows = found.join(labels.where(fold), "doc_id").select("quality", "tail_probability").collect()
    right = np.mean([(r["tail_probability"] >= quality.KEEP) == (r["quality"] == 1) for r in rows])
    kept = np.mean([r["tail_probability"] >= quality.KEEP for r in rows if r["quality"] == 1])
    assert right > 0.93 and kept > 0.97


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 1), (999, 0, 1), (3, None, None), (8, 0, 1), (4, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(awkward, labels)
    found = quality.score(awkward, model)
    assert found.count() == awkward.count()
    blank = found.where("text is null or trim(text) = ''").select("tail_probability").distinct().collect()
    assert len(blank) <= 2  # null, empty: the thresholds alone
    assert quality.selected(awkward, labels).columns == awkward.columns
    assert quality.selected(nothing, labels).count() == 0
    assert quality.selected(awkward, labels.where("false")).count() == awkward.count()


def plain_features(text):
    """The hashed features of a text by the docstring, word by word."""
    low = lambda b: bytes(c + 32 if 65 <= c <= 90 else c for c in b)
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = lambda x: int(mix64(np.array([x % 2**64], np.uint64))[0]) >> (64 - quality.FEATURE_BITS)
    out, last = [], 1 << 20
    for k, w in enumerate(words):
        kinds = [int(quality.KIND[c]) for c in w]
        marks = min(sum(x == 0 for x in kinds), 3)
        shape = (1 in kinds) + 2 * (2 in kinds) + 4 * (4 in kinds) + 8 * marks + 32 * min(len(w), 12) // 4
        end = 0
        for j in (1, 2, 3):
            end = (end * 257 + (int(BYTE_CODE[w[-j]]) if len(w) >= j else 1)) % 2**64
        same = int(k > 0 and low(words[k - 1]) == low(w))
        out += [h(end), h(shape * 4099 + last + 7), h(same + 12345)]
        last = shape
    return out


@pytest.mark.parametrize("grades", [2, 4])
def test_scores_against_brute_force(spark, awkward, grades):
    r = np.random.default_rng(grades)
    w, t = r.normal(size=1 << quality.FEATURE_BITS), np.sort(r.normal(size=grades - 1))
    got = quality.score(awkward, (w, t)).select("text", "expected_grade", "tail_probability").collect()
    seen = 0
    for x in got:
        if len(x["text"] or "") > 3000:
            continue
        f = plain_features(x["text"])
        z = sum(w[i] for i in f) / max(1, len(f) // 3)
        tails = 1 / (1 + np.exp(-(z - t)))
        assert abs(x["expected_grade"] - tails.sum()) < 1e-4 and abs(x["tail_probability"] - tails[-1]) < 1e-4
        seen += 1
    assert seen > 40


def test_any_whole_numbers_are_grades(spark, awkward):
    """Grades -1 and 7 teach what 0 and 1 teach."""
    ids = [1, 2, 3, 7, 8, *range(20, 60)]
    one, other = (quality.train(awkward, spark.createDataFrame([(i, a if i % 3 else b) for i in ids], "doc_id long, quality int")) for a, b in ((0, 1), (-1, 7)))
    assert np.allclose(one[0], other[0]) and np.allclose(one[1], other[1])


def test_query_scores_every_document(spark):
    q = quality.op6_ordinal_quality(spark, "/root/testdata/sf0.001")
    assert q.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert q.where("expected_grade not between 0 and 1 or tail_probability not between 0 and 1").count() == 0
