import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from watchloom.llm import toxicity
from watchloom.llm.words import words_of

#: 3,000 labels to learn from; the smaller tables have 20 toxic documents or fewer a language.
SF = "/root/testdata/sf0.1"


def brute_marginals(e, trans, begin):
    n, total, one = len(e), 0.0, np.zeros(len(e))
    for path in product((0, 1), repeat=n):
        p = begin[path[0]]
        for k in range(n):
            p *= np.exp(e[k]) if path[k] else 1.0
            if k:
                p *= trans[path[k - 1], path[k]]
        total += p
        one += p * np.array(path)
    return one / total


@pytest.mark.parametrize("block", [1, 3, 256])
def test_marginals_are_exact(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    r = np.random.default_rng(block)
    lengths = [1, 2, 7, 9, 3, 1, 5]
    e = r.normal(size=sum(lengths)) * 3
    trans, begin = r.random((2, 2)) + 0.1, r.random(2) + 0.1
    new = np.zeros(len(e), bool)
    new[np.cumsum([0, *lengths[:-1]])] = True
    got, at = toxicity.marginals(e, new, trans, begin), 0
    for n in lengths:
        assert np.allclose(got[at : at + n], brute_marginals(e[at : at + n], trans, begin))
        at += n


def test_scores_and_spans_against_brute_force(spark):
    """All paths of short texts, by the model's own weights: marginals, spans and the document score."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    model.bias += 2.0  # more words near the threshold
    texts = [None, "", " \n "] + [" ".join((r["text"] or "").split()[k : k + 9]) for r in docs.limit(30).collect() for k in (0, 5)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(rows, model).collect()}
    spans = 0
    for i, t in enumerate(texts):
        w = words_of(pa.array([t], pa.string()))
        e = model.weights[toxicity.features(w)].sum(axis=1, dtype=float) + model.bias
        mu = brute_marginals(e, model.trans, model.begin) if len(e) else np.zeros(0)
        top = min(max(mu.max(initial=0), 1e-4), 1 - 1e-4)
        x = np.array([1, np.log(top / (1 - top)) / 4, np.log1p(mu.sum()), np.log1p(1000 * mu.sum() / max(len(mu), 1))])
        assert abs(got[i]["toxicity"] - 1 / (1 + np.exp(-x @ model.doc))) < 1e-6
        want, k = [], 0
        while k < len(mu):
            if mu[k] >= 0.5:
                j = k
                while j + 1 < len(mu) and mu[j + 1] >= 0.5:
                    j += 1
                want.append((int(w.start[k]), int(w.stop[j])))
                k = j
            k += 1
        spans += len(want)
        assert [(s["start"], s["stop"]) for s in got[i]["toxic_spans"]] == want
    assert spans


def test_features_ignore_punctuation_case_and_neighbours():
    f = toxicity.features(words_of(pa.array(['"Idiot!!" x', "idiot", "...", "a"])))
    assert (f[0] == f[2]).all() and not f[3].any() and f[0, 0] != f[1, 0]


def test_field_learns_a_lexicon_with_context():
    r = np.random.default_rng(3)
    words = [f"word{i}" for i in range(200)]
    texts, toxic = [], []
    for i in range(400):
        t = [words[k] for k in r.integers(0, 200, 30)]
        if i % 4 == 0:
            t[int(r.integers(0, 30))] = "badness" + words[int(r.integers(0, 200))]
        texts.append(" ".join(t))
        toxic.append(int(i % 4 == 0))
    w = words_of(pa.array(texts))
    f = toxicity.features(w)
    m = toxicity.learn(f, w.first, np.array(toxic))
    s = m.scores(m.words(f, w.first), w.first)
    assert (s[np.array(toxic) == 1] > 0.5).all() and (s[np.array(toxic) == 0] < 0.3).all()


def test_words_that_the_sample_lacks_are_plain():
    """Most words of other documents are rare: they don't make clean ones toxic."""
    r = np.random.default_rng(5)
    name = lambda k: "".join("bcdfghklmn"[int(c)] + "aeiou"[int(c) % 5] for c in str(k * 7919 % 1_000_003))
    bad = [f"vile{name(k)}" for k in range(12)]

    def made(n):
        rows = []
        for i in range(n):
            t = [name(k) for k in r.zipf(1.3, 60) % 100_000]
            if i % 8 == 0:
                t[int(r.integers(0, 60))] = t[int(r.integers(0, 60))] = bad[int(r.integers(0, 12))]
            rows.append(" ".join(t))
        w = words_of(pa.array(rows))
        return toxicity.features(w), w.first, (np.arange(n) % 8 == 0).astype(int)

    sample = made(480)
    m = toxicity.learn(*sample)
    once = np.bincount(sample[0][:, 0], minlength=1 << toxicity.FEATURE_BITS) == 1
    assert once.sum() > 1000 and np.abs(m.weights[once]).mean() < 0.5  # one occurrence says little
    f, first, y = made(800)
    s = m.scores(m.words(f, first), first)
    assert (s[y == 0] < toxicity.THRESHOLD).mean() >= 0.99 and (s[y == 1] >= toxicity.THRESHOLD).mean() >= 0.95


def test_all_words_of_the_sample_teach(spark, monkeypatch):
    """Words beyond any bound on the sample's words, in the longest documents, teach as well; tasks learn what one process learns."""
    monkeypatch.setattr(toxicity, "WORDS", 2000, raising=False)
    r = np.random.default_rng(4)
    rows = []
    for i in range(300):
        t = [f"{'abcdefgh'[k % 8]}lain{k}" for k in r.integers(0, 200, 20 if i < 200 else 60)]
        if i % 4 == 0:
            t[int(r.integers(0, len(t)))] = "shortbad" if i < 200 else "longvile"
        rows.append((i, " ".join(t), int(i % 4 == 0)))
    w = words_of(pa.array([t for _, t, _ in rows]))
    f = toxicity.features(w)
    m = toxicity.learn(f, w.first, np.array([y for *_, y in rows]))
    late = np.array([w.text(i) == "longvile" for i in range(len(w.hash))])
    mu = m.words(f, w.first)
    assert late.sum() == 25 and (mu[late] > 0.5).all() and (mu[~late & (w.doc() >= 200)] < 0.5).all()
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    other = toxicity.train(docs.select("doc_id", "text"), labels, held_out=9, modulus=4)
    assert np.allclose(mu, other.words(f, w.first), atol=1e-3)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    q = toxicity.op10_crf_toxicity(spark, SF)
    rows = q.join(labels, "doc_id").where("held_out").collect()
    assert q.count() == docs.count()
    score, y = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    rank = score.argsort().argsort()
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3) for r in q.collect())


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    a, b = (toxicity.score(docs, toxicity.train(docs, x)).select("doc_id", "toxicity").toPandas().sort_values("doc_id") for x in (labels, flipped))
    assert np.array_equal(a["toxicity"].to_numpy(), b["toxicity"].to_numpy())


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, 1, int(i in (8, 22, 25, 30, 35))) for i in range(60)] + [(None, 1, 1), (3, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(awkward, labels)
    found = toxicity.score(awkward, model)
    assert found.count() == awkward.count() and found.where("toxicity is null or toxicity not between 0 and 1").count() == 0
    for r in found.where("size(toxic_spans) > 0").collect():
        raw = r["text"].encode()
        assert all(0 <= s["start"] < s["stop"] <= len(raw) and raw[s["start"] : s["stop"]].strip() for s in r["toxic_spans"])
    assert toxicity.clean(awkward, labels).columns == awkward.columns
    assert toxicity.clean(nothing, labels).count() == 0
    assert toxicity.clean(awkward, labels.where("false")).count() == awkward.count()
