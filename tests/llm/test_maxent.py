import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from watchloom.llm import maxent
from watchloom.llm.words import U, mix64

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + [None]


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def check(rows, got):
    c = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((d, held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for d, t in rows), key=str)
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str) == want


def piece(texts, train=True):
    h, first = maxent.tokens_of(pa.array(texts))
    u, at = np.unique(h, return_inverse=True)
    return maxent.Piece(u, at, first, np.full(len(texts), train))


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = maxent.score(awkward).collect()
    check(rows, got)
    assert all(r["score"] < 0 for r in got)
    assert maxent.score(nothing).count() == 0


def test_null_and_odd_ids(spark):
    """A null id is not the id -1, and ids may be text."""
    got = maxent.score(spark.createDataFrame([(None, "a b c"), (-1, "a b c")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] is None, r["held_out"]) for r in got) == sorted([(True, held(None)), (False, held(-1))])
    rows = [(x, "a b " + x) for x in ("one", "two", "three", "2")]
    check(rows, maxent.score(spark.createDataFrame(rows, "doc_id string, text string")).collect())


def test_no_training_texts(spark):
    d = [i for i in range(200) if held(i)]
    got = maxent.score(spark.createDataFrame([(i, f"word{i} x") for i in d], "doc_id long, text string")).collect()
    assert len(got) == len(d) and all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in got)


@pytest.mark.parametrize("bits,n", [(64, 1000), (38, 1000), (10, 5000), (38, 0)])
def test_distinct(bits, n):
    keys = np.random.default_rng(n).integers(0, 1 << min(bits, 12), n).astype(np.uint64)
    u, at = maxent.distinct(keys, bits)
    assert (u == np.unique(keys)).all() and (u[at] == keys).all()


def test_requests_and_totals_travel_whole():
    r = np.random.default_rng(2)
    for bits, slots in ((64, 6), (38, 6), (40, 8)):
        total, told = Counter(), []
        for _ in range(4):
            keys = np.unique(r.integers(0, 1 << 20, 3000).astype(np.uint64) * U((1 << bits) // (1 << 20)) + U(1))
            n = r.choice([0, 1, 2, 254, 255, 256, 70000], len(keys))
            total.update(dict(zip(keys.tolist(), n.tolist(), strict=True)))
            told.append((keys, maxent.asked(keys, n, bits, slots)))
        by_slot = defaultdict(list)
        for i, (_, rows) in enumerate(told):
            for s, k, c in rows:
                by_slot[s].append((i, k, c))
        back = [{} for _ in told]
        for s, rows in by_slot.items():
            u, sums, where, ends = maxent.added([(k, c) for _, k, c in rows], s, bits, slots)
            for (i, _, _), a, e in zip(rows, ends, ends[1:], strict=False):
                back[i][s] = maxent.small(sums[where[a:e]])
        for i, (keys, _) in enumerate(told):
            found, at = maxent.cuts(keys, bits, slots)
            got = np.concatenate([maxent.large(back[i][int(s)], e - a) for s, a, e in zip(found, at[:-1], at[1:], strict=True)])
            assert got.tolist() == [total[k] for k in keys.tolist()]


def test_unmixed():
    x = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (maxent.unmixed(mix64(x)) == x).all()


def test_scores_against_brute_force(spark, monkeypatch):
    """Counts of words, pairs and (word, class) by plain Python; the class softmax from the model's own weights."""
    kept = {}
    of, learn = maxent.classes_of, maxent.train
    monkeypatch.setattr(maxent, "classes_of", lambda v: kept.setdefault("classes", of(v)))
    monkeypatch.setattr(maxent, "train", lambda *a: kept.setdefault("weights", learn(*a)))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(3)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["score"] for r in maxent.score(docs).collect()}
    (classes, _, _), weights = kept["classes"], kept["weights"]
    n, pair, context, size = Counter(), Counter(), Counter(), Counter()
    ps = {d: piece([t]) for d, t in rows}
    tokens = {d: p.words[p.at].tolist() for d, p in ps.items()}
    leaf = {h: c for p in ps.values() for h, c in zip(p.words.tolist(), classes.of(p.words).tolist(), strict=True)}
    for d, t in tokens.items():
        if not held(d):
            for v, w in zip([None, *t], t, strict=False):
                n[w] += 1
                pair[v, w] += 1
                context[v, leaf[w]] += 1
    for w, k in n.items():
        size[leaf[w]] += k + 1
    assert all(classes.size[c] == k + 1 for c, k in size.items() if c >= maxent.SINGLE)
    off = 0
    for d, t in tokens.items():
        want = weights.log10(ps[d].rows(), classes.of(ps[d].words)[ps[d].at]).sum()
        for v, w in zip([None, *t], t, strict=False):
            if leaf[w] >= maxent.SINGLE:
                q = (n[w] + 1) / (size[leaf[w]] + 1)
                want += math.log10((pair[v, w] + maxent.PRIOR * q) / (context[v, leaf[w]] + maxent.PRIOR))
        off += abs(want - got[d]) > 1e-6 * abs(want)
    assert off <= 0.01 * len(rows)  # hashed pairs that fall together


def test_probabilities_add_up():
    """Over all groups and classes, and within a class after any word over its words and one more for the unseen."""
    r = np.random.default_rng(1)
    classes = maxent.Classes(np.sort(r.integers(0, 1 << 40, maxent.SINGLE).astype(np.uint64)), r.integers(maxent.SINGLE, maxent.LEAVES - 3, maxent.ENDINGS), np.ones(maxent.LEAVES))
    m = maxent.Weights(classes)
    m.w[:] = r.normal(size=m.w.shape)
    p = piece(["a b c d e f", None, "a"])
    total = np.zeros(len(p.at))
    for leaf in range(maxent.LEAVES):
        total += 10 ** m.log10(p.rows(), np.full(len(p.at), leaf))
    assert np.allclose(total, 1, atol=1e-5)
    counts, after = np.array([5, 3, 1]), np.array([2, 0, 1])
    q = np.append(counts + 1, 1) / (counts.sum() + len(counts) + 1)
    assert math.isclose(((np.append(after, 0) + maxent.PRIOR * q) / (after.sum() + maxent.PRIOR)).sum(), 1)


def test_steps_raise_the_likelihood():
    r = np.random.default_rng(4)
    texts = [" ".join(("the", "a")[i % 2] + " " + ("cat", "dog")[i % 2] + "s" * int(r.integers(1, 3)) for i in r.integers(0, 2, 60)) for _ in range(40)]
    p = piece(texts)
    classes = maxent.Classes(np.sort(np.append(p.words[:5], maxent.END)), np.arange(maxent.ENDINGS) % 40 + maxent.SINGLE, np.ones(maxent.LEAVES))
    m = maxent.Weights(classes)
    leaf = classes.of(p.words)[p.at]
    before = m.log10(p.rows(), leaf).sum()
    learner = maxent.Learner(m)
    for _ in range(20):
        learner.step(p.rows(), leaf)
    assert m.log10(p.rows(), leaf).sum() > 0.5 * before


def test_history_stays_in_its_text():
    p = piece(["a b c", "", "a b c"])
    rows = np.stack(p.rows(), axis=1)
    assert (rows[:4] == rows[5:]).all() and (rows[4] == rows[0]).all()


def test_clusters_part_languages():
    pairs = np.zeros((maxent.ENDINGS, maxent.ENDINGS))
    r = np.random.default_rng(0)
    for _ in range(20000):
        i, j = r.integers(0, 256, 2)
        s = int(r.integers(0, 2)) * 256
        pairs[i + s, j + s] += 1
    c = maxent.clusters(pairs)
    assert not set(c[:256] // maxent.MEMBERS) & set(c[256:] // maxent.MEMBERS) and c.min() >= maxent.SINGLE


def test_held_out_texts_score_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = maxent.score(docs).collect()
    check([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
