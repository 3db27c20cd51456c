import hashlib

import numpy as np
import pytest

from watchloom.llm import digest


def test_entropies_match_counts():
    r = np.random.default_rng(0)
    for n, k in ((64, 3), (65, 256), (400, 20), (900, 2)):
        x = r.integers(0, k, n).astype(np.uint8)
        want = [digest.TERM[np.bincount(x[i : i + digest.W])].sum() for i in range(n - digest.W + 1)]
        assert (np.abs(digest.entropies(x) - digest.quantised(np.array(want))) <= 1).all()
        for w in (digest.W, digest.SMALL):
            e = digest.entropies(x, w)
            assert (np.abs(digest.side_by_side(x, w) - np.append(e[::w][: n // w], e[-1:][: n % w])) <= 1).all()
    assert len(digest.entropies(x[:63])) == 0


def test_chosen_windows_match_a_plain_count():
    r = np.random.default_rng(1)
    for n in (1, 5, 40, 64, 65, 300):
        rank = r.integers(0, 50, n)
        span = min(digest.W, n)
        best = [i + int(rank[i : i + span].argmin()) for i in range(n - span + 1)]
        want = sorted({b for b in best if best.count(b) >= min(digest.POPULAR, len(best))})
        assert digest.chosen(rank).tolist() == want


def test_likeness_bounds():
    rank = np.arange(digest.STEPS)
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(600))
    f = lambda t: digest.digest(t.encode(), (rank, rank), digest.steps_of(t.encode()))
    a, b, c = f(text), f(text[:3000] + text[3100:]), f(" ".join(f"andere{i * 31 % 977}" for i in range(600)))
    assert digest.likeness(a, a) == 1 and digest.likeness(a, f("")) == 0 and digest.likeness(f(""), f("")) == 1
    assert digest.likeness(a, b) > 0.6 > 0.2 > digest.likeness(a, c)
    assert digest.likeness(a, b) == digest.likeness(b, a)


def brute(rows):
    """id, characters, edited hash of each row in the order of the operator, ties left out."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (d, t), (_, u) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        out[d] = (len(t), hashlib.sha256((t[: len(t) - k] + u[:k]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("slice_bytes", [300, 1 << 20])
def test_next_across_slices(spark, slice_bytes):
    rows = [(i * 5 - 100, f"text é {i} " * (i % 9)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = digest.with_next(docs, slice_bytes=slice_bytes).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == brute(rows) and len(got) == len(rows)


def test_awkward_rows(awkward, nothing):
    got = digest.with_next(awkward, slice_bytes=2000).collect()
    assert len(got) == awkward.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    one = [r["fingerprint"] for r in got if r["doc_id"] == 1]
    assert len(one) == 2 and one[0] == one[1] and any(r["doc_id"] == 1 and r["near_next"] == 1 for r in got)
    assert digest.with_next(nothing).count() == 0
    single = digest.with_next(awkward.where("doc_id = 10")).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1


def plain_digest(raw, ranks):
    """The chains by the docstring, window by window."""
    out = []
    for w, popular, rank, ok in ((digest.W, digest.POPULAR, ranks[0], True), (digest.SMALL, digest.SMALL_POPULAR, ranks[1], len(raw) < digest.SHORT)):
        if not raw or not ok:
            out.append([])
            continue
        windows = [raw[i : i + w] for i in range(len(raw) - w + 1)]
        r = [int(rank[s]) for s in digest.entropies(np.frombuffer(raw, np.uint8), w)]
        span = min(w, len(r))
        best = [min(range(i, i + span), key=lambda j: (r[j], j)) for i in range(len(r) - span + 1)] if r else []
        won = sorted({b for b in best if best.count(b) >= min(popular, len(best)) and r[b] < digest.STEPS})
        if won:
            hashes = [int(digest.mix64(np.array([sum(int(c) * int(digest.WEIGHT[k]) for k, c in enumerate(windows[b])) % 2**64], np.uint64))[0]) for b in won]
        else:
            hashes = [int.from_bytes(hashlib.sha256(raw).digest()[:8], "little")]
        chain = [set() for _ in range(-(-len(hashes) // digest.FULL))]
        for i, h in enumerate(hashes):
            chain[i // digest.FULL] |= {h >> (11 * k) & (digest.BITS - 1) for k in range(digest.MARKS)}
        out.append(chain)
    return out


def plain_likeness(x, y):
    if x == y:
        return 1.0
    a, b = (x[1], y[1]) if x[1] and y[1] else (x[0], y[0])
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    share = lambda f, g: max(0.0, min(1.0, (len(f & g) - len(f) * len(g) / digest.BITS) / (min(len(f), len(g)) - len(f) * len(g) / digest.BITS)))
    return min(sum(max(share(f, g) for g in b) for f in a) / len(a), 0.999999)


def test_likeness_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: -r[0])
    ranks = digest.rarity(docs)
    got = {r["doc_id"]: r for r in digest.with_next(docs, slice_bytes=20_000).collect()}
    for (d, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        if len(t) > 3000:
            continue
        own, after, other = (plain_digest(x.encode(), ranks) for x in (t, digest.edited(t, u), u))
        assert abs(got[d]["near_edited"] - plain_likeness(own, after)) < 1e-5 and abs(got[d]["near_next"] - plain_likeness(own, other)) < 1e-5


def test_short_texts_are_near_their_edits(spark):
    """Texts of 30 to 500 bytes: the edited one is nearer than another one."""
    import random

    r = random.Random(2)
    words = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    for n in (6, 12, 25, 60):
        rows = [(i, " ".join(r.choice(words) for _ in range(n))) for i in range(60)]
        got = digest.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        near, other = sorted(x["near_edited"] for x in got), sorted(x["near_next"] for x in got)
        assert near[3] > other[-4] and near[30] > 0.35 > 0.15 > other[30], (n, near, other)


def test_query_is_repeatable_and_near_means_near(spark):
    q = [digest.op9_improbable_digest(spark, "/root/testdata/sf0.001").toPandas().sort_values("doc_id").reset_index(drop=True) for _ in range(2)]
    assert q[0].equals(q[1])
    assert q[0]["near_edited"].median() > 0.4 and q[0]["near_next"].median() < 0.1
