import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from watchloom.llm import jaccard
from watchloom.llm.words import U, mix64, shingles, words_of

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def tuple_set(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(n, component) of each row; ids are vertices, null ids count by their text."""
    sets = [tuple_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[root(i)] = d if least[root(i)] is None else min(least[root(i)], d)
    return sorted(((d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def test_sets_match_tuples(vocabulary):
    r = random.Random(4)
    texts = [None, "", " ", "a", "A b", "a b", "a b c d", "A B C D E", "a b c d e f a b c d e f", "x\x0by\x0cz é É"] + [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 40))) for _ in range(50)]
    got = shingles(words_of(pa.array(texts, pa.string())))
    assert [len(s) for s in got] == [len(tuple_set(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(tuple_set(texts[i]) & tuple_set(texts[j]))


@pytest.mark.parametrize("rare", [1.0, 0.6, 0.3, 0.1, 0.0])
def test_linked_pairs_share_a_block(rare):
    """The pigeonhole holds for every size and whichever shingles are common: any pair at the threshold has a key in common."""
    r = np.random.default_rng(1)
    low, d, k = jaccard.bands(80)
    is_rare = lambda s: (mix64(s + U(99)) >> U(11)).astype(np.float64) / 2**53 < rare
    for n in [*range(1, 60), 100, 333, 1000]:
        for _ in range(4):
            a = r.integers(0, 2**63, n, np.uint64)
            drop = int(r.integers(0, n // 5 + 1))
            add = max(0, (len(a) - drop) * 5 // 4 - n)
            b = np.concatenate([a[drop:], r.integers(0, 2**63, int(r.integers(0, add + 1)), np.uint64)])
            if not len(b) or 100 * (n - drop) < 80 * len(np.union1d(a, b)):
                continue
            keys = []
            for s in (np.unique(a), np.unique(b)):
                i = int(np.searchsorted(low, len(s), "right")) - 1
                keys.append({int(x) for q in (i, i - 1)[: 1 + (i > 0)] for x in jaccard.block_keys(s, is_rare(s), q, int(d[q]), int(k[q]))})
            shared = {x >> 1 for x in keys[0]} & {x >> 1 for x in keys[1]}
            assert any(2 * x in keys[0] | keys[1] for x in shared)  # and not as probes both
            assert jaccard.may_link(jaccard.sketch(np.unique(a)), n, jaccard.sketch(np.unique(b)), len(b), 80)


def candidate_pairs(texts, least):
    """How many pairs of sets have a key in common, with shingles of `least` texts or more as the common ones."""
    low, d, k = jaccard.bands(80)
    sets = shingles(words_of(pa.array(texts)))
    u, n = np.unique(np.concatenate(sets), return_counts=True)
    common = u[n >= least]
    groups, probes = defaultdict(set), defaultdict(set)
    for j, s in enumerate(sets):
        i = int(np.searchsorted(low, len(s), "right")) - 1
        for q in (i, i - 1)[: 1 + (i > 0)]:
            for x in jaccard.block_keys(s, ~np.isin(s, common), q, int(d[q]), int(k[q])).tolist():
                (probes if x & 1 else groups)[x >> 1].add(j)
    return sum(len(g) * (len(g) - 1) // 2 + len(g) * len(probes[x]) for x, g in groups.items())


def test_a_shared_passage_makes_no_candidates():
    """Unlike texts of 80 words that share 40 of them: candidates don't grow with the square of their number."""
    r = random.Random(3)
    word = lambda: f"w{r.randrange(10**6)}"
    passage = [word() for _ in range(40)]
    for around in (20, 6):  # the second ones are passage for the most part, but too little to be alike
        texts = [" ".join([word() for _ in range(around)] + passage + [word() for _ in range(around)]) for _ in range(4000)]
        few, many = candidate_pairs(texts[:500], jaccard.COMMON), candidate_pairs(texts, jaccard.COMMON)
        assert few <= 500 and many <= 4000 < candidate_pairs(texts[:500], 10**9)


def test_sets_with_one_identity_stay_apart(spark, vocabulary):
    """With identities of 4 bits nearly all sets clash, and the second one tells them apart."""
    r = random.Random(6)
    base = [r.choice(vocabulary) for _ in range(50)]
    rows = [(i, " ".join(edited(r, base, vocabulary, 2) if i % 3 else [r.choice(vocabulary) for _ in range(30)])) for i in range(60)] + [(100, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    m = jaccard.grouped(docs, bits=4)
    least = {r["comp"]: r["least"] for r in m.groupBy("comp").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "least").collect()}
    assert sorted(((x["doc_id"], x["n"], least[x["comp"]]) for x in m.collect()), key=str) == brute(rows)


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert sorted([tuple(r) for r in jaccard.join(awkward).collect()], key=str) == brute(rows)
    assert jaccard.join(nothing).count() == 0


def edited(r, words, vocabulary, n):
    w = list(words)
    for _ in range(n):
        w[r.randrange(len(w))] = r.choice(vocabulary)
    return w


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_and_groups(spark, vocabulary, seed):
    """Chains of edits, near copies of one text and shared passages: links at and around the threshold."""
    r = random.Random(seed)
    draw = lambda n: [r.choice(vocabulary) for _ in range(n)]
    texts = []
    for n in (9, 25, 60, 150, 300):
        w = draw(n)
        for _ in range(14):
            w = edited(r, w, vocabulary, r.randint(0, max(1, n // 60)))
            texts.append(w)
    base = draw(100)
    texts += [edited(r, base, vocabulary, r.randint(1, 3)) for _ in range(70)]
    passage = draw(40)
    texts += [draw(r.randint(3, 30)) + passage + draw(r.randint(3, 30)) for _ in range(40)]
    rows = [(i * 7 % 1009, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(2000 + i, rows[i][1].upper()) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted([tuple(x) for x in jaccard.join(docs).collect()], key=str) == brute(rows)


def test_second_round_in_small_blocks(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUND_ROWS", 4)
    r = random.Random(8)
    base = [r.choice(vocabulary) for _ in range(80)]
    rows = [(i, " ".join(edited(r, base, vocabulary, 4))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(x) for x in jaccard.join(docs).collect()], key=str) == brute(rows)


@pytest.mark.parametrize("stars", [0, 1, 9])
def test_any_number_of_rounds_gives_the_same(spark, vocabulary, monkeypatch, stars):
    """A large group of near copies, few of which are alike at the threshold, by the last round alone and by many stars."""
    monkeypatch.setattr(jaccard, "STARS", stars)
    monkeypatch.setattr(jaccard, "LEFT", 0 if stars else 2)
    r = random.Random(11)
    base = [r.choice(vocabulary) for _ in range(100)]
    rows = [(i, " ".join(edited(r, base, vocabulary, r.randint(1, 4)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted([tuple(x) for x in jaccard.join(docs).collect()], key=str) == brute(rows)


def test_components_of_a_long_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a long, b long")
    got = {r["cid"]: r["comp"] for r in jaccard.components(edges).collect()}
    assert all(got[i] == 0 for i in range(n + 1)) and got[101] == got[100] == 100


def test_one_of_each_group_stays(awkward):
    kept = jaccard.distinct_documents(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect())
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    blank = [str(d) for d, t in rows if not tuple_set(t)]
    comps = {c for d, n, c in brute(rows) if n and c is not None}
    assert ids == sorted(blank + [str(c) for c in comps] + ["None"])  # the text with a null id is alone


def test_keys_travel_in_six_bytes():
    keys = jaccard.mix64(np.arange(10_000, dtype=np.uint64))
    got = jaccard.short(keys)
    assert (got < np.uint64(1 << 48)).all() and ((got & np.uint64(1)) == (keys & np.uint64(1))).all() and len(np.unique(got >> np.uint64(1))) == len(got)


def test_only_sets_of_candidates_travel(spark, monkeypatch):
    """Unlike texts that share a line meet in groups; whole sets are read only of pairs that sketches don't rule out."""
    r = random.Random(6)
    text = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    lines = [text(9) for _ in range(12)]
    rows = [(i, " ".join(text(5) + lines[i % 12] + text(5))) for i in range(72)]
    asked, sure = set(), set()
    sets_of, possible, across = jaccard.sets_of, jaccard.possible, jaccard.across
    both = lambda pairs: {x for p in pairs.collect() for x in (p["a"], p["b"])}

    def spy(docs, ids, form, *rest):
        if form is jaccard.pack:
            asked.update(x["cid"] for x in ids.select("cid").collect())
        return sets_of(docs, ids, form, *rest)

    def told(f):
        def run(*a):
            sure.update(both(out := f(*a)))
            return out

        return run

    monkeypatch.setattr(jaccard, "sets_of", spy)
    monkeypatch.setattr(jaccard, "possible", told(possible))
    monkeypatch.setattr(jaccard, "across", told(across))
    got = sorted(map(tuple, jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows) and asked <= sure
