import random
from collections import defaultdict

from watchloom.llm import mixing


def brute_targets(sizes, share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, out, free = share * sum(sizes.values()), {}, set(sizes)
    while free:
        left = goal - sum(out.values())
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > cap * sizes[s]]
        if not over:
            return out | t
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)
    return out


def test_flight_keeps_both_totals():
    r = random.Random(1)
    for _ in range(50):
        n = r.randint(1, 60)
        p, size = [r.random() for _ in range(n)], [float(r.randint(1, 9)) for _ in range(n)]
        q = mixing.fly(p, size, random.Random(3))
        assert abs(sum(q) - sum(p)) < 1e-6 and abs(sum(a * b for a, b in zip(q, size)) - sum(a * b for a, b in zip(p, size))) < 1e-6
        assert sum(0 < x < 1 for x in q) <= 2
        assert set(mixing.land(p, size, random.Random(3))) <= {0.0, 1.0}


def test_flight_keeps_inclusion_probabilities():
    p, size, n = [0.2, 0.5, 0.7, 0.4, 0.9], [1.0, 4.0, 2.0, 2.0, 7.0], 4000
    mean = [0.0] * 5
    for k in range(n):
        for i, x in enumerate(mixing.land(p, size, random.Random(k))):
            mean[i] += x / n
    assert all(abs(a - b) < 0.04 for a, b in zip(mean, p))


def test_mix_awkward(spark, awkward, nothing):
    a = awkward.unionByName(nothing)
    got = mixing.mix(a, bucket_rows=8).collect()
    assert len(got) == a.count()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert r["copies"] <= 2
    want = brute_targets(sizes)
    largest = max(r["size"] for r in got if r["source"] != "c")
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        if s != "c":  # there one text is nearly all of the source
            assert abs(taken[s] - target[s]) <= largest
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(a, bucket_rows=8).collect()), key=str)
    assert mixing.mix(nothing).count() == 0


def test_many_sources_near_target(spark):
    r = random.Random(2)
    rows = [(i, f"s{i % 5}" if i % 3 else "hot", " ".join("w" * r.randint(1, 30))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(docs, bucket_rows=64).groupBy("source").agg({"target": "max", "source_size": "max"}).collect()
    m = {x["source"]: x for x in mixing.mix(docs, bucket_rows=64).selectExpr("source", "size * copies as taken", "target").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()}
    assert len(got) == 6
    for x in m.values():
        assert abs(x["sum(taken)"] / x["max(target)"] - 1) < 0.01


def test_mixed_returns_documents(awkward):
    m = mixing.mixed(awkward, bucket_rows=8)
    assert m.columns == awkward.columns
    copies = mixing.mix(awkward, bucket_rows=8).agg({"copies": "sum"}).first()[0]
    assert m.count() == copies


def test_mixed_with_a_third_equal_rows(spark):
    """A row that makes up a third of the table, rows equal but for other columns, and rows met once: each as often as its unit is drawn."""
    rows = [(7, "hot", "same words here", "x")] * 400 + [(8, "hot", "a b c", str(i)) for i in range(50)] + [(100 + i, f"s{i % 3}", "w " * (i % 9 + 1), "y") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, more string").repartition(5)
    got = mixing.mixed(docs, bucket_rows=64).groupBy("doc_id", "source").count().collect()
    want = mixing.mix(docs, bucket_rows=64).groupBy("doc_id", "source").agg({"copies": "sum"}).collect()
    assert {(r["doc_id"], r["source"]): r["count"] for r in got} == {(r["doc_id"], r["source"]): r["sum(copies)"] for r in want if r["sum(copies)"]}
    again = lambda n: sorted(map(str, mixing.mixed(docs.repartition(n), bucket_rows=64).collect()))
    assert again(3) == again(7)


def test_small_sources_come_near_their_targets(spark):
    """The sources of the table of 1,000 documents, the smallest of 50: within 3 % of the target each."""
    m = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).selectExpr("source", "size * copies as taken", "target").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    worst = max(abs(x["sum(taken)"] / x["max(target)"] - 1) for x in m if x["max(target)"])
    assert len(m) > 3 and worst < 0.03


def test_the_landing_keeps_probabilities_and_sums():
    r = random.Random(5)
    for n in (1, 2, 7, 12, 40):
        p, size = [r.random() for _ in range(n)], [float(r.randint(1, 100)) for _ in range(n)]
        draws = [mixing.land(p, size, random.Random(k)) for k in range(600)]
        assert all(set(d) <= {0.0, 1.0} for d in draws)
        assert all(abs(sum(d[i] for d in draws) / len(draws) - p[i]) < 0.09 for i in range(n))
        if n >= 12:
            goal = sum(a * b for a, b in zip(p, size, strict=True))
            errors = [sum(a * b for a, b in zip(d, size, strict=True)) - goal for d in draws]
            assert sum(map(abs, errors)) / len(errors) < 0.05 * goal
    assert mixing.land([], [], r) == [] and mixing.land([0.5, 0.5], [0.0, 0.0], r) in ([1.0, 0.0], [0.0, 1.0], [1.0, 1.0], [0.0, 0.0])
