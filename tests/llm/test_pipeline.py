import sys

import corpus_pipeline
from tests.llm.test_jaccard import tuple_set
from watchloom.llm import quality, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = docs, docs.columns
    tables = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        before, kept = kept, spark.read.parquet(f"{tmp_path}/{k}")
        tables.append((before, kept))
        if k < 4:
            assert kept.columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
    q = quality.score(docs, quality.train(docs, labels)).where(f"tail_probability >= {quality.KEEP}")
    assert ids(tables[0][1]) == ids(q)
    t = toxicity.score(tables[1][0], toxicity.train(tables[1][0], labels)).where(f"toxicity < {toxicity.THRESHOLD}")
    assert ids(tables[1][1]) == ids(t)
    rows = sorted((r["doc_id"], tuple_set(r["text"])) for r in tables[2][0].collect())
    parent = {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                u, v = sorted((root(a), root(b)))
                parent[v] = u
    assert ids(tables[2][1]) == sorted(d for d, _ in rows if root(d) == d)
    taken = ids(tables[3][1])
    assert set(taken) <= set(ids(tables[2][1])) and all(taken.count(d) <= 2 for d in set(taken))
    assert ids(tables[4][1]) == taken


def test_run_and_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, "/root/testdata/sf0.01")
    good = labels.where("quality = 1")
    assert kept.join(good, "doc_id", "left_semi").count() >= 0.98 * good.count()
    assert corpus_pipeline.run(spark, SF).where("n_tokens is null or ids_sha256 is null").count() == 0


def test_stages_on_awkward_tables(spark, awkward, nothing, tmp_path):
    """Nulls in any column, repeated rows, very long texts and clashing columns go through all stages; empty tables stay empty."""
    spark.createDataFrame([(i, i % 4 and 1, int(i % 7 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None), (999, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, docs in (("a", awkward), ("n", nothing)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < 4:
                assert out.columns == awkward.columns
            out.write.parquet(f"{tmp_path}/{name}{k}")
            before, docs = docs.count(), spark.read.parquet(f"{tmp_path}/{name}{k}")
            assert docs.count() <= before or k == 3
        assert (docs.count() > 0) == (name == "a")


def test_registered():
    sys.path.insert(0, ".")
    import __spark_entry__ as e

    names = e.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
