import pyarrow as pa
from pyspark.sql import functions as F

from watchloom.llm import common
from watchloom.llm.words import words_of


def test_ranks_are_gapless_in_code_point_order(spark):
    names = ["b", "a", "é", "Z", None, "z", "🙂", "￿"]
    d = spark.createDataFrame([(n,) for n in names], "s string")
    got = common.ranked(d, F.col("s").isNull(), F.col("s")).orderBy("rank").collect()
    want = sorted([n for n in names if n is not None], key=lambda s: s.encode()) + [None]
    assert [(r["rank"], r["s"]) for r in got] == list(enumerate(want))
    assert common.ranked(d.where("false"), F.col("s")).count() == 0


def test_pieces_keep_all_rows_in_order():
    texts = ["a" * 10, None, "", "b" * 100, "c", "d" * 5] * 5
    b = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(range(30))], names=["text", "i"]).slice(3)
    got = list(common.pieces([b], "text", 20))
    assert [i for p in got for i in p.column("i").to_pylist()] == list(range(3, 30)) and len(got) > 3


def test_words_of_a_slice():
    texts = ["x y", "Ab  c d\x0be", None, " ", "é É"]
    w = words_of(pa.array(texts, pa.string()).slice(1))
    assert [w.text(i) for i in range(len(w.start))] == ["ab", "c d", "e", "é", "É"]
    assert w.first.tolist() == [0, 3, 3, 3, 5] and w.hash[3] != w.hash[4]


def test_keys_order_like_their_longs(spark):
    rows = [(-5, 1), (3, -9), (3, 7), (None, 0), (2**63 - 1, 0), (-(2**63), 4), (0, 0)]
    d = spark.createDataFrame(rows, "a long, b long")
    key = lambda down: common.ordered_key(F.col("a"), F.col("b"), descending=down)
    number = lambda x: -(2**63) if x is None else x
    up = [(number(r["a"]), r["b"]) for r in d.orderBy(key(False)).collect()]
    assert up == sorted(up) and [(number(r["a"]), r["b"]) for r in d.orderBy(key(True)).collect()] == up[::-1]


def test_unused_names():
    class Frame:
        columns = ["a", "_X", "_x_"]

    assert common.unused(Frame, "_x") == "_x__"


def test_labelled_sample_takes_an_id_once(spark):
    """Repeated rows, labels without a document, and the bounds on rows and bytes."""
    docs = spark.createDataFrame([(1, "b"), *[(1, "a")] * 50, (2, None), (3, "x" * 1000), *[(i, "word " * i) for i in range(10, 40)], (None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 1), *[(i, i % 2) for i in range(10, 60)], (None, 1), (4, None)], "doc_id long, y int")
    rows = common.labelled_sample(docs, labels, "y", 1000).collect()
    assert len(rows) == 33 and sum(r["text"] == "a" and r["label"] == 1 for r in rows) == 1 and sum(r["text"] == "" for r in rows) == 1
    few = common.labelled_sample(docs, labels, "y", 10, positive=4).collect()
    assert len(few) == 10 and sum(r["label"] for r in few) == 4
    small = common.labelled_sample(docs, labels, "y", 1000, sample_bytes=500).collect()
    assert 0 < len(small) < 33 and sum(len(r["text"]) for r in small) <= 500 and {r["text"] for r in small} <= {r["text"] for r in rows}
    assert common.labelled_sample(docs.where("false"), labels, "y", 10).count() == 0


def test_labelled_sample_passes_over_documents_that_do_not_fit(spark):
    """Whichever document comes first: those that fit after it are taken."""
    ids = [r["id"] for r in spark.range(40).orderBy(F.xxhash64("id"), "id").collect()]
    for place in (0, 3, 39):
        rows = [(i, ("x" * 1200) if i == ids[place] else f"text {i:04}") for i in range(40)]
        docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, y int")
        got = common.labelled_sample(docs, labels, "y", 1000, sample_bytes=1000).collect()
        assert sorted(r["text"] for r in got) == sorted(t for i, t in rows if i != ids[place])
