import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from watchloom.llm import common, sharding


def shards(docs, **how):
    d = docs.select("doc_id", "text", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("bytes"))
    return sharding.shard_rows(d, sharding.by_text_key(), F.col("bytes"), **how).collect()


def test_awkward_rows(awkward, nothing):
    got = shards(awkward)
    assert len(got) == awkward.count() and shards(nothing) == []
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(16))


def test_clashing_columns_ride_along(awkward):
    wide = awkward.withColumns({"shard": F.lit("x"), "_row": F.lit("y"), "own": F.lit("z")})
    got = sharding.shard_rows(wide, sharding.by_text_key(), F.octet_length(F.coalesce("text", F.lit(""))) + 1)
    assert sorted(got.columns) == sorted([*wide.columns, "slot"])
    plain = lambda df: sorted(map(str, df.select(*[c for c in wide.columns if c != "shard"]).collect()))
    assert plain(got) == plain(wide)


def test_even_bytes_and_groups(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 17 + 1)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = shards(docs)
    total, by, where = 0, defaultdict(int), defaultdict(set)
    for r in got:
        total += r["bytes"]
        by[r["shard"]] += r["bytes"]
        where[r["text"]].add(r["shard"])
    assert all(abs(v - total / 16) <= 0.01 * total / 16 for v in by.values()) and len(by) == 16
    assert sum(len(v) > 1 for v in where.values()) <= 16  # a group is cut only where a shard ends
    again = shards(docs.repartition(3))
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in got} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_splitters_are_exact(spark, parts):
    rows = spark.range(500).select(common.ordered_key(F.xxhash64("id"), F.col("id")).alias("key"), (F.col("id") % 9 + 1).alias("weight"))
    total = rows.agg(F.sum("weight")).first()[0]
    cut = common.splitters(rows, total, parts, tolerance=0.001, probes=64)
    keys = sorted((int.from_bytes(r["key"], "big"), r["weight"]) for r in rows.collect())
    below = [sum(w for k, w in keys if k < c) for c in cut]
    assert all(abs(b - total * (i + 1) / parts) <= 10 for i, b in enumerate(below))
    assert common.histogram(rows, cut)[0] == below


def test_query(spark):
    q = sharding.op7_histogram_shards(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(q) == len(docs)
    for r in q:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)


def against_order(docs, got, shards_=16):
    """Brute force: all rows by key, dealt out in that order; a shard is a run of it, within 1 % and a row of an equal share."""
    keys = {(r["doc_id"], r["text"]): bytes(r["key"]) for r in docs.select("doc_id", "text", sharding.by_text_key().alias("key")).collect()}
    run = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [keys[r["doc_id"], r["text"]][:8] for r in run] == sorted(keys[r["doc_id"], r["text"]][:8] for r in got)
    first = [r for k, r in enumerate(run) if not k or (r["doc_id"], r["text"]) != (run[k - 1]["doc_id"], run[k - 1]["text"])]
    assert all(keys[a["doc_id"], a["text"]] <= keys[b["doc_id"], b["text"]] or sum(x["text"] == b["text"] for x in got) > 1 for a, b in zip(first, first[1:], strict=False))
    total, largest, by, slots = sum(r["bytes"] for r in got), max(r["bytes"] for r in got), defaultdict(int), defaultdict(list)
    for r in got:
        by[r["shard"]] += r["bytes"]
        slots[r["shard"]].append(r["slot"])
    assert all(abs(by[k] - total / shards_) <= 0.01 * total / shards_ + largest for k in range(shards_))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_a_third_of_all_rows_are_one_row(spark):
    """Shards stay even, no task of the last exchange has over twice the mean, and reruns on other partitions agree."""
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(2000)] + [(77, "the same row")] * 1000 + [(None, None)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = shards(docs)
    assert len(got) == len(rows)
    against_order(docs, got)
    slices = defaultdict(int)
    for r in got:
        slices[r["shard"]] += 1
    assert max(slices.values()) <= 2 * len(rows) / 16 + 400  # rows of 1 byte weigh little: many to a shard
    place = lambda rs: sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in rs)
    assert place(got) == place(shards(docs.repartition(3)))


def test_against_order(spark):
    docs = spark.createDataFrame([(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 17 + 1)) for i in range(3000)], "doc_id long, text string").repartition(5)
    against_order(docs, shards(docs))
    one = spark.createDataFrame([(5, "x")] * 400, "doc_id long, text string").repartition(7)
    got = shards(one)
    sizes = defaultdict(int)
    for r in got:
        sizes[r["shard"]] += 1
    assert set(sizes.values()) <= {24, 25, 26} and len(sizes) == 16
