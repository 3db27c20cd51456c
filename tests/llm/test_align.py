import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from watchloom.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """The contract, text by text, by the two libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    t, m = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    table = align.byte_level()
    a_bytes = lambda i: bytes(table[c] for c in t.id_to_token(i))
    b_bytes = lambda i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for text in texts:
        a, b, raw = (t.encode(" " + text, add_special_tokens=False).ids, m.encode(text), (" " + text).encode()) if text else ([], [], b"")
        if b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            a, b = [], []
        ends = [dict(zip(np.cumsum([len(f(i)) for i in ids]).tolist() if ids else [], range(1, len(ids) + 1), strict=True)) for f, ids in ((a_bytes, a), (b_bytes, b))]
        shared = sorted(ends[0].keys() & ends[1].keys())
        links = [(a[ends[0][e] - 1], b[ends[1][e] - 1]) for e in shared]
        groups, p, q = [], 0, 0
        for e in shared:
            groups.append(",".join(map(str, a[p : ends[0][e]])) + "|" + ",".join(map(str, b[q : ends[1][e]])))
            p, q = ends[0][e], ends[1][e]
        found.append((a, b, groups, links))
    counts = Counter(x for *_, links in found for x in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (len(a), len(b), len(g), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for a, b, g, links in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["▁ a", "<|endoftext|> and <s> </s> <unk>", " leading", "trailing ", "  two  blanks  ", "\n\n\ttabs\r\n", "a　b\xa0c  d", "naïve café — “quotes” …", "日本語のテキスト", "👩‍👩‍👧 \x00 \x1f", "don't we'll", "é", "a" * 3000, " ", "\n", "x\n \ny", "f(a);\r\n};\r\n\r\n end \r", "a)\r b\r", "﻿bom"]


def check(docs, **how):
    got = sorted((str(r["doc_id"]), *[r[c] for c in COLUMNS]) for r in align.alignment(docs, A, B, **how).collect())
    rows = docs.select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), *x) for r, x in zip(rows, brute([r["text"] for r in rows]), strict=True))
    assert got == want
    return want


def test_awkward_rows(spark, awkward, nothing):
    odd = spark.createDataFrame(list(enumerate(ODD, 100)), "doc_id long, text string")
    want = check(awkward.select("doc_id", "text").union(odd))
    assert any(not x[1] for x in want) and align.alignment(nothing, A, B).collect() == []


@pytest.mark.parametrize("work", [1, 7, 1 << 14])
def test_long_texts_are_stitched(spark, awkward, work):
    """Texts above `short` go by pieces of `work` ends, whatever their number; the result is the same."""
    some = awkward.where("doc_id <> 7 or doc_id is null").select("doc_id", "text")
    check(some.union(spark.createDataFrame([(200, " ".join(ODD)), (201, "▁" * 99)], some.schema)), short=20, work=work)


def test_rare_pairs_are_joined(awkward, monkeypatch):
    """With few pairs broadcast, the others' counts come from the join."""
    monkeypatch.setattr(align.scored, "__defaults__", (3,))
    check(awkward.where("doc_id <> 7 or doc_id is null"))


def test_many_equal_rows(spark):
    r = random.Random(1)
    rows = [(i, "the same words again" if i % 3 == 0 else " ".join(r.choice(["the", "unlikely", "Zebra", "1234"]) for _ in range(9))) for i in range(600)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 9))
def test_merge_path(x, y, work):
    a, b = np.array(sorted(x), np.int64), np.array(sorted(y), np.int64)
    i, j = align.diagonals(a, b, work)
    assert (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all() and (i[-1], j[-1]) == (len(a), len(b))
    assert all(p + q <= work + 1 for p, q in zip(np.diff(i), np.diff(j), strict=True))
    p, q = align.merged(a, b, work)
    assert a[p].tolist() == b[q].tolist() == sorted(x & y)


def test_query(spark):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in align.op11_merge_path_alignment(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert got == dict(zip([r["doc_id"] for r in docs], brute([r["text"] for r in docs]), strict=True))
