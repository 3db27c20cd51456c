import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken

from watchloom.llm import bpe

AT = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(AT[0], "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pack(ids):
    return np.array(ids, "<u4").tobytes()


def test_pieces_and_long_pieces(library):
    c = bpe.Coder(*AT)
    r = random.Random(3)
    for n in (1, 2, 5, 300, 3000):
        t = "".join(r.choice("abcdeéß語🙂") for _ in range(n))
        assert c.encode(t) == pack(library.encode_ordinary(t))
    data, length = c.decode(np.frombuffer(c.encode("a\u0000b\r\n  é"), "<u4"))
    assert data.tobytes() == "a\u0000b\r\n  é".encode() and length.sum() == len(data)


def test_white_space_is_that_of_the_pattern():
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x20000)))
    assert re.findall(f"[{bpe.WHITE}]", every) == regex.findall(r"\s", every)


def test_parts_change_nothing(library):
    one, other = bpe.Coder(*AT), bpe.Coder(*AT, None)
    r = random.Random(8)
    alphabet = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u200b", "'s", "'", "a", "Zß", "12", "!", "!?", "語", "🙂", "\0"]
    for _ in range(2000):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 14)))
        assert one.encode(t) == other.encode(t) == pack(library.encode_ordinary(t)), t


def test_a_full_memory_forgets_and_stays_right(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    c = bpe.Coder(*AT)
    t = "one two three four five six one two one two seven " * 3
    assert c.encode(t) == pack(library.encode_ordinary(t)) and len(c.parts) <= 3 and len(c.parts.old) <= 3


def test_a_coder_that_forgot_encodes_as_before(library):
    c = bpe.Coder(*AT)
    t = "one two three, four one two; Straße 語 " * 20
    for _ in range(2):
        assert c.encode(t) == pack(library.encode_ordinary(t)) and len(c.parts)
        c.forget()
        assert not any(map(len, (c.parts, c.parts.old, c.pieces, c.pieces.old)))


@pytest.mark.parametrize("overlap", [2, 8, 40])
def test_stitching_is_exact(library, overlap):
    c = bpe.Coder(*AT)
    r = random.Random(overlap)
    alphabet = ["it's", "'ll", "  ", "\n\n ", "word", "Wörter", "1234567890" * 3, "!!!", " ", "x" * 90, "\t", "語" * 50, "<|endoftext|>", "'"]
    for _ in range(150):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        assert bpe.encode_text(c, t, chunk=32, overlap=overlap) == pack(library.encode_ordinary(t)), t


def test_frames(spark, awkward, nothing, library):
    short = bpe.encode(awkward, *AT).collect()
    long = {(r["doc_id"], r["text"]): bytes(r["ids"]) for r in bpe.encode(awkward, *AT, chunk=64, overlap=16).collect()}
    assert len(short) == awkward.count()
    for r in short:
        assert bytes(r["ids"]) == pack(library.encode_ordinary(r["text"] or "")) == long[r["doc_id"], r["text"]]
    for r in bpe.encode(awkward, *AT, chunk=64, overlap=16, parts=None, keep=["doc_id", "text"]).collect():
        assert bytes(r["ids"]) == long[r["doc_id"], r["text"]]
    assert set(awkward.columns) == set(bpe.encode(awkward, *AT).columns)
    d = bpe.digests(awkward).collect()
    assert {r["decoded_sha256"] for r in d} == {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in short}
    assert bpe.digests(nothing).count() == 0


def test_copies_of_a_long_text_are_encoded_once_and_spread(spark, vocabulary):
    """A third of all rows are one long text: its chunks are dealt out, and every copy gets the ids."""
    import public_tokenizers
    from collections import Counter

    r = random.Random(3)
    hot = " ".join(r.choice(vocabulary) for _ in range(3000))
    rows = [(i, hot if i % 3 == 0 else " ".join(r.choice(vocabulary) for _ in range(20))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    at = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs, *at, chunk=256, overlap=64)
    plain = bpe.Coder(*at)
    assert Counter((x["doc_id"], bytes(x["ids"])) for x in coded.collect()) == Counter((i, plain.encode(t)) for i, t in rows)
