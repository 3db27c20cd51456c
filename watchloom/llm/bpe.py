"""Byte-level BPE: chunks with an overlap are pre-tokenised in parallel, stitched, then their pieces are encoded.

A match of the pattern depends only on the text from its start on. Two chains of matches that
share a boundary are therefore the same from there on. A long text is cut into chunks; each chunk's chain
begins at its own start, which may be inside a piece, and runs on into the next chunk. The chain
of the next chunk is right from the first boundary that both share in the overlap; matches
near the end of what a chunk sees are left out, as more text could change them. If an overlap shares no
boundary (a piece longer than the overlap), the text is encoded anew as one. Decoding
concatenates the bytes of the ids.

Matches are taken part by part: a part is a run of white space with what follows it up to the next one (`PARTS`). A pattern
that looks back nowhere and has no white space behind another character in a match has a boundary wherever a part begins, so
a part's ids don't depend on its surroundings, and frequent parts are remembered. For another pattern give parts=None: then
each match is taken by itself.

Defined results: null texts count as empty, with no ids; other columns are not touched; repeated rows
are each encoded; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, need, pieces, prepare, text_of, unused

#: Characters of a chunk, and how far it looks into the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 10
#: Pieces and parts whose ids a worker remembers, twice at most: the last so many, and as many before them.
REMEMBERED = 150_000
#: Fixed value: what Unicode calls white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and what follows it up to the next; these matches tile a text.
PARTS = f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+"


class Memory(dict):
    """key -> make(key). When `most` are held, those not asked for since the last time are forgotten."""

    def __init__(self, make, most: int = 0) -> None:  # noqa: ANN001
        self.make, self.most, self.old = make, most or REMEMBERED, {}

    def __missing__(self, key: str) -> bytes:
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = out
        return out

    def forget(self) -> None:
        self.clear()
        self.old = {}


class Coder:
    """Encodes and decodes by a rank file; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, rank_file: str, pattern: str, parts: str | None = PARTS) -> None:
        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.pieces = Memory(self.piece)
        self.parts = Memory(lambda part: b"".join(map(self.pieces.__getitem__, self.pattern.findall(part)))) if parts else self.pieces
        self.split = re.compile(parts).findall if parts else self.pattern.findall
        size = 1 + max(self.ranks.values(), default=0)
        by_id = [b""] * size
        for raw, i in self.ranks.items():
            by_id[i] = raw
        self.data, self.length = np.frombuffer(b"".join(by_id), np.uint8), np.array([len(x) for x in by_id], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def piece(self, piece: str) -> bytes:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        ids = [rank] if rank is not None else self.merge(raw)
        return struct.pack(f"<{len(ids)}I", *ids)

    def merge(self, raw: bytes) -> list[int]:
        """Join the neighbours of lowest rank, the leftmost first, until none is in the table."""
        if len(raw) > 256:
            return self.merge_long(raw)
        ranks, parts = self.ranks, [raw[i : i + 1] for i in range(len(raw))]
        pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            low = min(pairs)
            if low == 1 << 60:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        return [ranks[p] for p in parts]

    def merge_long(self, raw: bytes) -> list[int]:
        """The same with a heap over linked neighbours, for pieces of many bytes."""
        import heapq

        n, ranks = len(raw), self.ranks
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != to:
                continue
            alive[j], end[i], after[i] = False, end[j], after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := ranks.get(raw[k : end[after[k]]])) is not None:
                    heapq.heappush(heap, (r, k, end[after[k]]))
        return [ranks[raw[i : end[i]]] for i in range(n) if alive[i]]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.split(text)))

    def forget(self) -> None:
        """At the end of a task: idle workers stay with an executor, so they should hold little beside the stages that follow."""
        self.parts.forget()
        self.pieces.forget()
        pa.default_memory_pool().release_unused()

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, length of each)."""
        length = self.length[ids]
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ids) else 0) + np.repeat(self.start[ids] - ends + length, length)
        return self.data[at], length


@functools.cache
def coder(rank_file: str, pattern: str, parts: str | None) -> Coder:
    return Coder(rank_file, pattern, parts)


#: Places and offsets into the ids, of boundaries.
Marks = list[tuple[int, int]]


def chain(c: Coder, text: str, start: int, stop: int, final: bool, overlap: int = OVERLAP) -> tuple[Marks, Marks, bytes]:
    """(boundaries in the first overlap, boundaries from `stop` on, ids) of a chunk that begins at `start` of its document.

    It covers [start, stop) and sees the overlap beyond. Unless it is the last chunk, parts that
    touch the end of what it sees, or whose next character isn't seen, are left out.
    """
    found = c.split(text)
    at = list(accumulate(map(len, found), initial=start))
    if not final:
        while found and at[-1] >= start + len(text) - 1:
            at.pop()
            found.pop()
    ids = list(map(c.parts.__getitem__, found))
    marks = list(zip(at, accumulate(map(len, ids), initial=0), strict=True))
    return [m for m in marks if m[0] < start + overlap], [m for m in marks if m[0] >= stop], b"".join(ids)


def stitch(chunks: list[tuple[Marks, Marks, bytes]]) -> bytes | None:
    """Ids of a document from its chunks' chains; None if two of them share no boundary."""
    out, begin = [], 0
    for (_, tail, ids), (head, _, _) in zip(chunks, chunks[1:], strict=False):
        places = dict(head)
        shared = next(((p, k) for p, k in tail if p in places and k >= begin), None)
        if shared is None:
            return None
        out.append(ids[begin : shared[1]])
        begin = places[shared[0]]
    return b"".join([*out, chunks[-1][2][begin:]])


def encode_text(c: Coder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> bytes:
    """One text by chunks, as `encode` does it over a cluster."""
    n = len(text)
    spans = [(s, min(n, s + chunk)) for s in range(0, max(n, 1), chunk)]
    ids = stitch([chain(c, text[s : e + overlap], s, e, e == n, overlap) for s, e in spans])
    return c.encode(text) if ids is None else ids


def tables(spark, rank_file: str, pattern: str, parts: str | None = PARTS):  # noqa: ANN001, ANN201
    """Ship the rank file to the executors; gives a function that loads it there."""
    name = rank_file.rsplit("/", 1)[-1]
    spark.sparkContext.addFile(rank_file)
    return lambda: coder(SparkFiles.get(name), pattern, parts)


def encode(docs: DataFrame, rank_file: str, pattern: str, *, column: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, parts: str | None = PARTS, keep: list[str] | None = None) -> DataFrame:
    """docs with `ids` (binary, unsigned 32-bit little-endian); keep: the columns to return with it, all if not given.

    Texts of one chunk are encoded where they are read. Longer ones are dealt out chunk by chunk, so
    that the pre-tokenising of one text runs in parallel; ids and boundaries meet by text for the stitching.
    """
    spark = prepare(docs.sparkSession)
    load = tables(spark, rank_file, pattern, parts)
    fields = [f for f in docs.schema.fields if f.name != "ids" and (keep is None or f.name in keep)]
    names = [f.name for f in fields]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    text = unused(docs, "_text")
    docs = docs.select(*[docs[n] for n in names], docs[column].alias(text))
    long = F.length(text_of(text)) > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = load()
        for b in pieces(batches, text):
            ids = pa.array([c.encode(t or "") for t in b.column(text).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), ids], names=[*names, "ids"])
        c.forget()

    short = docs.where(~long).mapInArrow(whole, f"{out}, ids binary")
    doc = unused(docs, "_doc")  # equal texts share their ids
    rows = docs.where(long).withColumn(doc, F.sha2(docs[text], 256))
    n = F.length(text)
    span = lambda s: F.struct(s.alias("_start"), F.substr(text, s + 1, F.lit(chunk + overlap)).alias("_piece"))
    texts = rows.select(F.col(doc).alias("_doc"), text).groupBy("_doc").agg(F.first(text).alias(text))  # a task sends a text once, however often it has it
    cut = texts.select("_doc", n.alias("_n"), F.inline(F.transform(F.sequence(F.lit(0), n - 1, F.lit(chunk)), span))).repartition("_doc", "_start")
    marks = "array<struct<at:int,offset:int>>"

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = load()
        kind = pa.list_(pa.struct([("at", pa.int32()), ("offset", pa.int32())]))
        for b in pieces(batches, "_piece"):
            cols = [b.column(k).to_pylist() for k in ("_start", "_n", "_piece")]
            got = [chain(c, t, s, s + chunk, s + chunk >= n, overlap) for s, n, t in zip(*cols, strict=True)]
            pair = lambda m: [{"at": p, "offset": k} for p, k in m]
            yield pa.RecordBatch.from_arrays([b.column("_doc"), b.column("_start"), pa.array([pair(h) for h, _, _ in got], kind), pa.array([pair(t) for _, t, _ in got], kind), pa.array([i for *_, i in got], pa.binary())], names=["_doc", "_start", "_head", "_tail", "_ids"])
        c.forget()

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_start")
        pair = lambda m: [(x["at"], x["offset"]) for x in m]
        ids = stitch([(pair(h), pair(t), bytes(i)) for h, t, i in zip(pdf["_head"], pdf["_tail"], pdf["_ids"], strict=True)])
        return pd.DataFrame({"_doc": pdf["_doc"].iloc[:1], "ids": [ids]})

    chained = cut.mapInArrow(chains, f"_doc string, _start int, _head {marks}, _tail {marks}, _ids binary")
    stitched = materialise(chained.groupBy("_doc").applyInPandas(join, "_doc string, ids binary").withColumnRenamed("_doc", doc))
    done = short.unionByName(rows.select(*names, doc).join(stitched.where("ids is not null"), doc).drop(doc))
    lost = stitched.where("ids is null").select(doc)
    if not lost.limit(1).count():
        return done
    return done.unionByName(rows.join(lost, doc, "left_semi").mapInArrow(whole, f"{out}, ids binary"))


def decode(coded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """coded with `decoded`, the bytes of its ids."""
    load = tables(coded.sparkSession, rank_file, pattern)
    fields = [f for f in coded.schema.fields if f.name != "decoded"]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = load()
        for b in pieces(batches, "ids"):
            raw = [x or b"" for x in b.column("ids").to_pylist()]
            data, length = c.decode(np.frombuffer(b"".join(raw), "<u4"))
            ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum([0, *(len(x) // 4 for x in raw)])]
            decoded = pa.Array.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), decoded.cast(pa.binary())], names=[*(f.name for f in fields), "decoded"])

    return coded.select(*[coded[f.name] for f in fields]).mapInArrow(run, f"{out}, decoded binary")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, by the public 50k vocabulary."""
    import public_tokenizers

    at = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    back = decode(encode(need(docs, "doc_id", "text"), *at, keep=["doc_id"]), *at)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
