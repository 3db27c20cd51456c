"""Two tokenizers over the same text: merge-path partitioning of their token ends, overlaps a piece, pieces stitched into groups.

A text's token ends are two ascending sequences. The k-th diagonal of their merge (i ends of A and j of B with i + j = k) is
found by a binary search, so that the merge falls into pieces of equal work that don't need one another. A piece finds the
ends that both have (overlaps), the groups between them, and the open ones at its borders; groups that a border cuts are
stitched from their pieces. A batch of short texts is merged the same way, as one pair of sequences; long texts are dealt
out piece by piece. What a link counts corpus-wide is told by pairs: those with at least one in 2 ** 19 of all links (so 2 ** 19
at most) are broadcast, all others are joined.

Texts are encoded part by part (a run of white space with what follows it, and what follows white space that a piece of B may
end in): no token of either tokenizer spans two parts, as A's pattern ends a match where white space begins, so parts are remembered and a whole text's ids are those of its parts.

Defined results: null and empty texts, and texts whose joined A or B bytes aren't a blank and the text (U+2581 in a text, for
one), have no tokens: zeros and ''. Repeated rows are each aligned and each count; null ids are kept; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.bpe import WHITE
from watchloom.llm.common import materialise, need, pieces, prepare, shared_dir, text_of

#: Characters of a text that is merged where it is read; token ends of a piece.
SHORT, WORK = 1 << 16, 1 << 14
#: Of all links, the share from which on a pair is broadcast: so many pairs at most.
HEAVY = 1 << 19
#: Parts that a worker remembers, and their characters.
REMEMBERED, REMEMBERED_CHARS = 400_000, 16 << 20
#: Characters that are given to a tokenizer at once.
BULK = 1 << 14


def byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: the bytes of each id, and the ids of many parts at once."""

    def __init__(self, token_bytes: list[bytes], encode, within: str = "") -> None:  # noqa: ANN001
        self.bytes, self.encode, self.within = token_bytes, encode, within  # within: white space that a token may have behind other characters
        self.length = np.array([len(x) for x in token_bytes], np.int64)


def byte_side(path: str) -> Side:
    """A byte-level BPE in the tokenizers library's format, whose pattern ends a match where white space begins; strings of special tokens are plain text.

    If each merge makes a token of a higher id than the one before, ids are ranks, and tiktoken encodes by them; else tokenizers does.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    table = byte_level()
    vocabulary = model["vocab"]
    token_bytes = [b""] * (1 + max(vocabulary.values()))
    for token, i in vocabulary.items():
        token_bytes[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made == sorted(made) and len({*made}) == len(made):
        import public_tokenizers
        import tiktoken

        ranks = {token_bytes[i]: i for token, i in vocabulary.items() if len(token) == 1} | {token_bytes[i]: i for i in made}
        coder = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Side(token_bytes, lambda texts: list(map(coder.encode_ordinary, texts)))
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return Side(token_bytes, lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)])


def piece_side(path: str) -> Side:
    """A sentencepiece model that sets a blank before the text: a part's own first blank is left to it."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    blank = m.piece_to_id("▁")
    names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
    token_bytes = [bytes([int(x[3:5], 16)]) if m.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    texts = [x.decode("utf-8", "ignore") for x in token_bytes]
    within = {c for x in texts for c in re.findall(f"[^{WHITE}]([{WHITE}])", x)}
    if any((x := re.match(f" (?! )([{WHITE}])", t)) and x[1] not in within for t in texts):
        raise ValueError("a piece is a blank with other white space: texts can't be encoded part by part")

    def encode(parts: list[str]) -> list[list[int]]:
        return [ids or [blank] for ids in m.encode([p[1:] for p in parts], num_threads=1)]

    return Side(token_bytes, encode, "".join(sorted(within)))


class Pair:
    """Both tokenizers, and the ids of the parts met so far: A's and B's in one array each, found by slot."""

    def __init__(self, a: Side, b: Side) -> None:
        more = f"(?:[{re.escape(b.within)}][{WHITE}]*[^{WHITE}]*)*" if b.within else ""
        self.a, self.b, self.split = a, b, re.compile(f"[{WHITE}]*[^{WHITE}]+{more}|[{WHITE}]+").findall
        self.white = frozenset(re.findall(f"[{WHITE}]", "".join(map(chr, range(0x3001)))))
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.at = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.good = np.zeros(0, bool)
        self.chars = 0

    def learn(self, parts: list[str]) -> None:
        """Encode parts, each once: those between blanks many in a row, cut at their bytes; the others by themselves."""
        chunks, plain, odd, size = [], [], [], BULK
        for p in parts:
            if p[0] == " " and p[-1] not in self.white and "▁" not in p:
                if size >= BULK:
                    chunks.append([])
                    size = 0
                chunks[-1].append(p)
                size += len(p)
                plain.append(p)
            else:
                odd.append(p)
        raw = ["".join(c) for c in chunks]
        ends = np.cumsum([len(p.encode()) for p in plain], dtype=np.int64)
        got, whole = [], "".join(raw).encode()
        for side in (self.a, self.b):
            ids = np.fromiter((i for x in side.encode(raw) for i in x), np.int32)
            stops = np.cumsum(side.length[ids])
            at = np.searchsorted(stops, ends)
            same = b"".join(map(side.bytes.__getitem__, ids.tolist())) == whole and (stops[np.minimum(at, len(stops) - 1)] == ends).all()
            got.append((ids, at + 1) if same else None)
        if None in got:
            got, plain, odd = [(np.zeros(0, np.int32), np.zeros(0, np.int64))] * 2, [], parts
        self.keep(plain, got, [True] * len(plain))
        if odd:
            self.keep(odd, *self.one_by_one(odd))

    def one_by_one(self, parts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[bool]]:
        """(ids and ends of A's and B's, whether both give the part's bytes). A part that begins without a blank is given to B with one, which goes again."""
        bare = [p[:1] != " " for p in parts]
        found = [self.a.encode(parts), self.b.encode([" " + p if x else p for p, x in zip(parts, bare, strict=True)])]
        found[1] = [b[1:] if x else b for b, x in zip(found[1], bare, strict=True)]  # the blank: no token of B is a blank with other white space
        good = [all(b"".join(map(side.bytes.__getitem__, f[k])) == p.encode() for side, f in zip((self.a, self.b), found, strict=True)) for k, p in enumerate(parts)]
        return [(np.fromiter((i for x in f for i in x), np.int32), np.cumsum([len(x) for x in f], dtype=np.int64)) for f in found], good

    def keep(self, parts: list[str], got: list[tuple[np.ndarray, np.ndarray]], good: list[bool]) -> None:
        for k, (ids, ends) in enumerate(got):
            self.at[k] = np.concatenate([self.at[k], self.at[k][-1] + ends])
            self.ids[k] = np.concatenate([self.ids[k], ids])
        self.good = np.concatenate([self.good, np.array(good, bool)])
        for p in parts:
            self.slot[p] = len(self.slot)
            self.chars += len(p)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A's ids, tokens of A a text, B's ids, tokens of B a text) of all texts in a row; a text without tokens has 0 of both."""
        if len(self.slot) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        found = [self.split(" " + t) if t else [] for t in texts]
        new = {p: None for parts in found for p in parts if p not in self.slot}
        if new:
            self.learn(list(new))
        slots = np.fromiter((self.slot[p] for parts in found for p in parts), np.int64)
        ends = np.cumsum([0, *map(len, found)])
        bad = np.concatenate([[0], np.cumsum(~self.good[slots])])
        lost = bad[ends[1:]] > bad[ends[:-1]]
        keep = ~np.repeat(lost, np.diff(ends))
        slots, many = slots[keep], np.where(lost, 0, np.diff(ends))
        out = []
        for k in (0, 1):
            n = self.at[k][slots + 1] - self.at[k][slots]
            stop = np.cumsum(n)
            out += [self.ids[k][np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.at[k][slots] - stop + n, n)]]
            whole = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(many)])]
            out += [np.diff(whole)]
        return out[0], out[1], out[2], out[3]


@functools.cache
def loaded(a_file: str, b_file: str) -> Pair:
    return Pair(byte_side(a_file), piece_side(b_file))


# --- merge path ----------------------------------------------------------------------------------


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of `work` ends begin in a and in b, the ends of both included: a binary search along each diagonal.

    a and b ascend. Of equal ends A's comes first; a diagonal between two equal ends moves past the second, so an overlap is never cut.
    """
    cut = np.arange(0, len(a) + len(b), work, dtype=np.int64)
    low, high = np.maximum(0, cut - len(b)), np.minimum(cut, len(a))
    while (open_ := low < high).any():
        i = (low + high) // 2
        ahead = np.zeros(len(cut), bool)  # a[i] belongs before the diagonal
        at = np.flatnonzero(open_)
        ahead[at] = a[i[at]] <= b[cut[at] - i[at] - 1]
        low, high = np.where(open_ & ahead, i + 1, low), np.where(open_ & ~ahead, i, high)
    j = cut - low
    split = (low > 0) & (j < len(b))
    at = np.flatnonzero(split)
    j[at] += a[low[at] - 1] == b[j[at]]
    return np.append(low, len(a)), np.append(j, len(b))


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the ends that both have, in order; each sequence ascends strictly."""
    at = np.searchsorted(b, a)
    hit = np.flatnonzero(at < len(b))
    hit = hit[b[at[hit]] == a[hit]]
    return hit, at[hit]


def merged(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """The same by independent pieces."""
    i, j = diagonals(a, b, work)
    got = [overlaps(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]) for k in range(len(i) - 1)]
    return np.concatenate([np.zeros(0, np.int64), *(x + i[k] for k, (x, _) in enumerate(got))]), np.concatenate([np.zeros(0, np.int64), *(y + j[k] for k, (_, y) in enumerate(got))])


def listed(ids: np.ndarray) -> list[str]:
    return list(map(str, ids.tolist()))


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[str]:
    """A group of each overlap: the tokens after the one before it, up to its own. Groups of two tokens, most of them, are written once each."""
    out = np.empty(len(x), object)
    p, q = (np.append(0, k[:-1] + 1)[: len(k)] for k in (x, y))
    two = (p == x) & (q == y)
    codes, which = np.unique(a_ids[x[two]].astype(np.int64) << 32 | b_ids[y[two]].astype(np.int64), return_inverse=True)
    out[two] = np.array([f"{c >> 32}|{c & 0xFFFFFFFF}" for c in codes.tolist()], object)[which]
    more, a, b = np.flatnonzero(~two), a_ids.tolist(), b_ids.tolist()
    for k, *at in zip(more.tolist(), p[more].tolist(), (x[more] + 1).tolist(), q[more].tolist(), (y[more] + 1).tolist(), strict=True):
        out[k] = f"{','.join(map(str, a[at[0] : at[1]]))}|{','.join(map(str, b[at[2] : at[3]]))}"
    return out.tolist()


MERGED = "_row long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"


def aligned(docs: DataFrame, a_file: str, b_file: str, *, column: str = "text", short: int = SHORT, work: int = WORK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256 of each row, and its links: 32-bit numbers (A's id * size of B + B's id) in order.

    The result is a written table, with a number of its own a row (`_row`).
    """
    spark = prepare(docs.sparkSession)
    for f in (a_file, b_file):
        spark.sparkContext.addFile(f)
    names = [f.rsplit("/", 1)[-1] for f in (a_file, b_file)]
    load = lambda: loaded(*map(SparkFiles.get, names))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(docs["doc_id"], text_of(column).alias("_text"))
    long = F.length("_text") > short

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load()
        for b in pieces(batches, "_text"):
            a_ids, a_n, b_ids, b_n = pair.encode(b.column("_text").to_pylist())
            a_end, b_end = np.cumsum(pair.a.length[a_ids]), np.cumsum(pair.b.length[b_ids])
            x, y = merged(a_end, b_end, work)
            texts = group_texts(a_ids, b_ids, x, y)
            links = (a_ids[x].astype(np.int64) * len(pair.b.bytes) + b_ids[y]).astype("<u4")
            at = np.concatenate([[0], np.searchsorted(x, np.cumsum(a_n))]).tolist()
            sha = [hashlib.sha256(";".join(texts[p:q]).encode()).hexdigest() if q > p else "" for p, q in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_row"), pa.array(a_n), pa.array(b_n), pa.array(np.diff(at)), pa.array(sha), pa.array([links[p:q].tobytes() for p, q in zip(at, at[1:], strict=False)], pa.binary())], names=["doc_id", "_row", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of a text: where its first ends are, and its ids; a text without tokens has one, an empty one."""
        pair = load()
        for b in pieces(batches, "_text", 1):
            a_ids, _, b_ids, _ = pair.encode(b.column("_text").to_pylist())
            a_end, b_end = np.cumsum(np.append(0, pair.a.length[a_ids])), np.cumsum(np.append(0, pair.b.length[b_ids]))
            i, j = diagonals(a_end[1:], b_end[1:], work)
            i, j = (i, j) if len(i) > 1 else (np.zeros(2, np.int64), np.zeros(2, np.int64))
            for k in range(len(i) - 1):
                parts = (a_ids[i[k] : i[k + 1]], b_ids[j[k] : j[k + 1]])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_row"), pa.array([k], pa.int32()), pa.array([a_end[i[k]]], pa.int64()), pa.array([b_end[j[k]]], pa.int64()), *(pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in parts)], names=["doc_id", "_row", "_piece", "_a_at", "_b_at", "_a", "_b"])

    texts = ("closed", "head_a", "head_b", "tail_a", "tail_b")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A piece's overlaps: links, groups closed in it, and the tokens before the first and after the last overlap."""
        pair = load()
        for b in batches:
            rows = []
            for r in b.select(["_a_at", "_b_at", "_a", "_b"]).to_pylist():
                a_ids, b_ids = np.frombuffer(r["_a"], "<u4"), np.frombuffer(r["_b"], "<u4")
                x, y = overlaps(r["_a_at"] + np.cumsum(pair.a.length[a_ids]), r["_b_at"] + np.cumsum(pair.b.length[b_ids]))
                links = (a_ids[x].astype(np.int64) * len(pair.b.bytes) + b_ids[y]).astype("<u4").tobytes()
                p, q = (x[0] + 1, y[0] + 1) if len(x) else (len(a_ids), len(b_ids))
                s, t = (x[-1] + 1, y[-1] + 1) if len(x) else (p, q)
                ids = lambda k: ",".join(listed(k))
                rows.append((len(a_ids), len(b_ids), links, ";".join(group_texts(a_ids, b_ids, x, y)[1:]), ids(a_ids[:p]), ids(b_ids[:q]), ids(a_ids[s:]), ids(b_ids[t:])))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_row"), b.column("_piece"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "_row", "_piece", "n_a", "n_b", "links", *texts])

    def stitch(table: pa.Table) -> pa.Table:
        table = table.sort_by("_piece")
        sha, first, a, b = hashlib.sha256(), True, [], []
        for r in table.select(["links", *texts]).to_pylist():
            a += [r["head_a"]] if r["head_a"] else []
            b += [r["head_b"]] if r["head_b"] else []
            if r["links"]:
                group = [f"{','.join(a)}|{','.join(b)}", *([r["closed"]] if r["closed"] else [])]
                sha.update((("" if first else ";") + ";".join(group)).encode())
                first, a, b = False, [r["tail_a"]] if r["tail_a"] else [], [r["tail_b"]] if r["tail_b"] else []
        links = b"".join(table["links"].to_pylist())
        n_a, n_b = (sum(table[c].to_pylist()) for c in ("n_a", "n_b"))
        one = [pa.array([n_a]), pa.array([n_b]), pa.array([len(links) // 4]), pa.array(["" if first else sha.hexdigest()]), pa.array([links], pa.binary())]
        return pa.Table.from_arrays([table["doc_id"][:1], table["_row"][:1], *one], names=["doc_id", "_row", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    number = F.monotonically_increasing_id() * 2
    few = rows.where(~long).withColumn("_row", number).mapInArrow(near, f"doc_id {kind}, {MERGED}")
    far = rows.where(long).withColumn("_row", number + 1).mapInArrow(cut, f"doc_id {kind}, _row long, _piece int, _a_at long, _b_at long, _a binary, _b binary").repartition("_row", "_piece")
    done = far.mapInArrow(each, f"doc_id {kind}, _row long, _piece int, n_a long, n_b long, links binary, " + ", ".join(f"{c} string" for c in texts))
    back = done.groupBy("_row").applyInArrow(stitch, f"doc_id {kind}, {MERGED}")
    path = shared_dir(spark)
    few.unionByName(back).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """pair, n, best: how many links have a pair, and whether no pair of its B id has more; tasks add up their own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pair, n = np.unique(np.frombuffer(b"".join(b.column("links").to_pylist()), "<u4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], names=["pair", "n"])

    counts = materialise(rows.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    b = (F.col("pair") % b_size).cast("int").alias("_b")
    most = counts.groupBy(b).agg(F.max("n").alias("_most"))  # a row an id of B
    return counts.withColumn("_b", b).join(F.broadcast(most), "_b").select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def scored(rows: DataFrame, b_size: int, heavy: int = HEAVY) -> DataFrame:
    """rows with n_links, n_best, count_sum instead of links."""
    counts = materialise(pair_counts(rows, b_size))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") * heavy >= total
    few = counts.where(often).orderBy("pair").toPandas()  # `heavy` pairs at most
    held = rows.sparkSession.sparkContext.broadcast((few["pair"].to_numpy(np.int64), few["n"].to_numpy(np.int64), few["best"].to_numpy(bool)))

    def places(links: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pairs of a row, where they are broadcast, whether they are)."""
        pair, known = np.frombuffer(links, "<u4").astype(np.int64), held.value[0]
        at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
        return pair, at, known[at] == pair if len(known) else np.zeros(len(pair), bool)

    names = ["doc_id", "_row", "n_a", "n_b", "n_groups", "groups_sha256"]
    kept = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, n, best = held.value
        for b in batches:
            got = [places(x) for x in b.column("links").to_pylist()]
            at = [p[hit] for _, p, hit in got]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array([len(p) for p, _, _ in got], pa.int64()), pa.array([int(best[p].sum()) for p in at], pa.int64()), pa.array([int(n[p].sum()) for p in at], pa.int64())], names=[*names, "n_links", "n_best", "count_sum"])

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, pair, times = [], [], []
            for r, x in zip(b.column("_row").to_pylist(), b.column("links").to_pylist(), strict=True):
                p, _, hit = places(x)
                u, c = np.unique(p[~hit], return_counts=True)
                row.append(np.full(len(u), r, np.int64))
                pair.append(u)
                times.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (row, pair, times)], names=["_row", "pair", "times"])

    rare = rows.select("_row", "links").mapInArrow(unknown, "_row long, pair long, times long").join(counts.where(~often), "pair")
    sums = rare.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    main = rows.select(*names, "links").mapInArrow(known, f"{kept}, n_links long, n_best long, count_sum long").join(sums, "_row", "left")
    add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return main.select("doc_id", "n_a", "n_b", "n_groups", "n_links", add("n_best", "_best"), add("count_sum", "_sum"), "groups_sha256")


def alignment(docs: DataFrame, a_file: str, b_file: str, **how) -> DataFrame:  # noqa: ANN003
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
    return scored(aligned(docs, a_file, b_file, **how), size)


def op11_merge_path_alignment(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    import public_tokenizers

    docs = need(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    out = alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
