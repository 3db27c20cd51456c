"""N-gram Jaccard join by parity sketches.

A document's word shingles are hashed into a bit sketch in which each shingle flips one bit. Two sketches differ
in no more bits than the sets differ in elements. A Jaccard similarity of 0.8 allows at most
(|A| + |B|) / 9 differing elements, so of k > that many blocks of the sketch at least one is equal.
Sets are joined by size band: band q holds the sizes from L[q] to below L[q + 2], where L grows by 1 / 0.8,
so each linked pair shares a band, and each set is in two. Blocks with bits are emitted under a hash of
their bits; blocks without any say nothing. k leaves room for them: with d allowed differences, a set with more than d
blocks with bits surely shares one of them with every partner.

Passages that many texts share would make blocks of unlike texts equal. So sketches hold the rarer shingles only: leaving some out of
all sets adds no difference, whichever they are. A bitmap of fixed size tells the common ones, those found in three sets of a task and
COMMON in all. A set whose rarer shingles fill d blocks at most also emits each of them by itself, and if there are no more than d
of them, the blocks of all its shingles (those without bits, too, if it must). Two such sets that share no rarer shingle have as many
differences as rarer shingles, so one of them has d / 2 at most: those with more are only probes of a group, held against
the others but not against one another, and a group of probes alone is dropped. Candidates are then verified on the sets.

No group of equal blocks is expanded into its pairs. First each member is held against the group's first one only; links
give components. Where a group still has several, its members are held against one drawn by a hash of group and member, so that a set meets other
members in each of its groups, again and again as long as that leaves clearly fewer pairs. Only the other members of different components in a group are
compared in a last round, in blocks of bounded size. Pairs inside a component can't change it, so the components are exact. In all rounds
the Hamming distance of short sketches, a few bits a shingle, rules most pairs out before sets are fetched. What is left to the last
round are sets that consist of common shingles but for d / 2 at most: its cost grows with the square of how many of those, not alike, a
passage has.

Identities are 64-bit hashes of the whole set, and where a second hash shows that two sets have the same, that second one, so
identities are as sure as 128 bits; equal sets are one class from the start. Verified sets hold 48 bits a shingle, whatever their size.

Defined results: null or blank texts have no shingles and are components of their own; rows that repeat a doc_id are one
vertex; null ids link others but a component's id is its smallest id that isn't null (null if none); other columns
are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, need, pieces, prepare
from watchloom.llm.mixing import WORD
from watchloom.llm.words import U, mix64, shingles, words_of

#: Bits of a sketch block, as a power of 2; bits of a block's key.
BLOCK_BITS, KEY_BITS = 16, 48
#: Set identities that a task remembers, to emit a copied text once.
SEEN = 1_000_000
#: Rounds with one member a group at most; pairs left to the last round, a set, with which no further one is made.
STARS, LEFT = 6, 2
#: Rows of a block of the last round, about: two blocks give at most the square of that many pairs.
ROUND_ROWS = 256
#: log2 of the bits of the filters of wanted sets and of common shingles; they are broadcast, whatever the input's size.
FILTER_BITS = 25
#: A shingle is common if this many sets of a task hold it (of so many shingles at a time), and so many in all; how many there are at most.
COMMON_IN_TASK, HELD, COMMON, COMMON_MOST = 3, 4_000_000, 8, 1 << 21
#: Identities that two different sets have, at most: they are broadcast.
CLASHES = 100_000


def bands(percent: int = 80) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lowest size, allowed differences, blocks) of each band, up to sets of 2 ** 40."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, -(-low[-1] * 100 // percent)))
    low_ = np.array(low, dtype=np.int64)
    # a band's pairs have their smaller size below low[q + 1]; with b <= a / t, |A| + |B| - 2 |A and B| <= a (1 / t - 1)
    d = (low_[1:] - 1) * (100 - percent) // percent
    k = d + 1 + np.where(d == 0, 0, np.maximum(2, np.ceil(0.06 * d + 0.3 * np.sqrt(d)))).astype(np.int64)
    return low_, d, k


def blocks(s: np.ndarray, q: int, k: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, numbers) of the blocks with bits of a sketch of k blocks, in band q."""
    if not len(s):
        return s, s
    y = mix64(s * U(2 * q + 1) + U(q + 77 + 1000 * level))
    part = ((y >> U(32)) * U(k) >> U(32)) if k < 1 << 31 else y % U(k)
    bit = mix64((y & U((1 << BLOCK_BITS) - 1)) | part << U(BLOCK_BITS) | U(q) << U(56)) * U(2 * level + 1)
    order = np.argsort(part, kind="stable")
    part, bit = part[order], bit[order]
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    keys = np.bitwise_xor.reduceat(bit, at)  # a hash of the block's bits: what is flipped twice cancels out
    own = part[at]
    some = keys != 0
    return keys[some], own[some]


def block_keys(s: np.ndarray, rare: np.ndarray, q: int, d: int, k: int) -> np.ndarray:
    """Keys of a set in band q; odd ones are those of a probe.

    Blocks of its rarer shingles, then each of these, then blocks of all shingles, as far as it takes to be sure of a partner's key.
    """
    even = ~U(1)
    own = s[rare]
    out = [blocks(own, q, k, 0)[0] & even]
    if len(out[0]) > d:
        return out[0]
    out.append(mix64(own * U(2 * q + 1) + U(q + 1077)) & even)
    if len(own) > d:
        return np.concatenate(out)
    keys, full = blocks(s, q, k, 2)
    if len(keys) <= d:
        empty = np.setdiff1d(np.arange(k, dtype=np.uint64), full)
        keys = np.append(keys, mix64(empty << U(8) | U(q) << U(56) | U(1)))
    return np.concatenate([*out, keys & even | U(2 * len(own) > d)])


def short(keys: np.ndarray) -> np.ndarray:
    """Keys by KEY_BITS of their bits, still odd for probes: two empty bytes shrink in the shuffle. Unlike blocks that then meet are only candidates."""
    return keys >> U(64 - KEY_BITS) & ~U(1) | keys & U(1)


def identity(s: np.ndarray, bits: int = 64) -> int:
    return int((mix64(s + U(1)).sum(dtype=np.uint64) >> U(64 - bits)).astype(np.int64)) if len(s) else 0


def second(s: np.ndarray) -> int:
    """Another hash of a set."""
    return int(mix64(s * U(0xD6E8FEB86659FD93) + U(2)).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0


Name = Callable[[np.ndarray], int]


def each_set(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for b in pieces(batches, "text"):
        yield b, shingles(words_of(b.column("text")), width)


def batch(names: list[str], *columns) -> pa.RecordBatch:  # noqa: ANN002
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def read(docs: DataFrame, width: int = 5, bits: int = 64) -> DataFrame:
    """doc_id, mark, n, cid, again of every document, and shingle, often of those that several sets of a task hold.

    cid is the identity of a document's set, again a second one, mark a hash of its text.
    """
    kind = docs.schema["doc_id"].dataType
    names = ["doc_id", "mark", "n", "cid", "again", "shingle", "often"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        ids = None

        def common() -> pa.RecordBatch:
            u, n = np.unique(np.concatenate(held), return_counts=True)
            u, n = u[n >= COMMON_IN_TASK].view(np.int64), n[n >= COMMON_IN_TASK]
            return batch(names, pa.nulls(len(u), ids), *[pa.nulls(len(u), pa.int64())] * 4, u, n)

        for b, sets in each_set(batches, width):
            ids = b.column("doc_id").type
            cids, again = np.array([identity(s, bits) for s in sets], np.int64), np.array([second(s) for s in sets], np.int64)
            none = pa.nulls(b.num_rows, pa.int64())
            yield batch(names, b.column("doc_id"), b.column("mark"), np.array([len(s) for s in sets], np.int64), cids, again, none, none)
            for s, c in zip(sets, again.tolist(), strict=True):
                if len(s) and c not in seen:
                    seen.add(c)
                    held.append(s)
            if len(seen) > SEEN:
                seen.clear()
            if sum(map(len, held)) > HELD:
                yield common()
                held.clear()
        if held:
            yield common()

    rows = need(docs, "doc_id", "text").withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, mark long, n long, cid long, again long, shingle long, often long")


def common_filter(rows: DataFrame) -> np.ndarray:
    """The bitmap of common shingles; where there are too many, of the most frequent ones."""
    often = rows.where("shingle is not null").groupBy("shingle").agg(F.sum("often").alias("n")).where(F.col("n") >= COMMON)
    often = materialise(often.select(F.col("shingle").alias("cid"), F.floor(F.log2("n") * 8).alias("step")))
    least, room = 0, COMMON_MOST
    for r in sorted(often.groupBy("step").count().collect(), key=lambda r: -r["step"]):  # 512 rows at most
        room -= r["count"]
        if room < 0:
            least = r["step"] + 1
            break
    return bit_filter(often.where(F.col("step") >= least))


def named(rows: DataFrame, bits: int = 64) -> tuple[DataFrame, Name]:
    """(doc_id, mark, n, cid of every document, the function that gives a set's cid): different sets have different ones."""
    m = rows.where("shingle is null")
    clash = m.where("n > 0").groupBy("cid").agg(F.min("again").alias("lo"), F.max("again").alias("hi")).where("lo <> hi").select("cid")
    found = frozenset(r["cid"] for r in clash.limit(CLASHES + 1).collect())
    if len(found) > CLASHES:
        raise ValueError(f"more than {CLASHES} identities are those of several sets")
    if found:
        few = m.sparkSession.createDataFrame([(c,) for c in found], "clash long")
        m = m.join(F.broadcast(few), F.col("cid") == F.col("clash"), "left").withColumn("cid", F.when(F.col("clash").isNull(), F.col("cid")).otherwise(F.col("again")))

    def name(s: np.ndarray) -> int:
        c = identity(s, bits)
        return second(s) if c in found else c

    return m.select("doc_id", "mark", "n", "cid"), name


def shared_blocks(docs: DataFrame, common: np.ndarray, name: Name = identity, width: int = 5, percent: int = 80) -> DataFrame:
    """key, cid, pivot, probe, many: the blocks that two or more sets have, not probes alone; pivot is the first of them, not a probe.

    many: there may be more than two. common: the bitmap of common shingles.
    """
    low, d, k = bands(percent)
    shared = docs.sparkSession.sparkContext.broadcast(common.tobytes())

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = np.frombuffer(shared.value, np.uint8), set()
        for _, sets in each_set(batches, width):
            keys, cids = [], []
            for s in sets:
                if not len(s) or (cid := name(s)) in seen:
                    continue
                seen.add(cid)
                rare = ~marked(bits, s.view(np.int64))
                i = int(np.searchsorted(low, len(s), "right")) - 1
                for q in (i, i - 1)[: 1 + (i > 0)]:
                    keys.append(short(block_keys(s, rare, q, int(d[q]), int(k[q]))))
                    cids.append(np.full(len(keys[-1]), cid, np.int64))
            if len(seen) > SEEN:
                seen.clear()
            if keys:
                yield batch(["key", "cid"], np.concatenate(keys).view(np.int64), np.concatenate(cids))

    def share(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, bool] | None = None  # the last group, its first member, whether that isn't a probe
        told = False
        for b in batches:
            ks, cs = np.asarray(b.column("key")), np.asarray(b.column("cid"))
            if not len(ks):
                continue
            new = np.append(True, (ks[1:] != ks[:-1]) | (cs[1:] != cs[:-1]))
            group, probe, cs = ks[new] >> 1, (ks[new] & 1).astype(bool), cs[new]  # probes come last
            start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            length = np.diff(np.append(start, len(group)))
            pivot, full = cs[start], ~probe[start]
            keep, many = (length > 1) & full, length > 2
            many[-1] = True  # it may go on
            lead: list[tuple] = []
            if goes_on := held is not None and group[0] == held[0]:
                pivot[0], full[0], many[0] = held[1], held[2], True
                keep[0] = full[0]
                if keep[0] and not told:
                    lead, told = [(held[0], held[1], held[1], False, True)], True
            each = lambda x: np.repeat(x, length)  # noqa: E731, B023
            kept = each(keep)
            if goes_on:
                kept[: length[0]] &= cs[: length[0]] != held[1]
            first = [np.array([x[i] for x in lead], t) for i, t in enumerate((np.int64, np.int64, np.int64, bool, bool))]
            rows = (group, cs, each(pivot), probe, each(many))
            yield batch(["key", "cid", "pivot", "probe", "many"], *(np.append(x, y[kept]) for x, y in zip(first, rows, strict=True)))
            if not (goes_on and len(start) == 1):
                held, told = (int(group[-1]), int(pivot[-1]), bool(full[-1])), bool(keep[-1])

    rows = need(docs, "text").mapInArrow(emit, "key long, cid long")
    dealt = rows.repartition(F.shiftright("key", 1)).sortWithinPartitions("key", "cid")
    return dealt.mapInArrow(share, "key long, cid long, pivot long, probe boolean, many boolean")


def bit_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** FILTER_BITS bits with one set for each id: tasks OR their own, 64 parts reach the driver."""
    part = 1 << (FILTER_BITS - 9)  # bytes

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            bits[place(np.asarray(b.column("cid")))] = True
        packed = np.packbits(bits).reshape(64, part)
        some = np.flatnonzero(packed.any(axis=1))
        salt = np.full(len(some), TaskContext.get().partitionId() % 64, np.int32)
        yield batch(["part", "salt", "bits"], some.astype(np.int32), salt, pa.array([packed[i].tobytes() for i in some], pa.binary()))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "salt": 0, "bits": [np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pdf["bits"]]).tobytes()]})

    out = np.zeros((64, part), np.uint8)
    kind = "part int, salt int, bits binary"
    marked = ids.select("cid").mapInArrow(mark, kind).groupBy("part", "salt").applyInPandas(join, kind)  # no group grows with the tasks
    for r in marked.groupBy("part").applyInPandas(join, kind).collect():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def place(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.view(np.uint64)) >> U(64 - FILTER_BITS)).astype(np.int64)


def marked(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids a bitmap of bit_filter holds, and a few others."""
    at = place(ids)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def pack(s: np.ndarray) -> bytes:
    """A set's shingles, ascending, by their leading 6 bytes."""
    return np.ascontiguousarray(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    full = np.zeros((len(raw) // 6, 8), np.uint8)
    full[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return full.view(">u8").ravel().astype(np.uint64)


def linked(a: bytes, b: bytes, percent: int) -> bool:
    na, nb = len(a) // 6, len(b) // 6
    if 100 * min(na, nb) < percent * max(na, nb):
        return False
    both = np.sort(np.concatenate([unpack(a), unpack(b)]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (na + nb - common)


def sketch(s: np.ndarray) -> bytes:
    """Parity sketch of two bits a shingle or more (a power of 2, 64 at least); XOR of its halves is the sketch of half the bits."""
    bits = max(64, 1 << (2 * len(s) - 1).bit_length())
    at = (mix64(s ^ U(0x5DEECE66D)) & U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(raw: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def may_link(a: bytes, na: int, b: bytes, nb: int, percent: int) -> bool:
    """False if sizes or sketches rule the pair out."""
    if 100 * min(na, nb) < percent * max(na, nb):
        return False
    size = min(len(a), len(b))
    return (100 + percent) * int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum()) <= (100 - percent) * (na + nb)


def sets_of(docs: DataFrame, ids: DataFrame, form: Callable[[np.ndarray], bytes], name: Name = identity, width: int = 5) -> DataFrame:
    """cid, n, data = form(set) for each set in ids (and a few others that pass the filter); one row an id."""
    wanted = bit_filter(ids)
    shared = docs.sparkSession.sparkContext.broadcast(wanted.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = np.frombuffer(shared.value, np.uint8), set()
        for _, sets in each_set(batches, width):
            cids = np.array([name(s) for s in sets], np.int64)
            out = []
            for i in np.flatnonzero(marked(bits, cids)):
                if len(sets[i]) and (c := int(cids[i])) not in seen:
                    seen.add(c)
                    out.append((c, len(sets[i]), form(sets[i])))
            if len(seen) > SEEN:
                seen.clear()
            if out:
                yield batch(["cid", "n", "data"], *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)))

    return need(docs, "text").mapInArrow(run, "cid long, n long, data binary").dropDuplicates(["cid"])


def both_sides(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("data").alias("db"))
    two = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("data").alias("da"))
    return pairs.join(one, "b").join(two, "a")


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""

    @F.pandas_udf("boolean")
    def may(x: pd.Series, nx: pd.Series, y: pd.Series, ny: pd.Series) -> pd.Series:
        return pd.Series([may_link(p, i, q, j, percent) for p, i, q, j in zip(x, nx.tolist(), y, ny.tolist(), strict=True)], dtype=bool)

    return both_sides(pairs, sketches).where(may("da", "na", "db", "nb")).select("a", "b")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cid"))


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (cid, n, data) are similar enough."""

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([linked(p, q, percent) for p, q in zip(x, y, strict=True)], dtype=bool)

    return both_sides(pairs, sets).where(alike("da", "db")).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """cid, comp: the smallest id that edges (a, b) reach, for all ids on edges; labels sink along edges and along themselves."""
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    label = materialise(both.groupBy(F.col("a").alias("cid")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = both.join(label, both["b"] == label["cid"]).groupBy(both["a"].alias("cid")).agg(F.min("comp").alias("near"))
        down = label.join(near, "cid").select("cid", F.col("comp").alias("was"), F.least("comp", "near").alias("low"))
        jump = label.select(F.col("cid").alias("low"), F.col("comp").alias("lower"))
        new = materialise(down.join(jump, "low", "left").select("cid", "was", F.least("low", F.coalesce("lower", "low")).alias("comp")))
        if not new.where("comp <> was").limit(1).count():
            return new.select("cid", "comp")
        label = new.select("cid", "comp")


def held(bits: np.ndarray, ids: DataFrame, column: Column) -> DataFrame:
    """The rows of ids whose column a bitmap of bit_filter holds, and a few others."""
    shared = ids.sparkSession.sparkContext.broadcast(bits.tobytes())

    @F.pandas_udf("boolean")
    def has(x: pd.Series) -> pd.Series:
        return pd.Series(marked(np.frombuffer(shared.value, np.uint8), x.to_numpy()))

    return ids.where(has(column))


def open_groups(shared: DataFrame, pairs: DataFrame, label: DataFrame) -> DataFrame:
    """key, cid, probe of the groups in which the pivot and another member are in different components, and of a few others, without the pivots.

    pairs are the different (pivot, member) pairs (a, b): few of them are open, and bitmaps pick their groups without a shuffle of all rows.
    """
    of = lambda c: label.select(F.col("cid").alias(c), F.col("comp").alias(f"comp_{c}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    apart = both.where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b"))
    others = shared.where("cid <> pivot and many")  # a pivot has met all others of its group
    keys = held(bit_filter(apart.select(F.xxhash64("a", "b").alias("cid"))), others, F.xxhash64(F.least("cid", "pivot"), F.greatest("cid", "pivot"))).select("key")
    return held(bit_filter(keys.select(F.col("key").alias("cid"))), others, F.col("key")).select("key", "cid", "probe")


def by_hub(rest: DataFrame, label: DataFrame, turn: int) -> DataFrame:
    """key, cid, probe, comp, hub, hub_comp of the groups with several components; hub is a member drawn by a hash, not a probe."""
    g = rest.join(label, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    best = F.max(F.struct((~F.col("probe")).alias("full"), F.xxhash64("key", "cid", F.lit(turn)).alias("rank"), "cid", "comp")).alias("best")
    mixed = g.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), best).where("lo <> hi and best.full")
    return g.join(mixed.select("key", F.col("best.cid").alias("hub"), F.col("best.comp").alias("hub_comp")), "key")


def pairs_left(g: DataFrame) -> float:
    """How many pairs of different components, not both probes, the groups of g hold."""
    each = g.groupBy("key", "comp").agg(F.count("*").cast("double").alias("n"), F.count_if("probe").cast("double").alias("p"))
    square = lambda c: F.col(c) * F.col(c)
    each = each.groupBy("key").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum(square("n") - square("p")).alias("same"))
    return each.agg(F.coalesce(F.sum((square("n") - square("p") - F.col("same")) / 2), F.lit(0.0))).first()[0]


def across(g: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of g (key, cid, probe, comp) that share a block, are in different components, not both probes, and may be linked."""
    parts = lambda test: F.ceil(F.count_if(test) / ROUND_ROWS).cast("int")
    mixed = g.groupBy("key").agg(parts(~F.col("probe")).alias("full"), parts(F.col("probe")).alias("probes"))
    spot = lambda n: F.pmod(F.xxhash64("cid"), F.greatest(n, F.lit(1))).cast("int")  # noqa: E731 - no key's rows need to meet for this
    rows = g.join(mixed, "key").withColumn("at", F.when(F.col("probe"), F.col("full") + spot(F.col("probes"))).otherwise(spot(F.col("full"))))
    rows = rows.withColumn("last", F.when(F.col("probe"), F.col("full")).otherwise(F.col("full") + F.col("probes")) - 1)
    rows = rows.join(sketches, "cid").withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    rows = rows.select("key", F.least("at", "other").alias("lo"), F.greatest("at", "other").alias("hi"), (F.col("at") > F.col("other")).alias("right"), "comp", "cid", "n", "data")

    def pairs_of(g: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs within one pair of blocks."""
        if g["lo"][0] == g["hi"][0]:
            i, j = np.triu_indices(len(g["cid"]), 1)
        else:
            i, j = (v.ravel() for v in np.meshgrid(np.flatnonzero(~g["right"]), np.flatnonzero(g["right"])))
        n = g["n"]
        m = (g["comp"][i] != g["comp"][j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        i, j = i[m], j[m]
        if len(i):
            size = min(map(len, g["data"]))
            x = np.stack([folded(d, size) for d in g["data"]])
            near = np.concatenate([np.bitwise_count(x[i[k : k + 4096]] ^ x[j[k : k + 4096]]).sum(axis=1, dtype=np.int64) for k in range(0, len(i), 4096)])
            m = (100 + percent) * near <= (100 - percent) * (n[i] + n[j])
            i, j = i[m], j[m]
        p, q = g["cid"][i], g["cid"][j]
        return np.minimum(p, q), np.maximum(p, q)

    def pair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for b in batches:
            if not b.num_rows:
                continue
            g = {c: np.array(b.column(c).to_pylist(), object) if c == "data" else b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names}
            if held is not None:
                g = {c: np.concatenate([held[c], g[c]]) for c in g}
            cut = np.flatnonzero(np.append(True, (g["key"][1:] != g["key"][:-1]) | (g["lo"][1:] != g["lo"][:-1]) | (g["hi"][1:] != g["hi"][:-1])))
            found = [pairs_of({c: v[x:y] for c, v in g.items()}) for x, y in zip(cut[:-1], cut[1:], strict=True)]
            held = {c: v[cut[-1] :] for c, v in g.items()}
            if any(len(p) for p, _ in found):
                yield batch(["a", "b"], *(np.concatenate(x) for x in zip(*found, strict=True)))
        if held is not None:
            yield batch(["a", "b"], *pairs_of(held))

    order = ["key", "lo", "hi"]
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(pair, "a long, b long").distinct()


def grouped(docs: DataFrame, *, width: int = 5, percent: int = 80, bits: int = 64) -> DataFrame:
    """doc_id, mark, n, cid, comp of every row; comp is the same for all rows that links connect. bits: of the first identities."""
    prepare(docs.sparkSession)
    rows = materialise(read(docs, width, bits))
    m, name = named(rows, bits)
    shared = materialise(shared_blocks(docs, common_filter(rows), name, width, percent))
    sketches = materialise(sets_of(docs, shared, sketch, name, width))
    pair = (F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
    pairs = materialise(shared.where("cid <> pivot").select(*pair).distinct())

    def checked(candidates: DataFrame) -> DataFrame:
        """Those of the pairs that are linked: only sets of candidates, which sketches don't rule out, are read and travel."""
        candidates = materialise(candidates)
        if not candidates.limit(1).count():
            return candidates
        return linked_pairs(candidates, materialise(sets_of(docs, ends(candidates), pack, name, width)), percent)

    links = materialise(checked(possible(pairs, sketches, percent)))
    label = components(links)
    rest = materialise(open_groups(shared, pairs, label))
    most, left = LEFT * sketches.count(), None
    for turn in range(STARS + 1):
        g = materialise(by_hub(rest, label, turn))
        before, left = left, pairs_left(g)
        if not left:
            break
        if turn == STARS or turn and (left <= most or turn > 1 and left > 0.8 * before):
            links = materialise(links.union(checked(across(g, sketches, percent))))
            label = components(links)
            break
        tested = g.where("comp <> hub_comp").select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()
        links = materialise(links.union(checked(possible(tested, sketches, percent))))
        label = components(links)
        rest = g.where("cid <> hub").select("key", "cid", "probe")
    return m.join(label, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))


def join(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    m = grouped(docs, width=width, percent=percent)
    least = materialise(m.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least")))  # on its own, so that Spark can split a large component in the join
    return m.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def distinct_documents(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, in the columns of docs: that of the smallest id (null ids last); blank ones all stay."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    key = lambda d, m: F.to_json(F.struct(d.alias("d"), m.alias("m"))).alias("_key")
    keep = grouped(docs, width=width, percent=percent).where("n > 0").groupBy("comp").agg(first).select(key(F.col("first.doc_id"), F.col("first.mark")))
    blank = F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD)) == 0
    rows = docs.where(~blank).select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), key(docs["doc_id"], F.xxhash64(docs["text"])))
    return rows.join(keep, "_key").dropDuplicates(["_key"]).select("_row.*").unionByName(docs.where(blank))


def op8_parity_join(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
