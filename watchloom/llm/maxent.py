"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(group | history) P(class | group, history) P(word | class, word before). A class is the end of a text, one of
the most frequent words, or the other words whose last bytes (hashed) are in one cluster; endings are clustered by which endings stand
before and after them, first into groups, then into classes. Groups and classes are softmaxes over weights of hashed features: the
word before, the two before, and skips to the second and third before. Within a class P(word) is proportional to exp(a[word] +
b[before, word]), with a weight b for every hashed pair of words that the training texts hold. Pairs overlap with nothing else, so
the weights that give each pair its smoothed share are known from counts, and so is the normaliser: with q the class's unigram shares,
P(word) = (n(before, word) + PRIOR q(word)) / (n(before, class) + PRIOR). All unseen words of a class together are one more word. So the
probabilities of all words, unseen ones included, add up to 1 (but for hashed pairs that fall together, about one in 2,500).

Training passes over all training texts, half of the steps a round: each task takes AdaGrad steps from the round's weights, and rows of
weights are averaged by how often a task met them; so class weights, and scores in their third digit or so, depend on how Spark splits
the input. Their number is fixed, so that they can be broadcast. Words, pairs and (word, class) counts grow with the corpus: they stay
in partitions. A piece of text asks for its own keys, once each; the partition that holds a key's slot adds up what all pieces hold and
answers each of them in the order it asked. No key's group is longer than the number of pieces.

Defined results: null and empty texts are one end token; a null id hashes as empty text and stays null; each row is scored by itself,
rows equal in id and text alike; without training texts all counts are 0; ids may have any type; other columns are not touched; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import bucket_of, materialise, need, pieces, prepare, shared_dir
from watchloom.llm.words import BYTE_CODE, U, mix64, words_of

#: Groups, classes of a group, and how many groups are of single tokens (the end of a text is one).
GROUPS, MEMBERS, SINGLE_GROUPS = 8, 8, 2
LEAVES, SINGLE = GROUPS * MEMBERS, SINGLE_GROUPS * MEMBERS
#: Features of a history, and log2 of the rows of each one's weights.
FEATURES, ROW_BITS = 4, 12
#: Cells of weights, MEMBERS numbers each: a row of a feature for the groups, and one for the classes of each group.
CELLS = (1 + GROUPS) * FEATURES << ROW_BITS
#: Rounds, each over its own steps; tokens of a gradient step; tokens of a training task at least; step size.
ROUNDS, STEP_TOKENS, TASK_TOKENS, RATE = 2, 1 << 15, 8_000_000, 0.125
#: Weights stay within this, so that a sum of them needs no scaling before it is raised to e.
MOST = 8.0
#: Hashed word endings; the low bits of a word's hash.
ENDINGS = 512
#: Weight of a class's unigram shares against the counts after one word.
PRIOR = 40.0
#: Weight cells that travel together.
GROUP = 2048
END, START = U(0x5851F42D4C957F2D) & ~U(ENDINGS - 1), U(0x14057B7EF767814F)
#: Bytes of text that are tokenised at once; tokens of a partition of counts; partitions at least, as a power of 2.
TEXT_BYTES, SLOT_TOKENS, SLOT_BITS = 1 << 18, 1 << 21, 4
WORD, FEATURE = 0, 1


# --- tokens ----------------------------------------------------------------------------------------


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes with an end after each text, offsets of the texts); a hash's low bits are the word's hashed ending."""
    w = words_of(column)
    docs = len(w.first) - 1
    first = w.first + np.arange(docs + 1)
    h = np.full(first[-1], END, np.uint64)
    tail = np.zeros(len(w.hash), np.uint64)
    for k in (1, 2, 3):
        tail = tail * U(1009) + np.where(w.stop - w.start >= k, BYTE_CODE[w.data[np.maximum(w.stop - k, 0)]] if len(w.data) else tail, U(3))
    h[np.arange(len(w.hash)) + w.doc()] = w.hash & ~U(ENDINGS - 1) | mix64(tail) % U(ENDINGS)
    return h, first


def squeezed(a: np.ndarray) -> bytes:
    raw = a.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def loose(raw: bytes, kind: str) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], n, codec="zstd", asbytes=True) if n else b"", kind)


def planes(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, byte by byte: first all low bytes, so that the high ones squeeze well."""
    return np.diff(ascending, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T


def unplaned(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def distinct(keys: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct keys, where in them each key is); keys have so many bits."""
    n = len(keys)
    room = max(1, (n - 1).bit_length())
    if bits + room > 64 or not n:
        return np.unique(keys, return_inverse=True)
    s = np.sort(keys << U(room) | np.arange(n, dtype=np.uint64))
    place = (s & U((1 << room) - 1)).astype(np.int64)
    s >>= U(room)
    new = np.append(True, s[1:] != s[:-1])
    inverse = np.empty(n, np.int64)
    inverse[place] = np.cumsum(new) - 1
    return s[new], inverse


@dataclass
class Piece:
    """Texts that are held together: distinct token hashes, the number of each token in them, offsets and training flags of the texts."""

    words: np.ndarray
    at: np.ndarray
    first: np.ndarray
    train: np.ndarray

    def before(self, k: int) -> np.ndarray:
        """The number of the token k before each; len(words) where the text has none."""
        out = np.full(len(self.at), len(self.words), np.int64)
        out[k:] = self.at[:-k] if len(self.at) > k else self.at[:0]
        for j in range(k):
            i = self.first[:-1] + j
            out[i[i < self.first[1:]]] = len(self.words)
        return out

    def taught(self) -> np.ndarray:
        """Which tokens are of training texts."""
        return np.repeat(self.train, np.diff(self.first))

    def rows(self) -> list[np.ndarray]:
        """For each feature the weight rows of the tokens' histories: word before, two before, skips to the second and third."""
        shift = U(64 - ROW_BITS)
        w = np.append(self.words, START)
        one, two, three = (self.before(k) for k in (1, 2, 3))
        alone = lambda salt: (mix64(w + U(salt)) >> shift).astype(np.int64)
        both = mix64((w * U(31) + U(1))[one] + w[two]) >> shift
        return [alone(0)[one], both.astype(np.int64), alone(2)[two], alone(3)[three]]


KIND = "piece long, n binary, train binary, words binary, low binary, high binary"


def tokenised(docs: DataFrame, modulus: int, held_out: int) -> DataFrame:
    """ids (array of doc_id) and the columns of KIND: a row for each piece of text, of one Arrow batch; all later passes read this."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            if not b.num_rows:
                continue
            parts = [tokens_of(x.column("text")) for x in pieces([b], "text", TEXT_BYTES)]
            words, at = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
            n = np.concatenate([np.diff(f) for _, f in parts]).astype(np.int32)
            blobs = [n, np.asarray(b.column("train").to_numpy(zero_copy_only=False), np.uint8), planes(words), (at & 0xFFFF).astype(np.uint16), (at >> 16).astype(np.uint16)]
            ids = b.column("doc_id")
            ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([ids, pa.array([number], pa.int64()), *(pa.array([squeezed(x)], pa.binary()) for x in blobs)], names=["ids", "piece", "n", "train", "words", "low", "high"])
            number += 1

    rows = docs.select("doc_id", "text", (bucket_of(F.col("doc_id"), modulus) != held_out).alias("train"))
    return rows.mapInArrow(run, f"ids array<{kind}>, {KIND}")


def in_buckets(tokens: DataFrame) -> DataFrame:
    """tokens, written in buckets by piece and read back: what meets them by piece comes to them, they aren't shuffled."""
    spark = tokens.sparkSession
    path = shared_dir(spark)
    name = f"tokens_{path.rsplit('/', 1)[-1]}"
    tokens.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "piece").option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name, not the files
    return out


def piece_of(row: dict[str, bytes]) -> Piece:
    at = loose(row["low"], "u2").astype(np.int64) | loose(row["high"], "u2").astype(np.int64) << 16
    return Piece(unplaned(loose(row["words"], "u1")), at, np.concatenate([[0], np.cumsum(loose(row["n"], "i4"), dtype=np.int64)]), loose(row["train"], "u1") > 0)


def each_piece(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Piece]]:
    for b in batches:
        for row in b.to_pylist():
            yield row["piece"], piece_of(row)


# --- counts of keys over all pieces ----------------------------------------------------------------


def coded(keys: np.ndarray, low: int) -> bytes:
    """Ascending distinct keys from `low` on, by their differences in as few bytes as they take."""
    d = np.diff(keys, prepend=np.uint64(low))
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    return bytes([width]) + d.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def decoded(raw: bytes, low: int) -> np.ndarray:
    width = raw[0]
    full = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    full[:, :width] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(full.view(np.uint64).ravel(), dtype=np.uint64) + U(low)


def small(counts: np.ndarray) -> bytes:
    """Counts in a byte each, those from 255 on in eight more at the end."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def large(raw: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, np.int64, offset=n)
    return out


def cuts(keys: np.ndarray, bits: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots that ascending keys of so many bits fall into, offsets of them): a slot is a key's leading bits."""
    slot = (keys >> U(bits - slots)).astype(np.int64)
    at = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(keys) else np.zeros(0, np.int64)
    return slot[at], np.append(at, len(keys))


def asked(keys: np.ndarray, counts: np.ndarray, bits: int, slots: int) -> list[tuple[int, bytes, bytes]]:
    """(slot, keys, counts) of ascending distinct keys."""
    found, at = cuts(keys, bits, slots)
    return [(int(s), coded(keys[a:e], int(s) << (bits - slots)), small(counts[a:e])) for s, a, e in zip(found, at[:-1], at[1:], strict=True)]


def added(rows: list[tuple[bytes, bytes]], slot: int, bits: int, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(distinct keys, their totals, where in them each row's keys are, offsets of the rows) of a slot's (keys, counts)."""
    keys = [decoded(k, slot << (bits - slots)) for k, _ in rows]
    ends = [0, *np.cumsum([len(k) for k in keys]).tolist()]
    counts = np.concatenate([large(c, len(k)) for (_, c), k in zip(rows, keys, strict=True)])
    u, inverse = distinct(np.concatenate(keys) - U(slot << (bits - slots)), bits - slots)
    return u + U(slot << (bits - slots)), np.bincount(inverse, counts, len(u)).astype(np.int64), inverse, ends


def vocabulary(tokens: DataFrame, slots: int) -> DataFrame:
    """part, keys, counts: the hashes (mixed) of each slot and how often training texts hold them; parts below 0 hold pairs of endings."""
    chunk = ENDINGS * ENDINGS // 64

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        pairs = np.zeros(ENDINGS * ENDINGS, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            u, back = distinct(np.concatenate([k for k, _ in held]))
            return u, np.bincount(back, np.concatenate([n for _, n in held]), len(u)).astype(np.int64)

        def out(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "salt", "keys", "counts"])

        def words() -> pa.RecordBatch:
            return out([(s, 0, k, c) for s, k, c in asked(*merged(), 64, slots)])

        for _, p in each_piece(batches):
            taught = p.taught()
            n = np.bincount(p.at[taught], minlength=len(p.words))
            ending = (p.words & U(ENDINGS - 1)).astype(np.int64)[p.at]
            follows = taught.copy()
            follows[p.first[:-1]] = follows[p.first[1:] - 1] = False  # neither the first word nor the end
            i = np.flatnonzero(follows)
            pairs += np.bincount(ending[i - 1] * ENDINGS + ending[i], minlength=len(pairs))
            if n.any():
                held.append((mix64(p.words[n > 0]), n[n > 0]))
            if sum(len(k) for k, _ in held) > 1_500_000:
                held = [merged()]
                if len(held[0][0]) > 750_000:
                    yield words()
                    held = []
        if held:
            yield words()
        salt = TaskContext.get().partitionId() % 64
        if pairs.any():
            yield out([(-1 - k, salt, b"", squeezed(x)) for k, x in enumerate(pairs.reshape(64, chunk)) if x.any()])

    def add(t: pa.Table) -> pa.Table:
        part, keys, counts = t.column("part")[0].as_py(), t.column("keys").to_pylist(), t.column("counts").to_pylist()
        if part < 0:
            k, n = b"", squeezed(np.sum([loose(c, "i8") for c in counts], axis=0))
        else:
            u, total, _, _ = added(list(zip(keys, counts, strict=True)), part, 64, slots)
            k, n = u.tobytes(), total.tobytes()
        return pa.table({"part": pa.array([part], pa.int32()), "keys": pa.array([k], pa.binary()), "counts": pa.array([n], pa.binary())})

    rows = tokens.select(*[c.split()[0] for c in KIND.split(", ")]).mapInArrow(run, "part int, salt int, keys binary, counts binary")
    return rows.groupBy("part", "salt").applyInArrow(add, "part int, keys binary, counts binary")


def unmixed(x: np.ndarray) -> np.ndarray:
    """The inverse of mix64."""
    x = x ^ (x >> U(31)) ^ (x >> U(62))
    x = x * U(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> U(27)) ^ (x >> U(54))
    x = x * U(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> U(30)) ^ (x >> U(60))


# --- classes ---------------------------------------------------------------------------------------


def near_means(x: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Cluster of each row, by weighted k-means from far apart rows."""
    chosen = [int(weight.argmax())]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(min(k, len(x)) - 1):
        chosen.append(int((far * weight).argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    c, own = x[chosen], np.zeros(len(x), np.int64)
    for _ in range(30):
        own = (-2 * x @ c.T + (c * c).sum(axis=1)).argmin(axis=1)
        share = (own[:, None] == np.arange(len(c))) * weight[:, None]
        c = share.T @ x / np.maximum(share.sum(axis=0), 1e-9)[:, None]
    return own


def clusters(pairs: np.ndarray) -> np.ndarray:
    """Class of each ending, by what stands before and after it; pairs[i, j]: j after i. Endings of a group's classes are alike, too."""
    weight = pairs.sum(axis=0) + pairs.sum(axis=1) + 1e-9
    share = lambda m: np.sqrt(m / np.maximum(m.sum(axis=1, keepdims=True), 1))
    x = np.concatenate([share(pairs), share(pairs.T)], axis=1)
    group = near_means(x, weight, GROUPS - SINGLE_GROUPS)
    out = np.zeros(len(x), np.int64)
    for g in range(GROUPS - SINGLE_GROUPS):
        own = np.flatnonzero(group == g)
        if len(own):
            out[own] = (SINGLE_GROUPS + g) * MEMBERS + near_means(x[own], weight[own], MEMBERS)
    return out


@dataclass
class Classes:
    single: np.ndarray  # hashes of the tokens that are a class each, ascending
    cluster: np.ndarray  # class of each ending
    size: np.ndarray  # words, distinct words and one more, of each class

    def of(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.single, words), len(self.single) - 1)
        return np.where(self.single[at] == words, at, self.cluster[(words & U(ENDINGS - 1)).astype(np.int64)])


def classes_of(vocab: DataFrame) -> tuple[Classes, int, int]:
    """(classes, tokens, distinct tokens) of the training texts; a few hundred rows reach the driver."""

    def facts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column("keys").to_pylist(), b.column("counts").to_pylist(), strict=True):
                h, n = unmixed(np.frombuffer(k, np.uint64)), np.frombuffer(c, np.int64)
                e = (h & U(ENDINGS - 1)).astype(np.int64)
                most = np.append(np.lexsort((h, -n))[:SINGLE], np.flatnonzero(h == END))  # the end of a text is a class however rare
                v = np.bincount(e, minlength=ENDINGS)
                full = np.flatnonzero(v)
                cols = [np.append(full, np.where(h[most] == END, -2, -1)), np.append(np.bincount(e, n, ENDINGS)[full].astype(np.int64), n[most]), np.append(v[full], np.ones(len(most), np.int64)), np.append(np.zeros(len(full), np.int64), h[most].view(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], names=["ending", "n", "v", "h"])

    rows = vocab.where("part >= 0").select("keys", "counts").mapInArrow(facts, "ending long, n long, v long, h long")
    top = {r["h"]: r["n"] for r in rows.where("ending = -1").orderBy(F.desc("n"), "h").limit(SINGLE - 1).union(rows.where("ending = -2").limit(1)).select("h", "n").collect()}
    single = np.array([*(h for h in top if h != END.view(np.int64)), END.view(np.int64)], np.int64)

    def add(t: pa.Table) -> pa.Table:
        total = np.sum([loose(c, "i8") for c in t.column("counts").to_pylist()], axis=0)
        return pa.table({"part": t.column("part").slice(0, 1), "counts": pa.array([squeezed(total)], pa.binary())})

    pairs = np.zeros((64, ENDINGS * ENDINGS // 64))
    for r in vocab.where("part < 0").select("part", "counts").groupBy("part").applyInArrow(add, "part int, counts binary").collect():
        pairs[-1 - r["part"]] = loose(r["counts"], "i8")
    cluster = clusters(pairs.reshape(ENDINGS, ENDINGS))
    by_ending = np.zeros((ENDINGS, 2), np.int64)
    for r in rows.where("ending >= 0").groupBy("ending").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        by_ending[r["ending"]] = r["n"], r["v"]
    words, kinds = (int(x) for x in by_ending.sum(axis=0))
    for h in single:
        by_ending[h & (ENDINGS - 1)] -= top.get(h, 0), int(h in top)
    size = 1 + np.bincount(cluster, by_ending.sum(axis=1), LEAVES)
    return Classes(np.sort(single.view(np.uint64)), cluster, size), words, kinds


# --- the softmax over groups and classes -----------------------------------------------------------


class Weights:
    """w[j] has the j-th number of every cell; bias[j, 0] is that of the j-th group, bias[j, 1 + g] that of the j-th class of group g."""

    def __init__(self, classes: Classes) -> None:
        self.w = np.zeros((MEMBERS, CELLS), np.float32)
        self.bias = np.zeros((MEMBERS, 1 + GROUPS), np.float32)
        used = np.zeros(LEAVES, bool)
        used[: len(classes.single)] = used[classes.cluster] = True
        self.bias[:, 1:][~used.reshape(GROUPS, MEMBERS).T] = -np.inf
        self.bias[:GROUPS, 0][~used.reshape(GROUPS, MEMBERS).any(axis=1)] = -np.inf

    def shares(self, rows: list[np.ndarray], block: np.ndarray | int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(softmax over the numbers of each token's block, a column a token; cells used). Block 0: groups, 1 + g: classes of g."""
        cells = [r + (block * FEATURES + k << ROW_BITS) for k, r in enumerate(rows)]
        x = np.empty((MEMBERS, len(rows[0])), np.float32)
        for j in range(MEMBERS):
            np.take(self.w[j], cells[0], out=x[j], mode="clip")
            for c in cells[1:]:
                x[j] += np.take(self.w[j], c, mode="clip")
            x[j] += self.bias[j][block]
        np.exp(x, out=x)
        x /= np.maximum(x.sum(axis=0), 1e-37)
        return x, cells

    def log10(self, rows: list[np.ndarray], leaf: np.ndarray) -> np.ndarray:
        """log10 P(class | history) of each token."""
        out = np.empty(len(leaf))
        for s in range(0, len(leaf), STEP_TOKENS):
            r, y = [x[s : s + STEP_TOKENS] for x in rows], leaf[s : s + STEP_TOKENS]
            g, i = y // MEMBERS, np.arange(len(y))
            one, two = self.shares(r, 0)[0][g, i], self.shares(r, 1 + g)[0][y % MEMBERS, i]
            out[s : s + STEP_TOKENS] = np.log10(np.maximum(one, 1e-30).astype(np.float64)) + np.log10(np.maximum(two, 1e-30).astype(np.float64))
        return out


class Learner:
    """AdaGrad steps from given weights; met: how often each cell was used."""

    def __init__(self, weights: Weights) -> None:
        self.weights = weights
        self.met, self.pace = np.zeros(CELLS, np.float32), np.full(CELLS, 1e-6, np.float32)
        self.pace_bias, self.tokens = np.full(weights.bias.shape, 1e-6, np.float32), 0

    def step(self, rows: list[np.ndarray], leaf: np.ndarray) -> None:
        m, n = self.weights, len(leaf)
        self.tokens += n
        for block, y in ((np.zeros(n, np.int64), leaf // MEMBERS), (1 + leaf // MEMBERS, leaf % MEMBERS)):
            g, cells = m.shares(rows, block)
            g[y, np.arange(n)] -= 1
            flat = np.concatenate(cells)
            used, at = distinct(flat.astype(np.uint64), CELLS.bit_length())
            used = used.astype(np.int64)
            often = np.bincount(at, minlength=len(used)).astype(np.float32)
            move = np.stack([np.bincount(at, np.tile(g[j], FEATURES), len(used)) for j in range(MEMBERS)]).astype(np.float32) / np.sqrt(often)
            self.met[used] += often
            self.pace[used] += (move * move).mean(axis=0)
            m.w[:, used] = np.clip(m.w[:, used] - RATE * move / np.sqrt(self.pace[used]), -MOST, MOST)
            mean = np.stack([np.bincount(block, g[j], 1 + GROUPS) for j in range(MEMBERS)]).astype(np.float32) / n
            self.pace_bias += mean * mean
            m.bias -= np.where(np.isinf(m.bias), 0, 4 * RATE * mean / np.sqrt(self.pace_bias))
            np.clip(m.bias, -MOST, MOST, out=m.bias, where=~np.isinf(m.bias))

    def parts(self) -> list[tuple[int, bytes, bytes]]:
        """(part, how often met, numbers) of the cells met; the bias is the last part."""
        n, w = self.met.reshape(-1, GROUP), self.weights.w.astype(np.float16).reshape(MEMBERS, -1, GROUP)
        return [(int(k), n[k].tobytes(), w[:, k].tobytes()) for k in np.flatnonzero(n.any(axis=1))] + [(len(n), np.float32([self.tokens]).tobytes(), self.weights.bias.astype(np.float16).tobytes())]


def train(tokens: DataFrame, classes: Classes, tasks: int) -> Weights:
    """Weights of groups and classes after ROUNDS rounds over the training texts."""
    weights = Weights(classes)
    rows = tokens.select(*[c.split()[0] for c in KIND.split(", ")]).coalesce(tasks)

    for turn in range(ROUNDS):
        shared = tokens.sparkSession.sparkContext.broadcast(weights)

        def run(batches: Iterable[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own = Weights(classes)
            own.w, own.bias = shared.value.w.copy(), shared.value.bias.copy()
            learner, steps = Learner(own), 0
            for _, p in each_piece(batches):
                keep = np.flatnonzero(p.taught())
                leaf, found = classes.of(p.words)[p.at[keep]], [r[keep] for r in p.rows()]
                for s in range(0, len(keep), STEP_TOKENS):
                    if steps % ROUNDS == turn:
                        learner.step([r[s : s + STEP_TOKENS] for r in found], leaf[s : s + STEP_TOKENS])
                    steps += 1
            if learner.tokens:
                got = learner.parts()
                salt = TaskContext.get().partitionId() % 64
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in got], pa.int32()), pa.array([salt] * len(got), pa.int32()), pa.array([n for _, n, _ in got], pa.binary()), pa.array([w for *_, w in got], pa.binary())], names=["part", "salt", "n", "w"])

        def mean(pdf: pd.DataFrame) -> pd.DataFrame:
            """The mean of weights by how often their cells were met."""
            n = np.stack([np.frombuffer(x, np.float32) for x in pdf["n"]]).astype(np.float64)
            w = np.stack([np.frombuffer(x, np.float16) for x in pdf["w"]]).astype(np.float32)
            w = w.reshape(len(n), -1, n.shape[1])
            all_n = n.sum(axis=0)
            out = (n[:, None, :] * np.maximum(w, -1e4)).sum(axis=0) / np.maximum(all_n, 1)
            return pd.DataFrame({"part": pdf["part"].iloc[:1], "salt": 0, "n": [all_n.astype(np.float32).tobytes()], "w": [out.astype(np.float16).tobytes()]})

        kind = "part int, salt int, n binary, w binary"
        sums = rows.mapInArrow(run, kind).groupBy("part", "salt").applyInPandas(mean, kind).groupBy("part").applyInPandas(mean, kind)
        new = Weights(classes)
        new.w = weights.w.copy()
        for r in sums.collect():  # the weights themselves, whatever the input's size
            n, w = np.frombuffer(r["n"], np.float32), np.frombuffer(r["w"], np.float16).astype(np.float32)
            if len(n) == 1:
                new.bias = np.where(np.isinf(new.bias), new.bias, w.reshape(new.bias.shape))
            else:
                at = slice(r["part"] * GROUP, (r["part"] + 1) * GROUP)
                new.w[:, at] = np.where(n > 0, w.reshape(MEMBERS, -1), new.w[:, at])
        shared.unpersist()
        weights = new
    return weights


# --- words within their classes ---------------------------------------------------------------------


def features(p: Piece, classes: Classes, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens that share their class with others, ascending distinct slots of their features, where in them each token's pair is, where its (before, class))."""
    leaf = classes.of(p.words)
    some = np.flatnonzero(leaf[p.at] >= SINGLE)
    before = np.append(p.words, START)
    one, at = p.before(1)[some], p.at[some]
    pair = mix64(mix64(before)[one] + (p.words * U(0x9E3779B97F4A7C15))[at])
    context = mix64(mix64(before + U(5))[one] + (leaf.astype(np.uint64) * U(0xD6E8FEB86659FD93))[at])
    keys, where = distinct(np.concatenate([pair, context]) >> U(32 - slots), 32 + slots)
    return some, keys, where[: len(some)], where[len(some) :]


def requests(tokens: DataFrame, classes: Classes, slots: int) -> DataFrame:
    """kind, slot, piece, keys, counts: what each piece asks for, with its own training counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, p in each_piece(batches):
            taught = p.taught()
            n = np.bincount(p.at[taught], minlength=len(p.words))
            mixed = mix64(p.words)
            order = np.argsort(mixed)
            some, keys, pair, context = features(p, classes, slots)
            own = np.bincount(np.append(pair, context), np.tile(taught[some], 2), len(keys)).astype(np.int64)
            rows = [(WORD, s, number, k, c) for s, k, c in asked(mixed[order], n[order], 64, slots)] + [(FEATURE, s, number, k, c) for s, k, c in asked(keys, own, 32 + slots, slots)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["kind", "slot", "piece", "keys", "counts"])

    return tokens.select(*[c.split()[0] for c in KIND.split(", ")]).mapInArrow(run, "kind int, slot int, piece long, keys binary, counts binary")


def answers(asked_for: DataFrame, slots: int) -> DataFrame:
    """kind, slot, piece, counts: the totals over all pieces of the keys of each request, in its order."""

    def add(t: pa.Table) -> pa.Table:
        kind, slot = t.column("kind")[0].as_py(), t.column("slot")[0].as_py()
        bits = 64 if kind == WORD else 32 + slots
        _, total, where, ends = added(list(zip(t.column("keys").to_pylist(), t.column("counts").to_pylist(), strict=True)), slot, bits, slots)
        told = [small(total[where[a:e]]) for a, e in zip(ends, ends[1:], strict=False)]
        return t.select(["kind", "slot", "piece"]).append_column("counts", pa.array(told, pa.binary()))

    return asked_for.groupBy("kind", "slot").applyInArrow(add, "kind int, slot int, piece long, counts binary")


def scores(p: Piece, classes: Classes, weights: Weights, slots: int, told: dict[tuple[int, int], bytes], words: int, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known tokens, base score, score) of each text of a piece; told: the answers it got."""

    def totals(kind: int, keys: np.ndarray, bits: int) -> np.ndarray:
        found, at = cuts(keys, bits, slots)
        return np.concatenate([large(told[kind, int(s)], e - a) for s, a, e in zip(found, at[:-1], at[1:], strict=True)]) if len(keys) else np.zeros(0, np.int64)

    mixed = mix64(p.words)
    order = np.argsort(mixed)
    n = np.empty(len(p.words), np.int64)
    n[order] = totals(WORD, mixed[order], 64)
    leaf = classes.of(p.words)
    some, keys, pair, context = features(p, classes, slots)
    held = totals(FEATURE, keys, 32 + slots)
    share = (n + 1) / classes.size[leaf]
    score = weights.log10(p.rows(), leaf[p.at])
    score[some] += np.log10((held[pair] + PRIOR * share[p.at[some]]) / (held[context] + PRIOR))
    base = np.log10((n + 1.0) / (words + kinds + 1))[p.at]
    total = lambda x: np.add.reduceat(x, p.first[:-1])
    return total((n > 0)[p.at].astype(np.int64)), total(base), total(score)


def score(docs: DataFrame, *, modulus: int = 7, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = prepare(docs.sparkSession)
    docs = need(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = in_buckets(tokenised(docs, modulus, held_out))

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([sum(int(loose(n, "i4").sum(dtype=np.int64)) for b in batches for n in b.column("n").to_pylist())], pa.int64())], names=["n"])

    total = tokens.select("n").mapInArrow(lengths, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slots = max(SLOT_BITS, int(total // SLOT_TOKENS).bit_length())
    classes, words, kinds = classes_of(materialise(vocabulary(tokens, slots + 5)))  # so many that they spread evenly among the tasks
    weights = train(tokens, classes, max(spark.sparkContext.defaultParallelism, -(-total // TASK_TOKENS)))
    shared = spark.sparkContext.broadcast((classes, weights))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        classes, weights = shared.value
        p = piece_of({c: own.column(c)[0].as_py() for c in ("n", "train", "words", "low", "high")})
        answer = {(k, s): c for k, s, c in zip(*(told.column(c).to_pylist() for c in ("kind", "slot", "counts")), strict=True)}
        known, base, own_score = scores(p, classes, weights, slots, answer, words, kinds)
        ids = own.column("ids").combine_chunks().flatten()
        m = len(ids)
        return pa.Table.from_arrays([ids, pa.array(~p.train), pa.array(np.diff(p.first)), pa.array(known), pa.array(np.full(m, words, np.int64)), pa.array(base), pa.array(own_score)], names=names)

    told = answers(requests(tokens, classes, slots), slots)
    return tokens.groupBy("piece").cogroup(told.groupBy("piece")).applyInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_maxent_score(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
