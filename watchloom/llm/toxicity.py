"""Toxic spans by a linear-chain conditional random field over words, with two states: plain and toxic.

A word's features are hashes of itself and of its first and last bytes. Documents are labelled, words are not; words of a
labelled document get labels from the documents: a word of a toxic one is toxic if one of its features is far more frequent among
toxic documents. The field learns from these words with their surroundings by gradient steps on the exact likelihood.
Forward-backward marginals of a text's words give its score, by a logistic function of the largest and the expected
number of toxic words, and its offending spans, in bytes of the UTF-8 text.

Forward and backward passes multiply 2 x 2 matrices; all texts of a batch form one sequence that starts anew at each text, cut into
blocks that are passed through side by side, so that a long text is no slower a word than a short one.

The model is fitted on a sample of at most `most` labelled documents (`TOXIC` toxic ones), picked by the hash of their ids, and on every word of them
(of SAMPLE_BYTES of text in all at most, by whole documents in that order; see common.labelled_sample): Spark tasks add up each round's gradient, so that only sums reach the driver. Scoring runs over
all texts where they are read. Labels, lang, source and ids are no inputs of a score.

Defined results: null, empty and blank texts get the score of no words, without spans; labels without a document, null labels and
ids don't teach; without labels or with one kind only, scores are 0; other columns are not touched; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import bucket_of, labelled_sample, materialise, need, pieces, prepare, unused
from watchloom.llm.quality import sigmoid
from watchloom.llm.words import BYTE_CODE, U, Words, flat, mix64, powers, words_of

#: log2 of the number of hashed features; labelled documents for the fit at most; files that they are dealt out to.
FEATURE_BITS, SAMPLE, PARTS = 18, 4000, 12
#: Of the documents for the fit, toxic ones at most.
TOXIC = 1300
#: Bytes at the start and at the end of a word that are features.
HEADS, TAILS = (4, 6, 8), (5,)
#: Length of a block of words in the forward-backward pass.
BLOCK = 128
THRESHOLD = 0.3


def letters(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the words without the ASCII punctuation around them."""
    d = w.data
    mark = (d < 128) & ~((d >= 97) & (d <= 122)) & ~((d >= 48) & (d <= 57))
    n = np.arange(len(d))
    after = np.minimum.accumulate(np.where(mark, len(d), n)[::-1])[::-1] if len(d) else n
    before = np.maximum.accumulate(np.where(mark, -1, n)) if len(d) else n
    start = np.minimum(after[w.start], w.stop)
    stop = np.maximum(before[w.stop - 1] + 1, start)
    return start, stop


def features(w: Words) -> np.ndarray:
    """A row of hashed features for each word: itself, its first bytes, its last bytes; 0 where it is too short."""
    start, stop = letters(w)
    n = len(w.data)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[w.data] * up[:n], out=total[1:])
    part = lambda a, b, salt: mix64((total[b] - total[a]) * down[a] + U(salt)) >> U(64 - FEATURE_BITS)
    length = stop - start
    out = np.zeros((len(start), 1 + len(HEADS) + len(TAILS)), np.int32)
    out[:, 0] = np.where(length > 0, part(start, stop, 101), U(0))
    for k, m in enumerate(HEADS):
        out[:, 1 + k] = np.where(length >= m, part(start, np.minimum(start + m, stop), 200 + m), U(0))
    for k, m in enumerate(TAILS):
        out[:, 1 + len(HEADS) + k] = np.where(length >= m, part(np.maximum(stop - m, start), stop, 300 + m), U(0))
    return out


def passes(e: np.ndarray, new: np.ndarray, trans: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrices, forward, backward) of the words, the vectors scaled to sum 1.

    e: log weight of toxic against plain for each word; new: whether a text starts there; trans[i, j], begin[j]: weights.
    """
    n = len(e)
    steps = -(-max(n, 1) // BLOCK)
    m = np.ones((steps * BLOCK, 2, 2))
    odds = np.exp(np.clip(e, -30, 30))
    m[:n] = trans
    m[:n][new] = begin
    m[:n, :, 1] *= odds[:, None]
    m[:n] /= m[:n].sum(axis=(1, 2), keepdims=True)
    g = m.reshape(steps, BLOCK, 2, 2)
    prod = np.broadcast_to(np.eye(2), (steps, 2, 2)).copy()
    for k in range(BLOCK):
        prod = prod @ g[:, k]
        prod /= prod.sum(axis=(1, 2), keepdims=True)
    into, back = np.empty((steps, 2)), np.empty((steps, 2))
    a = np.array([0.5, 0.5])
    for s in range(steps):
        into[s] = a
        a = a @ prod[s]
        a /= a.sum()
    a = np.array([0.5, 0.5])
    for s in range(steps - 1, -1, -1):
        back[s] = a
        a = prod[s] @ a
        a /= a.sum()
    fwd, bwd = np.empty((steps, BLOCK, 2)), np.empty((steps, BLOCK, 2))
    a = into
    for k in range(BLOCK):
        a = (a[:, None, :] @ g[:, k])[:, 0]
        a /= a.sum(axis=1, keepdims=True)
        fwd[:, k] = a
    a = back
    for k in range(BLOCK - 1, -1, -1):
        bwd[:, k] = a
        a = (g[:, k] @ a[:, :, None])[:, :, 0]
        a /= a.sum(axis=1, keepdims=True)
    return m[:n], fwd.reshape(-1, 2)[:n], bwd.reshape(-1, 2)[:n]


def marginals(e: np.ndarray, new: np.ndarray, trans: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """P(toxic) of each word, given its whole text."""
    if not len(e):
        return np.zeros(0)
    _, f, b = passes(e, new, trans, begin)
    p = f * b
    return p[:, 1] / p.sum(axis=1)


#: total(f, *values): the sums of the arrays that f(feat, first, toxic, *values) returns, over all parts of the sample.
Total = Callable[..., list[np.ndarray]]


def occurrences(feat: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> list[np.ndarray]:
    """Plain documents, toxic documents and words; toxic documents with each feature, plain ones with it."""
    dims = 1 << FEATURE_BITS
    doc = np.repeat(np.arange(len(toxic)), np.diff(first))
    pos, neg = np.zeros(dims), np.zeros(dims)
    for k in range(feat.shape[1]):
        pairs = np.unique(doc.astype(np.int64) << FEATURE_BITS | feat[:, k])
        d, f = pairs >> FEATURE_BITS, pairs & (dims - 1)
        pos += np.bincount(f, toxic[d], dims)
        neg += np.bincount(f, 1 - toxic[d], dims)
    return [np.array([(1 - toxic).sum(), toxic.sum(), len(feat)], float), pos, neg]


def hot_features(pos: np.ndarray, neg: np.ndarray, share: float, *, least: int = 3, odds: float = 2.5) -> np.ndarray:
    """Which features are far more frequent among toxic documents; a word of a toxic document with one of them is toxic."""
    score = np.log((pos + 0.2) / (neg * share + 0.2))
    score[(pos < least) | (np.arange(len(pos)) == 0)] = -9
    return score > odds


def gradient(feat: np.ndarray, first: np.ndarray, toxic: np.ndarray, hot: np.ndarray, par: np.ndarray) -> list[np.ndarray]:
    """Of the negative log likelihood of the words' labels, by feature weights; by bias, 4 transitions, 2 starts."""
    dims, rest = 1 << FEATURE_BITS, par[1 << FEATURE_BITS :]
    if not len(feat):
        return [np.zeros(dims), np.zeros(7)]
    y = hot[feat].any(axis=1).astype(int) & np.repeat(toxic, np.diff(first))
    new = np.zeros(len(y), bool)
    new[first[:-1][np.diff(first) > 0]] = True
    old, last = ~new, np.append(0, y[:-1])
    mat, f, b = passes(par[feat].sum(axis=1) + rest[0], new, np.exp(rest[1:5]).reshape(2, 2), np.exp(rest[5:]))
    p = f * b
    mu = p[:, 1] / p.sum(axis=1)
    pair = np.concatenate([[[0.5, 0.5]], f[:-1]])[:, :, None] * mat * b[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    d = mu - y
    by_weight = np.zeros(dims)
    for k in range(feat.shape[1]):
        by_weight += np.bincount(feat[:, k], d, dims)
    by_weight[0] = 0.0
    seen = np.bincount(2 * last[old] + y[old], minlength=4)
    starts = np.array([(1 - mu[new]).sum(), mu[new].sum()]) - np.bincount(y[new], minlength=2)
    return [by_weight, np.concatenate([[d.sum()], pair[old].sum(axis=0).ravel() - seen, starts])]


def fit_field(total: Total, hot: np.ndarray, n: float, *, rounds: int = 40, rate: float = 0.3, decay: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(feature weights, transition weights, start weights, bias) by Adam on the likelihood of the labels of all n words.

    Weights have a normal prior of variance 1 / decay, so that a feature needs occurrences to weigh: Adam's steps don't depend on how
    small a gradient is, so rare features of plain words would else grow as heavy as others, and words that the sample lacks look toxic.
    Steps shrink to nothing, so that the weights settle.
    """
    dims = 1 << FEATURE_BITS
    par = np.zeros(dims + 7)  # weights, bias, 4 transitions, 2 starts
    par[dims] = -2.0
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, rounds + 1):
        g = np.concatenate(total(gradient, hot, par)) / n
        g[:dims] += decay / n * par[:dims]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        par -= rate * (1 - (step - 1) / rounds) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        par[-6:] = par[-6:].clip(-8, 8)
    return par[:dims].copy(), np.exp(par[-6:-2]).reshape(2, 2), np.exp(par[-2:]), par[dims]


def summary(mu: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each document a row: 1, logit of the largest marginal, log of the expected toxic words, its share."""
    n = len(first) - 1
    out = np.zeros((n, 4))
    out[:, 0] = 1
    total = np.concatenate([[0.0], np.cumsum(mu)])
    s = total[first[1:]] - total[first[:-1]]
    full = np.flatnonzero(np.diff(first) > 0)
    top = np.zeros(n)
    if len(full):
        top[full] = np.maximum.reduceat(mu, first[full])
    top = top.clip(1e-4, 1 - 1e-4)
    out[:, 1] = np.log(top / (1 - top)) / 4
    out[:, 2] = np.log1p(s)
    out[:, 3] = np.log1p(1000 * s / np.maximum(np.diff(first), 1))
    return out


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression, by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w -= 0.7 * np.linalg.solve(h, x.T @ (p - y) + 0.05 * w)
    return w


class Model:
    """Feature weights, transitions, starts, bias, and the weights of the document score (None: never toxic)."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, begin: np.ndarray, bias: float, doc: np.ndarray | None) -> None:
        self.weights, self.trans, self.begin, self.bias, self.doc = weights.astype(np.float32), trans, begin, bias, doc

    def words(self, feat: np.ndarray, first: np.ndarray, most: int = 200_000) -> np.ndarray:
        """Marginals of all words, some documents at a time."""
        out, a = [], 0
        while a < len(first) - 1:
            b = max(a + 1, int(np.searchsorted(first, first[a] + most, "right")) - 1)
            f = feat[first[a] : first[b]]
            new = np.zeros(len(f), bool)
            new[(first[a:b] - first[a])[np.diff(first[a : b + 1]) > 0]] = True
            out.append(marginals(self.weights[f].sum(axis=1, dtype=np.float64) + self.bias, new, self.trans, self.begin))
            a = b
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, mu: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.zeros(len(first) - 1) if self.doc is None else sigmoid(summary(mu, first) @ self.doc)


def fit(total: Total, summaries: Callable[[Model], tuple[np.ndarray, np.ndarray]], odds: float | None = None) -> Model:
    """The model from all words of a sample; summaries: those of its documents and their labels; odds of toxic documents at large."""
    (plain, toxic, words), pos, neg = total(occurrences)
    if not plain or not toxic or not words:
        return Model(np.zeros(1 << FEATURE_BITS), np.ones((2, 2)), np.ones(2), -9.0, None)
    model = Model(*fit_field(total, hot_features(pos, neg, toxic / plain), words), None)
    model.doc = logistic(*summaries(model))
    if odds:
        model.doc[0] += np.log(odds * plain / toxic)
    return model


def learn(feat: np.ndarray, first: np.ndarray, toxic: np.ndarray, odds: float | None = None) -> Model:
    """The model from a sample at hand: features of its words, offsets of its documents, their labels."""
    return fit(lambda f, *values: f(feat, first, toxic, *values), lambda m: (summary(m.words(feat, first), first), toxic), odds)


def parts_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features of the words, offsets of the documents, labels) of each batch of sampled documents."""
    width = 1 + len(HEADS) + len(TAILS)
    for b in batches:
        if b.num_rows:
            data, ends = flat(b.column("f"))
            yield np.frombuffer(data.tobytes(), np.int32).reshape(-1, width), ends // (4 * width), (np.asarray(b.column("label")) > 0).astype(int)


def summed(rows: DataFrame) -> Total:
    """Adds up over the rows (f, label): tasks add up their own batches, and what is not 0 of their sums reaches the driver."""

    def total(f: Callable, *values: np.ndarray) -> list[np.ndarray]:
        none = [np.zeros_like(x) for x in f(np.zeros((0, 1 + len(HEADS) + len(TAILS)), np.int32), np.zeros(1, np.int64), np.zeros(0, int), *values)]
        shared = rows.sparkSession.sparkContext.broadcast(values)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for part in parts_of(batches):
                got = f(*part, *shared.value)
                sums = got if sums is None else [a + b for a, b in zip(sums, got, strict=True)]
            full = [np.flatnonzero(x).astype(np.int32) for x in sums or []]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(full)), pa.int32()), pa.array([i.tobytes() for i in full], pa.binary()), pa.array([x[i].tobytes() for x, i in zip(sums or [], full, strict=True)], pa.binary())], names=["k", "at", "v"])

        for r in rows.mapInArrow(run, "k int, at binary, v binary").collect():
            none[r["k"]][np.frombuffer(r["at"], np.int32)] += np.frombuffer(r["v"], np.float64)
        shared.destroy()
        return none

    return total


def train(docs: DataFrame, labels: DataFrame, *, column: str = "toxic", most: int = SAMPLE, held_out: int = 2, modulus: int = 4) -> Model:
    """Fit on all words of labelled documents outside the held-out fold, `most` of them at most."""
    prepare(docs.sparkSession)
    fold = lambda c: bucket_of(F.col(c), modulus) != held_out
    rows = labelled_sample(docs, labels, column, most, fold("_id"), TOXIC)
    yes, no = labels.where(fold("doc_id")).agg(F.count_if(F.col(column) > 0), F.count_if(F.col(column) <= 0)).first()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            w = words_of(b.column("text"))
            f = features(w)
            yield pa.RecordBatch.from_arrays([pa.array([f[a:e].tobytes() for a, e in zip(w.first[:-1], w.first[1:], strict=True)], pa.binary()), pa.array(b.column("label"))], names=["f", "label"])

    # few files, so that a round has few tasks; sorted, so that sums are the same each time
    held = materialise(rows.mapInArrow(run, "f binary, label int").repartition(PARTS).sortWithinPartitions("f", "label"))

    def summaries(model: Model) -> tuple[np.ndarray, np.ndarray]:
        def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for feat, first, toxic in parts_of(batches):
                x = summary(model.words(feat, first), first)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array(toxic, pa.int32())], names=["x", "toxic"])

        got = held.mapInArrow(each, "x binary, toxic int").collect()
        return np.stack([np.frombuffer(r["x"], np.float64) for r in got]), np.array([r["toxic"] for r in got], int)

    return fit(summed(held), summaries, yes / no if no else None)


def score(docs: DataFrame, model: Model, *, names: tuple[str, str] = ("toxicity", "toxic_spans")) -> DataFrame:
    """docs with toxicity (0 to 1) and toxic_spans, byte offsets with the mean marginal of their words; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if f.name not in names]
    docs = docs.select(*[docs[f.name] for f in keep])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches, "text"):
            w = words_of(b.column("text"))
            mu = m.words(features(w), w.first)
            spans: list[list[dict]] = [[] for _ in range(b.num_rows)]
            hot = np.flatnonzero(mu >= 0.5)
            if len(hot):
                doc = np.searchsorted(w.first, hot, "right") - 1
                for run_ in np.split(np.arange(len(hot)), np.flatnonzero((np.diff(hot) > 1) | (np.diff(doc) > 0)) + 1):
                    d, i, j = doc[run_[0]], hot[run_[0]], hot[run_[-1]]
                    spans[d].append({"start": int(w.start[i] - w.ends[d]), "stop": int(w.stop[j] - w.ends[d]), "p": float(mu[i : j + 1].mean())})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.scores(mu, w.first)), pa.array(spans, kind)], names=[*b.schema.names, *names])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return docs.mapInArrow(run, f"{out}, `{names[0]}` double, `{names[1]}` array<struct<start:long,stop:long,p:double>>")


def clean(docs: DataFrame, labels: DataFrame, *, most: float = THRESHOLD) -> DataFrame:
    """The documents that score below `most`, in the columns of docs."""
    names = unused(docs, "_toxicity"), unused(docs, "_spans")
    return score(docs, train(docs, labels), names=names).where(F.col(names[0]) < most).select(*docs.columns)


def op10_crf_toxicity(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = score(need(docs, "doc_id", "text"), train(docs, labels))
    p = F.col("toxicity").alias("score")
    return found.select("doc_id", (bucket_of(F.col("doc_id"), 4) == 2).alias("held_out"), p, (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"), F.size("toxic_spans").alias("n_spans"), "toxic_spans")
