"""Spelling variants: words one edit apart, found by bit-sliced position indices over groups of the vocabulary.

Of two words that differ by one edit, the place of the edit lies in a region of the shorter word; outside of it both are the
same. So words meet by (length of the shorter word, region, what is outside), at first with the two halves as regions. A group
of more than `most` words has its region halved again, until it holds or the region is one letter (then the alphabet bounds it).
A pair's place is its first difference, so each pair meets in one group, once.

A task packs groups into bins and indexes a bin by bitsets: for a position of the region and a letter, which words have it
there. Each shorter word is run through the index against all words of its group at once: per letter the sets of words that
match so far with no error, with one replaced letter (same position), or with one more letter (next position) are taken on by
and, or, not on whole machine words. Only counts and the best partner a word leave the task, never pairs.

Defined results: null and empty texts have no words; a null id counts as empty text in the hash; repeated rows count again, as
do repeated words; of partners equally frequent the least in code-point order is the form; an empty table, or one without words
frequent enough, gives an empty result; other columns are not read. How many words have one form is bounded by alphabet and
length; roots are found by pointer jumping, in as many rounds as the logarithm of the longest chain (itself logarithmic in n).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, need, prepare, text_of

#: What a run of letters is; letters that are lower-cased; one run in so many loses a letter; least length and number of a word.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ONE_IN, LEAST_LENGTH, LEAST_NUMBER = 97, 5, 3
#: Words of a group, and of a bin, before its region is halved; letters of a bin.
MOST, BIN_LETTERS = 2048, 1 << 18
#: Parts that a large group is dealt out to while it is halved.
SALTS = 64


def spelled(docs: DataFrame, *, one_in: int = ONE_IN) -> DataFrame:
    """word of each run of letters, of LEAST_LENGTH code points at least; one in `one_in` runs loses a letter, chosen by hash of id and run."""
    run = F.translate("run", UPPER, LOWER)
    runs = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text_of(), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= LEAST_LENGTH).select("id", run.alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= LEAST_LENGTH)


def vocabulary(words: DataFrame, least: int = LEAST_NUMBER) -> DataFrame:
    """word, n of words that occur `least` times or more."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def outside() -> list[Column]:
    """What words of a group have in common: m, lo, hi, the letters before lo and those behind hi (of the shorter word)."""
    behind = F.col("m") - F.col("hi")
    return [F.col("m"), F.col("lo"), F.col("hi"), F.concat(F.substring("word", F.lit(1), F.col("lo")), F.substring("word", F.length("word") - behind + 1, behind))]


def halves(rows: DataFrame) -> DataFrame:
    """Each row twice, with both halves of its region."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    both = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    return rows.select("word", "n", "m", F.inline(both))


class Bin:
    """Members of some groups: word, n, whether it is the longer one, its region's letters, whether the region ends the word."""

    def __init__(self) -> None:
        self.words: list[str] = []
        self.n: list[int] = []
        self.group: list[int] = []
        self.long: list[bool] = []
        self.last: list[bool] = []
        self.region: list[str] = []

    def add(self, group: list[tuple[str, int, bool, bool, str]]) -> None:
        k = self.group[-1] + 1 if self.group else 0
        for word, n, long, last, region in group:
            self.words.append(word)
            self.n.append(n)
            self.group.append(k)
            self.long.append(long)
            self.last.append(last)
            self.region.append(region)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """(shorter member, other member) of all pairs one edit apart; pairs of equal length both ways."""
        size = len(self.words)
        long, group = np.array(self.long, bool), np.array(self.group)
        length = np.array([len(r) for r in self.region])
        order = np.flatnonzero(~long)
        asks = order[np.argsort(-length[order], kind="stable")]  # longest region first: at each position those still running come first
        k, last, top = length[asks], np.array(self.last, bool)[asks], int(length.max())
        points = np.frombuffer("".join(self.region).encode("utf-32-le"), np.uint32)
        letters, code = np.unique(points, return_inverse=True)
        at = np.zeros((size, top + 2), np.int32)  # letters by position from 1 on, 0 where a region has none
        rows = np.repeat(np.arange(size), length)
        at[rows, np.arange(len(rows)) - np.repeat(np.cumsum(length) - length, length) + 1] = code.ravel() + 1

        def packed(flags: np.ndarray) -> np.ndarray:
            wide = np.zeros((len(flags), -(-size // 64) * 64), bool)
            wide[:, :size] = flags
            return np.packbits(wide, axis=1).view(np.uint64)

        index = lambda p: packed(at[:, p] == np.arange(len(letters) + 1)[:, None])  # noqa: E731 - a bitset a letter at position p
        masks = packed(group == np.arange(group[-1] + 1)[:, None])
        here = index(1)
        none = masks[group[asks]]  # matches so far without an error
        other, more = np.zeros_like(none), none & ~here[at[asks, 1]]  # with a replaced letter; with one more letter
        for p in range(1, int(k.max(initial=0)) + 1):
            on = slice(0, int(np.searchsorted(-k, -p, "right")))
            ask = asks[on]
            ahead = index(p + 1) if p + 1 < at.shape[1] else np.zeros_like(here)
            fits = here[at[ask, p]]
            other[on] = (other[on] & fits) | (none[on] & ~fits)
            none[on] &= fits
            seed = np.where((k[on] > p)[:, None], none[on] & ~ahead[at[ask, min(p + 1, at.shape[1] - 1)]], np.where(last[on][:, None], none[on], np.uint64(0)))
            more[on] = (more[on] & ahead[at[ask, p]]) | seed
            here = ahead
        shorts, longs = packed(~long[None]), packed(long[None])
        found = np.unpackbits(((other & shorts) | (more & longs)).view(np.uint8), axis=1)[:, :size]
        q, j = np.nonzero(found)
        return asks[q], j

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(members with a partner, number of partners, best partner)."""
        size = len(self.words)
        q, j = self.near()
        back = np.array(self.long, bool)[j]
        q, j = np.concatenate([q, j[back]]), np.concatenate([j, q[back]])
        by = np.array(sorted(range(size), key=lambda i: (-self.n[i], self.words[i])), np.int64)
        rank = np.empty(size, np.int64)
        rank[by] = np.arange(size)
        least = np.full(size, size, np.int64)
        np.minimum.at(least, q, rank[j])
        count = np.bincount(q, minlength=size)
        has = np.flatnonzero(count)
        return has, count[has], by[least[has]]


def partners(rows: Iterator[tuple], most: int) -> Iterator[tuple[list, list, list, list]]:
    """(words, numbers of partners, best partners' n, best partners) of bins of groups, from rows in group order: key, word, n, m, lo, hi."""
    held, key, group, letters = Bin(), None, [], 0

    def out(b: Bin) -> tuple[list, list, list, list]:
        has, count, best = b.best()
        return [b.words[i] for i in has.tolist()], count.tolist(), [b.n[i] for i in best.tolist()], [b.words[i] for i in best.tolist()]

    for k, word, n, m, lo, hi in chain(rows, [(None,) * 6]):
        if k != key:
            if len(group) > 1 and not all(long for _, _, long, _, _ in group):
                if held.words and (len(held.words) + len(group) > most or letters > BIN_LETTERS):
                    yield out(held)
                    held, letters = Bin(), 0
                held.add(group)
                letters += sum(len(r) for *_, r in group)
            key, group = k, []
        if word is not None:
            group.append((word, n, len(word) > m, hi == m, word[lo : len(word) - (m - hi)]))
    if held.words:
        yield out(held)


def near_words(vocab: DataFrame, most: int = MOST) -> DataFrame:
    """word, n_near, form_n, form: how many words of the vocabulary (word, n) are one edit away, and the most frequent of them."""
    length = F.length("word")
    roles = F.when(length > LEAST_LENGTH, F.array(length, length - 1)).otherwise(F.array(length))  # as the shorter word, as the longer one
    rows = vocab.select("word", "n", F.explode(roles).alias("m")).select("word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi"))
    rows, ready = halves(rows), []
    while True:
        sizes = rows.where("hi - lo > 1").groupBy(*[c.alias(f"_{i}") for i, c in enumerate(outside())]).agg(F.count("*").alias("size")).where(F.col("size") > most)
        large = materialise(sizes.select("_0", "_1", "_2", "_3"))
        if not large.limit(1).count():
            ready.append(rows)
            break
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
        key = [F.col(f"_{i}") == c for i, c in enumerate(outside())]
        spread = large.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        split = materialise(salted.join(spread, [*key, F.col("_salt") == F.col("_s")], "left").select("word", "n", "m", "lo", "hi", F.col("_s").isNotNull().alias("large")))
        ready.append(split.where("not large").drop("large"))
        rows = halves(split.where("large"))
    for more in ready[1:]:
        ready[0] = ready[0].unionByName(more)
    placed = ready[0].repartition(*outside()).sortWithinPartitions(*outside())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                for word, n, m, lo, hi in zip(*(b.column(c).to_pylist() for c in ("word", "n", "m", "lo", "hi")), strict=True):
                    yield (m, lo, hi, word[:lo], word[len(word) - (m - hi) :]), word, n, m, lo, hi

        for words, count, n, form in partners(each(), most):
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(count, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string())], names=["word", "count", "n", "form"])

    found = placed.mapInArrow(run, "word string, count long, n long, form string")
    best = found.groupBy("word").agg(F.sum("count").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), "form")).alias("best"))
    return best.select("word", "n_near", (-F.col("best.minus")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of each word with a form (word, form), by pointer jumping."""
    known = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while known.where("open").limit(1).count():
        t = known.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        on = known.where("open").join(t, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("open"))
        known = materialise(known.where("not open").unionByName(on))
    return known.select("word", "root")


def variants(vocab: DataFrame, most: int = MOST) -> DataFrame:
    """word, n, n_near, form, form_n, root of each word of the vocabulary (word, n)."""
    vocab = materialise(vocab.select("word", "n"))
    near = near_words(vocab, most)
    good = F.col("form_n") >= 2 * F.col("n")
    both = vocab.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n"))
    both = materialise(both)
    found = roots(both.where("form is not null").select("word", "form"))
    return both.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    docs = need(prepare(spark).read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return variants(vocabulary(spelled(docs))).select("word", "form", "root", "n", "n_near", "form_n")
