"""Mix sources to target weights by balanced sampling with the cube method.

Every document has an expected number of copies: the target of its source over the source's size. The
whole part is taken for sure. The fractional part is an inclusion probability; the flight phase
moves these probabilities along the null space of the balancing constraints (sum of sizes, number
of documents), so both totals stay put while one probability after another settles at 0 or 1. It
runs bucket by bucket; what stays open (two units a bucket at most) meets in fewer, larger
buckets, until one small landing problem a source is left: a linear programme over the subsets of its last units.

Defined results: a null text has size 0; null is a source of its own, ordered last; rows equal in
id, source and size are one unit with several copies, dealt out evenly, so that none is drawn
over twice; a source of size 0 has target 0 and takes nothing; an empty table gives an empty
result; other columns are not touched.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, need, prepare, ranked, repeats

#: A word: a run of other characters than ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target. Weights repeat over the sources in code point order, null last.

    No target passes cap times its source's size; what is above goes to the others by weight, again and
    again. Only sums reach the driver.
    """
    order = (F.col("source").isNull(), F.col("source"))
    t = ranked(sizes, *order)
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int")))
    t = materialise(t.select("source", "source_size", "weight", (F.col("source_size") * cap).alias("most")))
    level = 0.0
    while True:
        free = F.col("most") > F.col("weight") * level
        s = t.agg(
            F.sum(F.col("source_size").cast("decimal(38,0)")).alias("all"),
            F.sum(F.when(~free, F.col("most"))).alias("full"),
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
        ).first()
        if not s["weight"]:
            break
        above = (share * float(s["all"]) - (s["full"] or 0.0)) / s["weight"]
        if above <= level * (1 + 1e-12):
            break
        level = above
    return t.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def fly(p: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Flight phase: settles all probabilities but two at most, keeping their sum and their sum by size."""
    p, hold = list(p), []
    for i in range(len(p)):
        if 0 < p[i] < 1:
            hold.append(i)
        while len(hold) == 3:
            a, b, c = hold
            move(p, hold, (size[b] - size[c], size[c] - size[a], size[a] - size[b]), rng)
    if len(hold) == 2 and size[hold[0]] == size[hold[1]]:
        move(p, hold, (1.0, -1.0), rng)
    return p


def move(p: list[float], hold: list[int], way: tuple[float, ...], rng: random.Random) -> None:
    """A random step along `way`, far enough to settle one of `hold`; the mean of each probability stays."""
    if not any(way):
        way = (1.0, -1.0, 0.0)[: len(way)] if len(way) > 1 else (1.0,)
    ahead = min((1 - p[i]) / u if u > 0 else p[i] / -u for i, u in zip(hold, way, strict=True) if u)
    back = min(p[i] / u if u > 0 else (1 - p[i]) / -u for i, u in zip(hold, way, strict=True) if u)
    step = ahead if rng.random() * (ahead + back) < back else -back
    for i, u in zip(hold, way, strict=True):
        p[i] += step * u
        p[i] = 0.0 if p[i] < 1e-9 else 1.0 if p[i] > 1 - 1e-9 else p[i]
    left = [i for i in hold if 0 < p[i] < 1]
    if len(left) == len(hold):  # rounding kept all open: settle the nearest
        i = min(left, key=lambda k: min(p[k], 1 - p[k]))
        p[i] = float(round(p[i]))
        left.remove(i)
    hold[:] = left


#: Units that are left to the landing at most: it weighs all their subsets.
LANDING = 12
#: Error of a source, as a part of its target, above which the landing rather changes a probability.
NEAR = 0.02


def land(p: list[float], size: list[float], rng: random.Random, target: float | None = None) -> list[float]:
    """Landing: the flight settles all units but LANDING, the largest and some smaller ones; of these one subset is drawn by the best design.

    The design is the linear programme over all subsets that keeps each unit's probability and makes the expected squared error of the
    sum of sizes (that of the count little beside it) least. With a target (of all the source), probabilities may change where keeping them
    would cost more than NEAR of it: a document that is much of its source can't be left out and made up for.
    """
    p = list(p)
    still = [i for i, x in enumerate(p) if 0 < x < 1]
    large = sorted(still, key=lambda i: size[i])
    most = LANDING - 2
    rest, few = large[: -(most * 2 // 3)], most - most * 2 // 3
    kept = set(large) if len(large) <= most else set(large[len(rest) :]) | {rest[k * len(rest) // few] for k in range(few)}
    go = [i for i in still if i not in kept]
    for i, x in zip(go, fly([p[i] for i in go], [size[i] for i in go], rng), strict=True):
        p[i] = x
    hold = [i for i in still if 0 < p[i] < 1]
    if hold:
        for i, x in zip(hold, drawn(np.array([p[i] for i in hold]), np.array([size[i] for i in hold]), rng, target), strict=True):
            p[i] = float(x)
    return p


def drawn(p: np.ndarray, size: np.ndarray, rng: random.Random, target: float | None = None) -> np.ndarray:
    """A subset (0 or 1 a unit) from the design of least expected error that includes each unit with its probability (see land)."""
    n = len(p)
    sets = ((np.arange(1 << n)[:, None] >> np.arange(n)) & 1).astype(float)
    cost = ((sets - p) @ size / max(target or float(size.max()), 1.0)) ** 2 + 1e-6 * ((sets - p).sum(axis=1) / n) ** 2
    rows, want = np.column_stack([np.ones(1 << n), sets]), np.append(1.0, p)
    if target is not None:  # what a changed probability costs, up and down
        one = np.eye(n + 1)[1:]
        rows, cost = np.concatenate([rows, one, -one]), np.append(cost, np.full(2 * n, NEAR**2))
    apart = want + np.append(0.0, 1e-7 * np.arange(1, n + 1))  # equal probabilities would let the steps go in circles
    order = np.argsort(-apart[1:], kind="stable")
    basis = np.append(0, np.cumsum(1 << order))  # no unit, the likeliest, the two likeliest, ...: a design with these probabilities
    for _ in range(50 * n):
        b = rows[basis].T
        price = np.linalg.solve(b.T, cost[basis])
        gain = cost - rows @ price
        into = int(gain.argmin())
        if gain[into] > -1e-10:
            break
        share, way = np.linalg.solve(b, apart), np.linalg.solve(b, rows[into])
        far = np.full(n + 1, np.inf)
        far[way > 1e-9] = np.maximum(share[way > 1e-9], 0) / way[way > 1e-9]
        basis[int(far.argmin())] = into
    share = np.where(basis < 1 << n, np.maximum(np.linalg.solve(rows[basis].T, want), 0), 0)
    return sets[basis[rng.choices(range(n + 1), share.tolist())[0]]]


def level(units: DataFrame, last: bool, seed: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id"], na_position="first", kind="stable")
        rng = random.Random(f"{seed} {pdf['source'].iloc[0]} {pdf['bucket'].iloc[0]} {len(pdf)}")
        given = pdf["open"].tolist(), [float(x) for x in pdf["size"]], rng
        pdf["open"] = land(*given, float(pdf["target"].iloc[0])) if last else fly(*given)
        return pdf

    return units.groupBy("source", "bucket").applyInPandas(run, units.schema)


def balanced(units: DataFrame, *, bucket_rows: int = 256, seed: int = 7) -> DataFrame:
    """units (doc_id, source, size, open, ...) with `open` settled at 0 or 1, balanced in each source."""
    done = None
    most = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    while True:
        last = most <= bucket_rows
        buckets = 1 if last else -(-most // bucket_rows)
        mixed = F.pmod(F.xxhash64("doc_id", F.col("doc_id").isNull(), "size", F.lit(seed)), F.lit(buckets)).cast("long")
        units = materialise(level(units.withColumn("bucket", mixed), last, seed))
        settled = units.where("open = 0 or open = 1").drop("bucket")
        done = settled if done is None else done.unionByName(settled)
        if last:
            return done
        units = units.where("open > 0 and open < 1").drop("bucket")
        most = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0


def draw(docs: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, bucket_rows: int = 256, seed: int = 7) -> DataFrame:
    """doc_id, source, size, rows, source_size, target, total: how many copies of these equal rows are in the mix."""
    prepare(docs.sparkSession)
    rows = need(docs, "doc_id", "source", "text").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    facts = materialise(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")))
    t = targets(facts.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights=weights, share=share, cap=cap)
    t = materialise(t)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = facts.alias("f").join(t.alias("t"), F.col("f.source").eqNullSafe(F.col("t.source"))).select("f.*", "source_size", "target", (rate * F.col("rows")).alias("want"))
    near = F.round("want")
    sure = F.when(F.abs(F.col("want") - near) < 1e-9, near).otherwise(F.floor("want"))
    u = u.withColumn("sure", sure.cast("long")).withColumn("open", F.greatest(F.col("want") - F.col("sure"), F.lit(0.0))).drop("want")
    u = materialise(u)
    drawn = balanced(u.where("open > 1e-12 and size > 0"), bucket_rows=bucket_rows, seed=seed).unionByName(u.where("not (open > 1e-12 and size > 0)").withColumn("open", F.lit(0.0)))
    return drawn.select("doc_id", "source", "size", "rows", "source_size", "target", (F.col("sure") + F.col("open").cast("long")).alias("total"))


def nth_copies(n: Column) -> Column:
    """Copies of the n-th (from 0) of `rows` equal rows that share `total` copies."""
    return (F.floor(F.col("total") / F.col("rows")) + F.when(n < F.col("total") % F.col("rows"), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, **how) -> DataFrame:  # noqa: ANN003
    """doc_id, source, size, source_size, target, copies: one row a document, how often it is in the mix."""
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))
    out = draw(docs, **how).withColumn("n", each)
    return out.select("doc_id", "source", "size", "source_size", "target", nth_copies(F.col("n")).alias("copies"))


#: Equal rows that hold more than one in HOT of all rows: HOT different ones at most.
HOT = 4096


def mixed(docs: DataFrame, **how) -> DataFrame:  # noqa: ANN003
    """The documents of the mix, with repeats, in the columns of docs.

    Rows equal in id, source and size share the copies of their unit in the order of a hash of all columns; rows equal in that are the
    same. Units of many rows are broadcast (HOT at most), so that a repeated row meets in no single task.
    """
    key = lambda size: F.to_json(F.struct("doc_id", "source", size.alias("size"))).alias("_key")
    units = materialise(draw(docs, **how).select(key(F.col("size")), "rows", "total"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), key(word_count(docs["text"])))
    share = units.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] // HOT
    often = (F.col("rows") > share) & (F.col("rows") > 1)
    hot = F.broadcast(units.where(often))
    met = rows.join(hot, "_key").unionByName(rows.join(hot.select("_key"), "_key", "left_anti").join(units.where(~often), "_key")).where("total > 0")
    many = met.where("rows > 1").withColumns({"_row": F.monotonically_increasing_id(), "_by": F.xxhash64(*[F.col("_doc")[c] for c in docs.columns])})
    many = materialise(many)
    again = many.join(repeats(many, "_key", "_by"), "_row", "left").withColumn("_copies", nth_copies(F.coalesce("_copy", F.lit(0))))
    out = met.where("rows = 1").withColumn("_copies", F.col("total")).select("_doc", "_copies").unionByName(again.select("_doc", "_copies")).where("_copies > 0")
    return out.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).select("_doc.*")


def op1_cube_mix(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    m = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
