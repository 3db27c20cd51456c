"""What the operators of this folder share: materialised tables and exact range splitters."""

from __future__ import annotations

import tempfile
import uuid
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of an Arrow batch sent to a Python worker, and of the texts that numpy works on at once; one row may exceed them.
BATCH_BYTES, PIECE_BYTES = 4 << 20, 1 << 18


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches by bytes, so that long texts don't pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's spark.checkpoint.dir. Only a local session without that setting gets one of its own; a cluster must name it."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = "file://" + tempfile.mkdtemp(prefix="watchloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def ranked(table: DataFrame, *order: Column) -> DataFrame:
    """table, written and reread, with `rank` from 0 in that order: a range shuffle, a count per range, a window within each."""
    parts = materialise(table.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    counts = {r["range"]: r["count"] for r in parts.groupBy("range").count().collect()}  # a row per partition
    at, starts = 0, []
    for k in sorted(counts):
        starts += [F.lit(k), F.lit(at)]
        at += counts[k]
    first = F.create_map(*starts)[F.col("range")] if starts else F.lit(0)
    return parts.withColumn("rank", (first + F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1).cast("long")).drop("range")


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, and lost executors can't take it along."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeats(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """_row, _copy of written rows (with `_row`, a number of their own): a number from 1 on for all but the first of the rows of a key, by `order`.

    Tasks number the rows they see that are equal in both; the counts by task, a row a task, are added up in order. No task meets more rows
    equal in both than it reads. order: a column of whole numbers; rows equal in both are taken as interchangeable.
    """
    rows = rows.select(F.col(key).alias("_of"), (F.lit(0) if order is None else F.col(order)).cast("long").alias("_by"), "_row")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = defaultdict(int)
        part = TaskContext.get().partitionId()
        for b in batches:
            nth = []
            for k in zip(b.column("_of").to_pylist(), b.column("_by").to_pylist(), strict=True):
                nth.append(seen[k])
                seen[k] += 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(nth), part, np.int32)), pa.array(nth, pa.int64())], names=["_of", "_by", "_row", "_part", "_nth"])

    narrow = materialise(rows.mapInArrow(number, f"_of {rows.schema['_of'].dataType.simpleString()}, _by long, _row long, _part int, _nth long"))
    groups = ["_of", "_by", "_part"]
    tally = narrow.groupBy(*groups).agg((F.max("_nth") + 1).alias("_n"))
    of_key = Window.partitionBy("_of")
    before = F.sum("_n").over(of_key.orderBy("_by", "_part")) - F.col("_n")
    many = tally.withColumns({"_all": F.sum("_n").over(of_key), "_before": before}).where("_all > 1").select(*groups, "_before")
    return materialise(narrow.join(many, groups).select("_row", (F.col("_nth") + F.col("_before")).alias("_copy")).where("_copy > 0"))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def need(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns that an operator reads; others, whatever their names, don't get in its way."""
    return df.select(*[df[n] for n in names])


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of the text column."""
    for b in batches:
        if not b.num_rows:
            continue
        ends = np.frombuffer(b.column(column).buffers()[1], np.int64 if pa.types.is_large_string(b.column(column).type) else np.int32)[b.column(column).offset :][: b.num_rows + 1].astype(np.int64)
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


# --- exact splitters by histograms -------------------------------------------------------------

KEY_BYTES = 16
TOP = 1 << (8 * KEY_BYTES)


def ordered_key(first: Column, second: Column, *, descending: bool = False) -> Column:
    """16 bytes that order like two longs (as signed numbers): null first, or last if descending."""
    flip = lambda c: F.lpad(F.hex(F.coalesce(c, F.lit(-(1 << 63))).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    both = F.concat(flip(first), flip(second))
    return F.unhex(F.translate(both, "0123456789ABCDEF", "FEDCBA9876543210") if descending else both)


def keys_of(column: pa.Array) -> np.ndarray:
    """A binary column of KEY_BYTES a row as an array that sorts by bytes."""
    return np.frombuffer(b"".join(x if x is not None else bytes(KEY_BYTES) for x in column.to_pylist()), dtype=">u8").reshape(-1, KEY_BYTES // 8).astype(np.uint64)


def below(keys: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """For each key, how many of the ascending probes are at most as large."""
    low, high = np.searchsorted(probes[:, 0], keys[:, 0], "left"), np.searchsorted(probes[:, 0], keys[:, 0], "right")
    for i in np.flatnonzero(low != high):
        low[i] += np.searchsorted(probes[low[i] : high[i], 1], keys[i, 1], "right")
    return low


def halves(numbers: Iterable[int]) -> np.ndarray:
    return np.array([(n >> 64, n & ((1 << 64) - 1)) for n in numbers], dtype=np.uint64).reshape(-1, 2)


def histogram(table: DataFrame, probes: list[int]) -> tuple[list[int], list[int]]:
    """Exact weight and rows below each probe: each partition counts its own, Spark adds up, len(probes) + 1 rows reach the driver."""
    bounds = halves(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, rows = np.zeros(len(bounds) + 1, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for b in batches:
            if b.num_rows:
                at = below(keys_of(b.column("key")), bounds)
                np.add.at(weight, at, np.asarray(b.column("weight"), np.int64))
                rows += np.bincount(at, minlength=len(rows))
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(weight[full]), pa.array(rows[full])], names=["bin", "weight", "rows"])

    got = table.select("key", "weight").mapInArrow(count, "bin int, weight long, rows long").groupBy("bin").agg(F.sum("weight").alias("weight"), F.sum("rows").alias("rows")).collect()
    weight, rows = np.zeros(len(bounds) + 1, object), np.zeros(len(bounds) + 1, object)
    for r in got:
        weight[r["bin"]], rows[r["bin"]] = r["weight"], r["rows"]
    return list(np.cumsum(weight)[:-1]), list(np.cumsum(rows)[:-1])


def splitters(table: DataFrame, total: int, parts: int, *, tolerance: float = 0.01, probes: int = 4096) -> list[int]:
    """parts - 1 ascending keys that cut the table's weight into near equal parts.

    Each round counts the exact weight below candidate keys and keeps, for each splitter, the two
    candidates around its goal; new candidates divide what is between them. A splitter is settled
    when it is within `tolerance` of a part, or when one row at most lies between its candidates.
    """
    goals = [total * k // parts for k in range(1, parts)]
    slack = max(1, int(tolerance * total / parts))
    known, rows = {0: 0, TOP - 1: total}, {0: 0, TOP - 1: table.count()}
    best: dict[int, int] = {}
    asked = sorted({TOP * k // (probes + 1) for k in range(1, probes + 1)}) if goals else []
    while asked:
        weights, counts = histogram(table, asked)
        known |= dict(zip(asked, weights, strict=True))
        rows |= dict(zip(asked, counts, strict=True))
        order = sorted(known)
        sums = [known[k] for k in order]
        asked_next: set[int] = set()
        for i, goal in enumerate(goals):
            if i in best:
                continue
            at = bisect_right(sums, goal)
            low, high = order[max(0, at - 1)], order[min(at, len(order) - 1)]
            near = min((low, high), key=lambda k: abs(known[k] - goal))
            if abs(known[near] - goal) <= slack or high - low <= 1 or rows[high] - rows[low] <= 1:
                best[i] = near
                continue
            steps = max(1, min(63, probes // len(goals)))
            asked_next |= {low + (high - low) * j // (steps + 1) for j in range(1, steps + 1)} - {low, high}
        asked = sorted(asked_next - known.keys())
    return sorted(best[i] for i in range(len(goals)))


def slice_of(bounds: list[int], key: str = "key") -> Column:
    """The number of splitters at or below the key, as a column."""
    edges = halves(bounds)

    @F.pandas_udf("int")
    def find(k: pd.Series) -> pd.Series:
        return pd.Series(below(keys_of(pa.array(k, pa.binary())), edges).astype("int32"))

    return find(F.col(key)) if bounds else F.lit(0)


def pick(values: Iterable[int], at: Column) -> Column:
    """values[at], for more values than fit in a plan."""
    held = np.array(list(values), np.int64)

    @F.pandas_udf("long")
    def find(i: pd.Series) -> pd.Series:
        return pd.Series(held[i.to_numpy()])

    return find(at)


#: Bytes of text of a labelled sample at most.
SAMPLE_BYTES = 64 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: int, where: Column | None = None, positive: int | None = None, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """text and label of at most `most` labelled documents of docs, those of lowest hash of the id, whole ones of sample_bytes in all at most.

    A document that would exceed sample_bytes is left out, not those after it; a text that alone exceeds it is never in the sample.

    An id counts once, with its least text, however often it repeats. positive: take this many with a label above 0 at most, the others from the rest.
    """
    own = labels.select(F.col("doc_id").alias("_id"), F.col(column).cast("int").alias("label")).where("label is not null and _id is not null")
    own = own.groupBy("_id").agg(F.max("label").alias("label")).join(docs.select(docs["doc_id"].alias("_id")), "_id", "left_semi")
    if where is not None:
        own = own.where(where)
    order = (F.xxhash64("_id"), F.col("_id"))
    few = own.orderBy(*order).limit(most) if positive is None else own.where("label > 0").orderBy(*order).limit(positive).union(own.where("label <= 0").orderBy(*order).limit(most - positive))
    few = materialise(few)  # `most` rows: the broadcast is safe
    text = docs.select(docs["doc_id"].alias("_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = materialise(text.join(F.broadcast(few), "_id").groupBy("_id", "label").agg(F.min("text").alias("text")))
    taken, total = [], 0
    for r in rows.select("_id", F.octet_length("text").alias("n")).orderBy(*order).collect():  # `most` rows
        if total + r["n"] <= sample_bytes:  # one that doesn't fit is passed over; smaller ones after it may
            taken.append(r["_id"])
            total += r["n"]
    rows = rows.where(F.col("_id").isin(taken))
    return rows.select("text", "label")


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")
