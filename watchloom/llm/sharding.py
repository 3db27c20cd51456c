"""Shard by histogram sort: exact byte counts below candidate keys, refined until the splitters hold, then one exchange.

Documents are ordered by (hash of the text, hash of the id and, among rows equal in both, of a number from 1 on): equal texts stand
together, and a group too large for a shard can still be cut, one row repeated over and over too. The law is `bytes`: shards get near equal bytes. Splitters
are sought for `slices` ranges a shard, so that no task sorts a whole shard; a row's slot is the
exact count of rows below its slice, from the same histogram, plus its place in the slice.

Defined results: a null text has no bytes (size 1, CRC 0); null ids hash as 0; rows equal in id and
text are interchangeable and get different slots (which of them has which number is open, so more columns may come in another order); with fewer rows than shards some shards are
empty; an empty table gives an empty result; other columns ride along in `shard_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchloom.llm.common import histogram, materialise, need, ordered_key, pick, prepare, repeats, slice_of, splitters


#: Slices of a shard at most: what the driver holds of each is a key and two counts.
MOST_SLICES = 1024


def told_apart(keyed: DataFrame) -> DataFrame:
    """keyed, written, with other keys for all but one of the rows that have one `key`, still behind its first half."""
    rows = materialise(keyed.withColumn("_row", F.monotonically_increasing_id()))
    again = repeats(rows, "key")
    if not again.limit(1).count():
        return rows.drop("_row")
    other = F.unhex(F.lpad(F.hex(F.xxhash64(F.substring("key", 9, 8), "_copy")), 16, "0"))
    both = rows.join(again, "_row", "left").withColumn("key", F.when(F.col("_copy").isNull(), F.col("key")).otherwise(F.concat(F.substring("key", 1, 8), other)))
    return materialise(both.drop("_row", "_copy"))


def shard_rows(rows: DataFrame, key: Column, weight: Column, *, shards: int = 16, slice_rows: int = 250_000, tolerance: float = 0.01) -> DataFrame:
    """rows with `shard` and `slot` (instead of columns of these names); splitters come from a narrow table of keys and weights, rows are exchanged once, once more if keys repeat.

    A shard has 8 slices, or more when it would have over slice_rows rows a slice.

    tolerance: of a slice, so a shard's weight is off by tolerance / slices of it, but for a single row that weighs more.
    """
    own = F.struct(*[rows[c] for c in rows.columns if c.lower() not in ("shard", "slot")])
    keyed = told_apart(rows.select(own.alias("own"), key.alias("key"), weight.cast("long").alias("weight")))
    narrow = keyed.select("key", "weight")
    total, n = narrow.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.count("*")).first()
    slices = min(MOST_SLICES, max(8, -(-n // (shards * slice_rows))))
    bounds = splitters(narrow, total, shards * slices, tolerance=tolerance)
    under = [0, *histogram(narrow, bounds)[1]]
    starts = [int(under[k] - under[k - k % slices]) for k in range(shards * slices)]
    cut = keyed.withColumn("slice", slice_of(bounds)).repartition(shards * slices, "slice")
    place = F.row_number().over(Window.partitionBy("slice").orderBy("key")) - 1
    slot = pick(starts, F.col("slice")) + place
    return cut.withColumn("slot", slot.cast("long")).select("own.*", F.floor(F.col("slice") / slices).cast("int").alias("shard"), "slot")


def by_text_key() -> Column:
    return ordered_key(F.xxhash64(F.coalesce("text", F.lit(""))), F.xxhash64("doc_id"))


def op7_histogram_shards(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    docs = need(prepare(spark).read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    data = F.coalesce("text", F.lit(""))
    size = (F.octet_length(data) + 1).cast("long")
    facts = docs.select("doc_id", size.alias("size"), F.crc32(data.cast("binary")).alias("text_crc32"), by_text_key().alias("at"))
    out = shard_rows(facts, F.col("at"), F.col("size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
