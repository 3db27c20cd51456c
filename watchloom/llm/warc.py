"""WARC archives (ISO 28500) with revisit resolution.

Headers (digest, length, id), never payloads, are grouped by payload digest; of equal payloads one is
the response, the others become revisit records that refer to it. Archives are written by Spark's
text writer through whatever file system holds the shared folder: a record's bytes end in CR LF and the line
separator adds the second one. A task begins a new file when the next record would take it past FILE_BYTES; a file holds more only if
one record does. Compression is that of the writer, one gzip member a file (Spark writes no bytes but through a codec, so records
have no members of their own). Reading goes by Content-Length, so payloads may hold anything; it unpacks and hashes a file
slice by slice.

Defined results: a null html is an empty payload; payloads below `least` bytes are all responses; of
equal payloads that with the largest page_id is response (null ids last; if all are null, they stay
responses), and rows that repeat its page_id with the same payload are stored as responses too; control
characters and blanks in URLs are percent-encoded one by one, a null URL is `about:blank`; other columns are not
archived; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, need, prepare, shared_dir

#: WARC-Date of all records, so that reruns write the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records in an archive file, before compression; bytes that a reader unpacks at once.
FILE_BYTES, SLICE = 64 << 20, 1 << 20
FIELDS = "page_id long, record_id string, record_type string, refers_to_id string, payload_digest string, stored_bytes long, stored_digest string"


def resolve(pages: DataFrame, *, least: int = 1000) -> DataFrame:
    """page_id, url, body, digest, refers_to (null: response). The body moves once, by page and not by digest."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = need(pages, "page_id", "url", "html")
    digest = F.sha1(body)
    heads = rows.select("page_id", digest.alias("digest"), F.octet_length(body).alias("n")).where(F.col("n") >= least)
    first = heads.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("rows")).where("rows > 1 and refers_to is not null").drop("rows")
    first = materialise(first)  # on its own, so that Spark can split a payload that many pages share in the join
    revisits = heads.join(first, ["digest", "n"]).where("page_id is null or page_id <> refers_to").select("page_id", F.col("digest"), "refers_to").dropDuplicates()
    r = revisits.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to")
    b = rows.select("page_id", "url", "html", digest.alias("digest"))
    return b.join(r, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left").select("page_id", "url", F.coalesce("html", F.lit("")).alias("body"), "digest", "refers_to")


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("null")), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.substring(h, a, b), F.lit("-"))][:-1], F.lit(">"))


def records(resolved: DataFrame) -> DataFrame:
    """One string a record, up to the first CR LF after its block."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    odd = r"[\x00-\x20\x7F]"
    coded = F.array_join(F.transform(F.split("url", ""), lambda c: F.when(F.regexp_like(c, F.lit(odd)), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0"))).otherwise(c)), "")
    safe = F.coalesce(F.when(F.regexp_like("url", F.lit(odd)), coded).otherwise(F.col("url")), F.lit("about:blank"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("body"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", safe),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(F.col("page_id").isNotNull(), line("X-Page-Id", F.col("page_id").cast("string"))).otherwise(F.lit("")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("refers_to"), F.col("digest"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return resolved.select(F.concat(head, block, F.lit("\r\n")).alias("value"))


def write(resolved: DataFrame, path: str, *, compression: str = "gzip", file_bytes: int = FILE_BYTES) -> None:
    def rolled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The records with the number of their file, unique over all tasks."""
        task, number, held = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            files = []
            for n in b.column("n").to_pylist():
                if held and held + n > file_bytes:
                    number, held = number + 1, 0
                held += n
                files.append(f"{task}-{number:06}")
            yield pa.RecordBatch.from_arrays([b.column("value"), pa.array(files, pa.string())], names=["value", "file"])

    rows = records(resolved).withColumn("n", F.octet_length("value") + 2).mapInArrow(rolled, "value string, file string")
    rows.write.partitionBy("file").option("lineSep", "\r\n").option("compression", compression).text(path)


def unpacked(data: bytes) -> Iterator[bytes]:
    """The bytes of an archive file, whole or in gzip members, slice by slice."""
    if data[:2] != b"\x1f\x8b":
        yield from (data[i : i + SLICE] for i in range(0, len(data), SLICE))
        return
    while data:
        z = zlib.decompressobj(31)
        while not z.eof:
            out = z.decompress(data, SLICE)
            if not out and not z.unconsumed_tail and not z.eof:
                raise ValueError("the file ends within a gzip member")
            data = z.unconsumed_tail
            yield out
        data = z.unused_data


def parse(slices: Iterable[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Headers (lower-case names) and block, in slices, of each record; a block is to be read before the next record."""
    source, held, at = iter(slices), bytearray(), 0

    def more() -> bool:
        nonlocal at
        got = next(source, None)
        del held[:at]
        held.extend(got or b"")
        at = 0
        return got is not None

    def body(left: int) -> Iterator[bytes]:
        nonlocal at
        while left:
            if at == len(held) and not more():
                raise ValueError("the file ends within a record")
            part = bytes(held[at : at + left])
            at, left = at + len(part), left - len(part)
            if part:
                yield part

    while at < len(held) or more():
        if at == len(held):
            continue
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                raise ValueError("no end of a header")
        lines = held[at:end].decode().split("\r\n")
        at = end + 4
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {lines[0][:40]!r}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield head, body(int(head["content-length"]))
        while len(held) - at < 4 and more():
            pass
        if held[at : at + 4] != b"\r\n\r\n":
            raise ValueError("no end of a record")
        at += 4


def read(spark: SparkSession, path: str) -> DataFrame:
    """FIELDS of each record; digest and length of what is stored are taken from the stored bytes."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                rows = []
                for head, block in parse(unpacked(b.column("content")[k].as_py())):
                    page, digest, n = head.get("x-page-id"), hashlib.sha1(), 0
                    for part in block:
                        digest.update(part)
                        n += len(part)
                    rows.append((int(page) if page else None, head["warc-record-id"], head["warc-type"], head.get("warc-refers-to"), head["warc-payload-digest"].removeprefix("sha1:"), n, digest.hexdigest()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, FIELDS)


def lookup(archive: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record; revisits get their payload's length from the response they name."""
    own = archive.where("record_type = 'response'").select("page_id", F.col("stored_bytes").alias("payload_bytes"), F.col("stored_digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    target = archive.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.first("page_id").alias("refers_to"), F.first("stored_bytes").alias("payload_bytes"), F.first("stored_digest").alias("digest"))
    target = materialise(target)  # for the same reason
    again = archive.where("record_type = 'revisit'").join(target, "refers_to_id", "left")
    return own.unionByName(again.select("page_id", "payload_bytes", F.when(F.col("digest") == F.col("payload_digest"), F.col("digest")).alias("payload_digest"), "record_type", "refers_to"))


def op4_warc_revisits(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    path = shared_dir(prepare(spark))
    write(resolve(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)

    return lookup(materialise(read(spark, path)))
