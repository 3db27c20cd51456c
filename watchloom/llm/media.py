"""Media columns: ISO base media containers (ISO/IEC 14496-12) as binary values.

`inspect` walks the nested boxes, decodes the sample tables run by run, and the runs of movie fragments, and gives codec, duration
and the byte ranges of sync samples of every track; it never decodes a payload. `wrap` stores 8-bit mono PCM
losslessly as an audio track. Both work on one value at a time inside mapInArrow.

Defined results: a null or broken container gives `error` and nulls, never an exception; boxes that
run past their parent are cut off there; tables that tell of more samples than there are bytes, or of bytes past the end, are errors,
found before anything of that size is made; a null text is an empty one, whose payload is 64 bytes 0; equal texts give equal
containers; an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from watchloom.llm.common import need, pieces, prepare

#: Boxes that hold boxes.
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"dinf", b"stbl", b"edts", b"udta", b"mvex", b"moof", b"traf", b"sinf", b"schi"}
#: Samples a second of a wrapped payload, and samples of a chunk.
RATE, CHUNK = 8000, 1 << 16
TRACK_FIELDS = "codec:string,handler:string,timescale:long,duration_s:double,n_samples:long,keyframes:array<struct<start:long,stop:long>>"
MEDIA_FIELDS = f"codec string, handler string, timescale long, duration_s double, n_samples long, media_bytes long, keyframes array<struct<start:long,stop:long>>, error string, tracks array<struct<{TRACK_FIELDS}>>"
NAMES = ["codec", "handler", "timescale", "duration_s", "n_samples", "media_bytes", "keyframes", "error", "tracks"]
RANGES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def box(kind: bytes, *body: bytes) -> bytes:
    data = b"".join(body)
    return struct.pack(">I4s", 8 + len(data), kind) + data if len(data) < 2**32 - 8 else struct.pack(">I4sQ", 1, kind, 16 + len(data)) + data


def full(kind: bytes, *body: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *body)


def wrap(payload: bytes, rate: int = RATE, chunk: int = CHUNK) -> bytes:
    """A container with one track of 8-bit integer PCM (sample entry `ipcm`, ISO/IEC 23003-5)."""
    n = len(payload)
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso6")
    entry = box(b"ipcm", bytes(6), struct.pack(">H8xHHHHI", 1, 1, 8, 0, 0, rate << 16), full(b"pcmC", bytes([1, 8])))
    chunks, rest = divmod(n, chunk)
    runs = [(1, chunk, 1)] * bool(chunks) + [(chunks + 1, rest, 1)] * bool(rest)

    def moov(start: int) -> bytes:
        at = range(start, start + n, chunk)
        offsets = full(b"co64", struct.pack(f">I{len(at)}Q", len(at), *at))
        stbl = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, n, 1)),
            full(b"stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", *r) for r in runs]),
            full(b"stsz", struct.pack(">II", 1, n)),
            offsets,
        )
        dinf = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
        minf = box(b"minf", full(b"smhd", bytes(4)), dinf, stbl)
        mdhd = full(b"mdhd", struct.pack(">QQIQHH", 0, 0, rate, n, 0x55C4, 0), version=1)
        hdlr = full(b"hdlr", bytes(4), b"soun", bytes(12), b"bytes\0")
        tkhd = full(b"tkhd", struct.pack(">QQIIQ8xhhhH", 0, 0, 1, 0, n, 0, 0, 0x100, 0), matrix, bytes(8), version=1, flags=3)
        mvhd = full(b"mvhd", struct.pack(">QQIQIH10x", 0, 0, rate, n, 0x10000, 0x100), matrix, bytes(24), struct.pack(">I", 2), version=1)
        return box(b"moov", mvhd, box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, minf)))

    index = moov(0)
    return head + moov(len(head) + len(index) + (8 if n < 2**32 - 8 else 16)) + box(b"mdat", payload)


def boxes(data: memoryview, start: int, stop: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(kind, start, start of the body, end) of the boxes between two offsets."""
    while start + 8 <= stop:
        n, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if n == 1:
            if start + 16 > stop:
                return
            n, body = struct.unpack_from(">Q", data, start + 8)[0], start + 16
        end = stop if n == 0 else start + n
        if end < body:
            raise ValueError("box shorter than its header")
        yield kind, start, body, min(end, stop)
        start = end


def walk(data: memoryview, start: int, stop: int, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    for kind, head, a, b in boxes(data, start, stop):
        yield (*path, kind), head, a, b
        if kind in NESTED and len(path) < 16:
            yield from walk(data, a, b, (*path, kind))


def table(data: memoryview, a: int, b: int, kind: str, width: int = 1, skip: int = 4) -> np.ndarray:
    """Entries of a full box whose body is a count and that many numbers of `width` columns."""
    n = struct.unpack_from(">I", data, a + skip)[0]
    step = np.dtype(kind).itemsize * width
    return np.frombuffer(data, kind, min(n, max(0, (b - a - skip - 4) // step)) * width, a + skip + 4).astype(np.int64).reshape(-1, width)


def sizes_of(data: memoryview, inside: dict[bytes, tuple[int, int]]) -> tuple[int, int, np.ndarray | None]:
    """(number of samples, the size of each if it is the same, sizes if not); a number never exceeds the bytes of the file."""
    if b"stsz" in inside:
        a, b = inside[b"stsz"]
        each, n = struct.unpack_from(">II", data, a + 4)
        if each:
            if n * each > len(data):
                raise ValueError("more samples than bytes")
            return n, each, None
        sizes = table(data, a, b, ">u4", skip=8)[:, 0]
        return len(sizes), 0, sizes
    a, b = inside[b"stz2"]
    bits, n = data[a + 7], struct.unpack_from(">I", data, a + 8)[0]
    raw = np.frombuffer(data, np.uint8, max(0, min(b - a - 12, (n * bits + 7) // 8)), a + 12)
    sizes = (np.stack([raw >> 4, raw & 15], 1).ravel()[:n] if bits == 4 else raw if bits == 8 else raw[: len(raw) // 2 * 2].view(">u2")).astype(np.int64)
    return len(sizes), 0, sizes


def merged(low: np.ndarray, high: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Byte ranges, neighbours as one."""
    low, high = low[high > low], high[high > low]
    if not len(low):
        return []
    if low.min() < 0 or high.max() > size:
        raise ValueError("samples past the end")
    cut = np.flatnonzero(low[1:] != high[:-1]) + 1
    return list(zip(low[np.append(0, cut)].tolist(), high[np.append(cut - 1, len(high) - 1)].tolist(), strict=True))


def track(data: memoryview, inside: dict[bytes, tuple[int, int]]) -> dict:
    """What the header and sample tables of one track say."""
    need_ = [k for k in (b"mdhd", b"hdlr", b"stsd", b"stsc") if k not in inside]
    if need_ or not {b"stco", b"co64"} & inside.keys() or not {b"stsz", b"stz2"} & inside.keys():
        raise ValueError(f"no {(need_ or [b'stco or stsz'])[0].decode()} box")
    a, _ = inside[b"mdhd"]
    scale, length = struct.unpack_from(">IQ" if data[a] else ">II", data, a + (20 if data[a] else 12))
    codec = bytes(data[(a := inside[b"stsd"][0]) + 12 : a + 16]).decode("latin-1").strip()
    handler = bytes(data[(a := inside[b"hdlr"][0]) + 8 : a + 12]).decode("latin-1").strip()
    starts = table(data, *inside[b"co64"], ">u8")[:, 0] if b"co64" in inside else table(data, *inside[b"stco"], ">u4")[:, 0]
    runs = table(data, *inside[b"stsc"], ">u4", 3)
    edges = np.minimum(np.append(runs[1:, 0] - 1, len(starts)), len(starts))
    chunks = np.maximum(edges - np.minimum(runs[:, 0] - 1, len(starts)), 0)
    per_chunk = np.repeat(runs[:, 1], np.clip(len(starts) - np.cumsum(chunks) + chunks, 0, chunks))  # cut first: runs in no order may repeat chunks
    n, each, sizes = sizes_of(data, inside)
    first = np.cumsum(per_chunk) - per_chunk
    per_chunk = np.clip(n - first, 0, per_chunk)
    n = int(per_chunk.sum())
    wanted = None
    if b"stss" in inside:
        wanted = table(data, *inside[b"stss"], ">u4")[:, 0] - 1
        wanted = wanted[(wanted >= 0) & (wanted < n)]
    if each and wanted is None:  # every sample is a sync sample: whole chunks, however many samples they hold
        low = starts[: len(per_chunk)]
        ranges = merged(low, low + per_chunk * each, len(data))
    else:
        wanted = np.arange(n) if wanted is None else wanted
        chunk = np.searchsorted(first + per_chunk, wanted, "right")
        before = (lambda i: i * each) if each else np.append(0, np.cumsum(sizes)).__getitem__
        low = starts[chunk] + before(wanted) - before(first[chunk])
        ranges = merged(low, low + (each or sizes[wanted]), len(data))
    ticks = int(table(data, *inside[b"stts"], ">u4", 2).astype(float).prod(axis=1).sum()) if b"stts" in inside else length
    return {"codec": codec, "handler": handler, "timescale": scale, "n_samples": n, "ticks": ticks or length, "ranges": ranges}


def defaults(data: memoryview, a: int) -> tuple[int, int, int]:
    """Duration, size and flags of a trex box."""
    return struct.unpack_from(">III", data, a + 12)


def fragment(data: memoryview, head: int, a: int, b: int, known: dict[int, tuple[int, int, int]], found: dict[int, dict]) -> None:
    """Add the samples of a movie fragment to the tracks of `found`, by id."""
    end = head
    for kind, _, x, y in boxes(data, a, b):
        if kind != b"traf":
            continue
        base, own, number = None, (0, 0, 0), None
        for kind_, _, p, q in boxes(data, x, y):
            flags = int.from_bytes(data[p + 1 : p + 4], "big")
            if kind_ == b"tfhd":
                number, at = struct.unpack_from(">I", data, p + 4)[0], p + 8
                if flags & 1:
                    base, at = struct.unpack_from(">Q", data, at)[0], at + 8
                at += 4 * bool(flags & 2)
                own = list(known.get(number, own))
                for k, bit in enumerate((8, 0x10, 0x20)):
                    if flags & bit:
                        own[k], at = struct.unpack_from(">I", data, at)[0], at + 4
                if base is None:
                    base = head if flags & 0x20000 or end == head else end
                end = base
            elif kind_ == b"trun" and number in found:
                n, at = struct.unpack_from(">I", data, p + 4)[0], p + 8
                if flags & 1:
                    end, at = base + struct.unpack_from(">i", data, at)[0], at + 4
                lead = None
                if flags & 4:
                    lead, at = struct.unpack_from(">I", data, at)[0], at + 4
                columns = [c for c, bit in (("duration", 0x100), ("size", 0x200), ("flags", 0x400), ("shift", 0x800)) if flags & bit]
                if sum(t["n_samples"] for t in found.values()) + n > len(data) or 4 * n * len(columns) > q - at:
                    raise ValueError("more samples than bytes")
                t = found[number]
                if not columns:  # all samples alike: no array of them
                    stop = end + n * own[1]
                    if stop > len(data):
                        raise ValueError("samples past the end")
                    head_sync, sync = (not (own[2] if lead is None else lead) & 0x10000), not own[2] & 0x10000
                    parts = [(end, end + own[1], head_sync), (end + own[1], stop, sync)] if n else []
                    parts = [(parts[0][0], stop, sync)] if n and head_sync == sync else parts
                    t["ranges"] += [(x, y) for x, y, keep in parts if keep and y > x]
                    t["n_samples"], t["ticks"], end = t["n_samples"] + n, t["ticks"] + n * own[0], stop
                    continue
                rows = np.frombuffer(data, ">u4", n * len(columns), at).astype(np.int64).reshape(n, -1)
                of = lambda c, other: rows[:, columns.index(c)] if c in columns else np.full(n, other, np.int64)  # noqa: E731, B023
                size, sync = of("size", own[1]), of("flags", own[2]) & 0x10000 == 0
                if lead is not None and n:
                    sync[0] = not lead & 0x10000
                low = end + np.cumsum(size) - size
                if n and int(low[-1] + size[-1]) > len(data):
                    raise ValueError("samples past the end")
                t["ranges"] += merged(low[sync], (low + size)[sync], len(data))
                t["n_samples"], t["ticks"] = t["n_samples"] + n, t["ticks"] + int(of("duration", own[0]).sum())
                end = int(low[-1] + size[-1]) if n else end


def tracks_of(data: memoryview) -> list[dict]:
    """The tracks of a container, with the samples of its fragments."""
    parts: list[dict[bytes, tuple[int, int]]] = []
    known: dict[int, tuple[int, int, int]] = {}
    fragments = []
    for path, head, a, b in walk(data, 0, len(data)):
        if path == (b"moov", b"trak"):
            parts.append({})
        elif parts and path[:2] == (b"moov", b"trak"):
            parts[-1].setdefault(path[-1], (a, b))
        elif path == (b"moov", b"mvex", b"trex"):
            known[struct.unpack_from(">I", data, a + 4)[0]] = defaults(data, a)
        elif path == (b"moof",):
            fragments.append((head, a, b))
    if not parts:
        raise ValueError("no track")
    found = {}
    for k, p in enumerate(parts):
        number = struct.unpack_from(">I", data, p[b"tkhd"][0] + (20 if data[p[b"tkhd"][0]] else 12))[0] if b"tkhd" in p else -1 - k
        found[number if number not in found else -1 - k] = track(data, p)
    for f in fragments:
        fragment(data, *f, known, found)
    return [
        {k: t[k] for k in ("codec", "handler", "timescale", "n_samples")} | {"duration_s": t["ticks"] / t["timescale"] if t["timescale"] else None, "keyframes": [{"start": x, "stop": y} for x, y in t["ranges"]]}
        for t in found.values()
    ]


def inspect_bytes(media: bytes | None) -> dict:
    """One row of MEDIA_FIELDS: all tracks, and once more the first one with samples, video before others."""
    out = dict.fromkeys(NAMES)
    if media is None:
        return out | {"error": "null"}
    out["media_bytes"] = len(media)
    try:
        found = tracks_of(memoryview(media))
    except (ValueError, struct.error, IndexError, OverflowError, MemoryError) as e:
        return out | {"error": str(e)[:200] or type(e).__name__}
    return out | sorted(found, key=lambda t: (not t["n_samples"], t["handler"] != "vide"))[0] | {"tracks": found}


def inspect(media: DataFrame, column: str = "media") -> DataFrame:
    """media with MEDIA_FIELDS of its container column; the container itself is dropped."""
    keep = [f for f in media.schema.fields if f.name != column and f.name not in NAMES]
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), MEDIA_FIELDS])
    one = [("codec", pa.string()), ("handler", pa.string()), ("timescale", pa.int64()), ("duration_s", pa.float64()), ("n_samples", pa.int64()), ("keyframes", RANGES)]
    every = dict(one) | {"media_bytes": pa.int64(), "error": pa.string(), "tracks": pa.list_(pa.struct(one))}
    kinds = pa.schema([(n, every[n]) for n in NAMES])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = pa.RecordBatch.from_pylist([inspect_bytes(x.as_py()) for x in b.column(column)], schema=kinds)
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), *got.columns], names=[*(f.name for f in keep), *kinds.names])

    return prepare(media.sparkSession) and media.mapInArrow(run, out)


def padded(raw: bytes, unit: int = 64) -> bytes:
    return raw + bytes(-len(raw) % unit or (0 if raw else unit))


def store(texts: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every text, padded to whole units of 64 bytes, in a container."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", 1 << 20):
            raw = [(t or "").encode() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array([wrap(padded(x)) for x in raw], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return prepare(texts.sparkSession) and need(texts, "doc_id", "text").mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def payload(media: bytes, keyframes: list[dict]) -> bytes:
    """The stored bytes, by the ranges that the sample tables give."""
    return b"".join(media[r["start"] : r["stop"]] for r in keyframes)


def features(raw: bytes) -> str:
    """Level, spread, turns and rises of 8-bit samples, as text."""
    x = np.frombuffer(raw, np.uint8)
    up = x[1:] > x[:-1]
    return f"mean={x.mean():.3f};std={x.std():.3f};peak={x.max()};rises={int(up.sum())};turns={int((up[1:] != up[:-1]).sum())}"


def op2_media_columns(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    media = store(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    columns = {
        "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(),
        "codec": pa.string(), "duration_s": pa.float64(), "n_samples": pa.int64(), "keyframes": RANGES,
    }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for n, m in zip(*(b.column(k).to_pylist() for k in ("n_bytes", "media")), strict=True):
                seen = inspect_bytes(m)
                if seen["error"]:
                    raise ValueError(seen["error"])
                raw = payload(m, seen["keyframes"])
                about = f"codec={seen['codec']};rate={seen['timescale']};duration={seen['duration_s']:.6f};samples={seen['n_samples']};ranges={len(seen['keyframes'])};{features(raw)}"
                rows.append((n, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(m), hashlib.sha256(m).hexdigest(), about, *(seen[k] for k in ("codec", "duration_s", "n_samples", "keyframes"))))
            if rows:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), columns.values(), strict=True))], names=["doc_id", *columns])

    return media.mapInArrow(run, f"doc_id {media.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration_s double, n_samples long, keyframes array<struct<start:long,stop:long>>")
