import hashlib
import struct
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from watchloom.llm import media


def test_round_trip_of_many_sizes():
    for n in (64, 128, media.CHUNK, media.CHUNK + 64, 3 * media.CHUNK, 5 * media.CHUNK - 64):
        raw = np.random.default_rng(n).integers(0, 256, n, np.uint8).tobytes()
        m = media.wrap(raw)
        seen = media.inspect_bytes(m)
        assert seen["error"] is None and seen["codec"] == "ipcm" and seen["n_samples"] == n and seen["duration_s"] == n / 8000
        assert media.payload(m, seen["keyframes"]) == raw


def video(sizes, sync, per_chunk, stz2=False):
    """A small video track with variable sample sizes, in 32-bit offsets and a 64-bit mdat header."""
    starts, body, i = [], b"", 0
    head = 24
    while i < len(sizes):
        starts.append(head + len(body))
        for s in sizes[i : i + per_chunk]:
            body += bytes([i % 251]) * s
            i += 1
        body += b"gap"
    f, b = media.full, media.box
    sz = f(b"stz2", bytes([0, 0, 0, 8]), struct.pack(">I", len(sizes)), bytes(sizes)) if stz2 else f(b"stsz", struct.pack(">II", 0, len(sizes)), struct.pack(f">{len(sizes)}I", *sizes))
    stbl = b(b"stbl", f(b"stsd", struct.pack(">I", 1), b(b"avc1", bytes(78))), f(b"stts", struct.pack(">III", 1, len(sizes), 40)), f(b"stsc", struct.pack(">IIII", 1, 1, per_chunk, 1)), sz, f(b"stco", struct.pack(f">I{len(starts)}I", len(starts), *starts)), f(b"stss", struct.pack(f">I{len(sync)}I", len(sync), *[x + 1 for x in sync])))
    mdia = b(b"mdia", f(b"mdhd", struct.pack(">IIIIHH", 0, 0, 1000, 0, 0, 0)), f(b"hdlr", bytes(4), b"vide", bytes(13)), b(b"minf", stbl))
    return b(b"free") + struct.pack(">I4sQ", 1, b"mdat", 16 + len(body)) + body + b(b"moov", b(b"trak", mdia)), starts


def test_sync_samples_become_byte_ranges():
    sizes = [5, 7, 9, 11, 4, 6, 8]
    for stz2 in (False, True):
        m, starts = video(sizes, [0, 3, 4], 3, stz2)
        seen = media.inspect_bytes(m)
        assert seen["error"] is None and seen["codec"] == "avc1" and seen["handler"] == "vide" and seen["n_samples"] == 7 and seen["duration_s"] == 0.28
        assert [(r["start"], r["stop"]) for r in seen["keyframes"]] == [(starts[0], starts[0] + 5), (starts[1], starts[1] + 15)]


def audio_track(number, samples, starts, each=4):
    f, b = media.full, media.box
    stbl = b(b"stbl", f(b"stsd", struct.pack(">I", 1), b(b"sowt", bytes(28))), f(b"stts", struct.pack(">III", 1, samples, 10)), f(b"stsc", struct.pack(">IIII", 1, 1, samples, 1)), f(b"stsz", struct.pack(">II", each, samples)), f(b"stco", struct.pack(f">I{len(starts)}I", len(starts), *starts)))
    mdia = b(b"mdia", f(b"mdhd", struct.pack(">IIIIHH", 0, 0, 1000, 0, 0, 0)), f(b"hdlr", bytes(4), b"soun", bytes(13)), b(b"minf", stbl))
    return b(b"trak", f(b"tkhd", struct.pack(">IIII", 0, 0, number, 0), bytes(60)), mdia)


def test_all_tracks_come_back():
    m, starts = video([5, 7, 9], [0], 3)
    at = m.rfind(b"moov") - 4
    moov = media.box(b"moov", m[at + 8 :], audio_track(2, 2, [starts[0]]))
    seen = media.inspect_bytes(m[:at] + moov)
    assert seen["error"] is None and seen["codec"] == "avc1" and [t["codec"] for t in seen["tracks"]] == ["avc1", "sowt"]
    assert seen["tracks"][1]["n_samples"] == 2 and seen["tracks"][1]["keyframes"] == [{"start": starts[0], "stop": starts[0] + 8}]


def test_fragments():
    """Two fragments of one track: explicit sizes and flags in one, defaults and a first sample's flags in the other."""
    f, b = media.full, media.box
    trex = b(b"mvex", f(b"trex", struct.pack(">IIIII", 1, 1, 20, 6, 0x10000)))
    head = b(b"ftyp", b"iso5", bytes(4)) + b(b"moov", audio_track(1, 0, [], each=0), trex)

    def moof(*runs, flags=0x20000, more=b""):
        traf = lambda offset: b(b"moof", f(b"mfhd", bytes(4)), b(b"traf", f(b"tfhd", struct.pack(">I", 1), more, flags=flags), *[f(b"trun", struct.pack(">I", n), struct.pack(">i", offset) if fl & 1 else b"", body, flags=fl) for n, fl, body in runs]))
        return traf(len(traf(0)) + 8)

    one = moof((3, 0x601, struct.pack(">6I", 5, 0, 7, 0x10000, 9, 0)))
    first = len(head) + len(one) + 8
    one += b(b"mdat", bytes(21))
    two = moof((2, 0x5, struct.pack(">I", 0)), (1, 0, b""))
    second = len(head) + len(one) + len(two) + 8
    seen = media.inspect_bytes(head + one + two + b(b"mdat", bytes(18)))
    assert seen["error"] is None and seen["n_samples"] == 6 and seen["duration_s"] == 6 * 20 / 1000
    assert [(r["start"], r["stop"]) for r in seen["keyframes"]] == [(first, first + 5), (first + 12, first + 21), (second, second + 6)]


def test_tables_of_more_samples_than_bytes_take_no_memory():
    import tracemalloc

    f, b = media.full, media.box
    for n in (1 << 25, 1 << 28, (1 << 32) - 1):
        for sz in (struct.pack(">II", 1, n), struct.pack(">II", 0, n)):
            for extra in (b"", f(b"stss", struct.pack(">II", 1, 1))):
                stbl = b(b"stbl", f(b"stsd", struct.pack(">I", 1), b(b"sowt", bytes(28))), f(b"stts", struct.pack(">III", 1, n, n)), f(b"stsc", struct.pack(">IIII", 1, 1, n, 1)), f(b"stsz", sz), f(b"stco", struct.pack(">II", 1, 0)), extra)
                mdia = b(b"mdia", f(b"mdhd", struct.pack(">IIIIHH", 0, 0, 1000, 0, 0, 0)), f(b"hdlr", bytes(4), b"soun", bytes(13)), b(b"minf", stbl))
                tracemalloc.start()
                seen = media.inspect_bytes(b(b"moov", b(b"trak", mdia)))
                most = tracemalloc.get_traced_memory()[1]
                tracemalloc.stop()
                assert most < 1 << 20 and (seen["error"] == "more samples than bytes" or seen["n_samples"] == 0)
    trex = b(b"mvex", f(b"trex", struct.pack(">IIIII", 1, 1, 20, 0, 0)))
    run = b(b"moof", b(b"traf", f(b"tfhd", struct.pack(">I", 1)), f(b"trun", struct.pack(">I", 1 << 30))))
    assert media.inspect_bytes(b(b"moov", audio_track(1, 0, [], each=0), trex) + run)["error"] == "more samples than bytes"


def test_runs_that_repeat_chunks_take_no_memory():
    """Runs in no order name each chunk again and again; the bytes taken stay in proportion to the file."""
    import tracemalloc

    f, b, peaks = media.full, media.box, []
    for k in (500, 5000):
        runs = struct.pack(">I", k) + b"".join(struct.pack(">III", 1 if i % 2 == 0 else k, 1, 1) for i in range(k))
        stbl = b(b"stbl", f(b"stsd", struct.pack(">I", 1), b(b"sowt", bytes(28))), f(b"stts", struct.pack(">III", 1, k, 1)), f(b"stsc", runs), f(b"stsz", struct.pack(">II", 1, k)), f(b"stco", struct.pack(">I", k) + b"".join(struct.pack(">I", 2 * i) for i in range(k))))
        mdia = b(b"mdia", f(b"mdhd", struct.pack(">IIIIHH", 0, 0, 1000, 0, 0, 0)), f(b"hdlr", bytes(4), b"soun", bytes(13)), b(b"minf", stbl))
        media_ = b(b"moov", b(b"trak", mdia))
        tracemalloc.start()
        media.track(memoryview(media_), {path[-1]: (a, e) for path, _, a, e in media.walk(memoryview(media_), 0, len(media_)) if path[:2] == (b"moov", b"trak") and len(path) > 2})
        peaks.append(tracemalloc.get_traced_memory()[1] / len(media_))
        tracemalloc.stop()
    assert max(peaks) < 16


def test_many_runs_of_empty_samples():
    """Samples of size 0 are counted over all runs: more of them than bytes are refused at once."""
    f, b = media.full, media.box
    trex = b(b"mvex", f(b"trex", struct.pack(">IIIII", 1, 1, 20, 0, 0)))
    head = b(b"moov", audio_track(1, 0, [], each=0), trex)
    size = len(head) + 20 * 200
    runs = b(b"moof", b(b"traf", f(b"tfhd", struct.pack(">I", 1)), *[f(b"trun", struct.pack(">I", size)) for _ in range(300)]))
    assert media.inspect_bytes(head + runs)["error"] == "more samples than bytes"
    one = media.inspect_bytes(head + b(b"moof", b(b"traf", f(b"tfhd", struct.pack(">I", 1)), f(b"trun", struct.pack(">I", 30)), f(b"trun", struct.pack(">I", 40)))))
    assert one["error"] is None and one["n_samples"] == 70 and one["duration_s"] == 70 * 20 / 1000 and one["keyframes"] == []


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80), st.integers(0, 700), st.binary(min_size=1, max_size=8))
def test_broken_containers_are_rows(raw, at, noise):
    m = bytearray(media.wrap(raw + bytes(64)))
    m[at % len(m) : at % len(m) + len(noise)] = noise
    seen = media.inspect_bytes(bytes(m))
    assert set(seen) == set(media.NAMES)
    assert media.inspect_bytes(raw)["media_bytes"] == len(raw)


def test_frames(spark, awkward, nothing, tmp_path):
    stored = media.store(awkward)
    assert stored.count() == awkward.count() and media.store(nothing).count() == 0
    info = media.inspect(stored).collect()
    assert all(r["error"] is None and r["codec"] == "ipcm" for r in info)
    assert media.inspect(stored.selectExpr("doc_id", "cast(null as binary) as media")).first()["error"] == "null"
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    got = media.op2_media_columns(spark, str(tmp_path)).collect()
    want = {}
    for r in awkward.collect():
        raw = (r["text"] or "").encode()
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        want.setdefault(r["doc_id"], set()).add((len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert len(got) == awkward.count() and all(r["codec"] == "ipcm" and r["n_samples"] == r["payload_bytes"] and r["duration_s"] == r["n_samples"] / 8000 and len(r["keyframes"]) == 1 for r in got)
    assert all((r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) in want[r["doc_id"]] for r in got)
