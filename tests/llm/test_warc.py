import base64
import hashlib
import random
import struct

import zstandard as zstd

from plumbline.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload int"


def run(spark, rows, **kw):
    pages = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in warc.read_archives(warc.write_archives(pages, **kw)).drop("archive").collect()), key=str)


def digest(h):
    return base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(i, f"https://a.example/{i}?q=\n", "".join(rng.choice("<p>ab é\n") for _ in range(rng.randint(0, 300)))) for i in range(200)]
    rows += [(1000 + i, None, "the same page") for i in range(40)] + [(2000, "u", None), (2001, "u", ""), (2002, "u", "x" * 3_000_000), (2002, "u", "x" * 3_000_000), (None, "u", "alone"), (None, "u", "the same page")]
    for least, most in ((0, 200_000), (20, 200_000), (0, 0)):
        first = {}
        for i, _, h in rows:
            if i is not None:
                first[h or ""] = min(i, first.get(h or "", i))
        want = []
        for i, u, h in rows:
            raw = h or ""
            revisit = len(raw.encode()) >= least and raw in first and first[raw] != i
            want.append((i, u and u.replace("\n", "%0A"), "revisit" if revisit else "response", first[raw] if revisit else None, None if revisit else bytearray(raw.encode()), len(raw.encode()), digest(h), None))
        assert run(spark, rows, least_bytes=least, archive_bytes=20_000, most_broadcast=most) == sorted(want, key=str)
    assert run(spark, []) == []


def test_dictionary_and_frames():
    rng = random.Random(2)
    records = [warc.record(i, "https://example.org/", f"<html>{rng.random()} common words of all pages</html>".encode(), "D", None, False) for i in range(100)]
    content = warc.archive(records)
    assert struct.unpack("<I", content[:4])[0] == warc.DICTIONARY_MAGIC
    assert list(warc.frames(content)) == records and list(warc.frames(content, piece=7)) == records
    size = struct.unpack("<I", content[4:8])[0]
    packed = zstd.ZstdCompressor().compress(content[8 : 8 + size])  # a dictionary that is itself compressed
    assert list(warc.frames(struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + content[8 + size :])) == records
    assert list(warc.frames(warc.archive(records[:3]))) == records[:3]


def test_faults_are_told(spark):
    good = warc.record(1, "u", b"page", warc.sha1_base32(b"page"), None, False)
    press = zstd.ZstdCompressor().compress
    faults = {
        b"no version": good.replace(b"WARC/1.1", b"WARC/9"), b"length": good.replace(b"page\r\n\r\n", b"pages\r\n\r\n"), b"date": good.replace(b"WARC-Date", b"X-Date"),
        b"digest": good.replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A").replace(b"page\r\n\r\n", b"page\r\n\r\n"), b"twice": good.replace(b"WARC-Date", b"WARC-Type: x\r\nWARC-Date"),
    }
    archives = [("ok", press(good) + press(good)), ("cut", press(good) + press(good)[:-5]), ("junk", press(good) + b"what is this"), ("none", None), ("empty", b"")]
    archives += [(k.decode(), press(v) + press(good)) for k, v in faults.items()]
    df = spark.createDataFrame(archives, "path string, content binary")
    got = {}
    for r in warc.read_archives(df).collect():
        got.setdefault(r.archive, []).append((r.page_id, r.error))
    assert got["ok"] == [(1, None)] * 2 and "none" not in got and "empty" not in got
    for k in ("cut", "junk"):
        assert got[k][0] == (1, None) and got[k][1][0] is None and got[k][1][1]
    for k in faults:
        assert got[k.decode()][0][0] is None and got[k.decode()][0][1] and got[k.decode()][1] == (1, None)


def test_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i}", "", 0) for i in range(30)], SCHEMA)
    warc.export(warc.write_archives(pages), str(tmp_path))
    back = warc.read_archives(spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.zst"))
    assert sorted(bytes(r.payload).decode() for r in back.collect()) == sorted(f"page {i}" for i in range(30))


def test_ids_of_other_types(spark):
    for kind, ids in (("string", ["a", "b-1", "7"]), ("int", [5, -3, 9])):
        pages = spark.createDataFrame([(i, "u", "same") for i in ids], f"page_id {kind}, url string, html string")
        got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(pages), id_type=kind).collect()}
        assert got == {i: ("response", None) if i == min(ids) else ("revisit", min(ids)) for i in ids}
