"""WARC archives in Zstandard: one frame for each record, a dictionary in the leading skippable frame.

An archive is a row (archive, content): the shape of Spark's binaryFile source, which reads such files from any store.
The writer makes archives of bounded size; the reader loads the dictionary, decodes frame by frame, and checks version,
required fields, lengths and digests of every record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import materialize, small_batches, table

#: Magic number of the skippable frame that holds a dictionary, and of a Zstandard frame.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD = "page_id {kind}, url string, record_type string, refers_to {kind}, payload binary, payload_bytes long, payload_digest string, archive string, error string"


def sha1_base32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def uri_text(url: str) -> str:
    """The url on one header line: controls percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the head of the response without its payload."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {uri_text(url)}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(body)}", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def train(samples: list[bytes], size: int):
    """A dictionary of the first records, or None where they are too few to make one."""
    import zstandard as zstd

    try:
        return zstd.train_dictionary(size, samples, k=256, d=8) if len(samples) >= 16 else None
    except zstd.ZstdError:
        return None


def archive(records: list[bytes], level: int = 3, dictionary_bytes: int = 16384, samples: int = 128) -> bytes:
    """The archive of some records: dictionary frame, then a frame for each record."""
    import zstandard as zstd

    words = train([r[:8192] for r in records[:samples]], dictionary_bytes)
    out = []
    if words:
        raw = words.as_bytes()
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
    press = zstd.ZstdCompressor(level=level, dict_data=words, write_content_size=True, write_checksum=True)
    return b"".join([*out, *map(press.compress, records)])


class Bad(ValueError):
    """What is wrong with an archive or record."""


def frames(content: bytes, piece: int = 1 << 16) -> Iterator[bytes]:
    """The decoded frames of an archive. Raises Bad at the first place that can't be decoded; what stands before has been yielded."""
    import zstandard as zstd

    view, at, words = memoryview(content), 0, None
    while at < len(view):
        if len(view) - at < 4:
            raise Bad(f"cut off at byte {at}")
        magic = struct.unpack_from("<I", view, at)[0]
        if magic in SKIPPABLE:
            if len(view) - at < 8 or len(view) - at - 8 < (size := struct.unpack_from("<I", view, at + 4)[0]):
                raise Bad(f"skippable frame cut off at byte {at}")
            if magic == DICTIONARY_MAGIC and at == 0:
                raw = bytes(view[8 : 8 + size])
                if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary itself may be compressed
                    raw = zstd.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
                words = zstd.ZstdCompressionDict(raw)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise Bad(f"no frame at byte {at}")
        one, got = zstd.ZstdDecompressor(dict_data=words).decompressobj() if words else zstd.ZstdDecompressor().decompressobj(), []
        start = at
        try:
            while not one.eof:
                if at >= len(view):
                    raise Bad(f"frame cut off at byte {start}")
                got.append(one.decompress(view[at : at + piece]))
                at = min(at + piece, len(view)) - len(one.unused_data)
        except zstd.ZstdError as e:
            raise Bad(f"frame at byte {start}: {e}") from None
        yield b"".join(got)


def parse(raw: bytes) -> dict:
    """Fields and payload of one record. Raises Bad if version, a required field, a length or a digest is wrong."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise Bad("no WARC version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise Bad(f"not a header line: {line[:60]!r}")
        if name.lower() in fields:
            raise Bad(f"field {name} twice")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise Bad(f"no field {name}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise Bad(f"content-length is {fields['content-length']}, the block has {len(rest) - 4}")
    body = rest[:-4]
    if fields.get("warc-block-digest", "").startswith("sha1:") and fields["warc-block-digest"][5:] != sha1_base32(body):
        raise Bad("block digest differs")
    out = {"fields": fields, "type": fields["warc-type"], "payload": None, "bytes": None, "digest": None}
    if fields.get("content-type", "").startswith("application/http"):
        http, found, payload = body.partition(b"\r\n\r\n")
        size = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
        if not found:
            raise Bad("no end of the HTTP head")
        if out["type"] == "revisit":
            out["bytes"], out["digest"] = int(size[1]) if size else None, fields.get("warc-payload-digest", "")[5:] or None
        else:
            if size and int(size[1]) != len(payload):
                raise Bad(f"HTTP content-length is {size[1].decode()}, the payload has {len(payload)}")
            out |= {"payload": payload, "bytes": len(payload), "digest": sha1_base32(payload)}
            if fields.get("warc-payload-digest", "").startswith("sha1:") and fields["warc-payload-digest"][5:] != out["digest"]:
                raise Bad("payload digest differs")
    else:
        out |= {"payload": body, "bytes": len(body), "digest": sha1_base32(body)}
    return out


def write_archives(pages: DataFrame, *, least_bytes: int = 0, archive_bytes: int = 4 << 20, most_broadcast: int = 200_000) -> DataFrame:
    """(archive, content) for pages (page_id, url, html): each row becomes one record, with the html in UTF-8 as payload (null: empty).

    Of records with equal payloads of at least least_bytes, that with the smallest page_id is a response and the others
    revisit it; rows that share that page_id are all responses, and so are rows without any smallest. A null url makes no
    target field. Archives hold about archive_bytes of records, one record at least. The empty table gives no archives. Columns
    other than the three are not read.

    Digests that occur more than once are sent to the pages by a broadcast up to most_broadcast of them (about 100 bytes each),
    so payloads stay where they are read; beyond that the pages are dealt by digest.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    small_batches(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    # Only payloads that occur more than once are joined back; the minimum is a partial aggregate.
    first = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    first = materialize(first, "repeated-payloads")
    if first.count() <= most_broadcast:
        first = F.broadcast(first)
    told = rows.join(first, "digest", "left").withColumn("first", F.when(F.octet_length("payload") >= least_bytes, F.col("first")))
    told = told.withColumn("revisit", F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")))

    def run(batches):
        held, size, name = [], 0, hashlib.sha256()

        def flush():
            content = archive(held)
            return pa.RecordBatch.from_arrays([pa.array([f"{name.hexdigest()[:24]}.warc.zst"]), pa.array([content], pa.binary())], names=["archive", "content"])

        for b in batches:
            for page_id, url, raw, digest, first_id, revisit in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
                one = record(page_id, url, raw, base64.b32encode(bytes.fromhex(digest)).decode(), first_id, revisit)
                held.append(one)
                name.update(one)
                size += len(one)
                if size >= archive_bytes:
                    yield flush()
                    held, size, name = [], 0, hashlib.sha256()
        if held:
            yield flush()

    return told.select("page_id", "url", "payload", "digest", F.col("first").cast(kind), "revisit").mapInArrow(run, "archive string, content binary")


def read_archives(archives: DataFrame, *, id_type: str = "bigint", with_payload: bool = True) -> DataFrame:
    """One row for each record of archives (archive or path, content), and one with `error` for each record or place that is not sound.

    A record that fails its checks gives a row with its error and nothing else; a frame that can't be decoded ends its
    archive with such a row, and the other archives go on. A null content gives no rows. page_id and refers_to come
    from urn:page ids and are null for records of other writers. payload_bytes and payload_digest are those of the whole
    payload; for a revisit they are those that its head states. An archive is held whole, a record too.
    """
    schema = RECORD.format(kind=id_type)
    names = [x.split()[0] for x in schema.split(", ")]
    name = "archive" if "archive" in archives.columns else "path"
    small_batches(archives.sparkSession)

    def page(urn: str | None) -> int | str | None:
        m = re.fullmatch(r"<urn:page:(.*)>" if id_type == "string" else r"<urn:page:(-?\d+)>", urn or "")
        return None if not m else m[1] if id_type == "string" else int(m[1])

    def one(raw: bytes) -> tuple:
        p = parse(raw)
        f = p["fields"]
        return (page(f["warc-record-id"]), f.get("warc-target-uri"), p["type"], page(f.get("warc-refers-to")), p["payload"] if with_payload else None, p["bytes"], p["digest"])

    def run(batches):
        own = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
        types = [own, pa.string(), pa.string(), own, pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for b in batches:
            for which, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                try:
                    for raw in frames(content or b""):
                        try:
                            rows.append((*one(raw), which, None))
                        except Bad as e:
                            rows.append((*[None] * 7, which, str(e)))
                except Bad as e:
                    rows.append((*[None] * 7, which, str(e)))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return archives.select(F.col(name).alias("archive"), "content").mapInArrow(run, schema)


def export(archives: DataFrame, folder: str) -> None:
    """Writes archives as files to a folder that all executors reach by its path."""

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                target = Path(folder, name)
                target.with_suffix(".part").write_bytes(content)
                target.with_suffix(".part").rename(target)
            yield b.select(["archive"])

    archives.select("archive", "content").mapInArrow(run, "archive string").count()


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads them back."""
    archives = materialize(write_archives(table(spark, sf_dir, "pages")), "archives")
    return read_archives(archives, with_payload=False).select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


# SHA-1 in base32 has no SQL function; the oracle spells it from the hex digest, 8 letters for each 5 bytes.
_LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {10 * g + 1}, 10))::BIGINT >> {35 - 5 * k}) & 31)::INTEGER, 1)" for g in range(4) for k in range(8))
ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, url, octet_length(encode(body)) AS n, sha1(body) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first, count(*) OVER (PARTITION BY h, n) AS k FROM d)
SELECT page_id, url, n::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest,
 CASE WHEN k > 1 AND first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN k > 1 AND first IS DISTINCT FROM page_id THEN first END AS refers_to, NULL::VARCHAR AS error
FROM f"""
