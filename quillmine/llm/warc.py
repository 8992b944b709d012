"""WARC archives in Zstandard, with the dictionary in a leading skippable frame.

Layout of an archive (the public WARC-Zstandard convention): a skippable frame of magic 0x184D2A5D
that holds the dictionary, itself raw or one Zstandard frame; then one Zstandard frame a record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import goes_with_driver, map_arrow, pick, scratch, settle, tune

# Fixed values of the formats.
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def record_id(of: object) -> str:
    """A record's id, which follows from the page's id, so that a revisit can name it unseen."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(of))}>"


def make_record(page: object, url: str | None, size: int, sha1: bytes, payload: bytes | None, refers: object = None) -> bytes:
    """One record.  payload None makes a revisit of the page ``refers``: HTTP headers and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if page is not None:
        head.append(f"Page-Id: {page}")
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}", "Content-Type: application/http; msgtype=response"]
    if payload is None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers)}", f"Refers-To-Page-Id: {refers}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """A record's fields, headers and lengths checked; ValueError says what is wrong."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"not a header: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    if missing := [x for x in NEEDED if x not in fields]:
        raise ValueError(f"headers missing: {', '.join(missing)}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {fields['content-length']}, the block and its end have {len(rest)} bytes")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    sizes = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
    if not gap or len(sizes) != 1 or not sizes[0].isdigit():
        raise ValueError("no HTTP header with one length")
    kind, size = fields["warc-type"], int(sizes[0])
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha1" or len(sha1 := base64.b32decode(digest)) != 20:
        raise ValueError("no SHA-1 payload digest")
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != sha1):
        raise ValueError("the payload has another length or digest than its headers say")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit with a payload or without a record to refer to")
    if kind not in ("response", "revisit"):
        raise ValueError(f"unknown type {kind[:40]!r}")
    return {"page": fields.get("page-id"), "url": fields.get("warc-target-uri"), "type": kind, "payload_bytes": size, "digest": sha1.hex(), "refers_to": fields.get("refers-to-page-id"), "payload": payload if kind == "response" else None}


def leading_frame(dictionary: bytes) -> bytes:
    held = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(held)) + held


def load_dictionary(stream) -> zstandard.ZstdCompressionDict:
    """The dictionary of the skippable frame at the stream's start."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE:
        raise ValueError("no leading skippable frame")
    held = stream.read(struct.unpack("<I", head[4:])[0])
    if len(held) != struct.unpack("<I", head[4:])[0]:
        raise ValueError("the dictionary's frame is cut short")
    if len(held) >= 4 and struct.unpack("<I", held[:4])[0] == FRAME:
        held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
    trained = len(held) >= 4 and struct.unpack("<I", held[:4])[0] == DICTIONARY
    return zstandard.ZstdCompressionDict(held, zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def frames(stream, dictionary: zstandard.ZstdCompressionDict, chunk: int = 1 << 18) -> Iterator[bytes]:
    """What each frame holds, one after the other; ValueError where the last is cut short."""
    codec, rest = zstandard.ZstdDecompressor(dict_data=dictionary), b""
    while rest or (rest := stream.read(chunk)):
        one, parts = codec.decompressobj(), []
        while True:
            parts.append(one.decompress(rest))
            if one.eof:
                rest = one.unused_data
                break
            if not (rest := stream.read(chunk)):
                raise ValueError("the last frame is cut short")
        yield b"".join(parts)


def train_dictionary(pages: DataFrame, samples: int = 256, length: int = 16_384, size: int = 32_768) -> bytes:
    """A dictionary from the first ``length`` characters of ``samples`` pages, chosen by xxhash64 of their ids.

    It only helps compression; where there is too little to train on, plain header text serves."""
    share = int(min(1.0, 4 * samples / max(pages.count(), 1)) * (1 << 30)) + 1  # else each task would send as many as are wanted of all
    some = pages.where(F.pmod(F.xxhash64("page"), F.lit(1 << 30)) < share)
    got = some.select("page", F.substr("html", F.lit(1), F.lit(length)).alias("html")).orderBy(F.xxhash64("page"), "page").limit(samples).collect()
    texts = [make_record(r.page, None, 0, bytes(20), (r.html or "").encode()) for r in got]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return make_record(0, "http://", 0, bytes(20), b"<!DOCTYPE html><html><head><title></title></head><body></body></html>", 0)


def write_archives(pages: DataFrame, out: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000, level: int = 6, archive_bytes: int = 64 << 20) -> DataFrame:
    """Write a record for each row and return the manifest (archive, records, bytes).

    Payload: the html in UTF-8, empty where null.  Of the records with equal payloads of at least
    ``least`` bytes, those of the largest id are responses and the others revisit that id; a null id
    is always a response, and rows of one id with different payloads are records of their own, as are
    repeated rows.  An empty table writes no archive; payloads of any length are one frame each.  Texts are compressed before the one shuffle that brings each record the id
    it refers to; only digests are shuffled by digest.  Each attempt of a task writes files of its
    own, and only the manifest, of attempts that succeeded, says which count; so tasks can be lost.
    ``out`` is a folder that all executors reach (default: one in the shared folder that goes when the driver ends).
    """
    spark = pages.sparkSession
    tune(spark)
    own, out = out is None, out or scratch(spark, "warc")
    rows = pick(pages, page=id_col, url=url_col, html=html_col)
    page_type = rows.schema["page"].dataType.simpleString()
    dictionary = train_dictionary(rows)

    def compress(batch):
        codec = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        made, sizes, digests = [], [], []
        for page, url, html in zip(batch["page"].to_pylist(), batch["url"].to_pylist(), batch["html"].cast(pa.binary()).to_pylist(), strict=True):
            payload = html or b""
            sha1 = hashlib.sha1(payload).digest()
            made.append(codec.compress(make_record(page, url, len(payload), sha1, payload)))
            sizes.append(len(payload))
            digests.append(sha1)
        return {"page": batch["page"], "url": batch["url"], "size": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.binary()), "frame": pa.array(made, pa.binary())}

    slim = rows.select("page", F.octet_length(F.coalesce("html", F.lit(""))).alias("size"), F.unhex(F.sha1(F.coalesce("html", F.lit("")))).alias("digest"))
    slim = settle(slim.where((F.col("size") >= least) & F.col("page").isNotNull()), "warc-slim")
    groups = settle(slim.groupBy("digest").agg(F.max("page").alias("refers"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-groups")
    again = slim.join(groups, "digest").where("page <> refers").select("page", "digest", "refers").distinct()
    records = map_arrow(rows, f"page {page_type}, url string, size long, digest binary, frame binary", compress).join(again, ["page", "digest"], "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, folder = fs.FileSystem.from_uri(out)
        place.create_dir(folder, recursive=True)
        codec = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        stream, name, count, size = None, "", 0, 0

        def done():
            stream.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([count], pa.int64()), "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for page, url, length, sha1, frame, refers in zip(*[batch.column(c).to_pylist() for c in ("page", "url", "size", "digest", "frame", "refers")], strict=True):
                if refers is not None and length >= least:
                    frame = codec.compress(make_record(page, url, length, sha1, None, refers))
                if stream is None:
                    name, count, size = f"{out}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    stream = place.open_output_stream(f"{folder}/{name.rpartition('/')[2]}", compression=None)
                    size += stream.write(leading_frame(dictionary))
                stream.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= archive_bytes:
                    yield done()
                    stream = None
        if stream is not None:
            yield done()

    manifest = settle(records.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")
    if own:
        goes_with_driver(spark, out)
    return manifest


def read_archives(manifest: DataFrame, page_type: str = "long", payload: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """(page_id, url, type, payload_bytes, digest, refers_to, payload, error) of each record of the
    archives that the column ``archive`` names, one archive a task at a time, one frame a record.

    A record with bad headers, lengths or digest, and an archive's unreadable rest, give one row with
    ``error`` set and the other columns null.  payload is null for revisits, and for all records
    where it isn't asked for (it is checked nevertheless).
    """
    names = ("page", "url", "type", "payload_bytes", "digest", "refers_to", "payload")

    def records(uri: str) -> Iterator[dict]:
        place, path = fs.FileSystem.from_uri(uri)
        with place.open_input_stream(path, compression=None) as stream:
            try:
                for raw in frames(stream, load_dictionary(stream)):
                    try:
                        yield parse_record(raw)
                    except (ValueError, UnicodeDecodeError) as e:
                        yield {"error": str(e)}
            except (ValueError, zstandard.ZstdError) as e:
                yield {"error": f"{uri}: {e}"}

    def table(rows: list[dict]) -> pa.RecordBatch:
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip((*names, "error"), types, strict=True)], [*names, "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in records(uri):
                    if not payload:
                        row["payload"] = None
                    rows.append(row)
                    held += 200 + len(row.get("payload") or b"")
                    if held >= batch_bytes:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    spread = manifest.select("archive").repartition(max(1, manifest.count()), "archive")
    got = spread.mapInArrow(run, "page string, url string, type string, payload_bytes long, digest string, refers_to string, payload binary, error string")
    return got.select(F.col("page").cast(page_type).alias("page_id"), "url", "type", "payload_bytes", "digest", F.col("refers_to").cast(page_type).alias("refers_to"), "payload", "error")


def op10_warc_zstd(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    back = read_archives(write_archives(pages), pages.schema["page_id"].dataType.simpleString(), payload=False)
    return back.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to", "error")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     g AS (SELECT h, max(page_id) AS last FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN p.page_id <> g.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> g.last THEN g.last END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM p LEFT JOIN g ON p.h = g.h
"""
