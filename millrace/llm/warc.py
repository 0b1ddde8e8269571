"""WARC archives: writing pages with revisit records and segments, reading them back with segment reassembly.

Writing. Pages with equal payloads (UTF-8 bytes of the html, null counting as empty) of at least ``revisit_from`` bytes
have one response, that of the largest page_id; the others are revisits that refer to it. Smaller payloads are all
responses. Rows that repeat the largest page_id with the same payload are all responses; a null page_id ranks below all
others. Response bodies use chunked transfer framing, and a record block beyond ``segment_bytes`` is cut into a first
record and continuation records. Records are packed into blobs of about ``pack_bytes`` and written by Spark's text
writer, whose line separator is the blank line that ends a WARC record, so archives reach any file system Spark can
write to and a file holds at most four packs.

Reading. Each file is scanned by Content-Length. Whole records are decoded where they are read; segments alone are
shuffled, by origin identifier (a group is one page), ordered by segment number, checked against the total length of the
last one, joined, and their chunked framing decoded. A record that can't be restored has a null payload and says why in
``problem``.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import only, tidy

RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, problem string"
SEGMENTS = "origin string, number int, total long, page_id long, url string, digest string, block binary"
END = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int) -> bytes:
    out = bytearray()
    for at in range(0, len(body), size):
        piece = body[at : at + size]
        out += b"%x\r\n%b\r\n" % (len(piece), piece)
    return bytes(out + b"0\r\n\r\n")


def dechunked(body: bytes) -> bytes:
    out, at = bytearray(), 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].partition(b";")[0], 16)
        at = line + 2
        if n == 0:
            return bytes(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where it should")
        out += body[at : at + n]
        at += n + 2


def header(fields: dict[str, object]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n"


def records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of a page, without the blank line at their end."""
    digest = base32_sha1(payload)
    own = f"urn:page:{'null' if page_id is None else page_id}:{digest}"
    where = " ".join((url or "").split())
    common = {"WARC-Date": "1970-01-01T00:00:00Z", "WARC-Payload-Digest": f"sha1:{digest}"} | ({"WARC-Target-URI": where} if url is not None else {})
    http = {"Content-Type": "application/http;msgtype=response"}
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        yield header({"WARC-Type": "revisit", "WARC-Record-ID": f"<{own}:revisit>", "WARC-Refers-To": f"<urn:page:{refers_to}:{digest}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", **common, **http, "Content-Length": len(block)}) + block
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    first = {"WARC-Type": "response", "WARC-Record-ID": f"<{own}>", **common, **http}
    if len(block) <= segment_bytes:
        yield header({**first, "Content-Length": len(block)}) + block
        return
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield header({**first, "WARC-Segment-Number": 1, "Content-Length": len(parts[0])}) + parts[0]
    for number, part in enumerate(parts[1:], 2):
        total = {"WARC-Segment-Total-Length": len(block)} if number == len(parts) else {}
        yield header({"WARC-Type": "continuation", "WARC-Record-ID": f"<{own}:segment:{number}>", "WARC-Segment-Origin-ID": f"<{own}>", "WARC-Segment-Number": number, **total, "WARC-Date": "1970-01-01T00:00:00Z", "Content-Length": len(part)}) + part


def write(pages: DataFrame, path: str, revisit_from: int = 0, segment_bytes: int = 64 << 10, chunk_bytes: int = 8 << 10, pack_bytes: int = 4 << 20, compression: str = "gzip") -> None:
    """Archives of the pages (page_id, url, html) under path."""
    sized = only(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit(""))).withColumn("sha1", F.when(F.octet_length("html") >= revisit_from, F.sha1("html")))
    # one row for each payload that occurs again: the copies are counted before they are shuffled
    again = sized.filter("sha1 IS NOT NULL").groupBy(F.col("sha1").alias("of")).agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).filter("n > 1 AND latest IS NOT NULL").drop("n")
    known = sized.join(again, F.col("sha1") == F.col("of"), "left").select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("latest")), F.col("latest")).alias("refers_to"))

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    for record in records(row["page_id"], row["url"], row["html"].encode(), row["refers_to"], segment_bytes, chunk_bytes):
                        pack.append(record)
                        size += len(record)
                        if size >= pack_bytes:
                            yield pa.RecordBatch.from_pydict({"pack": pa.array([END.join(pack)], pa.binary())})
                            pack, size = [], 0
        if pack:
            yield pa.RecordBatch.from_pydict({"pack": pa.array([END.join(pack)], pa.binary())})

    known.mapInArrow(tidy(packs), "pack binary").select(F.col("pack").cast("string").alias("value")).write.option("lineSep", END.decode()).option("compression", compression).option("maxRecordsPerFile", 4).text(path)


def scanned(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    if archive[:2] == b"\x1f\x8b":
        plain = bytearray()
        while archive:  # members may follow one another
            one = zlib.decompressobj(31)
            plain += one.decompress(archive)
            archive = one.unused_data
        archive = bytes(plain)
    at = 0
    while at < len(archive):
        head = archive.index(END, at)
        lines = archive[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = head + len(END)
        at = start + int(fields["content-length"])
        yield fields, archive[start:at]
        at += len(END)


def page_of(identifier: str) -> int | None:
    number = identifier.strip("<>").split(":")[2]
    return None if number == "null" else int(number)


def restored(block: bytes, digest: str) -> tuple[bytes | None, str | None]:
    """The payload of an HTTP response block, or what is wrong with it."""
    head, _, body = block.partition(END)
    try:
        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError:
        return None, "chunked framing is broken"
    return (payload, None) if not digest or base32_sha1(payload) == digest else (None, "payload digest differs")


def row(page_id, url, kind, payload, problem, digest, refers_to=None, length=None, keep=True):
    return (page_id, url, kind, length if payload is None else len(payload), digest if payload is None else base32_sha1(payload), refers_to, payload if keep else None, problem)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives under path, one row for each page; payloads: with their bytes."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def rows(batches: Iterator[pa.RecordBatch], pick, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for fields, block in scanned(content.as_buffer().to_pybytes()):
                    if (x := pick(fields, block)) is not None:
                        held.append(x)
                        size += len(block) if payloads else 256
                    if size > 8 << 20:
                        yield arrow(held, schema)
                        held, size = [], 0
                if held:
                    yield arrow(held, schema)

    def arrow(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    def whole(fields: dict[str, str], block: bytes) -> tuple | None:
        kind = fields["warc-type"]
        if kind not in ("response", "revisit") or "warc-segment-number" in fields:
            return None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        page, url = page_of(fields["warc-record-id"]), fields.get("warc-target-uri")
        if kind == "revisit":
            http = dict(x.lower().split(b": ", 1) for x in block.split(b"\r\n")[1:] if b": " in x)
            return row(page, url, kind, None, None, digest, page_of(fields["warc-refers-to"]), int(http[b"content-length"]))
        payload, problem = restored(block, digest)
        return row(page, url, kind, payload, problem, digest, keep=payloads)

    def segment(fields: dict[str, str], block: bytes) -> tuple | None:
        if "warc-segment-number" not in fields:
            return None
        total = fields.get("warc-segment-total-length")
        own = fields["warc-record-id"].strip("<>")
        return (fields.get("warc-segment-origin-id", own).strip("<>"), int(fields["warc-segment-number"]), total and int(total), page_of(own), fields.get("warc-target-uri"), fields.get("warc-payload-digest", "").removeprefix("sha1:"), block)

    whole_schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())])
    segment_schema = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("block", pa.binary())])

    def reassembled(group: pd.DataFrame) -> pd.DataFrame:
        # rows that repeat a page with its payload have equal identifiers and equal segments
        repeats = max(1, int((group.number == 1).sum()))
        group = group.drop_duplicates("number").sort_values("number")
        first = group.iloc[0]
        total = group.total.dropna()
        block = b"".join(group.block)
        payload, problem = None, None
        if list(group.number) != list(range(1, len(group) + 1)) or total.empty:
            problem = "a segment is missing"
        elif int(total.iloc[0]) != len(block):
            problem = "total length differs"
        else:
            payload, problem = restored(block, first.digest)
        out = row(first.page_id, first.url, "response", payload, problem, first.digest, keep=payloads)
        return pd.DataFrame([out] * repeats, columns=whole_schema.names).astype({"payload_bytes": "Int64", "refers_to": "Int64", "page_id": "Int64"})

    singles = files.mapInArrow(tidy(lambda b: rows(b, whole, whole_schema)), RECORDS)
    joined = files.mapInArrow(tidy(lambda b: rows(b, segment, segment_schema)), SEGMENTS).groupBy("origin").applyInPandas(reassembled, RECORDS)
    return singles.unionByName(joined)
