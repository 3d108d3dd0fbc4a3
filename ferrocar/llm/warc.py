"""WARC archives: writing, normalising whole-file gzip streams, and reading by offset.

Pages are first written as archives that are one gzip stream each. The normaliser inflates such a
stream once, piece by piece, and rewrites every record as a gzip member of its own, with an index of
each member's place beside the archives, so that a record can be read without what stands before it.

Pages with equal payloads are stored once: the one with the smallest id is a response, the others are
revisits that name it.
"""

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrocar.llm import common
from ferrocar.session import stage

# Payloads of fewer bytes are never revisits. Bytes of records in an archive, and read at a time. Compression.
SMALLEST, ARCHIVE, PIECE, LEVEL = 0, 8 << 20, 1 << 20, 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit if it refers to another page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    place = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {place}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _packed(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member; one of no content follows where the last byte would not be zero."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    body = deflate.compress(data) + deflate.flush()
    return body if body[-1] == 0 else body + _EMPTY_MEMBER


def inflated(content: bytes) -> Iterator[bytes]:
    """The content of a gzip file, member after member, in pieces of bounded size."""
    rest, inflate = memoryview(content), None
    while len(rest) or (inflate and inflate.unconsumed_tail):
        inflate = inflate or zlib.decompressobj(31)
        given = inflate.unconsumed_tail or rest[:PIECE]
        rest = rest if inflate.unconsumed_tail else rest[PIECE:]
        if data := inflate.decompress(given, PIECE):
            yield data
        if inflate.eof:
            rest, inflate = memoryview(content)[len(content) - len(rest) - len(inflate.unused_data) :], None
    if inflate:
        # What the object still holds comes without input, or the member is cut off.
        while data := inflate.decompress(b"", PIECE):
            yield data
        if not inflate.eof:
            raise ValueError("the gzip stream ends early")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole WARC records out of inflated pieces."""
    held = b""
    for piece in pieces:
        held += piece
        while True:
            head = held.find(b"\r\n\r\n")
            if head < 0:
                break
            end = head + 4 + int(fields(held[:head])["content-length"]) + 4
            if len(held) < end:
                break
            yield held[:end]
            held = held[end:]
    if held.strip():
        raise ValueError("the archive ends within a record")


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a record's or a message's head."""
    lines = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def with_originals(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads all but the smallest id refer to that one."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    copies = rows.where(F.octet_length("html") >= smallest).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Written first: its true size decides how it meets the pages.
    copies = stage(copies.where("n > 1 AND first IS NOT NULL").select("sha", "first"), "copies")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(copies, "sha", "left").select("page_id", "url", "html", other.alias("refers_to"))


def write_streams(pages: DataFrame, folder: str) -> None:
    """Write archives that are one gzip stream each, from the columns of :func:`with_originals`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate, size, out = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, []

        def body() -> pa.RecordBatch:
            whole = b"".join(out) + deflate.flush()
            return pa.RecordBatch.from_arrays([pa.array([whole if whole[-1] == 0 else whole + _EMPTY_MEMBER], pa.binary())], ["body"])

        for batch in batches:
            for page, url, html, other in zip(*(c.to_pylist() for c in batch.columns)):
                data = record(page, url, html.encode(), other)
                if size and size + len(data) > ARCHIVE:
                    yield body()
                    deflate, size, out = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, []
                out.append(deflate.compress(data))
                size += len(data)
        if size:
            yield body()

    common.small_batches(pages.sparkSession)
    common.write_binary(pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "body binary"), folder, 1)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the archives below ``source`` with a gzip member per record, and an index beside each.

    An archive NAME, split where its records exceed ``ARCHIVE`` bytes, is the file below
    ``target``/kind=archive/archive=NAME; its index the gzip file below ``target``/kind=index/archive=NAME,
    a line for each member: offset, length, record id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = hashlib.sha1(batch.column(0)[i].as_py().encode()).hexdigest()[:16]
                number, size, at, bodies, lines = 0, 0, 0, [], []

                def out():
                    index = _packed("".join(lines).encode())
                    cols = [["archive", "index"], [f"{name}-{number:05d}"] * 2, [b"".join(bodies), index]]
                    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kind", "archive", "body"])

                for data in records(inflated(batch.column(1)[i].as_py())):
                    if size and size + len(data) > ARCHIVE:
                        yield out()
                        number, size, at, bodies, lines = number + 1, 0, 0, [], []
                    said, member = fields(data[: data.find(b"\r\n\r\n")]), _packed(data)
                    lines.append(f"{at} {len(member)} {said['warc-record-id']}\n")
                    bodies.append(member)
                    size, at = size + len(data), at + len(member)
                if bodies:
                    yield out()

    files = common.read_binary(spark, source).select("path", "content")
    common.write_binary(files.mapInArrow(run, "kind string, archive string, body binary"), target, 1, ("kind", "archive"))


def members(index: bytes) -> list[tuple[int, int]]:
    """Offsets and lengths of an archive's members from its index."""
    lines = b"".join(inflated(index)).decode().splitlines()
    return [(int(at), int(size)) for at, size, _ in (line.split(" ", 2) for line in lines)]


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every indexed record.

    A response's figures are those of its payload, which must have the digest it names; a revisit's are
    those it names.
    """

    def page(uri: str | None) -> int | None:
        number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                content, found = batch.column(0)[i].as_py(), []
                for at, size in members(batch.column(1)[i].as_py()):
                    data = b"".join(inflated(content[at : at + size]))
                    head = data.find(b"\r\n\r\n")
                    said = fields(data[:head])
                    http = data.find(b"\r\n\r\n", head + 4)
                    size, digest = int(fields(data[head + 4 : http])["content-length"]), said["warc-payload-digest"].removeprefix("sha1:")
                    if said["warc-type"] == "response":
                        payload = data[http + 4 : -4]
                        size, own = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if own != digest:
                            raise ValueError(f"digest of {said['warc-record-id']}")
                    found.append((page(said["warc-record-id"]), said["warc-target-uri"], size, digest, said["warc-type"], page(said.get("warc-refers-to"))))
                cols = zip(*found) if found else [[]] * 6
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    def files(kind: str, content: str) -> DataFrame:
        found = common.read_binary(spark, folder).where(F.col("path").contains(f"/kind={kind}/"))
        return found.select(F.regexp_extract("path", "archive=([^/]+)", 1).alias("archive"), F.col("content").alias(content))

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files("archive", "content").join(files("index", "index"), "archive").select("content", "index").mapInArrow(run, schema)


def archived(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """What :func:`read` says of ``pages`` (page_id, url, html) once written and normalised.

    A null html is an empty payload, a null url an empty one. Rows with the smallest id of equal payloads
    are all responses; rows with a null id refer to others, but nothing refers to them. Other columns are
    ignored; an empty table gives no rows.
    """
    spark, folder = pages.sparkSession, common.new_folder(pages.sparkSession, "warc")
    write_streams(with_originals(pages, smallest), f"{folder}/streams")
    normalise(spark, f"{folder}/streams", f"{folder}/normalised")
    return read(spark, f"{folder}/normalised")
