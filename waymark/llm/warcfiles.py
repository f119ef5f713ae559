"""WARC archives of pages, compressed record by record with a dictionary of their own.

An archive starts with a skippable Zstandard frame that holds its dictionary, and goes on with one frame per
record. The dictionary is built from the archive's own first records (SAMPLE_BYTES of them); where these are too
few for that, they are the dictionary's content as they stand.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest page_id is written
as response, the others as revisit: the HTTP head with the payload's length, the payload's digest, and the
record that holds it. Pages are dealt to archives by page_id. An archive is written under a name of its task
attempt and then moved to its final name, so a lost executor's archives are written again whole.

Cases: null html is the empty payload; a null url is an empty target; a page without an id is always a
response and comes back without an id; of several rows of the smallest page_id one is the response; other
columns are ignored; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.support import parts_for, pick, prepare
from waymark.runtime import shared_dir, stage

ARCHIVE_BYTES = 24 << 20
SAMPLE_BYTES, DICTIONARY_BYTES = 2 << 20, 96 << 10
LEVEL = 3
BLOCK = 256 << 10
#: fixed values of the format
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = "1970-01-01T00:00:00Z"
MANIFEST = "path string, records long, bytes long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, place: str) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:nopage:{place}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, place: str) -> bytes:
    """One WARC record; a revisit where ``refers_to`` names the page of the response."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, place)}",
        f"WARC-Date: {_EPOCH}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to, '')}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record as ``record`` writes it; the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        value = fields.get(name, "")
        return int(value.removeprefix("<urn:page:").removesuffix(">")) if value.startswith("<urn:page:") else None

    return {
        "page_id": page("WARC-Record-ID"), "payload_bytes": length, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
    }


def _dictionary(samples: list[bytes]):
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        content = b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b"\0")
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _open(folder: str):
    """(file system, path) of a folder that Spark names by path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else fs.FileSystem.from_uri(f"file://{folder}")


def _write_archive(folder: str, name: str, records: Iterator[bytes]) -> tuple[str, int, int] | None:
    """Write one archive; the records beyond the dictionary's sample stream through."""
    import zstandard

    samples, size = [], 0
    for raw in records:
        samples.append(raw)
        size += len(raw)
        if size >= SAMPLE_BYTES:
            break
    if not samples:
        return None
    dictionary = _dictionary(samples)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    draft, final = f"{path}/_{name}-{uuid.uuid4().hex}", f"{path}/{name}.warc.zst"
    count = 0
    with system.open_output_stream(draft, compression=None) as out:
        content = dictionary.as_bytes()
        out.write(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
        written = 8 + len(content)

        def put(raw: bytes) -> None:
            nonlocal count, written
            frame = packer.compress(raw)
            out.write(frame)
            written += len(frame)
            count += 1

        for raw in samples:
            put(raw)
        for raw in records:
            put(raw)
    system.move(draft, final)
    return final, count, written


def read_archive(system, path: str) -> Iterator[bytes]:
    """Records of an archive, one at a time."""
    import zstandard

    with system.open_input_stream(path, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} does not start with a dictionary")
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
        rest = source.read(BLOCK)
        while rest:
            frame, raw = unpacker.decompressobj(), []
            while not frame.eof:
                if not rest:
                    raise ValueError(f"{path} ends within a record")
                raw.append(frame.decompress(rest))
                rest = frame.unused_data if frame.eof else source.read(BLOCK)
            yield b"".join(raw)
            rest = rest or source.read(BLOCK)


def marks(own: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha1, first: rows that revisit an equal payload of a smaller page, found on digests alone."""
    firsts = (
        own.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least_bytes))
        .groupBy("sha1").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .where("first < last")
    )
    later = own.select("page_id", "sha1").join(stage(firsts, "warc-firsts"), "sha1").where("page_id > first")
    return stage(later.select("page_id", "sha1", "first").distinct(), "warc-marks")


def dealt(pages: DataFrame, parts: int, least_bytes: int = 0) -> DataFrame:
    """Payload rows and, ahead of those of their page, narrow mark rows (``first`` is the page to refer to).

    The two are united before the only shuffle that payloads go through, so no join moves them a second time and the
    number of archives is the one asked for. Pages without an id are dealt by url and digest.
    """
    own = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    found = marks(own, least_bytes)
    none = F.lit(None)
    rows = own.select("page_id", "url", "payload", none.cast("string").alias("sha1"), none.cast("long").alias("first"))
    marked = found.select("page_id", F.lit("").alias("url"), none.cast("binary").alias("payload"), "sha1", "first")
    deal = F.when(F.col("page_id").isNull(), F.xxhash64("url", F.md5("payload"))).otherwise(F.xxhash64("page_id"))
    both = rows.union(marked).withColumn("deal", deal).withColumn("at", F.col("payload").isNotNull())
    return both.repartition(parts, "deal").sortWithinPartitions("page_id", "at", "url")


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write all pages under ``folder``; the manifest has a row (path, records, bytes) for each archive."""
    total = pages.agg(F.sum(F.octet_length(F.coalesce("html", F.lit(""))) + 512)).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def records() -> Iterator[bytes]:
            n, page, held, marked = 0, None, set(), {}
            for batch in batches:
                for page_id, url, payload, sha1, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if page_id != page:
                        page, held, marked = page_id, set(), {}
                    if payload is None:
                        marked[base64.b32encode(bytes.fromhex(sha1)).decode()] = first
                        continue
                    digest, refers_to = base32_sha1(payload), None
                    if page_id is not None and len(payload) >= least_bytes:
                        # in rows given twice under one id, the first holds the payload
                        refers_to = marked.get(digest, page_id if digest in held else None)
                        held.add(digest)
                    n += 1
                    yield record(page_id, " ".join(url.split()), payload, digest, refers_to, f"{part}-{n}")

        done = _write_archive(folder, f"part-{part:06d}", records())
        if done:
            yield pa.record_batch([pa.array([x]) for x in done], names=["path", "records", "bytes"])

    rows = dealt(pages, parts_for(total, ARCHIVE_BYTES), least_bytes)
    return stage(rows.select("page_id", "url", "payload", "sha1", "first").mapInArrow(run, MANIFEST), "warc-manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record in the archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for raw in read_archive(_open(folder)[0], path):
                    rows.append(parse(raw))
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    count = max(1, manifest.count())
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return manifest.select("path").repartition(count, "path").mapInArrow(run, schema)


def archive_table(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` and describe each record from what is read back."""
    spark = prepare(pages.sparkSession)
    folder = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    folder = folder.replace("file:///", "/").replace("file:/", "/")
    return read(write(pages, folder, least_bytes), folder)
