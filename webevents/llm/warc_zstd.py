"""WARC archives compressed with Zstandard: a writer and a reader.

An archive begins with a skippable frame that holds its dictionary; then every record is a
frame of its own, so that a reader can start at any record. The reader loads the dictionary,
decodes frame by frame and checks each record's headers, lengths and digests.

Defined results: a null payload is empty; a record without an id gets a name of its payload
and address, and is never revisited by another; repeated rows are records of their own,
and of equal payloads those with the smallest id are all responses; a null address is
written as the record's own name; an empty table has no archives; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.llm.common import batch_of, hash_share, new_path, spread, stored
from webevents.llm.files import new_file, open_input, open_output

#: Payloads of fewer bytes are always written in full.
MIN_REVISIT = 100
#: An archive is closed at so many bytes before compression.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is trained on about so many payloads, none longer than DICT_PAYLOAD.
DICT_PAYLOADS = 800
DICT_PAYLOAD = 32 << 10
DICT_BYTES = 64 << 10
LEVEL = 3
READ_BYTES = 64 << 10

# Fixed values of the formats.
DICT_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
PAGE_URN = "urn:x-page:"


class WarcError(ValueError):
    """An archive that breaks the format, with the place."""


def page_name(page_id: int | None, digest: str, url: str | None) -> str:
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url}#{digest}')}>"
    return f"<{PAGE_URN}{page_id}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(rf"<{PAGE_URN}(-?\d+)>", name or "")
    return int(found[1]) if found else None


def safe_address(url: str) -> str:
    """Control characters, blanks and what isn't ASCII, percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP headers only."""
    name = page_name(page_id, digest, url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name),
        ("WARC-Date", date),
        ("WARC-Target-URI", safe_address(url) if url else name[1:-1]),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", page_name(refers_to, digest, url))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def info_record(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    head = (
        f"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
        f"Content-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n"
    )
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, payload: str = "html") -> bytes:
    """A dictionary from a bounded sample of payloads chosen by hash; empty if they are too few."""
    short = pages.select(F.col(f"`{payload}`").alias("p")).where(F.octet_length("p").between(64, DICT_PAYLOAD))
    some = short.where(hash_share(short.count(), DICT_PAYLOADS, "p")).distinct().collect()
    samples = sorted(r["p"].encode() for r in some)
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archives(
    pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", payload: str = "html",
    min_revisit: int = MIN_REVISIT, date: str = "1970-01-01T00:00:00Z", dictionary: bytes | None = None,
) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; their list (path, records), stored.

    The first of equal payloads is found on (id, digest, length) rows, where a payload that a
    third of all pages share is one row per task; the payloads themselves are shuffled
    once, by id, so equal ones spread."""
    if dictionary is None:
        dictionary = train_dictionary(pages, payload)
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    keys = stored(
        rows.where((F.octet_length("payload") >= min_revisit) & F.col("id").isNotNull()).select("id", "digest"),
        "warc-digests",
    )
    firsts = stored(
        keys.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("final")).where("first < final"),
        "warc-firsts",
    )
    revisits = (
        keys.join(firsts, "digest").where("id > first")
        .select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("first").alias("refers_to")).distinct()
    )
    planned = rows.join(
        revisits, (F.col("id") == F.col("_id")) & (F.col("digest") == F.col("_digest")), "left"
    ).select("id", "url", "payload", "digest", "refers_to")
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True).compress
        out, path, records, held = None, "", 0, 0
        for batch in batches:
            for row in zip(*batch.columns):
                number, address, body, digest, refers_to = (x.as_py() for x in row)
                if out is None:
                    path, records, held = new_file(folder, ".warc.zst"), 0, 0
                    out = open_output(path)
                    if dictionary:
                        out.write(struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary)
                    out.write(compress(info_record(date)))
                whole = record(number, address, body.encode(), digest, refers_to, date)
                out.write(compress(whole))
                records, held = records + 1, held + len(whole)
                if held >= ARCHIVE_BYTES:
                    out.close()
                    yield batch_of(schema, [path], [records])
                    out = None
        if out is not None:
            out.close()
            yield batch_of(schema, [path], [records])

    return stored(planned.mapInArrow(run, "path string, records long"), "warc-archives")


def frames(file: BinaryIO, read_bytes: int = READ_BYTES) -> Iterator[tuple[int, bytes]]:
    """(place, content) of every frame; holds one record and one read at a time."""
    held, place, dictionary, first = b"", 0, None, True

    def more(n: int) -> bytes:
        nonlocal held
        while len(held) < n and (got := file.read(max(read_bytes, n - len(held)))):
            held += got
        return held

    while more(8):
        if len(held) < 4:
            raise WarcError(f"{len(held)} stray bytes at {place}")
        magic = struct.unpack_from("<I", held)[0]
        if magic in SKIPPABLE:
            if len(held) < 8:
                raise WarcError(f"skippable frame cut off at {place}")
            size = struct.unpack_from("<I", held, 4)[0]
            if len(more(8 + size)) < 8 + size:
                raise WarcError(f"skippable frame cut off at {place}")
            if first and magic == DICT_FRAME:
                content = held[8 : 8 + size]
                if content[:4] == zstandard.FRAME_HEADER:  # the dictionary may be compressed itself
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                dictionary = zstandard.ZstdCompressionDict(content)
            held, place, first = held[8 + size :], place + 8 + size, False
            continue
        first = False
        if held[:4] != zstandard.FRAME_HEADER:
            raise WarcError(f"no frame at {place}")
        decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts, used = [], 0
        while True:
            try:
                parts.append(decoder.decompress(held))
            except zstandard.ZstdError as error:
                raise WarcError(f"frame at {place}: {error}") from error
            used += len(held)
            if decoder.eof:
                break
            held = file.read(read_bytes)
            if not held:
                raise WarcError(f"frame cut off at {place}")
        held = decoder.unused_data
        yield place, b"".join(parts)
        place += used - len(held)


def header_fields(lines: list[bytes], place: int) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+\-.^_`|~0-9A-Za-z]+", name):
            raise WarcError(f"record at {place}: bad header line {line[:80]!r}")
        if name.lower() in fields:
            raise WarcError(f"record at {place}: {name} twice")
        fields[name.lower()] = value.strip()
    return fields


def length_field(fields: dict[str, str], place: int) -> int:
    value = fields.get("content-length", "")
    if not value.isdecimal():
        raise WarcError(f"record at {place}: bad Content-Length {value!r}")
    return int(value)


def parse_record(content: bytes, place: int = 0) -> tuple[dict[str, str], bytes]:
    """Checked headers and block of the one record in a frame."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise WarcError(f"record at {place}: no WARC header")
    fields = header_fields(lines, place)
    if missing := [name for name in REQUIRED if name not in fields]:
        raise WarcError(f"record at {place}: without {', '.join(missing)}")
    size = length_field(fields, place)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"record at {place}: the block has {len(rest) - 4} bytes, Content-Length {size}")
    block = rest[:size]
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha256:") and stated[7:] != hashlib.sha256(block).hexdigest():
        raise WarcError(f"record at {place}: block digest")
    return fields, block


def read_record(content: bytes, place: int = 0) -> dict | None:
    """Page, payload and references of a response or revisit; None for other records."""
    fields, block = parse_record(content, place)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError(f"record at {place}: no HTTP header")
    size = length_field(header_fields(head.split(b"\r\n")[1:], place), place)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise WarcError(f"record at {place}: payload length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise WarcError(f"record at {place}: a revisit with a payload or without a reference")
    return {
        "page_id": page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")), "payload": payload,
    }


READ_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read_archives(archives: DataFrame, *, payloads: bool = False, rows: int = 200) -> DataFrame:
    """Every response and revisit of the archives listed in ``path``, one task per few archives.

    With ``payloads`` the payload bytes too (none for revisits)."""
    names = [f.split()[0] for f in READ_SCHEMA.split(", ")] + (["payload"] if payloads else [])
    types = [pa.string() if " string" in f else pa.int64() for f in READ_SCHEMA.split(", ")] + [pa.binary()]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []

        def batch() -> pa.RecordBatch:
            return batch_of(schema, *[[r[n] for r in found] for n in names])

        for paths in batches:
            for path in paths.column(0):
                with open_input(path.as_py()) as file:
                    for place, content in frames(file):
                        if (read := read_record(content, place)) is not None:
                            found.append(read)
                        if len(found) == rows:
                            yield batch()
                            found = []
        yield batch()

    return spread(archives.select("path"), "path").mapInArrow(
        run, READ_SCHEMA + (", payload binary" if payloads else "")
    )


def op10_warc_zstd(pages: DataFrame) -> DataFrame:
    """Write all pages as archives, read the archives back, and report every record."""
    archives = write_archives(pages, new_path(pages.sparkSession, "warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f
"""
