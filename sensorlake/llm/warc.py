"""WARC archives compressed record by record with a shared Zstandard dictionary, and their reader.

An archive (``*.warc.zst``) starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; every record, the leading ``warcinfo`` included, is a frame of its own, so a record
can be read by its offset alone. The dictionary is trained on ``SAMPLE`` records (those with the
least hashes, ``SAMPLE_CHARS`` characters from a hash-drawn place of each): a bound, whatever the corpus; too few
records for one give archives without that frame.

Of records with equal payloads (SHA-1) of ``REVISIT_BYTES`` or more the one with the largest
page_id is written as ``response``, the others as ``revisit`` without the payload. Payloads move
once at most: they join the digests that occur again (a left join, whose hot keys Spark splits).
A task rolls its archives at ``ARCHIVE_BYTES`` and writes each under a name of its attempt; the
returned table names those of the attempt that counted, and only they are read, so a retried or
a lost task leaves no record twice. Paths are any that ``pyarrow.fs`` knows.

Defined cases: null html: empty payload; null url: ``urn:x-none:``; null page_id: smaller than
any, no X-Page-ID field; rows that repeat the largest page_id with the same payload are all
responses (one capture, listed again); empty input: no archive, empty result. Only page_id, url
and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned, table
from sensorlake.session import delete_path, scratch_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
SAMPLE, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 8192, 64 << 10
LEVEL = 9
# The format's frame magics and the profile of revisits.
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.binary())])


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest (hex) of every row, ``again`` (its payload is another's) and ``keeper`` (whose)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumn(
        "digest", F.sha1("payload"))
    equal = (rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.count("*").alias("n"), F.max("page_id").alias("keeper")).filter("n > 1"))
    return rows.join(equal, "digest", "left").select(
        "page_id", "url", "payload", "digest", "keeper",
        (F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("again"))


def dictionary(pages: DataFrame) -> bytes:
    """A dictionary trained on a bounded sample of records; empty if they are too few."""
    drawn = F.xxhash64("page_id", "url")
    share = min(1.0, 2 * SAMPLE / max(pages.count(), 1))     # so tasks return few rows, whatever their number
    html = F.coalesce("html", F.lit(""))
    # a piece that begins anywhere, so what stands at the end of pages is learned, too
    begin = F.pmod(F.xxhash64("url", "page_id"), F.greatest(F.char_length(html) - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    rows = (pages.select("page_id", "url", F.substring(html, begin.cast("int"), F.lit(SAMPLE_CHARS)).alias("payload"), drawn.alias("drawn"))
            .filter(F.pmod("drawn", F.lit(1 << 31)) < int(share * (1 << 31)))
            .orderBy("drawn", "page_id").limit(SAMPLE).collect())
    samples = [record(r.page_id, r.url, r.payload.encode("utf-8", "replace"), "", None, False, "") for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}|{digest}')}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, keeper: int | None, again: bool,
           date: str) -> bytes:
    """One response or, if ``again``, revisit record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", _record_id(page_id, digest)),
              ("WARC-Date", date), ("WARC-Target-URI", " ".join((url or "urn:x-none:").split())),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
              ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if again:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(keeper, digest)),
                   ("X-Refers-To-Page-ID", str(keeper))]
    return _record(fields, http + (b"" if again else payload))


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def _writer(root: str, words: bytes, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        files, folder = _file_system(root)
        learned = zstandard.ZstdCompressionDict(words) if words else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned).compress
        opening = (struct.pack("<II", SKIPPABLE, len(words)) + words if words else b"") + pack(_record(
            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
             ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        frames, held, made = [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal frames, held, made
            path, data = f"{name}-{made:04d}.warc.zst", opening + b"".join(frames)
            files.create_dir(folder, recursive=True)
            with files.open_output_stream(f"{folder}/{path.rpartition('/')[2]}", compression=None) as out:
                out.write(data)
            row = pa.RecordBatch.from_pylist([{"path": path, "records": len(frames), "bytes": len(data)}], MANIFEST)
            frames, held, made = [], 0, made + 1
            return row

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, keeper, again = (batch.column(c)[i].as_py() for c in (
                    "page_id", "url", "payload", "digest", "keeper", "again"))
                frames.append(pack(record(page_id, url, payload.encode(), digest, keeper, again, date)))
                held += len(frames[-1])
                if held >= ARCHIVE_BYTES:
                    yield close()
        if frames:
            yield close()
    return run


def write(pages: DataFrame, root: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archives of all rows under ``root``; returns the table of those written: path, records, bytes."""
    rows = decided(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "payload", "digest",
                                 F.col("keeper").cast("long").alias("keeper"), "again")
    return pinned(rows.mapInArrow(_writer(root, dictionary(pages), date), "path string, records long, bytes long"))


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at ``at`` ends, from its block headers."""
    marks = data[at + 4]
    at += zstandard.frame_header_size(bytes(data[at:at + 18]))
    while True:
        block = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4 * (marks >> 2 & 1)


def frames(data: bytes) -> Iterator[bytes]:
    """The records of one archive, decompressed one after another."""
    view, at, words = memoryview(data), 0, None
    magic, size = struct.unpack_from("<II", data)
    if magic == SKIPPABLE:
        words, at = zstandard.ZstdCompressionDict(data[8:8 + size]), 8 + size
    unpack = zstandard.ZstdDecompressor(dict_data=words).decompress
    while at < len(data):
        if struct.unpack_from("<I", data, at)[0] != FRAME:
            raise ValueError(f"no frame at byte {at}")
        end = frame_end(view, at)
        yield unpack(view[at:end])
        at = end


def parsed(data: bytes) -> dict | None:
    """One record -> a row of RECORDS (None for warcinfo); a payload that doesn't fit its digest raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't fit its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields["WARC-Target-URI"],
            "payload_bytes": int(http.rpartition(b"Content-Length: ")[2]), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID"),
            "payload": None if revisit else payload}


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, name = _file_system(path)
                with files.open_input_file(name) as f:
                    data = f.read()
                rows, held = [], 0
                for one in frames(data):
                    row = parsed(one)
                    if row is None:
                        continue
                    held += len(row["payload"] or b"") if with_payload else 256
                    rows.append(row if with_payload else row | {"payload": None})
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, RECORDS)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORDS)
    return run


def read(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that ``manifest`` names: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload (null for revisits)."""
    return manifest.select("path").mapInArrow(
        _reader(with_payload), "page_id long, url string, payload_bytes long, payload_digest string, "
                               "record_type string, refers_to long, payload binary")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the archives written from ``pages`` (archives are deleted once read)."""
    root = scratch_path(spark, "warc")
    found = pinned(read(write(table(spark, sf_dir, "pages"), root), with_payload=False).drop("url", "payload"))
    delete_path(spark, root)
    return found


OP9_SQL = f"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM rows),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> keeper THEN keeper END AS refers_to
FROM kept
"""
