"""WARC archives: written one gzip member a record, and read back in byte ranges that split the files anywhere.

**Writing.** Of records with equal payloads of at least ``least`` bytes the one with the largest id is a response and the others are
revisits of it, which hold its id, the payload's digest and the HTTP header, but not the payload. Only ids and digests are
shuffled to find them; of the texts only those of revisits are. Files are named by the attempt that wrote them, and only those of
committed attempts are in the manifest, so a task that runs again after the loss of an executor leaves no record twice.

**Reading.** A task gets a range of a file. It looks for the two magic bytes of gzip, decodes a candidate's first bytes and takes it
for a record if they are a WARC version line; then it reads member after member, which lie end to end, as long as they start
inside its range. A record belongs to the range that its first byte is in, and is read to its end wherever that is. Checksums of
members are verified, and so are a response's length and digest. Payloads are decoded in pieces, so a very long one takes no more memory
than a short one unless it is asked for.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.batches import slices, text_bytes
from gaugeworks.llm.graph import maybe_among
from gaugeworks.llm.token_files import file_system
from gaugeworks.session import ship_package, written

# Fixed values of the format.
VERSION, MAGIC = b"WARC/1.1", b"\x1f\x8b"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"

MANIFEST = "path string, length long, n_records long"
RECORDS = ("path string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
           "payload_bytes long, payload_digest string")
#: A file is closed once it has so many bytes; each range to be read has this length.
FILE_BYTES, RANGE_BYTES = 1 << 30, 64 << 20
#: Bytes that are read and decoded at once, and the most that a record's headers take.
CHUNK, HEADERS = 1 << 18, 1 << 20


# --- writing -------------------------------------------------------------------------------------

def _safe(value: str) -> str:
    """A header's value without control characters, white space or what stands around ids."""
    return "".join(c if 32 < ord(c) < 127 and c not in '<>"' else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(record_id: str, uri: str | None, payload: bytes | None, size: int, sha1: bytes, refers_to: str | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit of ``refers_to``."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if refers_to is None:
        block += payload or b""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD_ID}{_safe(record_id)}>",
            f"WARC-Date: {date}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_safe(uri)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{RECORD_ID}{_safe(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """(id, sha1, refers_to) of the rows of (id, payload) whose payload is that of a row with a larger id.

    Equal are payloads of one length, SHA-1 and 64-bit hash. Rows that share the largest id are all responses, and so are
    all rows of a payload that only rows without an id have.
    """
    data = F.col("payload").cast("binary")
    facts = pages.select("id", F.octet_length(data).cast("long").alias("size"), F.sha1(data).alias("sha1"), F.xxhash64(data).alias("hash"))
    long = written(facts.where(F.col("size") >= least), "payload-facts")
    known = ["size", "sha1", "hash"]
    same = long.groupBy(*known).agg(F.max("id").alias("largest"), F.count("*").alias("n")).where("n > 1 and largest is not null").drop("n")
    found = long.join(same, known).where(~F.col("id").eqNullSafe(F.col("largest")))
    return found.select("id", "sha1", F.col("largest").alias("refers_to")).distinct()


def write_archives(pages: DataFrame, folder: str, least: int = 1000, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row to files below ``folder``; returns the stored manifest (path, length, n_records).

    A null payload is empty, a null address is left out, and ids stand in the records as text (a null id as an empty
    one). Repeated rows are all written. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    ship_package(spark)
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                         F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    again = written(revisits(named, least), "revisits")
    # A payload is looked up only if its id and digest may be in the list.
    place = lambda: F.xxhash64("id", "sha1")
    coded = named.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    split = maybe_among(coded.withColumn("place", place()), again.select(place().alias("place")), "place").drop("place")
    seen = again.select(F.col("id").alias("i"), F.col("sha1").alias("s"), "refers_to")
    likely = split.where("maybe").join(seen, F.col("id").eqNullSafe(F.col("i")) & (F.col("sha1") == F.col("s")), "left").drop("i", "s")
    none = F.lit(None).cast(likely.schema["refers_to"].dataType)
    rows = likely.unionByName(split.where("not maybe").withColumn("refers_to", none))
    ready = rows.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "url", F.unhex("sha1").alias("sha1"),
                        F.col("refers_to").cast("string").alias("refers_to"), F.octet_length("payload").cast("long").alias("size"),
                        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = file_system(folder)
        files.create_dir(where, recursive=True)
        part, stream, done, length, n = TaskContext.get().partitionId(), None, [], 0, 0
        for batch in slices(batches, "payload"):
            columns = [batch.column(c).to_pylist() for c in ("id", "url", "size", "sha1", "refers_to")]
            for name, uri, size, sha1, refers_to, payload in zip(*columns, text_bytes(batch.column("payload")), strict=True):
                if stream is None:
                    path = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    stream, length, n = files.open_output_stream(f"{where}/{path}", compression=None), 0, 0
                data = member(record(name, uri, payload, size, bytes(sha1), refers_to, date))
                stream.write(data)
                length, n = length + len(data), n + 1
                if length >= file_bytes:
                    stream.close()
                    stream = None
                    done.append((f"{folder}/{path}", length, n))
        if stream:
            stream.close()
            done.append((f"{folder}/{path}", length, n))
        yield pa.RecordBatch.from_pylist([{"path": a, "length": b, "n_records": c} for a, b, c in done], pa.schema(
            [("path", pa.string()), ("length", pa.int64()), ("n_records", pa.int64())]))

    return written(ready.mapInArrow(work, MANIFEST), "warc-manifest")


# --- reading -------------------------------------------------------------------------------------

@dataclass
class Record:
    """What one member holds; ``size`` and ``digest`` are those of the payload that was there."""

    offset: int
    head: dict[str, str] = field(default_factory=dict)
    http: dict[str, str] = field(default_factory=dict)
    size: int = 0
    digest: str = ""
    payload: bytes | None = None


class _Bytes:
    """A file from some place on, in chunks, with what has been read but not used."""

    def __init__(self, file, at: int):
        self.file, self.at, self.rest = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        got = self.file.read(CHUNK)
        self.rest += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.rest, self.at = self.rest[n:], self.at + n


def _named(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def is_record(start: bytes) -> bool:
    """Whether a gzip member begins here that decodes to a WARC version line. ``start`` holds its first bytes."""
    if start[:3] != MAGIC + b"\x08":
        return False
    try:
        return zlib.decompressobj(31).decompress(start, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def first_record(data: _Bytes, stop: int) -> bool:
    """Move to the first record that starts before ``stop``, if there is one."""
    probe = 1 << 12  # bytes after the magic from which a candidate's version line can be decoded
    while True:
        end = not data.more() if len(data.rest) < probe else False
        at = data.rest.find(MAGIC)
        if at < 0:
            data.skip(max(0, len(data.rest) - (0 if end else 1)))
            if end or data.at >= stop:
                return False
            continue
        data.skip(at)
        while len(data.rest) < probe and data.more():
            pass
        if data.at >= stop:
            return False
        if is_record(data.rest[:probe]):
            return True
        data.skip(1)


def read_member(data: _Bytes, payload: bool = False) -> Record:
    """The record at the present place; moves behind it. Raises ValueError for a member that is cut off or damaged."""
    out, packer = Record(data.at), zlib.decompressobj(31)
    text, left, sha1, kept = b"", None, hashlib.sha1(), []
    while not packer.eof:
        if not data.rest and not data.more():
            raise ValueError(f"record at {out.offset} is cut off")
        try:
            piece = packer.decompress(data.rest, CHUNK)
        except zlib.error as error:
            raise ValueError(f"record at {out.offset} is damaged: {error}") from error
        unused = packer.unused_data if packer.eof else packer.unconsumed_tail
        data.skip(len(data.rest) - len(unused))
        if left is None:
            text += piece
            if len(text) > HEADERS:
                raise ValueError(f"headers of the record at {out.offset} have no end")
            head, end, rest = text.partition(b"\r\n\r\n")
            if not end:
                continue
            if not out.head:
                lines = head.split(b"\r\n")
                if not lines[0].startswith(b"WARC/1."):
                    raise ValueError(f"no record at {out.offset}")
                out.head = _named(lines[1:])
                left = int(out.head.get("content-length", "0"))
                if out.head.get("content-type", "").startswith("application/http"):
                    http, ended, body = rest.partition(b"\r\n\r\n")
                    if not ended and len(rest) < left:  # the HTTP header goes on in the next piece
                        out.head, left = {}, None
                        continue
                    out.http = _named(http.split(b"\r\n")[1:])
                    left, rest = left - len(http) - len(ended), body
            piece = rest
        piece, left = piece[:left], left - len(piece[:left])
        out.size += len(piece)
        sha1.update(piece)
        if payload:
            kept.append(piece)
    if left:
        raise ValueError(f"record at {out.offset} is shorter than it says")
    out.digest, out.payload = sha1.hexdigest(), b"".join(kept) if payload else None
    return out


def records_in(file, start: int, stop: int, payload: bool = False) -> Iterator[Record]:
    """Records of an open file that start at ``start`` or later, but before ``stop``."""
    data = _Bytes(file, start)
    if not first_record(data, stop):
        return
    while data.at < stop:
        while len(data.rest) < 3 and data.more():
            pass
        if not data.rest:
            return
        yield read_member(data, payload)


def _name(value: str | None) -> str | None:
    return None if value is None else value.strip("<>").removeprefix(RECORD_ID)


def _digest(value: str) -> str:
    """A labelled digest as lower-case hexadecimal digits."""
    text = value.partition(":")[2]
    return base64.b32decode(text.upper()).hex() if len(text) == 32 else text.lower()


def read_archives(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, payload: bool = False) -> DataFrame:
    """A row for each record of ``files`` (path, length), read in ranges of ``range_bytes``.

    A revisit's size and digest are those that its headers state; a response's are those of what was read, which have to
    agree with its headers. ``payload`` adds it as binary, null for a revisit. Files without records give none.
    """
    ship_package(spark)
    ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes))).alias("start"))
    n = ranges.count()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, where = file_system(row["path"])
                rows, held = [], 0
                with system.open_input_file(where) as file:
                    for x in records_in(file, row["start"], min(row["start"] + range_bytes, row["length"]), payload):
                        kind, stated = x.head.get("warc-type", ""), _digest(x.head.get("warc-payload-digest", ""))
                        revisit = kind == "revisit"
                        if not revisit and (stated not in ("", x.digest) or int(x.http.get("content-length", x.size)) != x.size):
                            raise ValueError(f"payload of the record at {x.offset} of {row['path']} is not what its headers say")
                        size = int(x.http.get("content-length", 0)) if revisit else x.size
                        rows.append({"path": row["path"], "offset": x.offset, "record_id": _name(x.head.get("warc-record-id")), "record_type": kind,
                                     "target_uri": x.head.get("warc-target-uri"), "refers_to": _name(x.head.get("warc-refers-to")),
                                     "payload_bytes": size, "payload_digest": stated if revisit else x.digest,
                                     "payload": None if revisit else x.payload})
                        held += x.size if payload else 1
                        if len(rows) >= 4096 or held > 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    text, number = pa.string(), pa.int64()
    fields = [("path", text), ("offset", number), ("record_id", text), ("record_type", text), ("target_uri", text), ("refers_to", text),
              ("payload_bytes", number), ("payload_digest", text), *([("payload", pa.binary())] if payload else [])]
    arrow = pa.schema(fields)
    dealt = ranges.repartition(max(1, min(n, 100_000)))
    return dealt.mapInArrow(work, RECORDS + (", payload binary" if payload else ""))


def archives_below(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the archives in a folder, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length")
