"""Operator 13, WARC archives: a writer with revisit records, and a splittable reader.

The writer makes one gzip member for each record. Of equal payloads one is a
response; the others are revisit records that refer to it. Each task writes
archives of its own, under names no other attempt uses; the list of what was
written is kept as a table, and only archives it names are read.

The reader deals byte ranges of the archives to tasks. A task looks for the
gzip magic in its range, and takes a place for a member if what follows
decodes to the header of a WARC record. It owns the records that start in its
range and reads the last one to its end, beyond the range if need be. Bytes
that look like a member may lie inside one, in a stored block of its deflate
stream; such a block holds 65,535 bytes at most, so a place found by search
counts only if members follow one another from it for longer than that, or to
the end of the archive. Of a damaged member the bytes that look like records
may be taken for such.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitylake.llm.common import cut, looked_up

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/"
LINE = "\r\n"
#: No raw copy of a byte string in a deflate stream is longer.
STORED_BLOCK = 65_535
#: A member's head is looked for in so many bytes of it at first.
HEAD_BYTES = 512
MAX_HEAD = 1 << 20
ARCHIVE_BYTES = 1 << 30
SPLIT_BYTES = 16 << 20
#: Most tasks that ranges are dealt to; beyond it a task reads several.
MAX_TASKS = 100_000
READ_BYTES = 1 << 20
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_RECORD_ID = re.compile(r"<urn:page:(-?[0-9]*):[0-9a-f]*(?::[0-9a-f]+)?>")


# ------------------------------------------------------------------ records
def record_id(page: int | None, sha1: str, part: str = "") -> str:
    return f"<urn:page:{'' if page is None else page}:{sha1}{part and ':' + part}>"


def page_of(name: str | None) -> int | None:
    """The page in a record id of ``record_id``."""
    found = _RECORD_ID.fullmatch(name or "")
    return int(found[1]) if found and found[1] else None


def base32_of(sha1: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()


def hex_of(digest: str | None) -> str | None:
    """The bare lower-case hex of a digest header, given in base 32 or hex."""
    if digest is None:
        return None
    bare = digest.rpartition(":")[2]
    return base64.b32decode(bare.upper()).hex() if len(bare) == 32 else bare.lower()


def _one_line(value: str) -> str:
    """A header's value: control characters, which could end the line, as %XX."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def member(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member."""
    head = "".join(f"{name}: {_one_line(value)}{LINE}" for name, value in [*headers, ("Content-Length", str(len(block)))])
    packed = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packed.compress(f"WARC/1.1{LINE}{head}{LINE}".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packed.flush()


def _http(length: int) -> bytes:
    return f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: {length}{LINE}{LINE}".encode()


def page_record(page: int | None, url: str | None, sha1: str, length: int, payload: bytes | None, refers_to: str | None, unique: str) -> bytes:
    """A response with its payload or, if it refers to another record, a revisit without."""
    kind = "revisit" if refers_to else "response"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page, sha1, unique if refers_to else "")), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    headers += [("WARC-Payload-Digest", base32_of(sha1)), ("Content-Type", "application/http;msgtype=response")]
    if refers_to:
        headers += [("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
    return member(headers, _http(length) + (b"" if refers_to else payload or b""))


def fields(head: bytes) -> dict[str, str]:
    """The header lines after the first, by lower-case name; a line that begins with white space goes on the one before."""
    out, name = {}, None
    for line in head.decode("utf-8", "replace").split("\n")[1:]:
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


# ------------------------------------------------------------------ writer
def _opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system and path of a shared location, as tasks see it."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return pa.fs.FileSystem.from_uri(uri)


def _written(batches: Iterator[pa.RecordBatch], folder: str, most: int) -> Iterator[pa.RecordBatch]:
    system, root = _opened(folder)
    task, name = TaskContext.get().partitionId(), uuid.uuid4().hex
    out, size, done, number = None, 0, [], 0
    try:
        for batch in batches:
            for row in batch.to_pylist():
                if out is not None and size >= most:
                    out.close()
                    out = None
                if out is None:
                    done.append([f"part-{task:05d}-{len(done):05d}-{name}.warc.gz", 0])
                    out, size = system.open_output_stream(f"{root}/{done[-1][0]}", compression=None), 0
                    size += out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                              ("WARC-Filename", done[-1][0]), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                number += 1
                size += out.write(page_record(row["page"], row["url"], row["sha1"], row["length"], row["payload"], row["refers"], f"{task:x}{number:08x}"))
                done[-1][1] = size
    finally:
        if out is not None:
            out.close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n, _ in done]), pa.array([s for _, s in done], pa.int64())], names=["archive", "size"])


def _with_kinds(pages: DataFrame, least: int) -> DataFrame:
    """(page, url, sha1, length, payload, refers): refers is the id of the response whose payload a revisit repeats."""
    rows = pages.withColumn("sha1", F.sha1("payload")).withColumn("length", F.octet_length("payload").cast("bigint"))
    # Equal payloads are told by SHA-256; a null key is a payload that no record may refer to.
    rows = rows.withColumn("key", F.when(F.col("length") >= least, F.unhex(F.sha2("payload", 256))))
    counts = rows.where("key is not null").groupBy("key", "page").agg(F.count(F.lit(1)).alias("m"))
    top = F.max(F.struct("page", "m")).alias("top")
    facts = (counts.groupBy("key").agg(F.sum("m").alias("n"), top).where("n > 1")
                   .select("key", "n", F.lit(True).alias("several"), F.col("top.page").alias("keeper"), F.col("top.m").alias("ties")))
    facts = cut(facts)
    sizes = facts.agg(F.sum("n"), F.max("ties")).first()
    told = looked_up(rows, facts, "key", "n", sizes[0] or 0, ["page", "url"])
    kept = F.col("page").eqNullSafe(F.col("keeper"))
    refers = F.when(F.col("several") & ~kept, _id("keeper"))
    columns = ["page", "url", "sha1", "length"]
    if (sizes[1] or 0) < 2:
        return told.select(*columns, F.when(refers.isNull(), F.col("payload")).alias("payload"), refers.alias("refers"))
    # Rows that share the largest page too: one of the largest url is the response, the others revisit it.
    tied = F.coalesce(F.col("several") & kept & (F.col("ties") > 1), F.lit(False))
    plain = told.where(~tied).select(*columns, F.when(refers.isNull(), F.col("payload")).alias("payload"), refers.alias("refers"))
    same = told.where(tied)
    first = same.groupBy("key").agg(F.max(F.struct("url", "page", "sha1", "length", "payload")).alias("r"))
    response = first.select(*[F.col("r")[c].alias(c) for c in columns], F.col("r.payload"), F.lit(None).cast("string").alias("refers"))
    repeats = (same.groupBy("key", *columns).agg(F.count(F.lit(1)).alias("copies"))
                   .join(first.select("key", F.col("r.url").alias("taken")), "key")
                   .withColumn("copies", F.col("copies") - F.col("url").eqNullSafe(F.col("taken")).cast("int")).where("copies > 0"))
    again = (repeats.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
                    .select(*columns, F.lit(None).cast("binary").alias("payload"), _id("page").alias("refers")))
    return plain.unionByName(response).unionByName(again)


def _id(page: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(":"), F.col("sha1"), F.lit(">"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """A WARC record for each row of ``pages``, in archives under the shared ``folder``; (archive, size) of what was written.

    The payload is the body as UTF-8 bytes (null: empty). Of equal payloads of
    at least ``least`` bytes the one of the largest page (null: smallest) is a
    response and the others are revisits of it, shorter ones are all
    responses. Rows that repeat are records of their own; of rows that share a
    payload and the page, that of the largest url is the response. A null url
    has no target header. An empty table writes nothing. ``folder`` must be a
    location that tasks can write to.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{body_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    system, root = _opened(folder)
    system.create_dir(root, recursive=True)
    return cut(_with_kinds(rows, least).mapInArrow(partial(_written, folder=folder, most=archive_bytes), "archive string, size bigint"))


# ------------------------------------------------------------------ reader
class _Bytes:
    """A file read in blocks, of which the last two are held."""

    def __init__(self, file, size: int):
        self.file, self.size, self.held = file, size, {}

    def _block(self, k: int) -> bytes:
        if k not in self.held:
            if len(self.held) > 1:
                self.held.pop(min(self.held))
            self.file.seek(k * READ_BYTES)
            self.held[k] = self.file.read(READ_BYTES)
        return self.held[k]

    def at(self, start: int, n: int) -> bytes:
        out = bytearray()
        while n > 0 and start < self.size:
            k, off = divmod(start, READ_BYTES)
            piece = self._block(k)[off:off + n]
            if not piece:
                break
            out += piece
            start, n = start + len(piece), n - len(piece)
        return bytes(out)

    def find(self, start: int, end: int) -> int:
        """The first magic that starts in [start, end), or -1."""
        while start < end:
            n = min(READ_BYTES, end - start)
            at = self.at(start, n + len(MAGIC) - 1).find(MAGIC)
            if 0 <= at < n:
                return start + at
            start += n
        return -1


def _head(source: _Bytes, start: int) -> bool:
    """Whether a WARC record's whole header decodes from the member at ``start``."""
    packed, out, at = zlib.decompressobj(31), b"", start
    try:
        while len(out) < MAX_HEAD:
            data = source.at(at, HEAD_BYTES)
            if not data:
                return False
            at += len(data)
            out += packed.decompress(data)
            if not out.startswith(VERSION[:len(out)]):
                return False
            if b"\r\n\r\n" in out or b"\n\n" in out:
                return True
            if packed.eof:
                return False
    except zlib.error:
        return False
    return False


def _member(source: _Bytes, start: int) -> tuple[bytes, int] | None:
    """(content, end) of the member at ``start``; None if it is none, is cut off or fails its checksum."""
    if not _head(source, start):
        return None
    packed, out, at = zlib.decompressobj(31), [], start
    try:
        while not packed.eof:
            data = source.at(at, READ_BYTES // 16)
            if not data:
                return None
            at += len(data)
            out.append(packed.decompress(data))
    except zlib.error:
        return None
    return b"".join(out), at - len(packed.unused_data)


def _follows(source: _Bytes, start: int) -> bool | None:
    """Whether members follow one another from ``start`` beyond a stored block, or to the archive's end; None: to one that is broken."""
    at = start
    while at - start <= STORED_BLOCK and at < source.size:
        got = _member(source, at)
        if got is None:
            return None if at > start and source.at(at, len(MAGIC)) == MAGIC[:source.size - at] else False
        at = got[1]
    return True


def records(source: _Bytes, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the records that start in [start, end).

    Where a place found by search leads to a broken member within a stored
    block's length, it may be a member of the archive before a damaged one, or
    lie inside another: unless the members before it in this range are known,
    the archive is then walked from its start to tell.
    """
    at, known, sure = start, start == 0, start == 0
    while at < end:
        if not sure or source.at(at, len(MAGIC)) != MAGIC:
            at = source.find(at, end)
            if at < 0:
                return
            follows = _follows(source, at)
            if follows is None:
                follows = known or any(o == at for o, _ in records(source, 0, at + 1))
            if not follows:
                at, sure = at + 1, False
                continue
        got = _member(source, at)
        if got is None:  # broken: go on behind its start
            at, sure = at + 1, False
            continue
        yield at, got[0]
        at, known, sure = got[1], True, True


def parsed(content: bytes) -> tuple[dict[str, str], bytes | None, dict[str, str]]:
    """(WARC headers, payload, HTTP headers); the payload of a record that is not HTTP is its block, that of a revisit is none."""
    cut_at = re.search(rb"\r?\n\r?\n", content)
    headers = fields(content[:cut_at.start()])
    length = headers.get("content-length", "")
    block = content[cut_at.end():]
    block = block[:int(length)] if length.isdigit() else block
    http: dict[str, str] = {}
    if headers.get("content-type", "").startswith("application/http"):
        inner = re.search(rb"\r?\n\r?\n", block)
        http = fields(block[:inner.start()] if inner else block)
        block = block[inner.end():] if inner else b""
    return headers, None if headers.get("warc-type") == "revisit" else block, http


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("archive", "offset", "record_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "digest_ok", "refers_to", "payload")
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.binary())

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for archive, size, start, end in zip(*(batch.column(c).to_pylist() for c in ("archive", "size", "start", "end"))):
            system, path = _opened(archive)
            rows, held = [], 0
            with system.open_input_file(path) as file:
                for offset, content in records(_Bytes(file, size), start, end):
                    headers, payload, http = parsed(content)
                    stated = hex_of(headers.get("warc-payload-digest"))
                    sha1 = stated if payload is None else hashlib.sha1(payload).hexdigest()
                    length = http.get("content-length", "")
                    n = len(payload) if payload is not None else int(length) if length.isdigit() else None
                    rows.append((archive, offset, headers.get("warc-record-id"), headers.get("warc-type"), headers.get("warc-target-uri"), n, sha1,
                                 None if stated is None or payload is None else sha1 == stated, headers.get("warc-refers-to"), payload))
                    held += len(content)
                    if held >= 8 << 20:
                        yield out(rows)
                        rows, held = [], 0
            if rows:
                yield out(rows)


def read_archives(archives: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """The records of ``archives`` (archive, size), each range of ``split`` bytes read by itself.

    Columns: archive, offset, record_id, record_type, target_uri,
    payload_bytes, payload_digest (SHA-1, lower-case hex), digest_ok (whether
    the payload has the digest its header states; null if either is missing),
    refers_to, payload. A revisit has no payload; its size and digest are
    those its headers state, of the full payload. Members that are cut off or
    fail their checksum give no row. No archives give no rows.
    """
    # By number: a range is a small row but much work, and tasks merged by their rows' size would read many.
    found = archives.agg(F.sum(F.ceil(F.col("size") / split))).first()[0] or 1
    ranges = (archives.select("archive", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("bigint"))).alias("start"))
                      .withColumn("end", F.least(F.col("start") + split, F.col("size"))))
    return ranges.repartition(min(MAX_TASKS, int(found)), "archive", "start").mapInArrow(
        _read, "archive string, offset bigint, record_id string, record_type string, target_uri string, payload_bytes bigint, "
               "payload_digest string, digest_ok boolean, refers_to string, payload binary")


def page_in(name: str) -> Column:
    """The page id in a record id, as a column."""
    found = F.regexp_extract(name, "^<urn:page:(-?[0-9]*):", 1)
    return F.when(found != "", found.cast("bigint"))


def page_rows(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records of pages."""
    return (found.where(F.col("record_type").isin("response", "revisit"))
                 .select(page_in("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_in("refers_to").alias("refers_to")))
