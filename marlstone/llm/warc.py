"""WARC archives: a writer with revisit records, and a reader that salvages what damage has left.

Archives are bytes in rows (archive, content), gzip member per record, in tables that any Spark sink can hold; the reader
takes such rows from anywhere, for instance from Spark's binaryFile source, compressed or plain. When a member or record
fails its checks (gzip checksum, version line, header, length, end mark, block digest, payload digest), the reader looks
for the next place where a valid member or a version line begins, goes on there, and reports the bytes between as a gap; inside an
inflated member, or what inflates of a broken one, it does the same.

Of records with equal payloads of at least LEAST bytes, the one with the largest page id is a response and all others
revisit it; smaller ones are all responses. Rows: a null html is an empty payload; a null page id counts as smaller than
any other and is read back as null (where all ids of a group are null, all are responses); rows that share both id
and payload are of one type; a null url has no target header; control characters of a url are escaped; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, written

LEAST = 1000  #: bytes from which equal payloads are revisits
ARCHIVE = 8 << 20  #: bytes of payload in an archive, about
LEVEL = 6
_ID = "urn:page:"


def typed(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(page_id, url, payload, digest, record_type, refers_to). Only ids and digests of repeated payloads are gathered."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    groups = p.where(F.octet_length("payload") >= LEAST).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1 and holder is not null")
    p = p.join(groups.select("digest", "holder"), "digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return p.select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("holder")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def archives(records: DataFrame) -> DataFrame:
    """(archive, content) of typed records: a written table."""

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, ARCHIVE, "payload"):
            content = b"".join(_member(record(*r.values())) for r in batch.to_pylist())
            yield pa.RecordBatch.from_pydict({"archive": [f"pages-{part:06d}-{n:06d}.warc.gz"], "content": pa.array([content], pa.binary())})
            n += 1

    ordered = records.select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    return written(ordered.mapInArrow(run, "archive string, content binary"), "warc")


_CUT = "gzip: member is cut off"


class _Damage(ValueError):
    pass


_VERSION = re.compile(rb"WARC/1\.\d\r\n")


def _record_at(data: bytes, at: int, digest: bool = False) -> tuple[dict, int]:
    """The record that begins there, checked, and where it ends; digest: it needs a block digest."""
    if not _VERSION.match(data, at):
        raise _Damage("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise _Damage("header does not end")
    head = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise _Damage("malformed header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit():
        raise _Damage("no content length")
    begin = stop + 4
    end = begin + int(head["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise _Damage("record does not end where its length says")
    block = data[begin:end]
    want = head.get("warc-block-digest", "")
    if digest and not (want.startswith("sha1:") and len(want) == 45):
        raise _Damage("no block digest in a broken member")
    if want.startswith("sha1:") and len(want) == 45 and hashlib.sha1(block).hexdigest() != want[5:].lower():
        raise _Damage("block digest differs")
    kind = head.get("warc-type", "")
    http, mark, payload = block.partition(b"\r\n\r\n") if "application/http" in head.get("content-type", "") else (b"", b"", block)
    size = len(payload)
    if kind == "revisit" and (m := re.search(rb"(?im)^content-length:\s*(\d+)", http)):
        size = int(m[1])
    want = head.get("warc-payload-digest", "")
    if kind == "response" and want.startswith("sha1:") and len(want) == 45 and hashlib.sha1(payload).hexdigest() != want[5:].lower():
        raise _Damage("payload digest differs")
    return {"type": kind, "id": head.get("warc-record-id"), "uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"), "payload": payload, "payload_bytes": size, "payload_digest": want[5:].lower() or None}, end + 4


def _member_at(data: bytes, at: int) -> tuple[bytes, int | None, str]:
    """What inflates of the gzip member that begins there, where it ends, and, where it is broken or cut off (end None), why."""
    view, out, step, pos = memoryview(data), [], 1 << 16, at
    d, reason = zlib.decompressobj(31), ""
    while not d.eof and pos < len(data) and not reason:
        try:
            out.append(d.decompress(view[pos : pos + step]))
            pos += step
        except zlib.error as e:
            reason, d = f"gzip: {e}", zlib.decompressobj(31)
            d.decompress(view[at:pos])
            try:  # byte by byte up to the error
                for i in range(pos, min(pos + step, len(data))):
                    out.append(d.decompress(view[i : i + 1]))
            except zlib.error:
                pass
    if not d.eof and not reason:
        reason = _CUT
    plain = b"".join(out)
    if not _VERSION.search(plain):
        raise _Damage(reason or "member holds no record")
    return plain, None if reason else min(pos, len(data)) - len(d.unused_data), reason


def _inner(plain: bytes, digest: bool):
    """Yields (begin, end, record or reason) over inflated bytes: what fails its checks goes up to the next version line."""
    at, gap, reason = 0, None, ""
    while at < len(plain):
        try:
            r, end = _record_at(plain, at, digest)
        except _Damage as e:
            if gap is None:
                gap, reason = at, str(e)
            m = _VERSION.search(plain, at + 1)
            at = m.start() if m else len(plain)
            continue
        if gap is not None:
            yield gap, at, reason
            gap = None
        yield at, end, r
        at = end
    if gap is not None:
        yield gap, len(plain), reason


def salvage(data: bytes):
    """Yields ("record", offset, length, record) and ("gap", offset, length, reason), in order, over all bytes.

    A gap inside an inflated member has the member's offset and length, and its own place in the reason. Of a broken member
    the records with a good block digest count, without the one that ends where a cut-off member does; its bytes are a gap besides."""
    at, gap, reason = 0, None, ""
    start = re.compile(rb"\x1f\x8b\x08|WARC/1\.\d\r\n")
    while at < len(data):
        found, end = [], None
        try:
            if data.startswith(b"\x1f\x8b", at):
                plain, end, why = _member_at(data, at)
                found = list(_inner(plain, end is None))
                if end is None or not any(isinstance(r, dict) for _, _, r in found):
                    raise _Damage(why or found[0][2])
            else:
                r, end = _record_at(data, at)
                found = [(0, 0, r)]
        except _Damage as e:
            m = start.search(data, at + 1)
            after = m.start() if m else len(data)
            good = [r for _, b, r in found if isinstance(r, dict) and not (why == _CUT and b == len(plain))]
            if good and gap is not None:
                yield "gap", gap, at - gap, reason
                gap = None
            for r in good:
                yield "record", at, after - at, r
            if gap is None:
                gap, reason = at, str(e)
            at = after
            continue
        if gap is not None:
            yield "gap", gap, at - gap, reason
            gap = None
        for a, b, r in found:
            if isinstance(r, dict):
                yield "record", at, end - at, r
            else:
                yield "gap", at, end - at, f"{r} (bytes {a} to {b} of the inflated member)"
        at = end
    if gap is not None:
        yield "gap", gap, len(data) - gap, reason


SCHEMA = "archive string, kind string, offset long, length long, reason string, type string, id string, uri string, refers_to string, payload binary, payload_bytes long, payload_digest string"


def read(stored: DataFrame, archive_col: str = "archive", content_col: str = "content") -> DataFrame:
    """Every record and every gap of the archives. kind tells them apart."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[x.split()[1]]) for n, x in zip(names, SCHEMA.split(", "))])

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content")):
                rows = []
                size = 0
                for kind, offset, length, what in salvage(content.as_py() or b""):
                    row = {"archive": name, "kind": kind, "offset": offset, "length": length}
                    rows.append(row | (what if kind == "record" else {"reason": what}))
                    size += len(row.get("payload", b"")) if kind == "gap" else len(what["payload"])
                    if size > ARCHIVE:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return stored.select(F.col(archive_col).cast("string").alias("archive"), F.col(content_col).alias("content")).mapInArrow(run, SCHEMA)


def op4_salvage(spark, sf_dir: str) -> DataFrame:
    from .common import table

    back = read(archives(typed(table(spark, sf_dir, "pages")))).where("kind = 'record' and type in ('response', 'revisit')")
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<{_ID}(-?[0-9]+)>$', 1) as bigint)")
    return back.select(number("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))


OP4_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha1(COALESCE(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload_digest) AS holder FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM g
"""
