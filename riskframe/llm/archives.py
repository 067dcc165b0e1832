"""Converting legacy ARC archives to WARC, and reading WARC back.

An ARC file opens with a version block whose field line says what the header line
of each record holds; a record is as long as that line declares. The converter
synthesises what WARC asks for beyond it: record ids, ISO timestamps, record types
and digests. Records with a payload that another one has already become revisits.
WARC files are written through Spark's text sink, one gzip member per record.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import chunks

# The header fields of ARC records by version of the format.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
#: Payloads below this many bytes are never stored as revisits.
REVISIT_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member of nothing. The text sink puts it between records, where readers skip it.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
#: Bytes of pages that go into one ARC image.
ARC_BYTES = 4 << 20
PAGE_ID = "X-Page-Id"
RECORD = ("record_id string, record_type string, warc_date string, url string, ip string, content_type string, "
          "head binary, payload binary, payload_bytes long, payload_digest string, page_id long")


def arc_image(version: int, name: str, records: list[tuple[str, str, str, int, bytes]], date: str = "20000101000000") -> bytes:
    """An ARC file of (url, ip, content type, status, block) records."""
    fields = ARC_FIELDS[version]

    def line(url, ip, kind, status, size, offset):
        value = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Result-code": str(status),
                 "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(size)}
        return " ".join(value[f] for f in fields).encode() + b"\n"

    about = f"{version} 0 riskframe\n{' '.join(fields)}\n\n".encode()
    out = [line(f"filedesc://{name}", "0.0.0.0", "text/plain", 200, len(about), 0) + about]
    at = len(out[0])
    for url, ip, kind, status, block in records:
        out.append(b"\n" + line(url, ip, kind, status, len(block), at + 1) + block)
        at += len(out[-1])
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC file: its header fields by name, ``offset`` and ``block``.

    The first is the version block. A record that ends before its declared length
    has ``truncated`` set. A header line with too few fields or no length ends the
    file with a record that only has ``error``.
    """
    fields, at = ARC_FIELDS[1], 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        head = data[at : end if end >= 0 else len(data)].rstrip(b"\r").decode("utf-8", "replace")
        # addresses may hold spaces, so the other fields are counted from the end; a version block says its own fields
        if head.startswith("filedesc:"):
            about = data[end + 1 :].split(b"\n", 2) if end >= 0 else []
            if len(about) > 1 and about[1].strip():
                fields = about[1].decode("utf-8", "replace").split()
        parts = head.rsplit(" ", len(fields) - 1)
        if end < 0 or len(parts) < len(fields) or not parts[-1].isdigit():
            yield {"offset": at, "error": f"no record header: {head[:80]!r}"}
            return
        size = int(parts[-1])
        block = data[end + 1 : end + 1 + size]
        yield dict(zip(fields, parts, strict=True)) | {"offset": at, "block": block, "truncated": len(block) < size}
        at = end + 1 + size


def iso_date(date: str) -> str:
    """An ARC date of 4 to 14 digits as an ISO timestamp; what it lacks is the earliest; other text is the epoch."""
    if not (date.isdigit() and 4 <= len(date) <= 14):
        return "1970-01-01T00:00:00Z"
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Header, with its empty line, and payload of an HTTP response."""
    for gap in (b"\r\n\r\n", b"\n\n"):
        at = block.find(gap)
        if at >= 0:
            return block[: at + len(gap)], block[at + len(gap) :]
    return block, b""


def header_value(head: bytes, name: str) -> str | None:
    for line in head.split(b"\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def whole(value: str | None) -> int | None:
    try:
        return int(value) if value is not None else None
    except ValueError:
        return None


def arc_to_warc(files: DataFrame) -> DataFrame:
    """WARC records (``RECORD``) of (path, content) ARC files, such as ``binaryFile`` gives.

    Version blocks become ``warcinfo``, HTTP responses ``response``, all else
    ``resource``. Ids follow from the file's name, the place in it and the content, so
    a task that runs again gives the same. Null or empty files give no records; a
    malformed rest gives a ``resource`` with the message as its payload.
    """

    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for r in read_arc(content.as_py() or b""):
                    url = r.get("URL", "")
                    block = r.get("block", r.get("error", "").encode())
                    kind = "warcinfo" if url.startswith("filedesc:") else "response" if block.startswith(b"HTTP/") else "resource"
                    head, payload = http_parts(block) if kind == "response" else (b"", block)
                    digest = hashlib.sha256(payload).hexdigest()
                    seed = hashlib.sha256(f"{path}\n{r['offset']}\n{url}\n{digest}".encode()).digest()
                    ip = r.get("IP-address", "")
                    rows.append((f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>", kind, iso_date(r.get("Archive-date", "")), url,
                                 None if ip in ("", "0.0.0.0", "-") else ip, r.get("Content-type", "text/plain"), head, payload, len(payload), digest,
                                 whole(header_value(head, PAGE_ID))))
                if rows:
                    yield batch(rows)

    kinds = [pa.string()] * 6 + [pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return files.select("path", "content").mapInArrow(run, RECORD)


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(path, content) ARC images of pages as HTTP responses, versions 1 and 2 in turn.

    A null html is an empty payload, a null id has no ``X-Page-Id`` line, a null url
    is ``-``; white space in a url is percent-encoded. Other columns are not read.
    """

    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, hi in chunks(b, 2, ARC_BYTES):
                records = []
                for page, url, html in zip(*(c.slice(lo, hi - lo).to_pylist() for c in b.columns), strict=True):
                    payload = html or b""
                    mark = "" if page is None else f"{PAGE_ID}: {page}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{mark}\r\n"
                    url = "".join(f"%{ord(c):02X}" if c.isspace() and ord(c) < 256 else c for c in url or "-")
                    records.append((url, "0.0.0.0", "text/html", 200, head.encode() + payload))
                name = f"pages-{task:06d}-{n:06d}.arc"
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_image(1 + n % 2, name, records)], pa.binary())], ["path", "content"])
                n += 1

    return pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col).cast("binary")).mapInArrow(run, "path string, content binary")


def mark_revisits(records: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Adds first_id, first_page, first_date, first_url: the response that a repeated payload refers to.

    That is the one with the smallest page_id, ties to the smallest record id. They
    are null for first and single responses, other record types and payloads of
    fewer bytes. Payloads are told apart by digest; only digests that occur again are
    kept for the join.
    """
    can = (F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes)
    # a null page id comes last
    best = F.struct(F.col("page_id").isNull().alias("no_page"), F.col("page_id").alias("first_page"), F.col("record_id").alias("first_id"), F.col("warc_date").alias("first_date"), F.col("url").alias("first_url"))
    first = records.where(can).groupBy(F.col("payload_digest").alias("_digest")).agg(F.min(best).alias("_first"), F.count(F.lit(1)).alias("_times"))
    first = first.where("_times > 1").select("_digest", "_first.*").drop("no_page")
    out = records.join(first, (F.col("payload_digest") == F.col("_digest")) & can, "left").drop("_digest")
    own = F.col("first_id") == F.col("record_id")
    return out.withColumns({c: F.when(~own, F.col(c)) for c in ("first_page", "first_date", "first_url", "first_id")})


def warc_record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_warc(records: DataFrame, path: str) -> None:
    """Writes ``RECORD`` rows, with the columns of ``mark_revisits``, as gzipped WARC files.

    Each file starts with a warcinfo of its own. Tasks write through Spark's committed
    text sink, so a lost or repeated task leaves no half file.
    """
    names = [x.split()[0] for x in RECORD.split(", ")] + ["first_id", "first_page", "first_date", "first_url"]

    def run(batches):
        started = False
        for b in batches:
            out = []
            if b.num_rows and not started:
                started = True
                about = b"software: riskframe\r\nformat: WARC File Format 1.1\r\n"
                seed = hashlib.sha256(str(b.column(0)[0]).encode()).digest()
                out.append(member(warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(bytes=seed[16:], version=5)}>"),
                                               ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], about)))
            for r in zip(*b.columns, strict=True):
                rid, kind, date, url, ip, mime, head, payload, size, digest, _, first, first_page, first_date, first_url = (x.as_py() for x in r)
                again = first is not None
                block = head if again else head + payload
                mime = "application/http; msgtype=response" if kind == "response" else "application/warc-fields" if kind == "warcinfo" else mime
                fields = [("WARC-Type", "revisit" if again else kind), ("WARC-Record-ID", rid), ("WARC-Date", date),
                          ("WARC-Target-URI", None if kind == "warcinfo" else url), ("WARC-IP-Address", ip), ("Content-Type", mime),
                          ("WARC-Block-Digest", f"sha256:{digest if not head and not again else hashlib.sha256(block).hexdigest()}"), ("WARC-Payload-Digest", f"sha256:{digest}")]
                if again:
                    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", first), ("WARC-Refers-To-Target-URI", first_url),
                               ("WARC-Refers-To-Date", first_date), ("X-Refers-To-Page-Id", first_page), ("X-Payload-Length", size)]
                out.append(member(warc_record(fields, block)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["data"])

    data = records.select(*names).mapInArrow(run, "data binary")
    data.select(F.col("data").cast("string").alias("value")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files under ``path``: record_id, record_type, url,
    page_id, payload_bytes, payload_digest, refers_to_id, refers_to, digest_ok.

    Payload and block digests are worked out anew and compared with the declared
    ones; a revisit's payload is the one it refers to, so its size and digest are the
    declared ones.
    """

    def run(batches):
        for b in batches:
            rows = []
            for content in b.column(0):
                view = content.as_py()
                at = 0
                while at < len(view):
                    z = zlib.decompressobj(31)
                    data = z.decompress(view[at : at + (1 << 16)])
                    used = min(1 << 16, len(view) - at)
                    while not z.eof:
                        more = view[at + used : at + used + (1 << 20)]
                        if not more:
                            raise ValueError("a WARC file ends within a record")
                        data += z.decompress(more)
                        used += len(more)
                    at += used - len(z.unused_data)
                    if not data:
                        continue
                    head, _, rest = data.partition(b"\r\n\r\n")
                    f = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
                    block = rest[: int(f["content-length"])]
                    kind = f["warc-type"]
                    http = f.get("content-type", "").startswith("application/http")
                    top, payload = http_parts(block) if http else (b"", block)
                    declared = f.get("warc-payload-digest", "sha256:").split(":", 1)[1]
                    digest = declared if kind == "revisit" else hashlib.sha256(payload).hexdigest()
                    ok = digest == declared and (not http or f["warc-block-digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}")
                    size = int(f["x-payload-length"]) if kind == "revisit" else len(payload)
                    rows.append((f["warc-record-id"], kind, f.get("warc-target-uri"), whole(header_value(top, PAGE_ID)), size, digest,
                                 f.get("warc-refers-to"), whole(f.get("x-refers-to-page-id")), ok))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
            columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    schema = ("record_id string, record_type string, url string, page_id long, payload_bytes long, payload_digest string, "
              "refers_to_id string, refers_to long, digest_ok boolean")
    names = [x.split()[0] for x in schema.split(", ")]
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, schema)
