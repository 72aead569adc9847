"""Monolithic gzip normaliser for WARC archives.

Some crawlers write a whole archive as one gzip stream, which cannot be read
from the middle.  The normaliser inflates such a stream once, from front to
back, writes every record again as a gzip member of its own, and writes a
sidecar index (offset, length and identity of each member).  Afterwards any
record is read with one seek.

Archives are files in the shared work folder.  A task writes under names of
its own, and the name reaches the result only when the task has ended, so a
repeated task leaves an unused file and never a torn one.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.llm.common import landed, table
from shiftkit.session import shared_dir, ship_package

#: Payloads of at least this many bytes are written once.
REVISIT_BYTES = 1_000
#: A new archive begins after this many bytes of records.
ARCHIVE_BYTES = 64 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"       # fixed, so equal pages give equal records
_CHUNK = 1 << 20


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path in it; plain paths and file: are the shared mount."""
    if m := re.match(r"file:/*(/.*)|(/.*)", uri):
        return pafs.LocalFileSystem(), m[1] or m[2]
    return pafs.FileSystem.from_uri(uri)


# --- records -------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, n: int) -> bytes:
    """One WARC record with an HTTP block; a revisit has the HTTP header only.

    ``n`` is the size of the full payload.  Control characters of the URL are
    escaped; a null page id or url leaves its header out.
    """
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n").encode()
    block = http if revisit else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {digest}')}"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    """Header lines as a dictionary with lower-case names; the first line is under ''."""
    first, *rest = block.decode("utf-8", "replace").split("\r\n")
    return {"": first} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest if x)}


class Inflated:
    """Reads a gzip file of one or many members from front to back in bounded memory.

    What was inflated is handed out by a cursor; what is left of it is moved
    only when more is inflated, not for each record.
    """

    def __init__(self, read: Callable[[int], bytes]):
        self._read, self._z, self._buffer, self._at, self._fed = read, zlib.decompressobj(31), b"", 0, b""

    def _more(self) -> bool:
        while True:
            if self._z.eof:
                self._fed = self._z.unused_data or self._fed
                self._z = zlib.decompressobj(31)
            raw = self._fed or self._read(_CHUNK)
            self._fed = b""
            if not raw:
                return False
            out = self._z.decompress(raw, 4 * _CHUNK)
            self._fed = self._z.unconsumed_tail
            if out:
                self._buffer, self._at = self._buffer[self._at:] + out, 0
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to and with ``mark``; None at the end."""
        seen = 0                                             # bytes behind the cursor that hold no mark
        while (i := self._buffer.find(mark, self._at + seen)) < 0:
            seen = max(0, len(self._buffer) - self._at - len(mark) + 1)
            if not self._more():
                if self._buffer[self._at:].strip(b"\r\n"):
                    raise ValueError("the archive ends within a record's header")
                return None
        start, self._at = self._at, i + len(mark)
        return self._buffer[start:self._at]

    def pieces(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes in pieces."""
        while n:
            if self._at == len(self._buffer) and not self._more():
                raise ValueError("the archive ends within a record")
            part = self._buffer[self._at:self._at + n]
            self._at += len(part)
            n -= len(part)
            yield part


def normalise(read: Callable[[int], bytes], write: Callable[[bytes], object]) -> Iterator[dict]:
    """Rewrite a gzip stream with one member a record; yields an index entry for each record."""
    source, at = Inflated(read), 0
    while (head := source.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        h = headers(head[:-4])
        z, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
        for piece in chain([head], source.pieces(int(h["content-length"]) + 4)):
            size += len(b := z.compress(piece))
            write(b)
        size += len(b := z.flush())
        write(b)
        yield {"offset": at, "length": size, "id": h.get("warc-record-id"), "type": h.get("warc-type"),
               "uri": h.get("warc-target-uri"), "digest": h.get("warc-payload-digest")}
        at += size


# --- the job ---------------------------------------------------------------------

def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, n, digest, refers_to): which page's payload each record refers to.

    Of pages with equal payloads of at least ``revisit_bytes`` bytes that with
    the largest id is written in full (each row of it, if the id repeats); a
    page without id is always written in full.  A null html is empty.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("n"),
                        F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    big = rows.where((F.col("n") >= revisit_bytes) & F.col("page_id").isNotNull())
    tops = (big.groupBy("digest").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").select("digest", "top"))
    again = (F.col("n") >= revisit_bytes) & (F.col("page_id") < F.col("top"))
    return rows.join(tops, "digest", "left").select(
        "page_id", "url", "html", "n", "digest", F.when(again, F.col("top")).alias("refers_to"))


def write_monolithic(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records as archives of one gzip stream each; returns the landed list of (file)."""
    ship_package(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out, done, size = None, [], 0

        def end():
            nonlocal out
            out[0].close()
            out[1].close()
            done.append(out[2])
            out = None

        for b in batches:
            cols = [b.column(c) for c in ("page_id", "url", "html", "digest", "refers_to", "n")]
            for i in range(b.num_rows):
                page_id, url, html, digest, refers_to, n = (c[i].as_py() for c in cols)
                if out is None:
                    name = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    raw = fs.open_output_stream(name, compression=None)
                    out, size = (gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1, mtime=0), raw, name), 0
                rec = record(page_id, url, html.encode("utf-8"), digest, refers_to, n)
                out[0].write(rec)
                size += len(rec)
                if size >= archive_bytes:
                    end()
        if out is not None:
            end()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["file"])

    return landed(records.mapInArrow(run, "file string"), "warc-files")


def normalise_archives(files: DataFrame, folder: str) -> DataFrame:
    """Normalise each listed archive into ``folder`` with a sidecar index; returns the landed list of new files."""
    ship_package(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        for b in batches:
            done = []
            for f in b.column("file"):
                name = f"{root}/{uuid.uuid4().hex}.warc.gz"
                with fs.open_input_stream(f.as_py(), compression=None) as src, \
                        fs.open_output_stream(name, compression=None) as out, \
                        fs.open_output_stream(f"{name}.idx", compression=None) as idx:
                    for entry in normalise(src.read, out.write):
                        idx.write(json.dumps(entry).encode() + b"\n")
                done.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["file"])

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return landed(files.repartition(n, "file").mapInArrow(run, "file string"), "warc-files")


def index_entries(files: DataFrame, folder: str) -> DataFrame:
    """(file, offset, length) of every record, from the sidecar indexes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        for b in batches:
            for f in b.column("file").to_pylist():
                with fs.open_input_stream(f"{f}.idx", compression=None) as src:
                    lines = [json.loads(x) for x in src.read().splitlines()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f] * len(lines), pa.string()), pa.array([x["offset"] for x in lines], pa.int64()),
                     pa.array([x["length"] for x in lines], pa.int64())], names=["file", "offset", "length"])

    return files.mapInArrow(run, "file string, offset long, length long")


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(entries: DataFrame, folder: str) -> DataFrame:
    """One row per index entry, from the member it points to; a response's digest is computed from what was read."""
    def page(name: str | None) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
        return int(m[1]) if m else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        for b in batches:
            rows, name, src = [], None, None
            for f, at, n in sorted(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)):
                if f != name:
                    if src is not None:
                        src.close()
                    name, src = f, fs.open_input_file(f)
                src.seek(at)
                head, _, block = zlib.decompress(src.read(n), 31).partition(b"\r\n\r\n")
                h = headers(head)
                http, _, payload = block[:int(h["content-length"])].partition(b"\r\n\r\n")
                full = h["warc-type"] == "response"
                digest = hashlib.sha1(payload).hexdigest()
                if full and h["warc-payload-digest"] != f"sha1:{digest}":
                    raise ValueError(f"{f} at {at}: the payload does not have its record's digest")
                rows.append((page(h.get("warc-record-id")), int(headers(http)["content-length"]),
                             digest if full else h["warc-payload-digest"].removeprefix("sha1:"),
                             h["warc-type"], page(h.get("warc-refers-to"))))
            if src is not None:
                src.close()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return entries.mapInArrow(run, _READ)


def round_trip(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages written to monolithic archives, normalised, and read back over the sidecar index, one row per page."""
    spark = pages.sparkSession
    ship_package(spark)
    raw, members = shared_dir(spark, "warc-raw"), shared_dir(spark, "warc")
    files = normalise_archives(write_monolithic(plan_records(pages, revisit_bytes), raw), members)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = index_entries(files, members)
    spread = entries.repartition(n, "file", F.floor(F.col("offset") / (4 << 20)))
    return read_records(spread, members)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


ORACLE = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
t AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM p LEFT JOIN t USING (payload_digest)
"""
