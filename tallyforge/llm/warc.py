"""Web archives: a deterministic sharded writer and its reader."""

from __future__ import annotations

import gzip
import hashlib
import io
import posixpath
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import settle, slices
from tallyforge.session import shared_dir

# The archive format's version line and its profile for revisits.
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, part int, records long, bytes long, sha256 string, first_page long, last_page long"
FOUND = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, file string, position long"
)


def place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:"):
            return pyarrow.fs.LocalFileSystem(), urllib.parse.urlparse(uri).path
        return pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.fs.LocalFileSystem(), uri


def _number(value) -> str:
    return "" if value is None else str(value)


def _identity(page_id, digest: str, repeat: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{_number(page_id)} {digest} {repeat}')}>"


def record(page_id, url: str | None, payload: bytes, repeat: int, revisits: bool, refers_to, date: str) -> bytes:
    """One record, headers and block, uncompressed. ``repeat`` counts rows of the same id and payload.
    Everything follows from the arguments, so a task that runs twice writes the same bytes."""
    digest = hashlib.sha1(payload).hexdigest()
    headers = {
        "WARC-Type": "revisit" if revisits else "response",
        "WARC-Record-ID": _identity(page_id, digest, repeat),
        "WARC-Date": date,
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "urn:none",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Identified-Payload-Type": "text/html",
    }
    if revisits:
        headers["WARC-Profile"] = SAME_PAYLOAD
        headers["WARC-Refers-To"] = _identity(refers_to, digest, 0)
        headers["X-Refers-To-Page"] = _number(refers_to)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisits else head + payload
    headers |= {
        "X-Page": _number(page_id),
        "WARC-Block-Digest": f"sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode()
    return VERSION + lines + b"\r\n" + block + b"\r\n\r\n"


class Roller:
    """Writes records of one part to archives of at most about ``limit`` compressed bytes.

    An archive is written under a temporary name of its attempt and renamed when it is complete. The
    final name follows from the part and a running number, and the bytes from the rows, so attempts that
    race rename equal files.
    """

    def __init__(self, folder: str, part: int, limit: int):
        self.files, self.folder = place(folder)
        self.part, self.limit, self.number, self.done = part, limit, 0, []
        self._open = None

    def add(self, page_id, data: bytes) -> None:
        squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)  # one member a record, no name or time in it
        member = squeeze.compress(data) + squeeze.flush()
        if self._open is not None and self._size + len(member) > self.limit:
            self.close()
        if self._open is None:
            self._name = f"part-{self.part:06d}-{self.number:05d}.warc.gz"
            self._temporary = posixpath.join(self.folder, "_temporary", f"{self._name}.{uuid.uuid4().hex}")
            self.files.create_dir(posixpath.dirname(self._temporary), recursive=True)
            self._open = self.files.open_output_stream(self._temporary, compression=None)
            self._size, self._records, self._sha, self._first, self._last = 0, 0, hashlib.sha256(), page_id, page_id
        self._open.write(member)
        self._sha.update(member)
        self._size, self._records, self._last = self._size + len(member), self._records + 1, page_id

    def close(self) -> None:
        if self._open is None:
            return
        self._open.close()
        self.files.move(self._temporary, posixpath.join(self.folder, self._name))
        self.done.append((self._name, self.part, self._records, self._size, self._sha.hexdigest(), self._first, self._last))
        self._open, self.number = None, self.number + 1


def write(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_revisit: int = 1000, part_bytes: int = 32 << 20, file_bytes: int = 64 << 20, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write ``pages`` as archives under ``folder`` and return their manifest (also stored there).

    Rows are sorted by page id over range partitions; each part rolls its files by compressed size. Of
    rows with equal payloads of at least ``least_revisit`` bytes the one with the largest page id becomes
    a response and the others revisit it; all other rows are responses. Who revisits whom is found on
    digests alone, with a partially aggregated maximum. Those findings then travel through the same sort
    as the pages, each right before its page, so a page's text is shuffled once.

    A null payload is empty. Null page ids sort first and are never the largest; of repeated rows with
    the largest page id the first is the response and the others revisit it. An empty table writes no
    archive and an empty manifest. Other columns are left out, whatever their names.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("sha1"), F.col(url_col).alias("url"), payload.alias("payload"))
    hashed = settle(rows.select("page_id", "sha1", F.octet_length("payload").alias("size")), "warc-digests")
    long_ = hashed.where(F.col("size") >= least_revisit)
    most = long_.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("sha1", "refers_to")
    revisits = long_.join(most, "sha1").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "sha1", "refers_to").distinct()
    # A record's headers count as a kilobyte.
    parts = slices(hashed.agg(F.sum(F.col("size") + 1000)).first()[0] or 0, part_bytes)
    none = lambda t: F.lit(None).cast(t)
    order = [F.col("page_id").asc_nulls_first(), F.col("sha1")]
    ready = (
        revisits.select(F.lit(0).alias("is_page"), "page_id", "sha1", "refers_to", none("string").alias("url"), none("binary").alias("payload"))
        .unionByName(rows.select(F.lit(1).alias("is_page"), "page_id", "sha1", none("long").alias("refers_to"), "url", "payload"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order, "is_page", "url")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        roller = Roller(folder, TaskContext.get().partitionId(), file_bytes)
        last, repeat, target, revisit = None, 0, None, None
        for batch in batches:
            page_ids, sha1s, refers, urls, flags = (
                batch.column(c).to_pylist() for c in ("page_id", "sha1", "refers_to", "url", "is_page")
            )
            for page_id, sha1, refers_to, url, is_page, body in zip(page_ids, sha1s, refers, urls, flags, batch.column("payload")):
                if not is_page:
                    revisit, target = (page_id, sha1), refers_to
                    continue
                raw = body.as_py()
                repeat = repeat + 1 if last == (page_id, sha1) else 0
                last = (page_id, sha1)
                if revisit == last:
                    roller.add(page_id, record(page_id, url, raw, repeat, True, target, date))
                else:
                    again = repeat > 0 and len(raw) >= least_revisit
                    roller.add(page_id, record(page_id, url, raw, repeat, again, page_id if again else None, date))
        roller.close()
        if roller.done:
            names = [f.split()[0] for f in MANIFEST.split(", ")]
            types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*roller.done), types)], names=names)

    manifest = ready.mapInArrow(run, MANIFEST)
    manifest.write.parquet(f"{folder}/_manifest")  # its commit is the archive's: files it does not name don't count
    return pages.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/_manifest")


def records_of(source) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, headers, block) of each record of an archive, read as a stream: memory holds one record."""
    reader = io.BufferedReader(gzip.GzipFile(fileobj=source), 1 << 20)
    number = 0
    while line := reader.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"record {number} does not begin with a version line")
        headers = {}
        while (line := reader.readline()) not in (b"\r\n", b"\n", b""):
            key, _, value = line.decode("utf-8").partition(":")
            headers[key.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = reader.read(size)
        if len(block) != size:
            raise ValueError(f"record {number} is cut short")
        yield number, headers, block
        number += 1


def parse(headers: dict[str, str], block: bytes) -> dict:
    """What a record says of its page; digests are computed again and must agree."""
    if headers["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ValueError(f"block digest of {headers['warc-record-id']} differs")
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    size = next(int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if k.lower() == b"content-length")
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} differs from its digest")
    whole = lambda key: int(headers[key]) if headers.get(key) else None
    return {
        "page_id": whole("x-page"), "url": None if headers["warc-target-uri"] == "urn:none" else headers["warc-target-uri"],
        "payload_bytes": size, "payload_digest": digest, "record_type": headers["warc-type"],
        "refers_to": whole("x-refers-to-page") if revisit else None,
    }


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of all archives that ``manifest`` names: one row each, every digest verified."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()),
        ("position", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = place(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out = []
                with files.open_input_stream(posixpath.join(path, name), compression=None) as source:
                    for position, headers, block in records_of(source):
                        out.append(parse(headers, block) | {"file": name, "position": position})
                        if len(out) == 5000:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    n = manifest.count()
    return manifest.select("file").repartition(max(1, n), "file").mapInArrow(run, FOUND)


def archive(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` and read the archives back: one row a page."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    return read(write(pages, folder, **options), folder)
