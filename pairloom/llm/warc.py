"""WARC archives: one gzip member per record, written to the shared folder and read back in sequence.

The writer gives each page a record: `response` with its payload, or `revisit` for a payload of at least MIN_REVISIT
bytes that a page with a larger id has too (equal SHA-1 and length), which then holds headers only and names that page's
record. The reader goes through an archive once, front to back: it inflates in small steps, so a record of any size needs
no more memory than its own payload, frames the block by Content-Length and verifies the block and payload digests.

A task writes its archives under names of its own attempt and reports them, so a lost or repeated task leaves no record
that is read twice. Files are opened through pyarrow's file systems in the folder of spark.checkpoint.dir.

Nulls: a null html is an empty payload, a null url an empty target; a null page_id is kept as null and is no one's
original. Rows that repeat the largest page_id of a payload are all responses. Empty tables give no records; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import materialize, new_dir

MIN_REVISIT = 1000
#: An archive is closed after so many bytes of blocks.
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 16
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    text = record_id.rpartition(":")[2].rstrip(">")
    return None if text == "none" else int(text)


def _clean(value: str) -> str:
    return "".join(f"%{b:02X}" if b < 33 or b == 127 else chr(b) for b in value.encode()).encode("latin-1").decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A whole WARC record, before compression."""
    sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", _clean(url or "")), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha}"), ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"), ("Content-Length", str(len(block)))]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("latin-1") + block + b"\r\n\r\n"


def gzip_member(raw: bytes) -> bytes:
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(raw) + press.flush()


class Reader:
    """Records of an archive in sequence, from any object with read(n)."""

    def __init__(self, stream: Any) -> None:
        self.stream, self.raw, self.ended = stream, b"", False
        self.inflate = zlib.decompressobj(31)
        self.text = bytearray()

    def _fill(self) -> bool:
        if not self.raw and not self.ended:
            self.raw = self.stream.read(STEP)
            self.ended = not self.raw
        return bool(self.raw)

    def _more(self) -> bool:
        """Inflates one more step of the present member; False at its end."""
        if self.inflate.eof:
            return False
        self._fill()
        part = self.inflate.decompress(self.raw, STEP)
        if not part and self.ended and not self.inflate.eof:
            raise ValueError("the archive ends inside a record")
        self.text += part
        self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def _next_member(self) -> bool:
        self.inflate, self.text = zlib.decompressobj(31), bytearray()
        return self._fill()

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while self._next_member():
            at = -1
            while (at := self.text.find(b"\r\n\r\n", max(0, at))) < 0:
                if not self._more():
                    raise ValueError("a record has no end of its header")
            version, *lines = bytes(self.text[:at]).decode("latin-1").split("\r\n")
            if not version.startswith("WARC/1."):
                raise ValueError(f"no WARC record: {version[:40]!r}")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
            begin, size = at + 4, int(fields["Content-Length"])
            while len(self.text) < begin + size + 4 and self._more():
                pass
            block, close = bytes(self.text[begin : begin + size]), bytes(self.text[begin + size : begin + size + 4])
            while self._more():
                pass
            if len(block) != size or close != b"\r\n\r\n" or len(self.text) != begin + size + 4:
                raise ValueError("Content-Length doesn't frame the record")
            _verify(fields["WARC-Block-Digest"], block, "block")
            yield fields, block


def _verify(digest: str, content: bytes, what: str) -> None:
    if digest != f"sha1:{base64.b32encode(hashlib.sha1(content).digest()).decode()}":
        raise ValueError(f"the {what} digest doesn't match")


def parse_record(fields: dict[str, str], block: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest (hex), record_type, refers_to, payload (null for a revisit)."""
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind = fields["WARC-Type"]
    if kind == "response":
        _verify(fields["WARC-Payload-Digest"], payload, "payload")
        if len(payload) != int(sizes[0]):
            raise ValueError("the payload is cut off")
    sha = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    refers = _page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
    return _page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(sizes[0]), sha, kind, refers, payload if kind == "response" else None


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to names the page whose record a revisit repeats."""
    html = F.coalesce("html", F.lit(""))
    own = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"))
    keyed = own.where(F.octet_length("html") >= MIN_REVISIT).select("page_id", F.sha1("html").alias("sha"), F.octet_length("html").alias("size"))
    several = keyed.groupBy("sha", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").select("sha", "size", "last")
    several = materialize(several, "originals")
    again = materialize(keyed.join(several, ["sha", "size"]).where("page_id < last or page_id is null").select("page_id", F.col("last").alias("refers_to"), "sha").distinct(), "revisits")
    if again.isEmpty():
        return own.withColumn("refers_to", F.lit(None).cast("long"))
    joined = own.alias("o").join(again.alias("a"), F.col("o.page_id").eqNullSafe(F.col("a.page_id")) & (F.sha1("o.html") == F.col("a.sha")) & (F.octet_length("o.html") >= MIN_REVISIT), "left")
    return joined.select("o.page_id", "o.url", "o.html", "a.refers_to")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes (page_id, url, html, refers_to) as archives in the folder; returns their paths and numbers of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, store = TaskContext.get(), fs.FileSystem.from_uri(folder)
        made, out, n, size = [], None, 0, 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if out is None:
                    name = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(made):03d}.warc.gz"
                    store[0].create_dir(store[1], recursive=True)
                    out = store[0].open_output_stream(f"{store[1]}/{name.rpartition('/')[2]}", compression=None)
                    n = size = 0
                raw = record(page_id, url, html.encode(), refers_to)
                out.write(gzip_member(raw))
                n, size = n + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    made.append((name, n))
                    out = None
        if out is not None:
            out.close()
            made.append((name, n))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in made]), pa.array([x[1] for x in made], pa.int64())], names=["path", "records"])

    return records.mapInArrow(run, "path string, records long")


def read_archives(paths: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives (path, records), an archive to a task at a time; their number is verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, at = fs.FileSystem.from_uri(path)
                seen, rows, size = 0, [], 0
                with store.open_input_stream(at, compression=None, buffer_size=STEP) as stream:
                    for fields, block in Reader(stream):
                        row = parse_record(fields, block)
                        rows.append(row if payloads else row[:-1])
                        seen, size = seen + 1, size + len(block)
                        if len(rows) >= 2000 or payloads and size >= 16 << 20:
                            yield _rows(rows, payloads)
                            rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{path} has {seen} records, {records} were written")
                if rows:
                    yield _rows(rows, payloads)

    return paths.mapInArrow(run, _READ if payloads else _READ.rpartition(", ")[0])


def _rows(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads
    names = [x.split()[0] for x in _READ.split(", ")][: len(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes every page as a record, reads the archives back, and returns what they hold, payloads aside."""
    folder = new_dir(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    paths = materialize(write_archives(plan_records(pages), folder), "archives")
    spread = paths.repartition(max(1, min(paths.count(), 10_000)), "path")
    return read_archives(spread, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
