"""WARC archives of web pages, written and read as a stream of chunks.

**Writing.** Each task appends gzip members, one per record, to a file of its own in a shared folder;
the payload goes through the compressor piece by piece. Of records with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest page_id is the response, the others are revisits that
name it and carry no payload. A repeated task writes another file; only files that the saved list of
archives names are read.

**Reading.** :func:`chunks` turns archives into rows of record identifier and chunk number. Each row
carries the bytes of one chunk, the bytes so far and the SHA-256 so far, so the last row of a record
has the digest of its whole payload and no task ever holds more than a chunk of a record.

Defined results: null html is the empty payload, null urls leave the header out. Pages without id are
never referred to and become revisits if a page with an id has their payload. Pages that share the
smallest id of a payload are all responses. Empty tables give empty archives; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import saved, shared_folder

#: Payloads shorter than this are always stored.
MIN_REVISIT = 100
_ID = "urn:x-page:"
_PIECE, _BATCH = 1 << 18, 1 << 22
_FILES = "path string, bytes bigint, records bigint"
_CHUNKS = (
    "record_id string, chunk int, last boolean, record_type string, refers_to string, declared_digest string,"
    " declared_bytes bigint, bytes_so_far bigint, digest_so_far string, data binary"
)


def with_digests(pages: DataFrame) -> DataFrame:
    """page_id, url, html (never null), payload_bytes, payload_digest, first (the response's id, if
    this page is a revisit)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("bigint"), "payload_digest": F.sha2("html", 256)})
    long = rows.where(F.col("payload_bytes") >= MIN_REVISIT)
    repeated = (
        long.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1 and first is not null").select("payload_digest", "first")
    )
    joined = rows.join(repeated, "payload_digest", "left")
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("first", F.when(other, F.col("first")))


def _header(values: list[tuple[str, object]]) -> bytes:
    lines = [f"{k}: {str(v).replace(chr(13), '%0D').replace(chr(10), '%0A')}" for k, v in values if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode()


def record(page_id: int | None, url: str | None, html: str, size: int, digest: str, first: int | None,
           date: str) -> Iterator[bytes]:
    """Pieces of one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = first is not None
    head = _header([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", f"<{_ID}{first}>" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(http) + (0 if revisit else size)),
    ])
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    yield packer.compress(head + http)
    if not revisit:
        for at in range(0, len(html), _PIECE):
            yield packer.compress(html[at : at + _PIECE].encode())
    yield packer.compress(b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
                   max_bytes: int = 1 << 30) -> DataFrame:
    """Write records of :func:`with_digests` to ``folder``; the saved list of archives: path, bytes,
    records. A task begins a new file after ``max_bytes``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        files, out = [], None
        for batch in batches:
            for page in range(batch.num_rows):
                if out is None or files[-1][1] >= max_bytes:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    files.append([f"{folder}/{name}", 0, 0])
                for piece in record(*(column[page].as_py() for column in batch.columns), date):
                    out.write(piece)
                    files[-1][1] += len(piece)
                files[-1][2] += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*files)], names=["path", "bytes", "records"])

    rows = pages.select("page_id", "url", "html", "payload_bytes", "payload_digest", "first")
    return saved(rows.mapInArrow(write, _FILES))


class _Source:
    """Decompressed bytes of an archive, read by lines and by pieces."""

    def __init__(self, stream):
        self.stream, self.packed, self.plain = stream, b"", b""
        self.unpacker = zlib.decompressobj(31)

    def _more(self) -> bool:
        """Unpack at most a piece; False at the end of the file."""
        while True:
            if self.unpacker.eof:
                self.packed = self.unpacker.unused_data
                self.unpacker = zlib.decompressobj(31)
            packed = self.packed or self.stream.read(_PIECE)
            if not packed:
                return False
            made = self.unpacker.decompress(packed, _PIECE)
            self.packed = self.unpacker.unconsumed_tail
            if made:
                self.plain += made
                return True

    def head(self) -> dict[str, str] | None:
        """The next header block as lower-case names and values; None at the end."""
        while True:
            self.plain = self.plain.lstrip(b"\r\n")
            end = self.plain.find(b"\r\n\r\n")
            if end >= 0:
                lines = self.plain[:end].decode().split("\r\n")
                self.plain = self.plain[end + 4 :]
                return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            if not self._more():
                return None

    def read(self, size: int) -> bytes:
        while len(self.plain) < size and self._more():
            pass
        part, self.plain = self.plain[:size], self.plain[size:]
        return part


def _bare(value: str | None) -> str | None:
    return None if value is None else value.strip("<>").removeprefix(_ID)


def record_chunks(source: _Source, size: int) -> Iterator[dict]:
    """Chunk rows of all records; a record without payload has one empty chunk."""
    while (head := source.head()) is not None:
        http = source.head()
        stored = 0 if head["warc-type"] == "revisit" else int(http["content-length"])
        digest, done, number = hashlib.sha256(), 0, 0
        while True:
            data = source.read(min(size, stored - done))
            digest.update(data)
            done += len(data)
            last = done >= stored
            if not data and not last:
                raise ValueError(f"record {head['warc-record-id']} ends early")
            yield {
                "record_id": _bare(head["warc-record-id"]), "chunk": number, "last": last,
                "record_type": head["warc-type"], "refers_to": _bare(head.get("warc-refers-to")),
                "declared_digest": head["warc-payload-digest"].removeprefix("sha256:"),
                "declared_bytes": int(http["content-length"]), "bytes_so_far": done,
                "digest_so_far": digest.hexdigest(), "data": data,
            }
            if last:
                break
            number += 1


def chunks(archives: DataFrame, chunk_bytes: int = 1 << 16) -> DataFrame:
    """Rows of record_id and chunk of the archives in column ``path``, with running digests."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_CHUNKS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            store, inner = fs.FileSystem.from_uri(path)
            with store.open_input_stream(inner, compression=None) as stream:
                rows, held = [], 0
                for row in record_chunks(_Source(stream), chunk_bytes):
                    rows.append(row)
                    held += len(row["data"])
                    if held >= _BATCH or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    session = archives.sparkSession
    spread = archives.select("path").repartition(session.sparkContext.defaultParallelism * 4, "path")
    return spread.mapInArrow(read, _CHUNKS)


def payloads(rows: DataFrame) -> DataFrame:
    """One row per record from its last chunk: page_id, payload_bytes, payload_digest, record_type,
    refers_to. A response whose bytes do not have the declared digest raises an error."""
    last = rows.where("last")
    response = F.col("record_type") == "response"
    broken = response & (F.col("digest_so_far") != F.col("declared_digest"))
    digest = F.when(broken, F.raise_error(F.concat(F.lit("broken payload of record "), "record_id")))
    digest = F.coalesce(digest.cast("string"), F.when(response, F.col("digest_so_far")).otherwise(F.col("declared_digest")))
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("bigint")
    return last.select(
        number("record_id").alias("page_id"),
        F.when(response, F.col("bytes_so_far")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"),
    )


def written_and_read(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """The pages' records as they come back from archives in ``folder`` (a new shared one by default)."""
    folder = folder or shared_folder(pages.sparkSession)
    return payloads(chunks(write_archives(with_digests(pages), folder)))


ORACLE = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest having count(*) > 1
)
select page_id, payload_bytes, payload_digest,
  case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from p left join f using (payload_digest)
"""
