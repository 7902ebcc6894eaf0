"""WARC archives: written with one gzip member per record, read back sequentially.

Pages with equal payloads of at least ``REVISIT_BYTES`` bytes are stored once: the page with the largest id is the
response, the others are revisits that refer to it. The writer's tasks each fill archives of about ``ARCHIVE_BYTES``
bytes. An archive is the binary value of one row of a Parquet table in the shared folder, because every executor can
read that folder through Spark only; the bytes are those of a ``.warc.gz`` file. The reader takes an archive in chunks,
decompresses one member after the other, frames the record by its Content-Length, and verifies its digests.

A null payload counts as empty. A null id is smaller than all others, is written as an empty id and read back as null.
Rows that repeat an id and a payload are written one by one and have the same record type. A null URL writes no target
URI. A truncated member, a wrong length or a wrong digest raises ``WarcError``. Only the named columns are read. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.shared import shared_folder, written

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 4 << 20
CHUNK_BYTES = 64 << 10

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


class WarcError(ValueError):
    """An archive that is not what its framing or its digests say."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in lines) + "\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + _END) + packer.flush()


def page_member(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit with the HTTP head only if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", _urn(page_id))]
    headers += [("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        headers += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", _PROFILE)]
        payload = b""
    return member(headers, http.encode() + payload)


def _urn(page_id: str | None) -> str:
    return f"<urn:page:{quote(page_id or '', safe='')}>"


def _page_id(urn: str) -> str | None:
    return unquote(urn.removeprefix("<urn:page:").removesuffix(">")) or None


def _parsed(head: bytes) -> dict[str, str]:
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise WarcError(f"not a record: {first[:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


class _Framer:
    """Collects the bytes of one member: head, block of the stated length, end mark."""

    def __init__(self):
        self._data, self._headers, self._length = bytearray(), None, 0

    def add(self, data: bytes) -> None:
        self._data += data
        if self._headers is None:
            end = self._data.find(_END, max(0, len(self._data) - len(data) - 3))
            if end < 0:
                return
            self._headers = _parsed(bytes(self._data[:end]))
            del self._data[: end + len(_END)]
            try:
                self._length = int(self._headers["content-length"])
            except (KeyError, ValueError) as error:
                raise WarcError("a record without a length") from error
        if len(self._data) > self._length + len(_END):
            raise WarcError("a record is longer than its length says")

    def record(self) -> Record:
        if self._headers is None or self._data[self._length :] != _END:
            raise WarcError("a record is shorter than its length says")
        return Record(self._headers, bytes(self._data[: self._length]))


def read_records(chunks: Iterable[bytes]) -> Iterator[Record]:
    """Records of one archive, given in chunks of any size; at most one record is held."""
    unpacker, framer, begun = zlib.decompressobj(31), _Framer(), False
    for chunk in chunks:
        while chunk:
            begun = True
            try:
                framer.add(unpacker.decompress(chunk))
            except zlib.error as error:
                raise WarcError("not a gzip member") from error
            chunk = b""
            if unpacker.eof:
                yield _verified(framer.record(), "warc-block-digest", None)
                chunk = unpacker.unused_data
                unpacker, framer, begun = zlib.decompressobj(31), _Framer(), False
    if begun:
        raise WarcError("the last member is cut off")


def _verified(record: Record, header: str, content: bytes | None) -> Record:
    """``record`` if the digest in ``header`` is that of ``content`` (the block by default) or is not stated."""
    stated = record.headers.get(header)
    content = record.block if content is None else content
    if stated and stated.startswith("sha1:") and stated[5:] != hashlib.sha1(content).hexdigest():
        raise WarcError(f"{header} of {record.headers.get('warc-record-id')} does not hold")
    return record


def page_of(record: Record) -> tuple:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of a response or revisit."""
    head, mark, payload = record.block.partition(_END)
    kind = record.headers.get("warc-type")
    if not mark or kind not in ("response", "revisit"):
        raise WarcError(f"no HTTP response in a record of type {kind}")
    if kind == "response":
        _verified(record, "warc-payload-digest", payload)
    fields = dict(line.lower().split(b":", 1) for line in head.split(b"\r\n")[1:])
    size = int(fields[b"content-length"])
    if kind == "response" and size != len(payload):
        raise WarcError("the payload is not as long as its HTTP head says")
    refers_to = record.headers.get("warc-refers-to")
    return (
        _page_id(record.headers["warc-record-id"]),
        record.headers.get("warc-target-uri"),
        payload if kind == "response" else None,
        size,
        record.headers["warc-payload-digest"].removeprefix("sha1:"),
        kind,
        _page_id(refers_to) if refers_to else None,
    )


_ROW = pa.schema(
    [("page_id", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
)


def _archived(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of about ARCHIVE_BYTES made of the task's rows."""
    members, size, number, task = [], 0, 0, TaskContext.get().partitionId()

    def archive() -> pa.RecordBatch:
        name = f"pages-{task:06d}-{number:05d}.warc.gz"
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(members)])], ["archive", "content"])

    for batch in batches:
        columns = [batch.column(name) for name in ("page_id", "url", "payload", "digest", "refers_to")]
        for row in zip(*columns, strict=True):
            page_id, url, payload, digest, refers_to = (value.as_py() for value in row)
            members.append(page_member(page_id, url, payload.encode(), digest, refers_to))
            size += len(members[-1])
            if size >= ARCHIVE_BYTES:
                yield archive()
                members, size, number = [], 0, number + 1
    if members:
        yield archive()


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            data = content.as_buffer()
            chunks = (bytes(data[at : at + CHUNK_BYTES]) for at in range(0, data.size, CHUNK_BYTES))
            rows = [page_of(record) for record in read_records(chunks)]
            if rows:
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), _ROW.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ROW)


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest, refers_to of the rows that repeat a payload. Only ids and digests are dealt out."""
    rows = pages.where(F.octet_length("payload") >= REVISIT_BYTES).select("page_id", "digest")
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("refers_to"))
    groups = written(groups.where("n > 1").drop("n"), "equal-payloads")
    others = rows.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return others.distinct()


def write_archives(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> str:
    """Write one record per row; the folder of the archive table in the shared folder."""
    payload = F.coalesce(payload_column, F.lit(""))
    pages = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    repeats = revisits(pages).select(F.col("page_id").alias("id"), F.col("digest").alias("same"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("same"))
    rows = pages.join(repeats, same, "left").select(
        F.col("page_id").cast("string"), "url", "payload", "digest", F.col("refers_to").cast("string")
    )
    folder = f"{shared_folder(pages.sparkSession)}/llm-warc-{uuid.uuid4().hex}"
    archives = rows.mapInArrow(_archived, "archive string, content binary")
    archives.write.option("compression", "none").parquet(folder)
    return folder


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of every record; ids as text."""
    kinds = "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string"
    archives = spark.read.schema("archive string, content binary").parquet(folder)
    return archives.select("content").mapInArrow(_read, f"{kinds}, refers_to string")
