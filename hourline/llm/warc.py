"""WARC archives of pages, through a table of record chunks."""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import query, stored, table
from hourline.llm.exact_dedup import grouped
from hourline.session import scratch_path

CHUNK = 1 << 20
FLUSH = 8 << 20
DATE = "2024-01-31T00:00:00Z"
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "page_id {kind}, url string, record_type string, refers_to {kind}, payload_bytes long, chunk long, crc long, sha1 string, last boolean, data binary"


def decisions(pages: DataFrame, least: int, key: str, text: str) -> DataFrame:
    """(page_id, digest, record_type, refers_to): of equal payloads of at least `least` bytes the smallest id is the
    response and the others revisit it. Smaller payloads are all responses."""
    payload = F.coalesce(F.col(text), F.lit(""))
    rows, _ = stored(pages.select(
        F.col(key).alias("page_id"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("n")), "payloads")
    first = rows.groupBy("digest").agg(F.min("page_id").alias("keep_id"))
    marked = grouped(rows, first)
    again = (F.col("n") >= least) & ~F.col("page_id").eqNullSafe(F.col("keep_id")) & F.col("keep_id").isNotNull()
    return marked.select(
        "page_id", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("keep_id")).alias("refers_to"),
    ).distinct()


def chunk_table(pages: DataFrame, least: int = 0, key: str = "page_id", url: str = "url", text: str = "html", size: int = CHUNK) -> DataFrame:
    """The records as rows (page_id, chunk number): at most `size` bytes of payload each, with the payload's length, the
    CRC-32 of all bytes so far and the payload's SHA-1, which the record's header needs first. A revisit is one row without data. The rows of a record
    follow one another; no row or batch holds a long payload as a whole. NULL payloads are empty.
    """
    chosen = decisions(pages, least, key, text).withColumn("__id", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"digest": F.sha1(F.col("text").cast("binary")), "__id": F.coalesce(F.col("page_id").cast("string"), F.lit(""))})
    joined = rows.join(chosen.drop("page_id"), ["__id", "digest"]).select("page_id", "url", "record_type", "refers_to", "text")
    kind = dict(joined.dtypes)["page_id"]

    def run(batches):
        for batch in batches:
            ids, refers = batch.column(0).type, batch.column(3).type
            kinds = [ids, pa.string(), pa.string(), refers, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
            out, held = [], 0

            def packed(rows, kinds=kinds, names=("page_id", "url", "record_type", "refers_to", "payload_bytes", "chunk", "crc", "sha1", "last", "data")):
                columns = zip(*rows, strict=True) if rows else [[]] * len(names)
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

            for page, link, type_, refers_to, text in zip(*batch.columns, strict=True):
                payload = memoryview(text.as_buffer())  # a view of the batch, no copy
                head = (page.as_py(), link.as_py(), type_.as_py(), refers_to.as_py(), len(payload))
                sha, crc = hashlib.sha1(), 0
                for at in range(0, len(payload), size):
                    sha.update(payload[at : at + size])
                digest = base64.b32encode(sha.digest()).decode()
                for n, at in enumerate(range(0, max(len(payload), 1), size)):
                    part = payload[at : at + size]
                    crc = zlib.crc32(part, crc)
                    last = at + size >= len(payload)
                    if head[2] == "revisit" and not last:
                        continue
                    data = b"" if head[2] == "revisit" else bytes(part)
                    out.append((*head, 0 if head[2] == "revisit" else n, crc, digest, last, data))
                    held += len(data)
                    if held >= FLUSH:
                        yield packed(out)
                        out, held = [], 0
            yield packed(out)

    return joined.mapInArrow(run, SCHEMA.format(kind=kind))


def _name(page) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _header(page, url, type_, refers_to, length, digest) -> tuple[bytes, bytes]:
    """The record's header and the start of its block, the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {type_}", f"WARC-Record-ID: {_name(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if type_ == "revisit":
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (length if type_ == 'response' else 0)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass"), http


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Writes one gzip archive per task, one member per record, streaming chunk by chunk; a row (path, records,
    bytes) for each. The CRC-32 carried by each chunk is checked against the bytes that are written.

    Names hold the task attempt: what a lost executor leaves behind is in no returned row. Files go through the
    file system of the folder's URI, which all executors share.
    """
    def run(batches):
        files, at = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        path = f"{at}/part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        out, records, member, unfinished, crc = None, 0, None, False, 0
        for batch in batches:
            for page, url, type_, refers_to, length, _, carried, sha1, last, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    files.create_dir(at, recursive=True)
                    out = files.open_output_stream(path, compression=None)
                if not unfinished:
                    crc, member = 0, zlib.compressobj(1, zlib.DEFLATED, 31)
                    for part in _header(page, url, type_, refers_to, length, sha1):
                        out.write(member.compress(part))
                crc = zlib.crc32(data, crc)
                if type_ == "response" and crc != carried:
                    raise ValueError(f"{path}: a chunk of {_name(page)} is missing or damaged")
                out.write(member.compress(data))
                unfinished = not last
                if last:
                    out.write(member.compress(b"\r\n\r\n"))
                    out.write(member.flush())
                    records += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

    return chunks.mapInArrow(run, "path string, records long, bytes long")


class _Reader:
    """Lines and byte runs of an archive, inflated as they are asked for."""

    def __init__(self, stream) -> None:
        self.stream, self.raw, self.member, self.text = stream, b"", zlib.decompressobj(31), bytearray()

    def fill(self) -> bool:
        if self.member.eof:
            self.raw, self.member = self.member.unused_data, zlib.decompressobj(31)
        if self.member.unconsumed_tail:
            self.raw = self.member.unconsumed_tail
        elif not self.raw:
            self.raw = self.stream.read(CHUNK)
        if not self.raw:
            return False
        self.text += self.member.decompress(self.raw, CHUNK)
        self.raw = b""
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (at := self.text.find(mark, start)) < 0:
            start = max(0, len(self.text) - len(mark))
            if not self.fill():
                return None
        out = bytes(self.text[:at])
        del self.text[: at + len(mark)]
        return out

    def run(self, length: int):
        while length > 0:
            if not self.text and not self.fill():
                raise ValueError("the archive ends inside a record")
            part = bytes(self.text[:length])
            del self.text[:length]
            length -= len(part)
            yield part


def read_archives(paths: DataFrame, folder: str, kind: str = "bigint") -> DataFrame:
    """One row per record of the archives in `paths` (path): page_id, url, record_type, refers_to, payload_bytes, payload_digest.

    Each task streams its archives; payloads are digested run by run, never held. A response whose bytes do not give
    the digest or length in its header raises an error.
    """
    cast = int if kind in ("bigint", "int") else str

    def ident(value):
        value = value.removeprefix("<urn:x-page:").removesuffix(">") if value else ""
        return cast(value) if value else None

    def run(batches):
        files, _ = fs.FileSystem.from_uri(folder)
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
        key = pa.int64() if cast is int else pa.string()
        kinds = [key, pa.string(), pa.string(), key, pa.int64(), pa.string()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with files.open_input_stream(path, compression=None) as stream:
                    reader = _Reader(stream)
                    while (head := reader.until(b"\r\n\r\n")) is not None:
                        fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
                        http = reader.until(b"\r\n\r\n")
                        length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
                        sha, size = hashlib.sha1(), int(fields["Content-Length"]) - len(http) - 4
                        for part in reader.run(size):
                            sha.update(part)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if fields["WARC-Type"] == "response" and (size != length or base64.b32encode(sha.digest()).decode() != digest):
                            raise ValueError(f"{path}: {fields['WARC-Record-ID']} is damaged")
                        b"".join(reader.run(4))
                        rows.append((ident(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"],
                                     ident(fields.get("WARC-Refers-To")), length, digest))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    name = "bigint" if cast is int else "string"
    return paths.select("path").mapInArrow(
        run, f"page_id {name}, url string, record_type string, refers_to {name}, payload_bytes long, payload_digest string")


def archive(pages: DataFrame, folder: str, least: int = 0, **options) -> tuple[DataFrame, DataFrame]:
    """Writes the archives of `pages` to `folder`; the list of files and the records read back from them.

    One record per row of `pages`, repeated rows included; a NULL id is written without a number and read as NULL; an
    empty table writes nothing. Other columns are not stored.
    """
    chunks = chunk_table(pages, least, **options)
    files, _ = stored(write_archives(chunks, folder), "archives")
    kind = dict(chunks.dtypes)["page_id"]
    count = max(1, files.count())
    return files, read_archives(files.repartition(count, "path"), folder, kind)


@query("op8_warc", """
  WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
  bits AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id,
    list_reduce(list_prepend('', [lpad(bin(CAST('0x' || d[i * 2 - 1] || d[i * 2] AS INTEGER)), 8, '0') FOR i IN range(1, 21)]),
      lambda a, b: a || b) AS b FROM p)
  SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
    list_reduce(list_prepend('', ['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_reduce(list_prepend(0,
      [CAST(c AS INTEGER) FOR c IN string_split(b[j * 5 + 1:j * 5 + 5], '')]), lambda x, y: x * 2 + y)] FOR j IN range(0, 32)]),
      lambda a, b: a || b) AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
  FROM bits""")
def op8(spark, sf_dir):
    _, records = archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
