"""WARC archives: writing, the normaliser of whole-file gzip streams, and reading through the sidecar index.

A monolithic archive is one gzip stream over all its records, so that no record can be reached alone. The normaliser
inflates such a stream once, in pieces, writes every record as its own gzip member, and writes an index beside it: one line for
each record with offset, length, id and type. Archives live in the shared folder; each file is written under a name of
its attempt and renamed when it is whole, so that a task that is run again does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, stored

PIECE = 1 << 20
LEVEL = 6
#: Packed bytes after which an archive ends and the next begins.
ROLL = 1 << 30
#: When the pages were taken, for tables that don't say.
DATE = "1970-01-01T00:00:00Z"
#: Payloads of so many bytes at least are compared.
LEAST_BYTES = 0
#: A digest's rows are spread over so many groups before they meet their summary.
SALTS = 64


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(first: str, fields: list[tuple[str, str]]) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One response, or one revisit without its payload. A page without url has no such field; one without id has a random one."""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", date)]
    fields.append(("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"))
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    fields.append(("WARC-Payload-Length", str(len(payload))))
    if refers_to is not None:
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    body = payload if refers_to is None else b""
    return _header("WARC/1.1", [*fields, ("Content-Length", str(len(body)))]) + body + b"\r\n\r\n"


def parse(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header, body and all bytes of each record of an inflated stream."""
    held = bytearray()
    ended = False

    def more() -> bool:
        nonlocal ended
        piece = next(pieces, None)
        ended = piece is None
        held.extend(piece or b"")
        return not ended

    while True:
        while (cut := held.find(b"\r\n\r\n")) < 0 and more():
            pass
        if cut < 0:
            if held:
                raise ValueError(f"an archive ends within a header: {bytes(held[:80])!r}")
            return
        head = bytes(held[:cut]).decode().split("\r\n")
        header = dict(line.split(": ", 1) for line in head[1:])
        end = cut + 4 + int(header["Content-Length"])
        while len(held) < end + 4 and more():
            pass
        if len(held) < end + 4:
            raise ValueError("an archive ends within a record")
        yield header, bytes(held[cut + 4 : end]), bytes(held[: end + 4])
        del held[: end + 4]


def inflated(stream: fs.NativeFile | pa.NativeFile) -> Iterator[bytes]:
    """The content of a gzip file of one or many members, in pieces."""
    unzip = zlib.decompressobj(31)
    while piece := stream.read(PIECE):
        while piece:
            out = unzip.decompress(piece, PIECE)
            if out:
                yield out
            piece = unzip.unconsumed_tail
            if unzip.eof:
                piece, unzip = unzip.unused_data, zlib.decompressobj(31)
    if tail := unzip.flush():
        yield tail


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Whole:
    """A file that appears under its name when it is closed."""

    def __init__(self, path: str):
        self.store, self.path = _place(path)
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}"
        self.out, self.size = self.store.open_output_stream(self.part, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.store.move(self.part, self.path)


def classified(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, refers_to (null for a response): the largest page_id of equal payloads is the response.

    A row without page_id revisits it too; if none of equal payloads has one, all are responses.

    The rows of one payload meet in parts, by digest and a salt of the id: a payload that a third of all
    pages have spreads over SALTS groups, and only the digest and id of each part go on.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    parts = rows.filter(F.octet_length("payload") >= least).groupBy("digest", "salt").agg(F.max("page_id").alias("most"))
    whole = parts.groupBy("digest").agg(F.max("most").alias("largest"), F.collect_list("salt").alias("salts"))
    whole = whole.select("digest", "largest", F.explode("salts").alias("salt"))
    joined = rows.join(whole, ["digest", "salt"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_monolithic(rows: DataFrame, folder: str, roll: int = ROLL, date: str = DATE) -> DataFrame:
    """Writes the rows of each partition as archives, each a single gzip stream of about ``roll`` bytes at most: path, n_records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, n, number = TaskContext.get(), None, 0, 0
        # an attempt's archives are its own: only those of the one that ends are listed, and a late one replaces none of them
        task = f"{context.partitionId():06d}-{context.taskAttemptId():08d}"

        def ended() -> pa.RecordBatch:
            out.write(pack.flush())
            out.close()
            return pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])

        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    path, pack = f"{folder}/pages-{task}-{number:06d}.warc.gz", zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    out, n, number = _Whole(path), 0, number + 1
                page_id, url, payload, refers_to = (batch.column(c)[i].as_py() for c in range(4))
                out.write(pack.compress(record(page_id, url, payload, payload_digest(payload), refers_to, date)))
                n += 1
                if out.size >= roll:
                    yield ended()
                    out = None
        if out:
            yield ended()

    return stored(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, "path string, n_records long"), "archives")


def _each_path(archives: DataFrame) -> DataFrame:
    """One archive in each task: ranges of so few names are cut exactly, where a hash would put several into one."""
    n = archives.count()
    return archives.select("path").repartitionByRange(max(n, 1), "path")


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrites every archive record by record with an index beside it: path, index_path, n_records."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                target = path.removesuffix(".warc.gz") + ".members.warc.gz"
                store, name = _place(path)
                out, index, n = _Whole(target), _Whole(target + ".index"), 0
                with store.open_input_stream(name, compression=None) as stream:
                    for header, _, data in parse(inflated(stream)):
                        member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = member.compress(data) + member.flush()
                        line = {"offset": out.size, "length": len(member), "id": header.get("WARC-Record-ID"), "type": header["WARC-Type"]}
                        index.write(json.dumps(line).encode() + b"\n")
                        out.write(member)
                        n += 1
                out.close()
                index.close()
                yield pa.record_batch([pa.array([target]), pa.array([target + ".index"]), pa.array([n], pa.int64())], ["path", "index_path", "n_records"])

    return stored(_each_path(archives).mapInArrow(rewrite, "path string, index_path string, n_records long"), "normalised")


def _lines(stream: pa.NativeFile) -> Iterator[bytes]:
    held = b""
    while piece := stream.read(PIECE):
        *whole, held = (held + piece).split(b"\n")
        yield from whole
    if held:
        yield held


def read_back(archives: DataFrame) -> DataFrame:
    """Every record of normalised archives, each reached by its own index line: page_id, url, type, digest, bytes, refers_to, payload.

    A response's digest and length are those of the payload read; a revisit has those that its header gives.
    """
    schema = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"

    def urn(value: str | None) -> int | None:
        return int(value.removeprefix("<urn:page:").removesuffix(">")) if value and value.startswith("<urn:page:") else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = _place(path)
                rows, held = [], 0
                with store.open_input_file(name) as archive, store.open_input_stream(name + ".index", compression=None) as lines:
                    for line in _lines(lines):
                        at = json.loads(line)
                        archive.seek(at["offset"])
                        header, body, _ = next(parse(iter([zlib.decompress(archive.read(at["length"]), 31)])))
                        if header["WARC-Type"] == "response":
                            digest, n = payload_digest(body), len(body)
                        else:
                            digest, n, body = header["WARC-Payload-Digest"].removeprefix("sha1:"), int(header["WARC-Payload-Length"]), None
                        rows.append((urn(header.get("WARC-Record-ID")), header.get("WARC-Target-URI"), header["WARC-Type"], digest, n, urn(header.get("WARC-Refers-To")), body))
                        held += len(body or b"")
                        if held > 8 * PIECE:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return _each_path(archives).mapInArrow(read, schema)


def archive(pages: DataFrame, least: int = LEAST_BYTES, roll: int = ROLL, date: str = DATE) -> DataFrame:
    """Writes all pages, normalises the archives and reads them back: the columns of ``read_back``.

    A null html is an empty payload. A row without page_id revisits the response of its payload, or is one. Rows that repeat a page_id are records of their own; equal ones of the same id are all
    responses, and share a Record-ID. Payloads of any length are written and read whole, one at a time. An empty table gives
    no archive and no rows. Further columns are ignored.
    """
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    return read_back(normalise(write_monolithic(classified(pages, least), folder, roll, date)))


def report(pages: DataFrame) -> DataFrame:
    """The digest columns of ``archive``, a row for each page."""
    return archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
