"""WARC archives and the normaliser of whole-file gzip (operator 3).

``write_archives`` writes one monolithic ``.warc.gz`` per partition: a single
gzip stream over all its records.  Such a file can only be read from its
start.  ``normalise`` inflates each stream once, in chunks, writes every
record as a gzip member of its own, and puts an offset index (JSON lines)
beside the archive.  ``read_records`` follows the index, so any record is
read alone.

Files are written under a name of the task attempt and renamed when they are
complete, and their bytes depend on their rows only: a repeated task replaces
its file by an equal one.  They go through pyarrow's file systems, so the
folder may be local, HDFS or an object store.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import stored, work_path

CHUNK = 1 << 20
GZIP = 31  # zlib window bits of the gzip format
#: Equal payloads of at least so many bytes are written once.
LEAST_REVISIT = 100
#: The tables have no crawl time.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "archive string, offset long, length long, record string, type string"


def file_system(path: str):
    """(file system, path in it) of a folder or file that all executors reach."""
    from pyarrow import fs

    if re.match(r"[a-z][a-z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


class _Output:
    """A file that appears under its name only when it is complete."""

    def __init__(self, path: str) -> None:
        self.fs, self.path = file_system(path)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        self.draft = f"{folder}/_{name}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
        self.stream, self.size = self.fs.open_output_stream(self.draft, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.stream.close()
        self.fs.move(self.draft, self.path)


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int,
                 refers_to: int | None) -> bytes:
    """A response record, or without ``payload`` a revisit record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    name = lambda n: f"<urn:x-page:{'' if n is None else n}>"
    fields = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", name(page_id)),
              ("WARC-Date", DATE)]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        fields.append(("WARC-Target-URI", safe))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if payload is None:
        fields += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", PROFILE)]
    block = http + (payload or b"")
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines if ":" in x)}


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads compressed on their way through the shuffle."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        blobs = [pack((html or "").encode()) for html in (x.as_py() for x in batch.column("html_"))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(blobs, pa.binary())],
                                         names=[*batch.schema.names[:-1], "blob"])


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        out, deflate, n = None, zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
        for batch in batches:
            for row in batch.to_pylist():
                out = out or _Output(f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz")
                again = row["refers_to"] is not None
                payload = None if again else unpack(row["blob"])
                out.write(deflate.compress(record_bytes(row["page_id"], row["url"], payload, row["digest"],
                                                        row["bytes"], row["refers_to"])))
                n += 1
        if out:
            out.write(deflate.flush())
            out.commit()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{out.path.rpartition('/')[2]}"]),
                                              pa.array([n], pa.int64())], names=["archive", "records"])
    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Writes a record per row and returns (archive, records), stored.

    Of rows with equal payloads of at least ``least`` bytes, those with the
    smallest identifier are responses and the others revisit it.  A null
    payload is empty, a null URL leaves its header out, and rows without an
    identifier are always responses."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    firsts = stored(given.filter(F.col("bytes") >= least).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "warc-firsts")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"),
                        html.alias("html_"))
    packed = rows.mapInArrow(_packed, "page_id long, url string, digest string, bytes long, blob binary")
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    ready = (packed.join(firsts, "digest", "left").withColumn("refers_to", refers).drop("first")
             .sortWithinPartitions("page_id", "digest"))
    return stored(ready.mapInArrow(_write(folder), "archive string, records long"), "warc-list")


class _Inflated:
    """The bytes of a gzip file of one or more members, inflated as they are read."""

    def __init__(self, stream) -> None:
        self.stream, self.inflate = stream, zlib.decompressobj(GZIP)
        self.held, self.ended = bytearray(), False

    def more(self) -> bool:
        while not self.ended:
            data = self.inflate.unused_data or self.stream.read(CHUNK)
            if self.inflate.eof:
                if not data:
                    self.ended = True
                    break
                self.inflate = zlib.decompressobj(GZIP)
            elif not data:
                raise ValueError("the gzip stream ends early")
            out = self.inflate.decompress(data)
            if out:
                self.held += out
                return True
        return False

    def until(self, mark: bytes, most: int = CHUNK) -> bytes | None:
        """What comes before ``mark``; None at the end of the file."""
        at = 0
        while (end := self.held.find(mark, at)) < 0:
            if len(self.held) > most:
                raise ValueError("a record's header is too long")
            at = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held.strip(b"\r\n"):
                    raise ValueError("the archive ends inside a record's header")
                return None
        found = bytes(self.held[:end])
        del self.held[:end + len(mark)]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("the archive ends inside a record")
            data = bytes(self.held[:n])
            del self.held[:n]
            n -= len(data)
            yield data


def normalise_file(source: str, target: str) -> int:
    """Rewrites one archive; returns its number of records."""
    fs, path = file_system(source)
    records = 0
    out, index = _Output(target), _Output(re.sub(r"\.warc\.gz$", "", target) + ".index.json")
    with fs.open_input_stream(path, compression=None) as stream:
        inflated = _Inflated(stream)
        while (head := inflated.until(b"\r\n\r\n")) is not None:
            head = head.lstrip(b"\r\n")
            fields, start = header_fields(head), out.size
            member = zlib.compressobj(6, zlib.DEFLATED, GZIP)
            out.write(member.compress(head + b"\r\n\r\n"))
            for data in inflated.take(int(fields["content-length"])):
                out.write(member.compress(data))
            if b"".join(inflated.take(4)) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            out.write(member.compress(b"\r\n\r\n") + member.flush())
            line = {"archive": target, "offset": start, "length": out.size - start,
                    "record": fields.get("warc-record-id"), "type": fields.get("warc-type")}
            index.write(json.dumps(line).encode() + b"\n")
            records += 1
    out.commit()
    index.commit()
    return records


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites every archive named in the column ``archive``, one task for
    each, and returns (archive, records) of the new ones, stored.  A damaged
    or truncated archive raises ValueError; an empty list gives no file."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                target = f"{folder}/{source.rpartition('/')[2]}"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([target]), pa.array([normalise_file(source, target)], pa.int64())],
                    names=["archive", "records"])
    files = archives.select("archive")
    spread = files.repartition(max(1, files.count()))
    return stored(spread.mapInArrow(rewrite, "archive string, records long"), "warc-normal")


def parse_record(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = header_fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:x-page:(-?\d+)>", fields.get(name, ""))) else None
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields.get('warc-record-id')} is damaged")
    return (number("warc-record-id"), size, digest, kind, number("warc-refers-to"), fields.get("warc-target-uri"),
            payload if kind == "response" else None)


def _fetch(payloads: bool):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    n = len(names) if payloads else len(names) - 1

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, name = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for archive, offset, length in zip(*(c.to_pylist() for c in part.columns[:3]), strict=True):
                    if archive != name:
                        fs, path = file_system(archive)
                        file, name = fs.open_input_file(path), archive
                    member = file.read_at(length, offset)
                    rows.append(parse_record(zlib.decompress(member, GZIP))[:n])
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns],
                                                 names=["archive", "offset", "length", *names[:n]])
    return fetch


def read_records(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """A row per record of the normalised archives of a folder, read member by
    member at the offsets of the indexes.  Payloads come only on request."""
    schema = ("archive string, offset long, length long, page_id long, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, url string")
    index = spark.read.schema(INDEX_SCHEMA).json(f"{folder}/*.index.json").select("archive", "offset", "length")
    return index.mapInArrow(_fetch(payloads), schema + (", payload binary" if payloads else ""))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes monolithic archives of ``pages``, normalises them and reads the
    result back; an empty table gives an empty result."""
    spark = pages.sparkSession
    whole, single = work_path(spark, "warc-whole"), work_path(spark, "warc")
    made = normalise(write_archives(pages, whole, **options), single)
    if made.isEmpty():
        return spark.createDataFrame([], "archive string, offset long, length long, page_id long, payload_bytes long, "
                                         "payload_digest string, record_type string, refers_to long, url string")
    return read_records(spark, single)
