"""Token files with a shared zstandard dictionary (operator 8).

A file holds the documents of one range of identifiers in order.  Each
document's ids are serialised (little-endian, 2 bytes where the vocabulary
allows it, else 4) and compressed as a frame of its own with a dictionary
trained on such arrays, so that a short document is read alone and still
compresses well.

    magic "LTOK1\\n", width (1 byte), SHA-256 of the dictionary (32 bytes), frames

Beside it lies an index in JSON lines: the document's identifier, its row in
the file, the frame's offset and length, its number of ids, and the ids before
it in the file.  ``dictionary-<hash>`` is in the same folder, and a reader
refuses a dictionary with another hash.  Files appear under their name only
when complete, and a repeated task replaces its file by an equal one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import stored, work_path
from larder.llm.encode import encoder, slices, vocabulary_size
from larder.llm.warc_normal import _Output, file_system

MAGIC = b"LTOK1\n"
LEVEL = 3
#: The dictionary is trained on the first ``SAMPLE_IDS`` ids of about ``SAMPLE_DOCS`` documents.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_IDS = 64 * 1024, 1000, 2048
INDEX_SCHEMA = "file string, row long, doc_id long, offset long, length long, n_tokens long, before long"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or where the samples are too few for that, their
    last bytes as raw content."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:].rjust(8, b"\0")


def _dictionary(data: bytes):
    import zstandard

    kind = zstandard.DICT_TYPE_AUTO if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(data, dict_type=kind)


def _samples(docs: DataFrame, tokenizer: str, width: str, added_tokens: bool) -> list[bytes]:
    """Serialised starts of a bounded sample, chosen by a hash of the identifier."""
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, added_tokens).encode
        for batch in batches:
            texts = [(t or "")[:8 * SAMPLE_IDS] for t in batch.column("text").to_pylist()]
            blobs = [np.frombuffer(b, "<u4")[:SAMPLE_IDS].astype(width).tobytes() for b in encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(blobs, pa.binary())], names=["doc_id", "blob"])

    found = chosen.mapInArrow(start, "doc_id long, blob binary").limit(2 * SAMPLE_DOCS)
    return [bytes(r.blob) for r in sorted(found.collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.blob)) if r.blob]


def _write(folder: str, tokenizer: str, end_id: int, width: str, dictionary: bytes, added_tokens: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode, end = encoder(tokenizer, added_tokens).encode, np.array([end_id], "<u4").tobytes()
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
        task = TaskContext.get().partitionId()
        path = f"{folder}/part-{task:06d}.ltok"
        out = index = None
        rows = tokens = 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices(texts):
                if out is None:
                    out, index = _Output(path), _Output(path + ".index.json")
                    out.write(MAGIC + bytes([np.dtype(width).itemsize]) + hashlib.sha256(dictionary).digest())
                lines = []
                for doc, blob in zip(ids[a:b], encode(texts[a:b]), strict=True):
                    blob += end
                    frame = pack(np.frombuffer(blob, "<u4").astype(width).tobytes())
                    lines.append(json.dumps({"file": path, "row": rows, "doc_id": doc, "offset": out.size,
                                             "length": len(frame), "n_tokens": len(blob) // 4, "before": tokens}))
                    out.write(frame)
                    rows, tokens = rows + 1, tokens + len(blob) // 4
                index.write(("\n".join(lines) + "\n").encode())
        if out is not None:
            out.commit()
            index.commit()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([task], pa.int32()), pa.array([rows], pa.int64()), pa.array([tokens], pa.int64())],
                names=["file", "part", "docs", "tokens"])
    return write


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", added_tokens: bool = True) -> DataFrame:
    """Writes the ids of every text, with ``end_id`` behind each, in ascending
    order of the identifiers (nulls first; rows with the same identifier in any
    order).  Null texts are empty.  The names of the file's added tokens in a text
    give their ids, or with ``added_tokens=False`` are ordinary text.  Returns (file, part, docs, tokens), stored;
    an empty table writes no file."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    width = "<u2" if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else "<u4"
    dictionary = train_dictionary(_samples(given, tokenizer, width, added_tokens))
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/dictionary-{hashlib.sha256(dictionary).hexdigest()}", compression=None) as file:
        file.write(dictionary)
    ordered = given.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stored(ordered.mapInArrow(_write(folder, tokenizer, end_id, width, dictionary, added_tokens),
                                     "file string, part int, docs long, tokens long"), "token-files")


class TokenFile:
    """Reads documents of one file by their index lines."""

    def __init__(self, path: str) -> None:
        fs, own = file_system(path)
        self.file = fs.open_input_file(own)
        head = self.file.read_at(len(MAGIC) + 33, 0)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is not a token file")
        self.width = f"<u{head[len(MAGIC)]}"
        digest = head[-32:]
        with fs.open_input_stream(f"{own.rpartition('/')[0]}/dictionary-{digest.hex()}", compression=None) as file:
            data = file.read()
        if hashlib.sha256(data).digest() != digest:
            raise ValueError(f"{path}: the dictionary has another hash")
        import zstandard

        self.unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress

    def ids(self, offset: int, length: int) -> np.ndarray:
        return np.frombuffer(self.unpack(self.file.read_at(length, offset)), self.width)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name = file = None
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part, blobs = batch.slice(at, 512), []
            for path, offset, length in zip(*(part.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if path != name:
                    file, name = TokenFile(path), path
                blobs.append(file.ids(offset, length).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(blobs, pa.binary())], names=[*part.schema.names, "ids"])


def read_tokens(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """A row per document: doc_id, start (the ids of all documents before it),
    n_tokens and ids (little-endian unsigned 32-bit), read frame by frame."""
    index = spark.read.schema(INDEX_SCHEMA).json(f"{folder}/*.index.json")
    upto = F.sum("tokens").over(Window.orderBy("part"))
    # One narrow row per file, so one task numbers them and they are broadcast.
    starts = F.broadcast(files.select("file", (upto - F.col("tokens")).alias("first")))
    return (index.mapInArrow(_fetch, INDEX_SCHEMA + ", ids binary").join(starts, "file")
            .select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, **columns) -> DataFrame:
    """Writes ``docs`` and reads the files back; empty for an empty table."""
    spark = docs.sparkSession
    folder = work_path(spark, "tokens")
    files = write_tokens(docs, folder, tokenizer, end_id, **columns)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    return read_tokens(spark, folder, files)
