"""Token ids in length-delimited binary files, with an offset index beside them.

File format, little-endian, one record after another:

    u64 length of the payload | u32 masked crc32 of those 8 bytes
    payload                   | u32 masked crc32 of the payload

    payload: u8 1 if the id is known else 0 | i64 doc_id | u8 bytes of an id (2 or 4) | ids

A crc is masked by rotating it 15 bits right and adding a constant, so that a
checksum over data that holds checksums stays useful.  The index is a Parquet
table of one row per record (file, place, doc_id, offset, length, n_tokens):
a reader that wants records in shuffled order seeks to them with ``read_at``.

Documents are range-partitioned by id, so files in index order hold them in
ascending order.  A task that is run again writes a file of a new name; only
the files that the (committed) index names count.  Files are cut at
``FILE_BYTES``; they live under a URI that pyarrow's file systems open (shared
mounts, HDFS, object stores).

Ids are looked up by chunk: the tokenizer never looks across blanks and line
ends, so each distinct chunk between them is encoded once per cache and a
document's ids are its chunks' bytes joined.  Chunks of Latin letters, digits
and marks go to the tokenizer's model run by run, others through all its steps.

Defined results: null and empty texts hold the end id alone; a null doc_id
sorts first; repeated rows each keep a record, ties in scan order; an empty
table has an empty index.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airmesh.session import ensure_checkpoint_dir

from .common import RowBuffer, map_rows, texts_of

FILE_BYTES = 64 << 20
#: Chunks of each of the two generations of a worker's cache.
CACHE_CHUNKS = 500_000
#: Fixed value of the record format.
MASK_DELTA = 0xA282EAD8
_HEAD, _HEAD_BYTES = "<QI", 12
_OWN, _OWN_BYTES = "<BqB", 10
#: A mark alone between a letter or digit and a blank is a token of its own: cut off, it leaves fewer distinct chunks.
#: Only after letters that stay letters: others may end in a combining mark once they are normalised, which takes the mark along.
_MARK_AFTER_WORD = re.compile(r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ])([,.])(?=[ \n])")
#: Chunks that lower-casing and normalising leave as long as they are, without apostrophes, and their runs: letters, single digits, marks.
_SIMPLE = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
_RUN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^A-Za-zÀ-ÖØ-öø-ÿ0-9]+")
_INDEX = "file string, place long, doc_id long, offset long, length long, n_tokens long"


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(zlib.crc32(size))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def unframe(stream) -> Iterator[bytes]:
    """Payloads of a stream of records; a damaged or cut record raises ValueError."""
    while head := stream.read(_HEAD_BYTES):
        if len(head) < _HEAD_BYTES:
            raise ValueError("record cut short")
        length, check = struct.unpack(_HEAD, head)
        if masked(zlib.crc32(head[:8])) != check:
            raise ValueError("damaged record length")
        payload, tail = stream.read(length), stream.read(4)
        if len(payload) < length or len(tail) < 4:
            raise ValueError("record cut short")
        if masked(zlib.crc32(payload)) != struct.unpack("<I", tail)[0]:
            raise ValueError("damaged record")
        yield payload


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids as little-endian u32) of a payload."""
    known, doc_id, width = struct.unpack_from(_OWN, payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=_OWN_BYTES).astype("<u4")


def _open(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


@lru_cache(maxsize=2)
def shared_encoder(tokenizer_path: str) -> ChunkEncoder:
    """One encoder for all tasks of a Python worker, so that they share its cache."""
    return ChunkEncoder(tokenizer_path)


def byte_letters() -> list[str]:
    """The letter by which byte-level tokenizers write each byte: printing ones are themselves, others follow U+0100."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(others)) for b in range(256)]


class ChunkEncoder(dict):
    """Ids of texts as bytes; a mapping of chunks to their ids, of two bounded generations."""

    def __init__(self, tokenizer_path: str, cache: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.old, self.most, self.bytes = {}, cache, byte_letters()
        # whether the model alone, run by run, gives a simple chunk's ids
        self.simple = all(self._runs(c) == self._whole(c) for c in ("a", "probe", "Words", "déjà", "STRASSE", "end.", "(a1b22)--c!", "x***", "***"))

    def _whole(self, chunk: str) -> list[int]:
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _runs(self, chunk: str) -> list[int]:
        tokenize, letters = self.tokenizer.model.tokenize, self.bytes
        return [t.id for run in _RUN.findall(chunk.lower()) for t in tokenize(
            run if run.isascii() else "".join(map(letters.__getitem__, run.encode())))]

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.old.get(chunk)) is None:
            own = self._runs(chunk) if self.simple and _SIMPLE.fullmatch(chunk) and "<|" not in chunk else self._whole(chunk)
            ids = struct.pack(f"<{len(own)}{self.kind}", *own)
        self[chunk] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        # the tokenizer lower-cases; done before, it leaves fewer distinct chunks (special tokens are told by case)
        texts = [t.lower() if t.isascii() and "<|" not in t else t for t in texts]
        return [b"".join(map(self.__getitem__, _MARK_AFTER_WORD.sub(r" \1", t).replace("\n", " ").split(" "))) for t in texts]


def write_token_files(docs: DataFrame, folder: str, make_encoder: Callable[[], ChunkEncoder], end_id: int) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) under ``folder`` (a URI) in ascending doc_id order.

    Returns the index, as read back from ``folder``/index.
    """
    schema = pa.schema([("file", pa.string()), ("place", pa.int64()), ("doc_id", pa.int64()),
                        ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = make_encoder()
        end = end_id.to_bytes(encoder.width, "little")
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        part, cut, out, stream, offset = TaskContext.get().partitionId(), 0, RowBuffer(schema), None, 0
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    rows = batch.slice(start, 256)
                    texts = [t or "" for t in rows.column("text").to_pylist()]
                    for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                        if stream is None or offset > FILE_BYTES:
                            if stream is not None:
                                stream.close()
                            name, offset = f"part-{part:06d}-{cut:04d}-{uuid.uuid4().hex}.tokens", 0
                            stream, cut = system.open_output_stream(f"{path}/{name}"), cut + 1
                        record = frame(struct.pack(_OWN, doc_id is not None, doc_id or 0, encoder.width) + ids + end)
                        stream.write(record)
                        out.add(name, (part << 24) + cut, doc_id, offset, len(record), len(ids) // encoder.width + 1)
                        offset += len(record)
                yield from out.full()
        finally:
            if stream is not None:
                stream.close()
        yield from out.rest()

    spark = docs.sparkSession
    placed = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                          F.monotonically_increasing_id().alias("at"))
              # the scan position breaks ties, so that an id that many rows share is dealt out too
              .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("at"))
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("at")))
    map_rows(placed.select("doc_id", "text"), write, _INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def read_at(folder: str, file: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record, by its place in the index."""
    system, path = _open(folder)
    with system.open_input_file(f"{path}/{file}") as stream:
        stream.seek(offset)
        return unpack(next(unframe(stream)))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) digests of every record, read from the files that the index names.

    Columns: doc_id, start (ids in all records before it), n_tokens, ids_crc32
    (of the ids as little-endian u32).
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        out = RowBuffer(schema)
        for file, start in texts_of(batches, "file", "start"):
            with system.open_input_stream(f"{path}/{file}") as stream:
                for payload in unframe(stream):
                    doc_id, ids = unpack(payload)
                    out.add(doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
                    start += len(ids)
                    yield from out.full()
        yield from out.rest()

    index = spark.read.schema(_INDEX).parquet(f"{folder}/index")
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file of up to 64 MB goes through the window, not one per document
    files = (index.groupBy("file", "place").agg(F.sum("n_tokens").alias("n"))
             .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("start"),
                     (F.row_number().over(Window.orderBy("place")) - 1).alias("number")))
    # a task per file: their names alone are few bytes, of which AQE would make one task
    files = files.repartitionById(max(1, files.count()), F.col("number").cast("int")).drop("number")
    return map_rows(files, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode, write and read back ``docs``; ``folder`` is a new one in the shared folder by default."""
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, folder, partial(shared_encoder, tokenizer_path), end_id)
    return read_token_files(spark, folder)

