"""Token-id files: bit planes of fixed-size blocks, each plane under zstandard, with a chunk index.

File format (all numbers little-endian), one file per shard:

    "TKPL" magic, u16 version = 1, u16 planes (bits of an id), u32 block (ids per chunk)
    chunks: for each plane, from the lowest bit up, one zstandard frame of the
        plane's ceil(ids / 8) bytes (numpy order of bits: the first id is bit 7)
    index: one entry per chunk: u64 offset, u32 ids, then ``planes`` x u32 frame sizes
    footer: u64 offset of the index, u32 chunks, "TKPL"

Every chunk but the last has exactly ``block`` ids, so the chunk of an id is a
division, and a reader touches only the chunks that it needs. Planes above the
highest bit in use are all zero and cost a few bytes.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.llm.pieces import PieceEncoder, joined_encoder, one_thread
from tabforge.session import materialize, scratch_path

MAGIC = b"TKPL"
_HEAD, _FOOT = struct.Struct("<4sHHI"), struct.Struct("<QI4s")


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """One packed bit array per plane of unsigned ids."""
    size = 2 if planes <= 16 else 4
    bits = np.unpackbits(ids.astype(f"<u{size}").view(np.uint8).reshape(-1, size), axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(np.ascontiguousarray(bits.T[:planes]), axis=1)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    rows = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes])
    size = 2 if len(planes) <= 16 else 4
    full = np.zeros((n, 8 * size), np.uint8)
    full[:, : len(planes)] = rows.T
    return np.packbits(full, axis=1, bitorder="little").view(f"<u{size}").ravel().astype(np.uint32)


class ShardWriter:
    """Streams ids into one file; holds at most one block and what one document adds to it."""

    def __init__(self, out, planes: int, block: int, level: int):
        self.out, self.planes, self.block = out, planes, block
        self.pack = zstandard.ZstdCompressor(level=level)
        self.rest, self.index, self.at = np.empty(0, np.uint32), [], _HEAD.size
        out.write(_HEAD.pack(MAGIC, 1, planes, block))

    def add(self, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.planes:
            raise ValueError(f"an id needs more than {self.planes} bits")
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.block * self.block
        for start in range(0, whole, self.block):
            self._chunk(ids[start : start + self.block])
        self.rest = ids[whole:]

    def _chunk(self, ids: np.ndarray) -> None:
        frames = [self.pack.compress(p) for p in to_planes(ids, self.planes)]
        self.index.append(struct.pack(f"<QI{self.planes}I", self.at, len(ids), *map(len, frames)))
        for f in frames:
            self.out.write(f)
            self.at += len(f)

    def close(self) -> None:
        if len(self.rest):
            self._chunk(self.rest)
        self.out.write(b"".join(self.index))
        self.out.write(_FOOT.pack(self.at, len(self.index), MAGIC))
        self.out.close()


class ShardReader:
    """Random access to the ids of one file; keeps the last decoded chunk."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        magic, version, self.planes, self.block = _HEAD.unpack(self._read(0, _HEAD.size))
        start, self.chunks, end = _FOOT.unpack(self._read(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC or end != MAGIC or version != 1:
            raise ValueError("not a token file")
        self.start, self.entry = start, struct.Struct(f"<QI{self.planes}I")
        self.last: tuple[int, np.ndarray] | None = None

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def chunk(self, no: int) -> np.ndarray:
        if self.last is None or self.last[0] != no:
            at, n, *sizes = self.entry.unpack(self._read(self.start + no * self.entry.size, self.entry.size))
            packed, unpack = self._read(at, sum(sizes)), zstandard.ZstdDecompressor()
            ends = np.cumsum([0, *sizes])
            planes = [unpack.decompress(packed[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            self.last = (no, from_planes(planes, n))
        return self.last[1]

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the file."""
        found = []
        while count > 0:
            part = self.chunk(start // self.block)[start % self.block :][:count]
            found.append(part)
            start, count = start + len(part), count - len(part)
        return found[0] if len(found) == 1 else np.concatenate([np.empty(0, np.uint32), *found])


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The store of a path or URI, as tasks reach it."""
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


@lru_cache(maxsize=2)
def byte_level_encoder(tokenizer: str, special_as_text: bool = True) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Encoder of a byte-level tokenizer file, kept for the life of a Python worker.

    Strings of special tokens are text, or with ``special_as_text`` False get
    the ids that the file as loaded gives them.
    """
    from tokenizers import Tokenizer

    one_thread()
    library = Tokenizer.from_file(tokenizer)
    library.encode_special_tokens = special_as_text
    library.no_padding()
    library.no_truncation()
    lengths = np.array([len(library.id_to_token(i) or "") for i in range(library.get_vocab_size())])
    wide = False
    for i, token in library.get_added_tokens_decoder().items():
        lengths[i] = len(token.content.encode())
        if not (token.special and special_as_text):
            wide |= token.lstrip or token.rstrip or token.single_word or any(c.isspace() for c in token.content)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = encode([t or "" for t in texts.to_pylist()])
        return np.concatenate([np.empty(0, np.uint32), *[np.array(x, np.uint32) for x in found]]), np.cumsum([0, *map(len, found)])

    if wide:  # an added token can take in blanks, so no text may be cut at one
        return whole
    return PieceEncoder(joined_encoder(encode, lengths), remember=1_000_000)


def write_token_files(
    docs: DataFrame,
    encoder: Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]],
    path: str,
    end_id: int | None = 0,
    planes: int = 16,
    block: int = 65_536,
    level: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
    rows: int = 1500,
) -> DataFrame:
    """Write the ids of all texts to files under ``path`` and return ``(doc_id, shard, file, position, n_tokens)``.

    Documents go to shards by ranges of ``id_col`` and are sorted within (null
    first), so the shards in order hold all documents in ascending order. A task
    streams its texts into one file, finished under a name of its own attempt;
    only the files that the returned, stored rows name count, so lost and
    repeated tasks leave nothing wrong behind. Null and empty texts are just
    the end id (no ids at all with ``end_id`` None); equal ids keep all rows.
    ``rows`` texts are encoded at a time.
    """
    filesystem(path)[0].create_dir(filesystem(path)[1], recursive=True)
    tail = None if end_id is None else np.uint32(end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, store, writer, position = encoder(), filesystem(path), None, 0
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.tkpl"
        for batch in batches:
            if writer is None:
                writer = ShardWriter(store[0].open_output_stream(f"{store[1]}/{name}"), planes, block, level)
            for some in (batch.slice(i, rows) for i in range(0, batch.num_rows, rows)):
                ids, starts = encode(some.column(1))
                if tail is not None:
                    ids, starts = np.insert(ids, starts[1:], tail), starts + np.arange(len(starts))
                writer.add(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array(np.full(some.num_rows, shard, np.int32)),
                        pa.array([name] * some.num_rows),
                        pa.array(position + starts[:-1]),
                        pa.array(np.diff(starts)),
                    ],
                    names=["doc_id", "shard", "file", "position", "n_tokens"],
                )
                position += int(starts[-1])
        if writer is not None:
            writer.close()

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ranged = slim.repartitionByRange(shards, "doc_id") if shards else slim.repartitionByRange("doc_id")
    kind = dict(slim.dtypes)["doc_id"]
    written = ranged.sortWithinPartitions("doc_id").mapInArrow(write, f"doc_id {kind}, shard int, file string, position long, n_tokens long")
    return materialize(written, "token-rows")


def with_starts(rows: DataFrame) -> DataFrame:
    """``rows`` of ``write_token_files`` with ``start``, the number of ids of all documents before.

    Only one total per shard goes through the running sum.
    """
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    return rows.join(materialize(offsets, "token-offsets"), "shard").withColumn("start", F.col("before") + F.col("position")).drop("before")


def read_documents(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``ids_crc32``, the checksum of the ids read back from the files as little-endian u32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, reader, name = filesystem(path), None, None
        for batch in batches:
            sums = []
            for file, position, n in zip(*[batch.column(c).to_pylist() for c in ("file", "position", "n_tokens")], strict=True):
                if file != name:
                    reader, name = ShardReader(store[0].open_input_file(f"{store[1]}/{file}")), file
                sums.append(zlib.crc32(reader.ids(position, n).astype("<u4", copy=False)))
            yield batch.append_column("ids_crc32", pa.array(sums, pa.int64()))

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", ids_crc32 long"
    return rows.mapInArrow(read, schema)


def token_path(spark: SparkSession) -> str:
    """A new folder for token files in the shared storage."""
    return scratch_path(spark, "token-files")
