"""Token ids as bit planes: fixed-size blocks of ids are transposed into bit planes, each plane is compressed with
zstandard, and every chunk carries an index of its blocks, planes and documents.

A *chunk* is a binary value that can be read alone::

    magic "BPL1" | blocks u32 | for each block: ids u32, planes u32, bytes of each plane u32 ... | planes

It holds whole documents of up to CHUNK_IDS ids together (a longer document is a chunk of its own, with more blocks).
The file format is Parquet with one row for each chunk: its place, its documents' ids and lengths, and the chunk. So any
store that Spark reaches can hold it, and a lost task leaves nothing half written.

Defined results: a null text is empty (the end id alone); rows with the same id are all written, in no set order among
themselves; null ids come first; an empty table gives an empty file set and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_text, slices
from .public_ids import CACHE_BYTES, ENCODED_BYTES, ENCODED_ROWS, END_ID, default_path, encoder

MAGIC = b"BPL1"
BLOCK_IDS = 1 << 14
CHUNK_IDS = 1 << 16
LEVEL = 3

CHUNKS = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
                    ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("payload", pa.binary())])
CHUNKS_DDL = ("part long, chunk long, first long, n_ids long, first_doc long, doc_ids array<long>, "
              "lengths array<long>, payload binary")
BACK = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def pack(ids: np.ndarray, block_ids: int = BLOCK_IDS, level: int = LEVEL) -> bytes:
    """One chunk of any number of ids (unsigned 32-bit)."""
    compress = zstandard.ZstdCompressor(level=level).compress
    index, planes = [], []
    blocks = range(0, len(ids), block_ids)
    for at in blocks:
        block = np.ascontiguousarray(ids[at:at + block_ids], dtype="<u4")
        width = int(block.max()).bit_length()
        lanes = np.ascontiguousarray(block.view(np.uint8).reshape(-1, 4).T)  # a byte of each id together
        packed = [compress(np.packbits(lanes[bit >> 3] & np.uint8(1 << (bit & 7)), bitorder="little").tobytes()) for bit in range(width)]
        index += [len(block), width, *map(len, packed)]
        planes += packed
    return b"".join([MAGIC, struct.pack(f"<{len(index) + 1}I", len(blocks), *index), *planes])


def unpack(chunk: bytes) -> np.ndarray:
    """The ids of a chunk."""
    if chunk[:4] != MAGIC:
        raise ValueError("not a chunk of bit planes")
    n_blocks, at, shape = struct.unpack_from("<I", chunk, 4)[0], 8, []
    for _ in range(n_blocks):
        n, width = struct.unpack_from("<2I", chunk, at)
        shape.append((n, struct.unpack_from(f"<{width}I", chunk, at + 8)))
        at += 8 + 4 * width
    expand, out = zstandard.ZstdDecompressor().decompress, []
    for n, sizes in shape:
        ids = np.zeros(n, dtype="<u4")
        for bit, size in enumerate(sizes):
            plane = np.unpackbits(np.frombuffer(expand(chunk[at:at + size]), np.uint8), count=n, bitorder="little")
            ids |= plane.astype("<u4") << np.uint32(bit)
            at += size
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, dtype="<u4")


def write(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          cache_bytes: int = CACHE_BYTES, first: bool = False) -> None:
    """Encode every whole text, append END_ID, and write the ids in ascending id order under ``path``."""
    tokenizer = tokenizer or default_path()
    end, keep_first = np.uint32(END_ID).tobytes(), first

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, first = TaskContext.get().partitionId(), 0, 0
        held_docs: list = []
        held_ids: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held_ids), "<u4")
            row = [part, chunk, first, len(ids), held_docs[0], list(held_docs), [len(x) // 4 for x in held_ids], pack(ids)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, CHUNKS.types)], schema=CHUNKS)

        for batch in batches:
            for piece in slices(batch, 1, ENCODED_BYTES, ENCODED_ROWS):
                for doc, ids in zip(piece.column(0).to_pylist(), encoder(tokenizer, cache_bytes, keep_first).encode(piece.column(1))):
                    n = len(ids) // 4 + 1
                    if held and held + n > CHUNK_IDS:
                        yield out()
                        chunk, first = chunk + 1, first + held
                        held_docs, held_ids, held = [], [], 0
                    held_docs.append(doc)
                    held_ids.append(ids + end)
                    held += n
        if held:
            yield out()

    ordered = id_text(docs, id_col, text_col).repartitionByRange(F.col("doc_id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ordered.mapInArrow(chunks, CHUNKS_DDL).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A part is one task of the writer, so there are no more parts than shuffle partitions; only their totals are summed
    up in one window and broadcast.
    """
    chunks = spark.read.schema(CHUNKS_DDL).parquet(path)
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"), F.min("first_doc").alias("first_doc")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, docs, lengths, payload in zip(*(batch.column(i) for i in range(4))):
                ids, at = unpack(payload.as_py()), np.cumsum([0, *lengths.as_py()])
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs.as_py(), pa.int64()), pa.array(start.as_py() + at[:-1]), pa.array(np.diff(at)),
                     pa.array(crc, pa.int64())], schema=BACK)

    placed = chunks.join(F.broadcast(parts), "part") \
        .select((F.col("first") + F.col("part_start")).alias("start"), "doc_ids", "lengths", "payload")
    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
