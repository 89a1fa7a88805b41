"""Best-fit packing of documents into training sequences, after the plan of ``linear_grouping``.

One step tokenizes and cuts (only documents longer than a sequence; all pieces but the first are full) and numbers the
pieces of each length within its task. The histogram, at most one row for each length, gives the plan; a window over the
tasks' counts turns the numbers into ranks among all pieces of a length; the rank finds its place in the plan. So texts
are read once and never shuffled, and a length that most documents share is dealt like any other.

Defined results: null and empty texts are a piece of one token (the end id); each row is packed by itself, also where
ids repeat or are null; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_CHARS, id_text, shared_table, slices
from .linear_grouping import Plan
from .public_ids import CACHE_BYTES, ENCODED_ROWS, END_ID, default_path, encoder

CAPACITY = 1024
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("part", pa.int64()), ("nth", pa.int64())])
PLACED_DDL = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
PLACED = pa.schema([*list(PIECES)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", cache_bytes: int = CACHE_BYTES,
         slice_bytes: int = SLICE_CHARS) -> DataFrame:
    """Pieces with their task and their number among the task's pieces of that length, as a shared table."""
    tokenizer = tokenizer or default_path()
    end = np.uint32(END_ID).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for some in slices(batch, 1, slice_bytes, ENCODED_ROWS):
                rows = []
                for doc, ids in zip(some.column(0).to_pylist(), encoder(tokenizer, cache_bytes).encode(some.column(1))):
                    ids = ids + end
                    short = len(ids) % (4 * capacity)
                    cuts = [*([0] if short else []), *range(short, len(ids), 4 * capacity)]
                    for k, (at, to) in enumerate(zip(cuts, [*cuts[1:], len(ids)])):
                        own = ids[at:to]
                        n = len(own) // 4
                        rows.append((doc, k, at // 4, n, zlib.crc32(own), part, seen[n]))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PIECES.types)], schema=PIECES)

    return shared_table(id_text(docs, id_col, text_col).mapInArrow(cut, PIECES_DDL), "pieces")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", cache_bytes: int = CACHE_BYTES,
         slice_bytes: int = SLICE_CHARS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = pieces(docs, capacity, tokenizer, id_col, text_col, cache_bytes, slice_bytes)
    by_task = cut.groupBy("part", "length").count()
    # At most one row for each length up to the capacity.
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = np.array(Plan(capacity, histogram).rows, dtype=np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_task.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(earlier, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("earlier")).alias("rank"))
    keys = (plan[:, 0] << 48) + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = plan[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])],
                                             schema=PLACED)

    return ranked.mapInArrow(place, PLACED_DDL)
