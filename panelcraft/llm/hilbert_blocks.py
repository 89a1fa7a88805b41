"""Product quantisation in exact integers over Hilbert-sorted flat blocks.

Each part of the vectors is its own problem: its rows are sorted along a Hilbert curve and cut into flat blocks, which keep the
box (least and greatest component), the sum and the number of their rows beside the rows themselves. A round sends the codebook
to the blocks. Distances between a box and all entries leave a *shortlist* of entries that can be nearest to some row of the
block; a block with one entry left adds its stored sum and reads no row, others run an integer kernel over the shortlist only.
Tasks return sums and counts by entry, Spark adds them up, and the driver keeps only the codebook (entries x parts, bounded).

The bounds are exact. An entry leaves the list only if another one is strictly nearer everywhere in the box, so ties still go to
the lower index. Equal rows are spread over many blocks by their row number, so a hot vector is no hot task.

Defined results: rows whose vector is null, empty, or holds null or non-finite components are dropped; fewer rows than entries
give a smaller codebook; null ids start the codebook last; rows with the same id are rows of their own (equal ids start in the
order of their vectors); null labels are one group; an empty table gives no rows. Other columns are dropped. Vectors of unequal
length, of a length that the parts do not divide, and scaled components beyond 2^26 are refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, shared_table

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK_ROWS = 64
#: Components up to this size keep all distances within 64 bits; those up to EXACT_DOUBLE also in doubles.
MOST, EXACT_DOUBLE = 1 << 26, 1 << 22
#: Blocks compared with the codebook at once.
BOXES_AT_ONCE = 32

BLOCKS = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())),
                    ("total", pa.list_(pa.int64())), ("row_ids", pa.binary()), ("rows", pa.binary())])
BLOCKS_DDL = "part int, n int, low array<long>, high array<long>, total array<long>, row_ids binary, rows binary"


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (unsigned, below 2^bits), after Skilling's transform."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            t = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(t)
    for bit in range(bits - 1, -1, -1):
        for column in x:
            key = (key << 1) | (((column ^ t) >> bit) & 1)
    return key


def scaled(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """row (unique), vec_id, label and the integer vector of every kept row, as a table in the shared folder."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    inside = F.forall("v", lambda x: F.abs(x) < MOST)
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                        vector.alias("v")).where(fine).withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE)))
    checked = F.when(inside, F.col("v")).otherwise(F.raise_error(F.lit(f"a scaled component is beyond {MOST}")))
    return shared_table(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label",
                                    checked.cast("array<long>").alias("v")), "vectors")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def blocks(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """The Hilbert-sorted flat blocks of all parts, as a table in the shared folder."""
    ends = rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.min("x").alias("a"), F.max("x").alias("b")).collect()
    low, high = (np.array([r[c] for r in sorted(ends, key=lambda r: r["i"])]) for c in ("a", "b"))
    curved = min(width, 62)
    bits = max(1, min(8, 62 // curved))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), _matrix(batch.column(1), width * parts)
            for part in range(parts):
                span = slice(part * width, part * width + curved)
                room = np.maximum(1, high[span] - low[span] + 1)
                cells = ((vectors[:, span] - low[span]) << bits) // room
                own = np.ascontiguousarray(vectors[:, part * width:(part + 1) * width])
                lists = pa.ListArray.from_arrays(np.arange(0, own.size + 1, width, dtype=np.int32), pa.array(own.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), part, np.int32)), pa.array(hilbert_key(cells, bits)),
                                                  ids, lists], names=["part", "place", "row", "v"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            part = table["part"].to_numpy()
            ids, vectors = table["row"].to_numpy(), _matrix(table["v"].combine_chunks(), width)
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            out, kept = [], len(part)
            for start, stop in zip(edges, edges[1:]):
                for at in range(start, stop, BLOCK_ROWS):
                    end = min(at + BLOCK_ROWS, stop)
                    if end == len(part) and end - at < BLOCK_ROWS and not last:
                        kept = at
                        break
                    own = vectors[at:end]
                    out.append((int(part[at]), end - at, own.min(0), own.max(0), own.sum(0), ids[at:end].astype("<i8").tobytes(),
                                own.astype("<i4").tobytes()))
            held[:] = table.slice(kept).to_batches() if kept < len(part) else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), BLOCKS.types)], schema=BLOCKS)

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= 8 * BLOCK_ROWS:
                yield from packed(False)
        if held:
            yield from packed(True)

    order = rows.select("row", "v").mapInArrow(keyed, "part int, place long, row long, v array<long>") \
        .repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row").select("part", "row", "v")
    return shared_table(order.mapInArrow(cut, BLOCKS_DDL), "blocks")


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each box (rows of ``low`` and ``high``) the entries that can be nearest to a point in it, as a boolean table.

    First by box distances: the least distance of an entry against the smallest of all greatest ones. Then each remaining entry
    against that smallest one: their difference of squared distances is linear, so its maximum lies at a corner of the box.
    """
    below, above = low[:, None, :] - book, book - high[:, None, :]
    nearest = np.square(np.maximum(np.maximum(below, above), 0)).sum(2)
    farthest = np.square(np.maximum(np.abs(below), np.abs(above))).sum(2)
    best = farthest.argmin(1)
    can = nearest <= farthest[np.arange(len(low)), best][:, None]
    step = 2 * (book - book[best][:, None, :])
    norms = np.square(book).sum(1)
    gain = np.maximum(step * low[:, None, :], step * high[:, None, :]).sum(2) + norms[best][:, None] - norms
    return can & (gain >= 0)


def nearest_entries(rows: np.ndarray, book: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest of the entries ``names`` (ascending) for each row, and its squared distance; exact."""
    own = book[names]
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(own).max(initial=0)))
    norms = np.square(own).sum(1)
    if most * most * 4 * rows.shape[1] < 1 << 53:  # all terms are whole numbers that doubles hold
        far = norms - 2 * (rows.astype(float) @ own.T.astype(float)).astype(np.int64)
    else:
        far = norms - 2 * (rows @ own.T)
    at = far.argmin(1)
    return names[at], far[np.arange(len(rows)), at] + np.square(rows).sum(1)


def _walk(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple]:
    """part, n, total, row ids, rows and shortlist of each block."""
    width = books.shape[2]
    for whole in batches:
        for at in range(0, len(whole), BOXES_AT_ONCE):
            batch = whole.slice(at, BOXES_AT_ONCE)
            part = batch.column(0).to_numpy()
            low, high, total = (_matrix(batch.column(i), width) for i in (2, 3, 4))
            for p in np.unique(part):
                here = np.flatnonzero(part == p)
                for i, can in zip(here, shortlists(low[here], high[here], books[p])):
                    i = int(i)
                    rows = np.frombuffer(batch.column(6)[i].as_py(), "<i4").reshape(-1, width).astype(np.int64)
                    yield int(p), batch.column(1)[i].as_py(), total[i], batch.column(5)[i].as_py(), rows, np.flatnonzero(can)


def _round(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round of assigning and averaging; unused entries stay."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = np.zeros((parts, entries, width + 1), np.int64)
        for p, n, total, _, rows, names in _walk(batches, books):
            if len(names) == 1:
                state[p, names[0], :width] += total
                state[p, names[0], width] += n
            else:
                own, _ = nearest_entries(rows, books[p], names)
                np.add.at(state[p], own, np.column_stack([rows, np.ones(len(rows), np.int64)]))
        p, e = np.nonzero(state[:, :, width])
        if len(p):
            values = np.ascontiguousarray(state[p, e])
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), *[pa.array(values[:, i]) for i in range(width + 1)]],
                names=["part", "entry", *[f"s{i}" for i in range(width)], "n"])

    columns = [f"s{i}" for i in range(width)] + ["n"]
    added = table.mapInArrow(sums, "part int, entry int, " + ", ".join(f"{c} long" for c in columns)) \
        .groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in columns])
    new = books.copy()
    for r in added.collect():  # parts x entries rows at most
        new[r["part"], r["entry"]] = np.array(r[2:-1]) // r["n"]
    return new


def _assign(table: DataFrame, books: np.ndarray) -> DataFrame:
    """row, part, code and squared distance of every row of every block."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, n, _, ids, rows, names in _walk(batches, books):
            own, far = nearest_entries(rows, books[p], names)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, "<i8")), pa.array(np.full(n, p, np.int32)),
                                              pa.array(own.astype(np.int32)), pa.array(far)], names=["row", "part", "code", "far"])

    return table.mapInArrow(codes, "row long, part int, code int, far long")


@dataclass(frozen=True)
class Codec:
    """Codebooks (parts x entries x components) and the integer scale they were made at."""

    books: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def decode(self, code: bytes) -> list[float]:
        """The vector that a code (one byte for each part) stands for."""
        return (np.concatenate([self.books[p, c] for p, c in enumerate(code)]) / SCALE).tolist()


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codec | None]:
    """row, vec_id, label, code (binary, a byte for each part) and error of every kept row, and the codec (None without rows)."""
    if entries > 256:
        raise ValueError("a code is one byte for each part")
    rows = scaled(table, id_col, vector_col, label_col)
    sizes = rows.select(F.min(F.size("v")), F.max(F.size("v"))).first()
    empty = rows.select("row", "vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
    if sizes[0] is None:
        return empty, None
    if sizes[0] != sizes[1] or sizes[0] % parts:
        raise ValueError(f"vectors have {sizes[0]} to {sizes[1]} components; {parts} equal parts need one length they divide")
    width = sizes[0] // parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    table = blocks(rows, parts, width)
    for _ in range(rounds):
        books = _round(table, books)
    codes = F.concat(*[F.unhex(F.lpad(F.hex(F.max(F.when(F.col("part") == p, F.col("code")))), 2, "0")) for p in range(parts)])
    coded = _assign(table, books).groupBy("row").agg(codes.alias("code"), F.sum("far").alias("error"))
    return rows.select("row", "vec_id", "label").join(coded, "row").select("row", "vec_id", "label", "code", "error"), Codec(books)


def digest(table: DataFrame) -> DataFrame:
    """vec_id, code in hex, error, error summed over the label (nulls together) and the hash of all entries."""
    coded, codec = compress(table)
    coded = shared_table(coded.withColumn("group", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))),
                         "codes")
    groups = shared_table(coded.groupBy("group").agg(F.count("*").alias("n"), F.sum("error").alias("label_error")), "labels")
    return join_groups(coded, groups, "group", coded.count()).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codec.sha256 if codec else None).cast("string").alias("codebooks_sha256"))


def _sql() -> str:
    """The same rows in DuckDB: all distances, one statement for each round."""
    rounds = []
    for r in range(ROUNDS + 1):
        rounds.append(f"""
a{r} AS MATERIALIZED (
  SELECT v.row, v.p, min(CAST(v.vv - 2 * list_inner_product(v.x, c.x) + c.cc AS BIGINT) * {ENTRIES} + c.i) AS best
  FROM parts v JOIN c{r} c USING (p) GROUP BY v.row, v.p)""")
        if r < ROUNDS:
            rounds.append(f"""
m{r} AS (
  SELECT p, i, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT a.p, a.best % {ENTRIES} AS i, unnest(v.x) AS x, unnest(range(len(v.x))) AS d
        FROM a{r} a JOIN parts v USING (row, p)) GROUP BY p, i, d),
u{r} AS (SELECT p, i, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY d) AS x FROM m{r} GROUP BY p, i),
c{r + 1} AS MATERIALIZED (
  SELECT p, i, x, list_inner_product(x, x) AS cc
  FROM (SELECT c.p, c.i, coalesce(u.x, c.x) AS x FROM c{r} c LEFT JOIN u{r} u USING (p, i)))""")
    body = ",".join(rounds)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS q
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT row, p, x, list_inner_product(x, x) AS vv
  FROM (SELECT row, p, q[p * (len(q) // {PARTS}) + 1:(p + 1) * (len(q) // {PARTS})] AS x FROM kept, range({PARTS}) t(p))),
c0 AS MATERIALIZED (SELECT p, row - 1 AS i, x, vv AS cc FROM parts WHERE row <= {ENTRIES}),{body},
coded AS (
  SELECT row, string_agg(lpad(lower(to_hex(best % {ENTRIES})), 2, '0'), '' ORDER BY p) AS code,
         CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY row),
book AS (
  SELECT sha256(string_agg(array_to_string(list_transform(x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ','), ','
                           ORDER BY p, i)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (row), book
"""


SQL = _sql()
