"""Links between vectors of equal label with a cosine at or above a threshold, by PCA-ordered tiles.

The Gram matrix of all unit vectors, summed in Spark, gives principal axes; coordinates along them come in descending
spread. Unit vectors with cosine >= t are at most sqrt(2 - 2t) apart, so in each of the two leading coordinates: a grid of
that width over them places the vectors, and only neighbouring cells are compared. A cell is dealt into blocks of bounded
size by a hash. For two blocks, products accumulate over the leading coordinates first; the rest is bounded by the product
of suffix norms, and a pair stops when sum plus bound cannot reach the threshold. Pairs that stay are decided by the
cosine in double precision of the original components.

Equal vectors of a label are one row with a count. A task returns link counts and a spanning forest, no pairs.

Defined results: a vector that is null, zero, or holds null or non-finite components, or has a null label, links with
nothing; vectors of different lengths are compared within their length only; rows with equal ids stay separate rows
(each counts as another vector), and a null id is never a component's name unless nothing else is reachable.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table
from .components import components, local_roots

THRESHOLD = 0.98
#: Rows of a block: with few rows blocks are small so that many tasks share the work; results do not depend on it.
BLOCK_LEAST, BLOCK_MOST = 128, 2_048
STEP = 8
#: Room for rounding in bounds, far above double precision's error and far below any gap that matters.
SLACK = 1e-9


def _packed(embedding) -> bytes | None:
    if embedding is None or any(x is None for x in embedding):
        return None
    v = np.asarray(embedding, dtype=np.float64)
    if not len(v) or not np.isfinite(v).all() or not v.any():
        return None
    return (v + 0.0).tobytes()  # -0.0 is 0.0


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length one, scaled first so that neither tiny nor huge components lose their squares."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """rep (a number), label, dim, v (doubles as bytes), n, least from row, vec_id, label, v."""
    return rows.where("v IS NOT NULL AND label IS NOT NULL").groupBy("label", "v").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"), F.min("row").alias("rep"))


def axes(reps: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes (columns, largest spread first) for each vector length; one matrix of each length on the driver."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, v in by_dim(batch.column(0).to_pylist()):
                u = unit(v)
                sums[dim] = sums.get(dim, 0) + u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                         names=["dim", "gram"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in batches:
            for dim, raw in zip(frame.dim, frame.gram):
                total[dim] = total.get(dim, 0) + np.frombuffer(raw)
        yield pd.DataFrame({"dim": list(total), "gram": [t.tobytes() for t in total.values()]})

    out = {}
    some = reps.select("v").mapInArrow(gram, "dim long, gram binary").coalesce(64).mapInPandas(add, "dim long, gram binary")
    for dim, raws in some.groupBy("dim").agg(F.collect_list("gram")).collect():  # 64 matrices at most of each length
        total = sum(np.frombuffer(r) for r in raws).reshape(dim, dim)
        out[dim] = np.linalg.eigh(total)[1][:, ::-1].copy()
    return out


def by_dim(raws: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.array([len(r) // 8 for r in raws])
    for dim in np.unique(sizes):
        yield int(dim), np.frombuffer(b"".join(r for r, s in zip(raws, sizes) if s == dim)).reshape(-1, dim)


def close(a: np.ndarray, b: np.ndarray, turn: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) with cosine(a[i], b[j]) >= threshold."""
    ua, ub = unit(a), unit(b)
    pa_, pb = ua @ turn, ub @ turn
    tail = lambda p: np.sqrt(np.maximum(0, np.cumsum((p * p)[:, ::-1], axis=1)[:, ::-1]))
    ta, tb = tail(pa_), tail(pb)
    step = min(STEP, a.shape[1])
    sums = pa_[:, :step] @ pb[:, :step].T
    rest = np.outer(ta[:, step], tb[:, step]) if step < a.shape[1] else 0
    i, j = np.nonzero(sums + rest >= threshold - SLACK)
    sums = sums[i, j]
    for at in range(step, a.shape[1], STEP):
        to = min(at + STEP, a.shape[1])
        sums = sums + (pa_[i, at:to] * pb[j, at:to]).sum(axis=1)
        rest = ta[i, to] * tb[j, to] if to < a.shape[1] else 0
        stay = sums + rest >= threshold - SLACK
        i, j, sums = i[stay], j[stay], sums[stay]
    cosine = (a[i] * b[j]).sum(axis=1) / np.sqrt((a[i] * a[i]).sum(axis=1) * (b[j] * b[j]).sum(axis=1))
    cosine = np.where(np.isfinite(cosine), cosine, (ua[i] * ub[j]).sum(axis=1))
    keep = cosine >= threshold
    return i[keep], j[keep]


def links(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
          label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    taken = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [_packed(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["vec_id", "label", "v"])

    rows = shared_table(taken.mapInArrow(packed, "vec_id long, label string, v binary")
                        .withColumn("row", F.monotonically_increasing_id()), "vectors")
    reps = shared_table(distinct_vectors(rows), "reps")
    turns = axes(reps)
    width = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for dim, v in by_dim(frame.v.tolist()):
                part = frame[frame.v.str.len() == 8 * dim]
                lead = np.floor(unit(v) @ turns[dim][:, :2] / width).astype(np.int64)
                if dim == 1:
                    lead = np.column_stack([lead, np.zeros(len(lead), np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.rep), pa.array(part.label), pa.array(np.full(len(part), dim)), pa.array(lead[:, 0]),
                     pa.array(lead[:, 1]), pa.array(part.v), pa.array(part.n)],
                    names=["rep", "label", "dim", "x", "y", "v", "n"])

    placed = reps.select("rep", "label", "v", "n").mapInArrow(cells, "rep long, label string, dim long, x long, y long, v binary, n long")
    total = reps.count()
    most = max(BLOCK_LEAST, min(BLOCK_MOST, total // 512))
    cell = ["label", "dim", "x", "y"]
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count("*") / most).cast("long").alias("blocks"))
    placed = shared_table(placed.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks")), "cells")
    key = F.struct(*cell, "block")
    blocks = placed.select(key.alias("a")).distinct()
    beside = blocks.select("a", F.explode(F.array([F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy"))
                                                   for dx in (-1, 0, 1) for dy in (-1, 0, 1)])).alias("by")) \
        .select("a", F.col("a.label").alias("label"), F.col("a.dim").alias("dim"), (F.col("a.x") + F.col("by.dx")).alias("x"),
                (F.col("a.y") + F.col("by.dy")).alias("y"))
    tiles = shared_table(beside.join(blocks.select("a.label", "a.dim", "a.x", "a.y", F.col("a").alias("b")), cell).where("a <= b")
                         .select("a", "b").withColumn("tile", F.monotonically_increasing_id()), "tiles")
    sides = placed.select(key.alias("a"), "rep", "n", "v")
    dealt = sides.join(tiles.select("a", "tile", (F.col("a") == F.col("b")).alias("same"), F.lit(True).alias("first")).union(
        tiles.where("a != b").select(F.col("b").alias("a"), "tile", F.lit(False), F.lit(False))), "a") \
        .select("tile", "same", "first", "rep", "n", "v")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        def side(part: pd.DataFrame) -> tuple:
            part = part.sort_values("rep")
            return part.rep.to_numpy(), part.n.to_numpy(), np.frombuffer(b"".join(part.v)).reshape(len(part), -1)

        same = bool(frame.same.iat[0])
        ra, na, a = side(frame[frame["first"]])
        rb, nb, b = (ra, na, a) if same else side(frame[~frame["first"]])
        i, j = close(a, b, turns[a.shape[1]], threshold)
        if same:
            i, j = i[i < j], j[i < j]
            rep, n = ra, np.bincount(i, na[j], len(ra)) + np.bincount(j, na[i], len(ra))
        else:
            rep = np.concatenate([ra, rb])
            n = np.concatenate([np.bincount(i, nb[j], len(ra)), np.bincount(j, na[i], len(rb))])
            j = j + len(ra)
        root = local_roots(len(rep), i, j)
        keep = n > 0
        return pd.DataFrame({"rep": rep[keep], "linked": n[keep].astype(np.int64), "root": rep[root[keep]]})

    found = shared_table(dealt.groupBy("tile").applyInPandas(compare, "rep long, linked long, root long"), "found")
    roots = components(found.where("rep != root").select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    rooted = reps.select("rep", "label", "v", "n", "least").join(linked, "rep", "left") \
        .join(roots.withColumnRenamed("id", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(lowest, "root").select(
        "label", "v", "component", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("links"))
    return rows.join(named, ["label", "v"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
