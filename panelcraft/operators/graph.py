"""Nearest-neighbour graphs of respondents, exact and without comparing all pairs.

Equal rows are merged first: rows with one answer pattern share their neighbours, and of a pattern only its k + 1
smallest ids can be anybody's neighbour. Patterns are then dealt to the nearest of a set of pivots and written once into
the shared folder, in blocks of one cell and one range of distances from its pivot. A task takes blocks of askers and reads the blocks
of members in turn, near ones first: the triangle inequality (the pivot scheme for kNN joins of Lu et al., VLDB 2012) and what
was found so far tell which blocks can be left out. No pattern is written more than once, and a task holds a chunk of askers and
one block of members, however skewed the cells are.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut_lineage, shared_place
from .batch import no_gaps, unpacked

MAX_PIVOTS = 512
BLOCK_ROWS = 1024
ASKERS = 4096
#: Numbers of one block of members, members met and pairs compared at once.
BLOCK_NUMBERS = 1 << 20
MEMBERS = 1024
PAIRS = 1 << 21
#: Bytes of patterns with copies that are broadcast to find the rows of each.
COPIED_BYTES = 8 << 20
DIGITS = 9  # distances are compared at this many decimals
SLACK = 1e-8


@dataclass(frozen=True)
class Space:
    """How far two rows are apart: ``gower``, ``euclidean`` or ``cosine`` over numeric columns and codes."""

    metric: str
    n_numeric: int
    n_codes: int

    def between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        p = self.n_numeric
        if self.metric == "gower":
            out = np.zeros((len(x), len(y)))
            for j in range(p):
                out += np.abs(x[:, j][:, None] - y[None, :, j])
            for j in range(p, p + self.n_codes):
                out += x[:, j][:, None] != y[None, :, j]
            return out / (p + self.n_codes)
        out = np.zeros((len(x), len(y)))
        for j in range(p):
            out += (x[:, j][:, None] - y[None, :, j]) ** 2
        return np.sqrt(out)


def _prepare(df: DataFrame, id_col: str, numeric: list[str], codes: list[str], metric: str,
             by: str | None) -> DataFrame:
    """(id, grp, x): features as one array, ranged for Gower, of unit length for cosine."""
    if metric not in ("gower", "euclidean", "cosine"):
        raise ValueError("metric is 'gower', 'euclidean' or 'cosine'")
    exprs = [F.col(c).cast("double") for c in numeric]
    if metric == "gower" and numeric:
        row = df.agg(*[f(F.col(c).cast("double")).alias(f"{t}{i}") for i, c in enumerate(numeric)
                       for t, f in (("a", F.min), ("b", F.max))]).first()
        exprs = [(e - row[f"a{i}"]) / ((row[f"b{i}"] - row[f"a{i}"]) or 1.0) for i, e in enumerate(exprs)]
    elif metric == "euclidean":
        exprs += [F.col(c).cast("double") for c in codes]
        codes = []
    exprs += [F.col(c).cast("double") for c in codes]
    group = F.col(by).cast("string") if by else F.lit("")
    rows = df.select(F.col(id_col).alias("id"), group.alias("grp"), F.array(*exprs).alias("x"))
    if metric == "cosine":
        length = F.greatest(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)), F.lit(1e-12))
        rows = rows.withColumn("n", length).withColumn("x", F.transform("x", lambda v: v / F.col("n"))).drop("n")
    return rows


def nearest(df: DataFrame, k: int, id_col: str = "id", numeric: list[str] | None = None, codes: list[str] | None = None,
            metric: str = "gower", by: str | None = None, across: bool = False) -> DataFrame:
    """(src, dst, d, rn[, src_group, dst_group]): the k nearest other rows of each row, ties to the smaller id.

    ``by`` restricts neighbours to the row's own group; ``across`` asks for k in every group instead.
    Missing values raise: a row without neighbours would be lost to what is built on them.
    """
    s = _search(df, k, id_col, numeric, codes, metric, by, across)
    found = s.edges(s.owner).select("src", "dst", "d", "rn", "src_group", F.col("target").alias("dst_group"))
    return found if by else found.drop("src_group", "dst_group")


@dataclass
class _Found:
    """``merged``: grp, x, rep of every pattern; ``owner``: id, grp, rep of every row; ``lists``: rep, target and the k + 1 nearest rows."""

    merged: DataFrame
    owner: DataFrame
    lists: DataFrame
    k: int

    def edges(self, some: DataFrame) -> DataFrame:
        """The k nearest other rows of each row of ``some`` (id, grp, rep; other columns stay)."""
        kept = [c for c in some.columns if c not in ("id", "grp")]
        return (some.join(self.lists, "rep")
                .select(F.col("id").alias("src"), F.col("grp").alias("src_group"), "target", *kept,
                        F.posexplode(F.slice(F.filter("near", lambda e: e["dst"] != F.col("id")), 1, self.k)).alias("rn", "e"))
                .select("src", F.col("e.dst").alias("dst"), F.col("e.d").alias("d"), (F.col("rn") + 1).alias("rn"),
                        "src_group", "target", *kept))


def _search(df: DataFrame, k: int, id_col: str, numeric: list[str] | None, codes: list[str] | None, metric: str,
            by: str | None = None, across: bool = False) -> _Found:
    numeric, codes = list(numeric or []), list(codes or [])
    no_gaps(df, [*numeric, *codes])
    rows = _prepare(df, id_col, numeric, codes, metric, by)
    n_codes = len(codes) if metric == "gower" else 0
    space = Space(metric, len(numeric) + len(codes) - n_codes, n_codes)
    keys = ["grp", "x"]
    merged = rows.groupBy(*keys).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    merged = merged.persist()
    n_patterns = merged.count()
    if n_patterns == 0:
        raise ValueError("no rows")
    n_pivots = min(MAX_PIVOTS, max(1, math.isqrt(n_patterns)))
    picked = merged.select(F.xxhash64("rep").alias("h"), "rep", "x").orderBy("h", "rep").limit(n_pivots).collect()
    pivots = np.array([r["x"] for r in picked], dtype=float)

    def to_cell(batches):
        for batch in batches:
            d = space.between(unpacked(batch, "x"), pivots)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                names=[*batch.schema.names, "cell", "away"])

    kind = merged.schema["rep"].dataType.simpleString()
    placed = merged.mapInArrow(to_cell, f"grp string, x array<double>, rep {kind}, copies long, cell int, away double")
    links = _pattern_links(placed, pivots, space, k, across)

    # From patterns back to ids. Only the k + 1 smallest ids of a pattern can be neighbours.
    copied = broadcast_if_small(merged.filter("copies > 1").select(*keys, "rep"), COPIED_BYTES // (8 * len(pivots[0]) + 16))
    owner = (merged.filter("copies = 1").select(F.col("rep").alias("id"), "grp", "rep")
             .unionByName(rows.join(copied, keys).select("id", "grp", "rep")))
    smallest = Window.partitionBy("rep").orderBy("id")
    members = (owner.withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= k + 1)
               .select(F.col("rep").alias("other"), F.col("id").alias("dst")))
    order = Window.partitionBy("rep", "target").orderBy("d", "dst")
    lists = (links.join(members, "other").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
             .groupBy("rep", "target").agg(F.array_sort(F.collect_list(F.struct("d", "dst"))).alias("near")))
    return _Found(merged, owner, lists, k)


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


@dataclass(frozen=True)
class Block:
    """Where the patterns of one group and cell, at distances low to high from its pivot, lie in a file."""

    grp: str
    cell: int
    low: float
    high: float
    rows: int
    ids: int
    path: str
    at: int
    bytes: int


def read_blocks(blocks: list[Block], files: dict) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Rows, representatives and copies; ``files`` holds the files that are open."""
    parts = []
    for b in blocks:
        if b.path not in files:
            store, name = open_store(b.path)
            files[b.path] = store.open_input_file(name)
        with pa.ipc.open_stream(files[b.path].read_at(b.bytes, b.at)) as reader:
            parts.append(reader.read_next_batch())
    x = np.concatenate([p.column(0).flatten().to_numpy().reshape(p.num_rows, -1).astype(float) for p in parts])
    return x, pa.concat_arrays([p.column(1) for p in parts]), np.concatenate([p.column(2).to_numpy() for p in parts])


def write_blocks(placed: DataFrame, folder: str, most: int, need: int) -> list[Block]:
    """The patterns in blocks of at most ``most`` rows; those of attempts that were lost are listed nowhere."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, path, held, at = None, f"{folder}/{uuid.uuid4().hex}", [], 0

        def blocks(last: bool) -> Iterator[dict]:
            nonlocal file, at
            table = pa.Table.from_batches(held)
            cell, grp = table["cell"].to_numpy(), table["grp"].combine_chunks().dictionary_encode()
            grp = (grp.combine_chunks() if isinstance(grp, pa.ChunkedArray) else grp).indices.to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(grp) != 0)) + 1).tolist(), len(cell)]
            kept = len(cell)
            for start, stop in zip(edges, edges[1:]):
                for begin in range(start, stop, most):
                    end = min(begin + most, stop)
                    if end == len(cell) and not last:
                        kept = begin
                        break
                    rows = table.slice(begin, end - begin).combine_chunks().to_batches()[0]
                    x = unpacked(rows, "x")
                    short = x.astype(np.float32)
                    if (short == x).all():
                        x = short
                    own = pa.RecordBatch.from_arrays(
                        [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]), rows.column(rows.schema.get_field_index("rep")),
                         rows.column(rows.schema.get_field_index("copies"))], names=["x", "rep", "copies"])
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, own.schema) as writer:
                        writer.write_batch(own)
                    raw = sink.getvalue()
                    if file is None:
                        store, name = open_store(path)
                        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                        file = store.open_output_stream(name, compression=None)
                    file.write(raw)
                    away = table["away"]
                    yield {"grp": table["grp"][begin].as_py(), "cell": int(cell[begin]), "low": away[begin].as_py(), "high": away[end - 1].as_py(),
                           "rows": end - begin, "ids": int(np.minimum(own.column(2).to_numpy(), need).sum()), "path": path, "at": at, "bytes": raw.size}
                    at += raw.size
            held[:] = table.slice(kept).to_batches() if kept < len(cell) else []

        schema = pa.schema([("grp", pa.string()), ("cell", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("rows", pa.int64()), ("ids", pa.int64()), ("path", pa.string()),
                            ("at", pa.int64()), ("bytes", pa.int64())])
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(map(len, held)) > 2 * most:
                yield pa.RecordBatch.from_pylist([*blocks(False)], schema)
        if held:
            yield pa.RecordBatch.from_pylist([*blocks(True)], schema)
        if file is not None:
            file.close()

    ordered = placed.select("grp", "cell", "away", "rep", "copies", "x").repartitionByRange("grp", "cell", "away") \
        .sortWithinPartitions("grp", "cell", "away")
    listed = ordered.mapInArrow(write, "grp string, cell int, low double, high double, rows long, ids long, path string, at long, bytes long").collect()
    return sorted((Block(*r) for r in listed), key=lambda b: (b.grp, b.cell, b.low, b.path, b.at))


def _keys(reps: pa.Array) -> np.ndarray:
    """Values in the order of the ids, which break ties."""
    if pa.types.is_integer(reps.type):
        return reps.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False) if reps.type == pa.int64() else reps.cast(pa.int64()).fill_null(-(1 << 63)).to_numpy()
    some = reps.to_pylist()
    least = min((v for v in some if v is not None), default=None)
    return np.array([(v is not None, least if v is None else v) for v in some] + [None], dtype=object)[:-1]


class _Askers:
    """Some patterns, and the ``need`` nearest patterns of one group that each has met so far."""

    def __init__(self, x: np.ndarray, space: Space, pivots: np.ndarray, to_pivots: np.ndarray, need: int):
        self.x, self.space, self.need, self.to_pivots = x, space, need, to_pivots
        self.bound, self.full = np.full(len(x), np.inf), np.zeros(len(x), bool)
        self.asker, self.d = np.zeros(0, np.int64), np.zeros(0)
        self.other, self.copies = None, np.zeros(0, np.int64)
        self.middle = pivots.mean(0)

    def ask(self, sides: list[Block], files: dict) -> None:
        """Meet the patterns of all blocks that may hold near ones, likely ones first."""
        cell, low, high = np.array([b.cell for b in sides]), np.array([b.low for b in sides]), np.array([b.high for b in sides])
        some = np.array([b.ids >= self.need for b in sides])
        if some.any():
            ends = np.full(self.to_pivots.shape[1], np.inf)
            np.minimum.at(ends, cell[some], high[some])
            self.bound = (self.to_pivots + ends).min(1) + SLACK  # distances found are rounded
        middle = self.to_pivots.mean(0)[cell]
        order = np.argsort(np.maximum(middle - high, low - middle), kind="stable")
        part = np.cumsum([sides[j].rows for j in order]) // MEMBERS
        for batch in np.split(order, np.flatnonzero(np.diff(part)) + 1):
            d = self.to_pivots[:, cell[batch]]
            near = np.maximum(d - high[batch], low[batch] - d) <= self.bound[:, None] + SLACK
            who, met = np.flatnonzero(near.any(1)), batch[near.any(0)]
            if len(who):
                self.meet(who, *read_blocks([sides[j] for j in met], files))

    def meet(self, who: np.ndarray, y: np.ndarray, reps: pa.Array, copies: np.ndarray) -> None:
        step = max(1, PAIRS // len(y))
        found = [self._near(who[at:at + step], y) for at in range(0, len(who), step)]
        asker, at, d = (np.concatenate(c) for c in zip(*found))
        if not len(asker):
            return
        met, back = np.unique(at, return_inverse=True)
        some = reps.take(pa.array(met))
        other = some if self.other is None else pa.concat_arrays([self.other, some])
        place = np.concatenate([np.arange(len(self.asker)), len(self.asker) + back]) if self.other is not None else back
        asker, d = np.concatenate([self.asker, asker]), np.concatenate([self.d, d])
        n = np.concatenate([self.copies, copies[at]])
        key = _keys(other)[place]
        if key.dtype == object:
            key = np.unique(key, return_inverse=True)[1]
        order = np.lexsort((key, d, asker))
        asker, d, n, place = asker[order], d[order], n[order], place[order]
        first = np.searchsorted(asker, asker, "left")
        rank = np.arange(len(asker)) - first
        kept = rank < self.need
        asker, d, n, place, rank, first = asker[kept], d[kept], n[kept], place[kept], rank[kept], first[kept]
        seen = np.cumsum(np.minimum(n, self.need))
        start = np.searchsorted(asker, asker, "left")
        seen = seen - (seen - np.minimum(n, self.need))[start]
        full = seen >= self.need
        enough = np.full(len(self.bound), np.inf)
        np.minimum.at(enough, asker[full], d[full])
        self.bound = np.minimum(self.bound, enough)
        kept = d <= self.bound[asker]
        self.asker, self.d, self.copies = asker[kept], d[kept], n[kept]
        self.other = other.take(pa.array(place[kept]))

    def _near(self, who: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(asker, row of y, distance) of all pairs that may be among the nearest."""
        x = self.x[who]
        if self.space.metric == "gower":
            d = np.round(self.space.between(x, y), DIGITS)
            bound = self._sharpened(who, lambda n: np.partition(d, n - 1, axis=1)[:, n - 1], len(y))
            a, b = np.nonzero(d <= bound[:, None])
            return who[a], b, d[a, b]
        # one product in single precision tells which pairs are worth an exact distance
        u, v = x - self.middle, y - self.middle
        nu, nv = (u * u).sum(1), (v * v).sum(1)
        most = nu.max() + nv.max()
        kind = np.float32 if most < 1e30 else np.float64
        slack = (2 * u.shape[1] + 16) * float(np.finfo(kind).eps) * most + 1e-35
        product = np.column_stack([u, np.ones(len(u))]).astype(kind) @ np.column_stack([v, -nv / 2]).astype(kind).T

        def least(n: int) -> np.ndarray:
            best = np.argpartition(product, len(y) - n, axis=1)[:, len(y) - n:]
            return self._exact(np.repeat(x, n, axis=0), y[best.ravel()]).reshape(-1, n).max(1)

        bound = self._sharpened(who, least, len(y)) + SLACK
        a, b = np.nonzero(~(product < ((nu - bound ** 2 - slack) / 2 - 1e-35).astype(kind)[:, None]))
        d = np.concatenate([self._exact(x[a[at:at + 65536]], y[b[at:at + 65536]]) for at in range(0, len(a), 65536)] or [np.zeros(0)])
        kept = d <= bound[a]
        return who[a[kept]], b[kept], d[kept]

    def _sharpened(self, who, least, n: int) -> np.ndarray:
        """Bounds of ``who``; where some rest on pivots alone, the nearest of these patterns give better ones."""
        if n >= self.need and not self.full[who].all():
            self.bound[who] = np.minimum(self.bound[who], least(self.need))
            self.full[who] = True
        return self.bound[who]

    def _exact(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        d = x - y
        d *= d
        return np.round(np.sqrt(d.sum(1)), DIGITS)


def _pattern_links(placed: DataFrame, pivots: np.ndarray, space: Space, k: int, across: bool) -> DataFrame:
    """(rep, target, other, d): for each pattern and target group its nearest patterns, itself included, k + 1 of them or
    fewer that stand for as many ids."""
    spark, need, kind = placed.sparkSession, k + 1, placed.schema["rep"].dataType.simpleString()
    folder = f"{shared_place(spark)}/blocks"
    most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, len(pivots[0]))))
    blocks = write_blocks(placed, folder, most, need)
    shared = spark.sparkContext.broadcast((blocks, pivots))  # a line for each block
    groups = sorted({b.grp for b in blocks})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (blocks, pivots), files = shared.value, {}
        sides = {g: [b for b in blocks if b.grp == g] for g in groups}
        chunks: list[list[Block]] = []
        for i in (i for batch in batches for i in batch.column(0).to_pylist()):
            held = chunks[-1] if chunks else []
            if not held or sum(b.rows for b in held) + blocks[i].rows > ASKERS or not across and held[0].grp != blocks[i].grp:
                chunks.append([])
            chunks[-1].append(blocks[i])
        for chunk in chunks:
            x, reps, _ = read_blocks(chunk, files)
            to_pivots = np.concatenate([space.between(x[at:at + 512], pivots) for at in range(0, len(x), 512)])
            for target in groups if across else [chunk[0].grp]:
                askers = _Askers(x, space, pivots, to_pivots, need)
                askers.ask(sides[target], files)
                yield pa.RecordBatch.from_arrays(
                    [reps.take(pa.array(askers.asker)), pa.array([target] * len(askers.asker), pa.string()), askers.other, pa.array(askers.d)],
                    names=["rep", "target", "other", "d"])

    tasks = max(1, min(len(blocks), max(4 * spark.sparkContext.defaultParallelism, sum(b.rows for b in blocks) // (4 * ASKERS))))
    pairs = spark.range(0, len(blocks), 1, tasks).mapInArrow(run, f"rep {kind}, target string, other {kind}, d double")
    best = Window.partitionBy("rep", "target").orderBy("d", "other")  # a representative may stand for more than one pattern
    links = cut_lineage(pairs.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= need).drop("r"))
    store, name = open_store(folder)
    store.delete_dir(name)
    return links


# --- weights ----------------------------------------------------------------------------------------------


def weigh(edges: DataFrame, mode: str = "heat_kernel", t: float = 1.0, metric: str = "gower") -> DataFrame:
    """Weight of each edge: 1, exp(-d^2 / 2t^2), or the cosine."""
    d = F.col("d")
    if mode == "binary":
        w = F.lit(1.0)
    elif mode == "heat_kernel":
        w = F.exp(-d * d / (2.0 * t * t))
    elif mode == "cosine":
        w = 1.0 - d * d / 2.0
    else:
        raise ValueError("mode is 'binary', 'heat_kernel' or 'cosine'")
    return edges.withColumn("w", w)


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge with the larger of the two weights (an absent one counts as 0)."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    return (edges.select("src", "dst", "w").unionByName(back).groupBy("src", "dst").agg(F.max("w").alias("w")))


def with_loops(edges: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Adds every row as its own neighbour with weight 1."""
    return edges.unionByName(ids.select(F.col(id_col).alias("src"), F.col(id_col).alias("dst"), F.lit(1.0).alias("w")))


def affinity(df: DataFrame, k: int, id_col: str = "id", numeric: list[str] | None = None, codes: list[str] | None = None,
             metric: str = "gower", t: float = 1.0, mode: str = "heat_kernel") -> DataFrame:
    return symmetric(weigh(nearest(df, k, id_col, numeric, codes, metric), mode, t))


class CodedGraph:
    """The symmetric heat kernel graph of coded rows (Gower) with few nodes where many rows are equal.

    Of a pattern only its k + 1 smallest ids are anybody's neighbour. All its other rows have the same neighbours and are
    nobody's, so they are one node that stands for them. Nodes: ``node``, the pattern ``rep``, the ids and rows it stands for.
    """

    def __init__(self, df: DataFrame, k: int, codes: list[str], id_col: str = "id", t: float = 1.0):
        self.codes, self.k = list(codes), k
        found = _search(df, k, id_col, None, codes, "gower")
        self.patterns = found.merged.select("rep", "x")
        self.held = found.owner.filter(F.col("id").isNotNull()).groupBy("rep", "id").agg(F.count(F.lit(1)).alias("rows")).persist()
        smallest = Window.partitionBy("rep").orderBy("id")
        alone = self.held.withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= k + 1).drop("r")
        last = alone.groupBy("rep").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k + 1)
        self.others = self.held.join(broadcast_if_small(last.select("rep", "last")), "rep").filter(F.col("id") > F.col("last")).drop("last")
        self.alone = alone
        rest = self.others.groupBy("rep").agg(F.count(F.lit(1)).alias("ids"), F.sum("rows").alias("rows"))
        of_row, of_rest = F.struct(F.lit(0).alias("kind"), F.col("id").alias("id")), F.struct(F.lit(1).alias("kind"), F.col("rep").alias("id"))
        self.of_row, self.of_rest = of_row, of_rest
        self.nodes = cut_lineage(alone.select(of_row.alias("node"), "rep", F.lit(1).cast("long").alias("ids"), "rows")
                                 .unionByName(rest.select(of_rest.alias("node"), "rep", "ids", "rows")))
        rows = found.edges(alone.select("id", F.lit("").alias("grp"), "rep"))
        near = rest.join(found.lists, "rep").select(of_rest.alias("src"), F.posexplode(F.slice("near", 1, k)).alias("rn", "e"))
        edges = (rows.select(F.struct(F.lit(0).alias("kind"), F.col("src").alias("id")).alias("src"), "dst", "d", "rn")
                 .unionByName(near.select("src", F.col("e.dst").alias("dst"), F.col("e.d").alias("d"), F.col("rn") + 1)
                              .toDF("src", "dst", "d", "rn")))
        edges = edges.filter(F.col("dst").isNotNull()).withColumn("dst", F.struct(F.lit(0).alias("kind"), F.col("dst").alias("id")))
        self._edges = cut_lineage(weigh(edges, t=t))

    def first(self, n: int) -> CodedGraph:
        """The graph of the n nearest rows of each row, n <= k."""
        out = copy(self)
        out.k = n
        return out

    def edges(self) -> DataFrame:
        """src, dst, w between nodes: the weight of each row of src to each row of dst."""
        return symmetric(self._edges.filter(F.col("rn") <= self.k))

    def links(self) -> DataFrame:
        """a, b, w: the summed weights between the rows of two patterns."""
        nodes = self.nodes
        return (self.edges().join(nodes.select(F.col("node").alias("src"), F.col("rep").alias("a"), F.col("rows").alias("na")), "src")
                .join(nodes.select(F.col("node").alias("dst"), F.col("rep").alias("b"), F.col("rows").alias("nb")), "dst")
                .groupBy("a", "b").agg(F.sum(F.col("w") * F.col("na") * F.col("nb")).alias("w")))

    def values(self, features: list[str]) -> DataFrame:
        """rep, x: the codes of ``features`` of every pattern."""
        return self.patterns.select("rep", F.array(*[F.col("x")[self.codes.index(f)] for f in features]).alias("x"))

    def sums(self, columns: list) -> DataFrame:
        """node, z: sums over the ids that each node stands for of what ``columns`` make of ``id``."""
        z = [c.cast("double") for c in columns]
        rest = self.others.groupBy("rep").agg(F.array(*[F.sum(c) for c in z]).alias("z"))
        return self.alone.select(self.of_row.alias("node"), F.array(*z).alias("z")).unionByName(rest.select(self.of_rest.alias("node"), "z"))


def relief_weights(df: DataFrame, k: int, by: str, id_col: str = "id", numeric: list[str] | None = None,
                   metric: str = "euclidean") -> DataFrame:
    """Supervised graph: 1 to itself, 1/k to the k nearest of the own class, and -1/((c-1)k) between rows that are
    among the k nearest of each other's class. A class of k rows or fewer uses its size less one."""
    near = nearest(df, k, id_col, numeric, None, metric, by=by, across=True).persist()
    own = F.col("src_group") == F.col("dst_group")
    sizes = df.groupBy(F.col(by).cast("string").alias("src_group")).agg(
        F.least(F.lit(k), F.count(F.lit(1)) - 1).alias("hits"))
    hits = near.filter(own).join(sizes, "src_group").select("src", "dst", (1.0 / F.col("hits")).alias("w"))
    n_classes = df.select(by).distinct().count()
    miss = near.filter(~own).select("src", "dst")
    mutual = miss.join(miss.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"])
    return with_loops(hits, df, id_col).unionByName(
        mutual.withColumn("w", F.lit(-1.0 / max((n_classes - 1) * k, 1))))


def fisher_groups(df: DataFrame, by: str) -> DataFrame:
    """The graph that links all rows of a class with weight 1/size is kept as its class sizes: its product with any
    column is the column's class mean, so its pairs are never written out."""
    return df.groupBy(F.col(by).alias("class")).agg(F.count(F.lit(1)).alias("n"), (1.0 / F.count(F.lit(1))).alias("w"))
