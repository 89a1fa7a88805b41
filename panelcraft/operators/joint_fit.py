"""Fits of several searches at once: over a whole table, or inside every branch of it.

``fit_together`` reads the rows once per iteration for all searches, whatever their kinds. A task returns one packed state, states
are added up in NODES groups, and the driver sees at most NODES of them. Where the columns of a search hold few different rows, these
are counted once, and all steps but the draws by key hash read the counted rows.

``fit_branches`` keeps one row of state for each branch in a table. Rows are laid out once, in blocks of one branch each, sorted
and range-partitioned by branch and key hash, so that a branch of any size is cut over as many parts as it needs. In a round every
part meets the states of its own branches; a branch that lies in one part is fitted there to its end, of the others each part returns
one packed state, and those are added up in a tree by branch. The number of jobs hangs on the longest fit, not on the number of
branches, and no value of the branch column, no model and no label reaches the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batch import PACKED, packed, unpacked
from .search import Search, merge

NODES = 32
BLOCK_ROWS = 4096
#: States of one branch that one task adds up.
STATES_AT_ONCE = 64
MAX_ROUNDS = 5_000
#: Equal rows are merged where the table has this many times as many rows as different ones; rows of them for a task.
MERGED_FROM, MERGED_ROWS = 4, 512
IGNORED_LABEL = -99


class Together:
    """Several searches as one: their states side by side under their names.

    With ``go_on`` a search that cannot be made (missing values, say) ends with the reason as its note; else it raises.
    """

    def __init__(self, searches: dict[str, Search], go_on: bool = False):
        self.searches, self.go_on = searches, go_on
        self.columns = list(dict.fromkeys(c for s in searches.values() for c in s.columns))

    @property
    def done(self) -> bool:
        return all(s.done for s in self.searches.values())

    def _own(self, s: Search, v: np.ndarray, columns: list[str] | None = None) -> np.ndarray:
        return v[:, [(columns or self.columns).index(c) for c in s.columns]]

    def expect(self, v: np.ndarray, w: np.ndarray, h: np.ndarray, names: list[str] | None = None, columns: list[str] | None = None) -> dict:
        """What the searches (those named, or all) ask of rows of ``columns`` (of all by default)."""
        out, known = {}, {}
        for name, s in self.searches.items():
            if not s.done and (names is None or name in names):
                like = s.asks_like
                if like is None or like not in known:
                    known[like] = s.expect(self._own(s, v, columns), w, h)
                out[name] = known[like]
        return out

    def update(self, total: dict) -> None:
        for name, s in self.searches.items():
            if not s.done:
                try:
                    s.update(total.get(name, {}))
                except ValueError as fault:
                    if not self.go_on:
                        raise
                    s.note, s.phase, s.model = str(fault), "done", None

    def label(self, name: str, v: np.ndarray) -> np.ndarray | None:
        return self.searches[name].label(self._own(self.searches[name], v))


def _hash(id_col: str) -> Column:
    return F.xxhash64(F.col(f"`{id_col}`")).alias("h")


def fit_together(df: DataFrame, searches: dict[str, Search], id_col: str = "id", weight: str | None = None,
                 go_on: bool = False) -> dict[str, Search]:
    """Move all searches to their ends. ``weight`` names a column of copies (rows that stand for several respondents)."""
    both = Together(searches, go_on)
    rows = df.select(packed(both.columns), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
                     F.lit(0).cast("long").alias("h") if id_col not in df.columns else _hash(id_col)).persist()

    n_parts = rows.rdd.getNumPartitions()
    merged = _merged(rows, both, n_parts)
    while not both.done:
        total: dict = {}
        live = [name for name, s in both.searches.items() if not s.done]
        plain = [name for name in live if name not in merged or both.searches[name].by_key]
        if plain:
            total |= _pass(rows, both, plain, both.columns, n_parts > NODES)
        for columns, table in {id(merged[n][1]): merged[n] for n in live if n not in plain}.values():
            total |= _pass(table, both, [n for n in live if n not in plain and merged[n][1] is table], columns, n_parts > NODES)
        both.update(total)
    for _, table in merged.values():
        table.unpersist()
    rows.unpersist()
    return searches


def _merged(rows: DataFrame, both: Together, n_parts: int) -> dict[str, tuple[list[str], DataFrame]]:
    """Columns and counted rows of every search whose columns hold few different rows and no gaps."""
    at = {name: tuple(both.columns.index(c) for c in s.columns) for name, s in both.searches.items()}
    sets = [i for i in dict.fromkeys(at.values()) if i]
    if not sets:
        return {}
    own = {i: [F.col(PACKED)[j] for j in i] for i in sets}
    gap = {i: F.exists(F.array(*own[i]), lambda x: x.isNull() | F.isnan(x)) for i in sets}
    found = rows.agg(F.count(F.lit(1)).alias("n"), *[f for k, i in enumerate(sets) for f in (
        F.approx_count_distinct(F.xxhash64(*own[i])).alias(f"d{k}"), F.coalesce(F.max(gap[i]), F.lit(True)).alias(f"g{k}"))]).first()
    tables = {}
    for k, i in enumerate(sets):
        if found[f"d{k}"] * MERGED_FROM <= found["n"] and not found[f"g{k}"]:
            parts = max(1, min(n_parts, found[f"d{k}"] // MERGED_ROWS))
            tables[i] = ([both.columns[j] for j in i], rows.groupBy(F.array(*own[i]).alias(PACKED)).agg(F.sum("w").alias("w")).repartition(parts)
                         .select(PACKED, "w", F.lit(0).cast("long").alias("h")).persist())
    return {name: tables[i] for name, i in at.items() if i in tables}


def _pass(rows: DataFrame, both: Together, names: list[str], columns: list[str], tree: bool) -> dict:
    """What the named searches ask of all rows, added up."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            if batch.num_rows:
                total = merge(total, both.expect(unpacked(batch, PACKED), batch.column(1).to_numpy(), batch.column(2).to_numpy(), names, columns))
        if total:
            yield _state(TaskContext.get().partitionId() % NODES, total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, dict] = {}
        for batch in batches:
            for node, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[node] = merge(total.get(node, {}), pickle.loads(state))
        for node, state in total.items():
            yield _state(node, state)

    states = rows.mapInArrow(task, "node int, state binary")
    if tree:  # fewer tasks than nodes have nothing to meet for
        states = states.repartition("node").mapInArrow(add, "node int, state binary")
    got = sorted(states.collect(), key=lambda r: r["node"])
    return reduce(merge, (pickle.loads(r["state"]) for r in got), {})


def _state(node: int, state: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([pickle.dumps(state, 5)], pa.binary())],
                                      names=["node", "state"])


# --- branches -------------------------------------------------------------------------------------------


def _blocks(df: DataFrame, branch: str, columns: list[str], id_col: str) -> DataFrame:
    """part, b, ids, h, x: blocks of at most BLOCK_ROWS rows of one branch. ``b`` is never null."""
    kind = df.schema[id_col].dataType.simpleString()
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{branch}`").cast("string")), F.lit("null")).alias("b")
    ordered = df.select(key, F.col(f"`{id_col}`").alias("i"), _hash(id_col), packed(columns)) \
        .repartitionByRange("b", "h").sortWithinPartitions("b", "h")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            x = np.ascontiguousarray(rows[PACKED].combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype="<f8")
            ids = rows["i"].combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([rows["b"][0].as_py()]), pa.ListArray.from_arrays([0, len(ids)], ids),
                 pa.array([rows["h"].to_numpy().astype("<i8").tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                names=["part", "b", "ids", "h", "x"])

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            names = table["b"].combine_chunks().dictionary_encode()
            codes = (names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names).indices.to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            kept = len(codes)
            for start, stop in zip(edges, edges[1:]):
                for at in range(start, stop, BLOCK_ROWS):
                    end = min(at + BLOCK_ROWS, stop)
                    if end == len(codes) and not last:
                        kept = at
                        break
                    yield block(table.slice(at, end - at))
            held[:] = table.slice(kept).to_batches() if kept < len(codes) else []

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) > 2 * BLOCK_ROWS:
                yield from blocks(False)
        if held:
            yield from blocks(True)

    return ordered.mapInArrow(cut, f"part int, b string, ids array<{kind}>, h binary, x binary")


def _rows_of(table: pa.Table, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    v = np.concatenate([np.frombuffer(table["x"][i].as_py(), "<f8").reshape(-1, width) for i in at.tolist()])
    h = np.concatenate([np.frombuffer(table["h"][i].as_py(), "<i8") for i in at.tolist()])
    return v, h


STATES = pa.schema([("b", pa.string()), ("alone", pa.bool_()), ("done", pa.bool_()), ("model", pa.binary())])
STATES_DDL = "b string, alone boolean, done boolean, model binary"


class Branches:
    """Fitted branches: ``labels`` (id, cluster) for one method, ``models`` (b, and what was chosen), rounds taken."""

    def __init__(self, blocks: DataFrame, states: DataFrame, members: DataFrame, order: DataFrame, width: int, rounds: int):
        self.blocks, self.states, self.members, self.order, self.width, self.rounds = blocks, states, members, order, width, rounds

    def summaries(self) -> DataFrame:
        """b, method, algorithm, n_clusters, cost, seed, note of every branch and method."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for b, model in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for name, s in pickle.loads(model).searches.items():
                        about = s.summary
                        out.append({"b": b, "method": name, **{k: about[k] for k in ("algorithm", "n_clusters", "cost", "seed", "note")}})
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("b", pa.string()), ("method", pa.string()), ("algorithm", pa.string()), ("n_clusters", pa.int32()),
                    ("cost", pa.float64()), ("seed", pa.int64()), ("note", pa.string())]))

        return self.states.select("b", "model").mapInArrow(
            rows, "b string, method string, algorithm string, n_clusters int, cost double, seed long, note string")

    def labels(self, method: str, ignored: list | None = None) -> DataFrame:
        """id and cluster of every row: labels of a branch follow those of the branches before it, in the order of their values.

        A branch without labels is one segment. Ignored branches are marked IGNORED_LABEL and take no labels.
        """
        width, kind = self.width, self.blocks.schema["ids"].dataType.elementType.simpleString()
        skip = [f"={v}" if v is not None else "null" for v in ignored or []]

        def local(table: pa.Table, states: pa.Table) -> Iterator[tuple]:
            names = np.array(table["b"].to_pylist(), dtype=object)
            for row in states.to_pylist():
                both = pickle.loads(row["model"])
                for i in np.flatnonzero(names == row["b"]).tolist():
                    v = np.frombuffer(table["x"][i].as_py(), "<f8").reshape(-1, width)
                    own = both.label(method, v)
                    yield row, table["ids"][i], np.zeros(len(v), np.int64) if own is None else own.astype(np.int64)

        def tops(table: pa.Table, states: pa.Table) -> pa.Table:
            best: dict[str, int] = {}
            for row, _, own in local(table, states):
                best[row["b"]] = max(best.get(row["b"], 0), int(own.max(initial=0)))
            return pa.table({"b": pa.array(list(best), pa.string()), "top": pa.array(list(best.values()), pa.int64())})

        def final(table: pa.Table, states: pa.Table) -> pa.Table:
            ids, out = [], []
            for row, own_ids, own in local(table, states):
                ids.append(own_ids.values)
                out.append(np.full(len(own), IGNORED_LABEL) if row["offset"] is None else own + row["offset"])
            schema = pa.schema([("id", table.schema.field("ids").type.value_type), ("cluster", pa.int32())])
            if not out:
                return schema.empty_table()
            return pa.table([pa.concat_arrays(ids), pa.array(np.concatenate(out).astype(np.int32))], schema=schema)

        blocks = self.blocks.groupBy("part")
        sent = self.members.join(self.states.select("b", "model"), "b")
        top = blocks.cogroup(sent.groupBy("part")).applyInArrow(tops, "b string, top long").groupBy("b").agg(F.max("top").alias("top"))
        sizes = top.join(self.order, "b").withColumn("width", F.when(F.col("b").isin(skip), 0).otherwise(F.col("top") + 1))
        offsets = running_total(sizes, "v", "width").select(
            "b", F.when(~F.col("b").isin(skip), F.col("before")).alias("offset"))
        sent = self.members.join(self.states.select("b", "model").join(offsets, "b"), "b").select("part", "b", "model", "offset")
        return blocks.cogroup(sent.groupBy("part")).applyInArrow(final, f"id {kind}, cluster int")

    def unpersist(self) -> None:
        self.blocks.unpersist()


def running_total(df: DataFrame, order: str, value: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over all rows that come earlier in ``order`` (unique, nulls first).

    Ranges of the order are summed apart and shifted by the totals of the ranges before them, one row for each range.
    """
    ranged = cut_lineage(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_total"))
    shifts = totals.withColumn("_shift", F.coalesce(F.sum("_total").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_range", "_shift")
    return ranged.withColumn("_own", F.coalesce(F.sum(value).over(earlier), F.lit(0))).join(shifts, "_range") \
        .withColumn("before", F.col("_own") + F.col("_shift")).drop("_range", "_own", "_shift")


def fit_branches(df: DataFrame, branch: str, searches: Callable[[], dict[str, Search]], id_col: str = "id") -> Branches:
    """Fit fresh searches inside every value of ``branch`` (null is a value of its own)."""
    columns = Together(searches()).columns
    width = len(columns)
    laid = cut_lineage(_blocks(df, branch, columns, id_col))
    found = laid.select(F.col("part").alias("part"), F.col("b").alias("b")).distinct()  # names of their own, for the joins below
    n_parts = laid.agg(F.max("part")).first()[0]
    blocks = laid.repartition((n_parts or 0) + 1, "part").sortWithinPartitions("part").persist()
    members = cut_lineage(found)
    order = df.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{branch}`").cast("string")), F.lit("null")).alias("b"),
                      F.col(f"`{branch}`").alias("v")).distinct()
    fresh = pickle.dumps(Together(searches()), 5)
    states = cut_lineage(members.groupBy("b").agg((F.count("*") == 1).alias("alone"))
                         .select("b", "alone", F.lit(False).alias("done"), F.lit(fresh).alias("model")))

    def advance(table: pa.Table, sent: pa.Table) -> pa.Table:
        names = np.array(table["b"].to_pylist(), dtype=object)
        out = {"b": [], "node": [], "model": [], "state": []}
        for row in sent.to_pylist():
            v, h = _rows_of(table, np.flatnonzero(names == row["b"]), width)
            both, w = pickle.loads(row["model"]), np.ones(len(v))
            if row["alone"]:
                while not both.done:
                    both.update(both.expect(v, w, h))
            out["b"].append(row["b"])
            out["node"].append(row["part"] // STATES_AT_ONCE)
            out["model"].append(pickle.dumps(both, 5) if row["alone"] else None)
            out["state"].append(None if row["alone"] else pickle.dumps(both.expect(v, w, h), 5))
        return pa.table([pa.array(out["b"], pa.string()), pa.array(out["node"], pa.int32()), pa.array(out["model"], pa.binary()),
                         pa.array(out["state"], pa.binary())], names=["b", "node", "model", "state"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = reduce(merge, (pickle.loads(x.as_py()) for x in table["state"]), {})
        return pa.table([pa.array([key[0].as_py()]), pa.array([pickle.dumps(total, 5)], pa.binary())], names=["b", "state"])

    def settle(states_of: pa.Table, total: pa.Table) -> pa.Table:
        out = []
        for row in states_of.to_pylist():
            both = pickle.loads(row["model"])
            both.update(reduce(merge, (pickle.loads(x.as_py()) for x in total["state"]), {}))
            out.append({**row, "done": both.done, "model": pickle.dumps(both, 5)})
        return pa.Table.from_pylist(out, STATES)

    rounds = 0
    while rounds < MAX_ROUNDS:
        open_ones = states.where("NOT done")
        sent = members.join(open_ones.select("b", "alone", "model"), "b").select("part", "b", "alone", "model")
        moved = cut_lineage(blocks.groupBy("part").cogroup(sent.groupBy("part"))
                            .applyInArrow(advance, "b string, node int, model binary, state binary"))
        whole = moved.where("model IS NOT NULL").select("b", F.lit(True).alias("alone"), F.lit(True).alias("done"), "model")
        nodes = moved.where("state IS NOT NULL").groupBy("b", "node").applyInArrow(add, "b string, state binary")
        shared = open_ones.where("NOT alone").groupBy("b").cogroup(nodes.groupBy("b")).applyInArrow(settle, STATES_DDL)
        states = cut_lineage(states.where("done").unionByName(whole).unionByName(shared))
        rounds += 1
        if states.where("NOT done").isEmpty():
            break
    return Branches(blocks, states, members, order, width, rounds)
