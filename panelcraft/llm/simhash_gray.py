"""SimHash fingerprints and near-duplicate groups by a hierarchical index in Gray order.

Distinct fingerprints are sorted by Gray rank (the number whose reflected Gray code the fingerprint is), so neighbours
share bits. The order is cut into blocks of bounded size; a block's upper node is the pattern that all its fingerprints
share (a mask and the bits under it), and inside a block groups of GROUP fingerprints have such nodes again. A difference
counted under a mask is a lower bound for the whole distance, so blocks, then fingerprints against blocks, then groups are
pruned as soon as the accumulated difference exceeds the limit. What is left is compared in full. Nothing is approximate.

A pair of blocks is one task's work, bounded on both sides; it returns a spanning forest of the links it found, never the
pairs. Equal fingerprints are one row from the start, so copies cost nothing. There are BLOCKS blocks at most, so the
directory of upper nodes (three numbers each) is bounded; blocks grow beyond that.

Defined results: null texts are empty; a text without words has fingerprint zero and links like any other; rows with a
null id take part and, where no id is reachable, have a null component; rows with equal ids stay separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_step, id_text, shared_table, texts_of
from .components import components, local_roots

WORDS = 3
MAX_BITS = 2
SEED = 42
BLOCK_ROWS = 2_048
BLOCKS = 4_096
GROUP = 64


def text_fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Bits set in over half the XXH64 hashes of the word shingles, repeats included."""
    found = text.encode("utf-8").lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])
    k = min(words, len(found))
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(line[a:b], seed) for a, b in zip(starts[:len(found) - k + 1].tolist(), (ends[k - 1:] - 1).tolist())],
                      dtype="<u8")
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as long), text_hash (of the text, null as null) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("text_hash", pa.int64())])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([text_fingerprint(t, words) for t in texts_of(batch.column(1))], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64)), batch.column(2)], schema=schema)

    return id_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")) \
        .mapInArrow(arrow_step(step, 1), "doc_id long, fp long, text_hash long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def shared_bits(values: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Mask of the bits that all values share, and those bits."""
    all_, any_ = np.bitwise_and.reduce(values), np.bitwise_or.reduce(values)
    return ~(all_ ^ any_), all_


def close_pairs(a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) with a[i] and b[j] at most ``max_bits`` apart, through the groups of b (in Gray order)."""
    left, right = [], []
    cuts = range(0, len(b), GROUP)
    nodes = [shared_bits(b[at:at + GROUP]) for at in cuts]
    for at, (mask, value) in zip(cuts, nodes):
        near = np.flatnonzero(np.bitwise_count((a ^ value) & mask) <= max_bits)
        if len(near):
            i, j = np.nonzero(np.bitwise_count(a[near, None] ^ b[None, at:at + GROUP]) <= max_bits)
            left.append(near[i])
            right.append(j + at)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """src, dst: a spanning forest of the fingerprints (column fp, distinct) at most ``max_bits`` apart."""
    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = gray_rank(batch.column(0).to_numpy().view(np.uint64)) ^ np.uint64(1 << 63)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rank.view(np.int64))], names=["fp", "rank"])

    table = shared_table(distinct.select("fp").mapInArrow(ranked, "fp long, rank long"), "gray")
    n_blocks = max(1, min(BLOCKS, -(-table.count() // block_rows)))
    cuts = np.array(sorted(set(table.select(F.col("rank").cast("double")).approxQuantile(
        "rank", [k / n_blocks for k in range(1, n_blocks)], 0.2 / n_blocks)))) if n_blocks > 1 else np.zeros(0)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.searchsorted(cuts, batch.column(1).to_numpy().astype(float), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), batch.column(0)], names=["block", "fp"])

    placed = table.mapInArrow(blocks, "block int, fp long")
    nodes = placed.groupBy("block").agg(F.bit_and("fp").alias("all"), F.bit_or("fp").alias("any")).collect()  # <= BLOCKS rows
    ids = np.array([r["block"] for r in nodes], np.int32)
    value = np.array([r["all"] for r in nodes], np.int64).view(np.uint64)
    mask = ~(value ^ np.array([r["any"] for r in nodes], np.int64).view(np.uint64))
    near = [np.flatnonzero(np.bitwise_count((value ^ value[k]) & mask & mask[k]) <= max_bits) for k in range(len(ids))]
    at = {int(b): k for k, b in enumerate(ids)}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A fingerprint goes to every pair of its block with a block whose node is near enough."""
        for batch in batches:
            block, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for own in np.unique(block):
                rows, k = fp[block == own], at[int(own)]
                for other in near[k]:
                    some = rows[np.bitwise_count((rows.view(np.uint64) ^ value[other]) & mask[other]) <= max_bits]
                    if len(some):
                        low, high = sorted((int(own), int(ids[other])))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), low, np.int32)), pa.array(np.full(len(some), high, np.int32)),
                             pa.array(np.full(len(some), own == low)), pa.array(some)], names=["low", "high", "first", "fp"])

    def forest(frame: pd.DataFrame) -> pd.DataFrame:
        def side(rows: pd.Series) -> np.ndarray:
            values = rows.to_numpy().view(np.uint64)
            return values[np.argsort(gray_rank(values))]

        a = side(frame.fp[frame["first"]])
        b = a if frame.low.iat[0] == frame.high.iat[0] else side(frame.fp[~frame["first"]])
        if not len(a) or not len(b):
            return pd.DataFrame({"src": [], "dst": []}, dtype=np.int64)
        i, j = close_pairs(a, b, max_bits)
        if b is not a:
            j = j + len(a)
        both = a if b is a else np.concatenate([a, b])
        root = local_roots(len(both), i, j)
        tied = np.flatnonzero(root != np.arange(len(both)))
        return pd.DataFrame({"src": both[tied].view(np.int64), "dst": both[root[tied]].view(np.int64)})

    return placed.mapInArrow(route, "low int, high int, first boolean, fp long") \
        .groupBy("low", "high").applyInPandas(forest, "src long, dst long")


def rooted(marked: DataFrame, max_bits: int) -> DataFrame:
    """fp, root, first (the row that stands for the fingerprint: smallest id, then text hash; null ids last)."""
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    distinct = shared_table(marked.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
    roots = components(links(distinct, max_bits)).withColumnRenamed("id", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")


def groups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id) of every row."""
    marked = shared_table(fingerprints(docs, words, id_col, text_col), "fingerprints")
    tree = rooted(marked, max_bits)
    lowest = tree.groupBy("root").agg(F.min("first").alias("first"))
    named = tree.select("fp", "root").join(lowest, "root").select("fp", F.col("first.doc_id").alias("component_id"))
    return marked.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each group, with all its columns: that of the smallest id; of repeated rows, one."""
    marked = shared_table(fingerprints(docs, words, id_col, text_col), "fingerprints")
    stays = rooted(marked, max_bits).groupBy("root").agg(F.min("first").alias("first")) \
        .select(F.col("first.doc_id").alias("_stay_id"), F.col("first.text_hash").alias("_stay_hash"))
    own_id, own_hash = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    keyed = docs.withColumns({"_own_id": own_id, "_own_hash": own_hash})
    found = keyed.join(stays, keyed["_own_hash"].eqNullSafe(stays["_stay_hash"]) & keyed["_own_id"].eqNullSafe(stays["_stay_id"]), "left_semi")
    once = Window.partitionBy("_own_hash", "_own_id").orderBy(F.lit(1))
    return found.withColumn("_nth", F.row_number().over(once)).where("_nth = 1").select(*(f"`{c}`" for c in docs.columns))
