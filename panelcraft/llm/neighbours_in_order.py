"""Each document beside the next one by ascending id, without a window over the whole table.

Ids are range partitioned and sorted, so the next document is in the same task but for the last of each task. A task hands
out its first and its last document, and those (two for each task) are paired in a second small step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, shared_table
from .oph import fingerprint, likeness

DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
       "near_next double")
RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                    ("near_next", pa.float64())])
STEP = pa.schema([*RESULT, ("part", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def compared(doc: int | None, text: str, own: str, following: str, its: str) -> list:
    cut = len(text) // 4
    edited = text[:len(text) - cut] + following[:cut]
    made = own if edited == text else fingerprint(edited)
    return [doc, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), own, made, likeness(own, made),
            likeness(own, its)]


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its fingerprint, its edited text's (the last quarter replaced by the start of the next
    document's) and the likeness to that and to the next document. The next of the last is the first.

    A null id counts as smallest; equal ids follow one another in no set order; one document alone is its own next.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                for doc, text in zip(*(c.to_pylist() for c in batch.slice(at, 200).columns)):
                    text = text or ""
                    own = fingerprint(text)
                    if held is None:
                        rows.append([doc, None, None, own, None, None, None, part, "first", text])
                    else:
                        rows.append([*compared(*held, text, own), part, "done", None])
                    held = doc, text, own
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), STEP.types)], schema=STEP)
        if held:
            row = [held[0], None, None, held[2], None, None, None, part, "last", held[1]]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, STEP.types)], schema=STEP)

    order = F.col("doc_id").asc_nulls_first()
    table = shared_table(id_text(docs, id_col, text_col).repartitionByRange(order).sortWithinPartitions(order)
                         .mapInArrow(step, f"{DDL}, part long, role string, text string"), "neighbours")
    firsts, lasts = (table.where(F.col("role") == r).select("part", "doc_id", "text", "fingerprint") for r in ("first", "last"))
    # One row for each task: the part that follows, and the first part after the last.
    by_part = Window.orderBy(order, "part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turns = firsts.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(whole)).alias("then"))
    pairs = lasts.join(turns, "part").join(
        firsts.select(F.col("part").alias("then"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fp")), "then")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [compared(*r) for r in zip(*(c.to_pylist() for c in batch.columns))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RESULT.types)], schema=RESULT)

    ends = pairs.select("doc_id", "text", "fingerprint", "next_text", "next_fp").mapInArrow(finish, DDL)
    return table.where(F.col("role") == "done").select(*RESULT.names).unionByName(ends)
