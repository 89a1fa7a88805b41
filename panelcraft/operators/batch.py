"""Per-batch numeric work over a wide numeric frame.

``partial_sums`` hands each Arrow batch to a small numpy function as one matrix and lets Spark add up what the
function returns. Used where a step needs matrix products (distances to centres, cross products).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PACKED = "__x"


def packed(columns: list) -> Column:
    """Columns as one array of doubles. Wide tables stay one column to the planner and to Arrow."""
    if not columns:
        return F.array().cast("array<double>").alias(PACKED)
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in columns]).alias(PACKED)


def unpacked(batch: pa.RecordBatch, name: str = PACKED) -> np.ndarray:
    """The packed column of a batch as float64 rows; missing values are NaN."""
    x = batch.column(batch.schema.get_field_index(name))
    flat = np.asarray(x.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 0)


def no_gaps(df: DataFrame, columns: list[str]) -> None:
    """Raise where a column has a missing number: distances and sums over it would be undefined."""
    gaps = [F.count_if(F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double"))).alias(f"g{i}") for i, c in enumerate(columns)]
    found = df.agg(*gaps).first() if columns else ()
    refuse_gaps({c: n for c, n in zip(columns, found) if n})


def refuse_gaps(gaps: dict[str, int]) -> None:
    if gaps:
        raise ValueError("Missing values, fill them first: " + ", ".join(f"{c} ({n} rows)" for c, n in gaps.items()))


def partial_sums(df: DataFrame, columns: list, fn: Callable[[np.ndarray], dict[str, np.ndarray]],
                 keys: list[str], value: str = "value") -> DataFrame:
    """Sum by key of what ``fn`` returns per batch: equally long integer key arrays and one value array.

    Batches of a task are added up before they leave it when their keys repeat, by Spark's partial aggregation.
    """
    schema = ", ".join([f"{k} long" for k in keys] + [f"{value} double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(unpacked(batch))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(out[k], dtype=np.int64)) for k in keys]
                    + [pa.array(np.asarray(out[value], dtype=np.float64))], names=[*keys, value])

    return (df.select(packed(columns)).mapInArrow(run, schema)
            .groupBy(*keys).agg(F.sum(value).alias(value)))


def add_columns(df: DataFrame, inputs: list[str], outputs: dict[str, str],
                fn: Callable[[np.ndarray], list[np.ndarray]]) -> DataFrame:
    """``df`` with the columns that ``fn`` makes from a matrix of the input columns; equal names are replaced."""
    kept = [f for f in df.schema.fields if f.name not in outputs]
    wide = df.select(*[F.col(f"`{f.name}`") for f in kept], packed(inputs))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{n}` {t}" for n, t in outputs.items()])
    kinds = {"int": np.int32, "long": np.int64, "double": np.float64}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = fn(unpacked(batch))
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [pa.array(np.asarray(v).astype(kinds[t])) for v, t in zip(made, outputs.values())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*[f.name for f in kept], *outputs])

    return wide.mapInArrow(run, schema)
