"""Connected components as joins and partial aggregates; nothing but a count of changes reaches the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of n indices under links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    while (again := root[root] != root).any():
        root[again] = root[root[again]]
    return root


def components(edges: DataFrame) -> DataFrame:
    """id, root (smallest reachable id) for every id in ``edges`` (src, dst long; any order, repeats allowed).

    Each round takes the smallest root among an id's neighbours, hooks the id's old root to it, and halves the way to the
    root; the work tables are written to the shared folder, so a lost executor costs one round at most. No edges: no rows.
    """
    both = shared_table(edges.select("src", "dst").union(edges.select("dst", "src")).where("src != dst").distinct(), "edges")
    labels = shared_table(both.select(F.col("src").alias("id")).distinct().withColumn("root", F.col("id"))
                          .withColumn("moved", F.lit(True)), "roots")
    while True:
        near = both.join(labels.select(F.col("id").alias("dst"), F.col("root").alias("near")), "dst") \
            .groupBy(F.col("src").alias("id")).agg(F.min("near").alias("near"))
        seen = labels.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        hooked = seen.groupBy(F.col("old").alias("id")).agg(F.min("low").alias("hook"))
        step = shared_table(
            seen.join(hooked, "id", "left").select("id", "old", F.least("low", F.coalesce("hook", "low")).alias("root")), "hook")
        jump = step.select(F.col("id").alias("root"), F.col("root").alias("up"))
        labels = shared_table(step.join(jump, "root").select("id", F.least("root", "up").alias("root"),
                                                             (F.least("root", "up") != F.col("old")).alias("moved")), "roots")
        if not labels.where("moved").limit(1).count():
            return labels.select("id", "root")
