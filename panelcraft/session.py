"""Session helpers: settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "panelcraft", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for.

    Shuffle partition counts are left to adaptive execution: a high initial number that is coalesced
    to the advisory size suits both a laptop run and a large cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared(spark: SparkSession) -> str:
    """The context's checkpoint folder, set from ``spark.checkpoint.dir`` where it is not set yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="panelcraft-checkpoint-"))
    return context.getCheckpointDir()


def shared_place(spark: SparkSession) -> str:
    """A new folder name that driver and executors share."""
    return f"{_shared(spark)}/panelcraft-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder named by ``spark.checkpoint.dir``.

    Only on a local master, one machine, a temporary folder stands in for a missing setting.
    """
    _shared(df.sparkSession)
    held = df.persist()  # an eager checkpoint reads its input twice
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Hint a broadcast only after counting at most ``max_rows + 1`` rows; otherwise leave a shuffle join."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
