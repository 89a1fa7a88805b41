"""Helpers of the corpus operators: the shared folder, Arrow steps over bounded slices, the document hash."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and characters an Arrow step works on at once; a single longer text is a slice of its own.
SLICE_ROWS = 2_000
SLICE_CHARS = 500_000
#: Bytes of one Arrow batch of a filtering stage (or one row that is longer).
BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the context's own checkpoint folder.

    Only on a local master, where one machine is all there is, a temporary folder stands in for a missing setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage ends there, and tasks that are
    lost or run twice leave one committed copy."""
    path = f"{shared_folder(df.sparkSession)}/corpus-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_CHARS, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of column ``text`` in a slice stay below ``most`` bytes (or are one text)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > most or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def arrow_step(fn: Callable[[pa.RecordBatch], pa.RecordBatch], text: int) -> Callable:
    """A ``mapInArrow`` function that applies ``fn`` to each bounded slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield fn(part)

    return run


def texts_of(column: pa.Array) -> list[str]:
    """Texts with null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text, under fixed names, whatever other columns the table has."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def remainder(doc_id: int | None, modulus: int) -> int | None:
    """crc32 of the id as text, modulo ``modulus``; null ids have none."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def remainder_column(col, modulus: int):
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def keep_rows(docs: DataFrame, keep: Callable[[list[str]], list[bool]], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text (null as empty) ``keep`` says stays.

    Only texts go to Python, BATCH_BYTES at once, and one bit for each comes back; the rows themselves stay in the JVM."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def stays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = [pa.array(keep(texts_of(part.column(0))), pa.bool_())
                     for part in slices(pa.RecordBatch.from_arrays([column], names=["text"]), 0)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.bool_())

    return docs.where(F.arrow_udf(stays, "boolean")(F.col(f"`{text_col}`").cast("string")))


def below_cut(limit: int, rows, key: str = "doc_id"):
    """Condition that leaves about twice ``limit`` of ``rows`` rows (a number or column), those of smallest hash of ``key``.

    Put before a sort and limit by that hash it changes no result where keys differ, and what is sorted or sent to one place
    no longer grows with the number of partitions. Tables of up to about twice the limit stay whole.
    """
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    return F.xxhash64(key).cast("double") / 2.0 ** 64 + 0.5 <= (2.0 * limit + 50) / rows


#: A group of more than 1 / HOT_SHARE of all rows is hot, so there are fewer than HOT_SHARE hot groups in any table.
HOT_SHARE = 1_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``groups`` (``key`` not null, row count ``n``, and further columns) without a hot key.

    Groups of more than ``total / HOT_SHARE`` rows are broadcast: as their rows add up to ``total`` at most, they are fewer than
    HOT_SHARE. Rows of the others are shuffled by the key; those that a hot group has answered are spread by their number.
    """
    values = [c for c in groups.columns if c not in (key, "n")]
    hot = groups.where(F.col("n") > total / HOT_SHARE).select(F.col(key).alias("_hot"), F.struct("n", *values).alias("_of_hot"))
    cold = groups.where(F.col("n") <= total / HOT_SHARE).select(F.col(key).alias("_cold"), F.struct("n", *values).alias("_of_cold"))
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    where = F.when(F.col("_hot").isNull(), F.concat(F.lit("k"), F.col(key).cast("string"))) \
        .otherwise(F.concat(F.lit("r"), F.monotonically_increasing_id().cast("string")))
    joined = met.withColumn("_where", where).join(
        cold.withColumn("_where", F.concat(F.lit("k"), F.col("_cold").cast("string"))), "_where", "left")
    found = F.coalesce("_of_hot", "_of_cold")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in ("n", *values)])
