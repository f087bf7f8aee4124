"""What the training-data operators share: shared folders, staged tables, columns."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts have it: blank and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where it is unset and Spark runs in one JVM (tests), a temporary folder is
    set; on a cluster that is an error, as no local folder is seen by all.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not path:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="scriptorium-")
        context.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


_open: list[list[str]] = []  # paths made inside each `temporary`


def scratch(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _on(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def deleted(spark: SparkSession, path: str) -> None:
    system, target = _on(spark, path)
    system.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _on(spark, path)
    return system.exists(target)


def moved(spark: SparkSession, path: str, to: str) -> None:
    system, target = _on(spark, path)
    if not system.rename(target, _on(spark, to)[1]):
        raise OSError(f"{path} can't be renamed to {to}")


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted when it ends without an error, so what is
    returned must be staged outside."""
    _open.append([])
    try:
        yield
        for path in _open[-1]:
            deleted(spark, path)
    finally:
        _open.pop()


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of steps whose results are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Texts reach Python in small Arrow batches, which bounds what a worker holds; a
    setting below these stays."""
    for name, most, number in (("maxRecordsPerBatch", str(rows), int), ("maxBytesPerBatch", size, _bytes)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < number(spark.conf.get(key)) <= number(most):
            spark.conf.set(key, most)


def _bytes(text: str) -> int:
    units = {"b": 0, "k": 10, "m": 20, "g": 30}
    low = text.lower().removesuffix("b") or "0"
    return int(low[:-1]) << units[low[-1]] if low[-1] in units else int(low)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_rows(df: DataFrame, label: str, *columns: Column | str, row: str = "_row") -> DataFrame:
    """The columns staged beside a row number that holds for the whole run, as
    doc_id may be null or repeated."""
    return staged(df.select(*(columns or ["*"]), F.monotonically_increasing_id().alias(row)), label)


HOT = 1000  # a key with more than one in so many rows is hot, so there are fewer hot keys than this
PIECES = 64


def salted_join(rows: DataFrame, unique: DataFrame, key: str | list[str], size: str, by: str) -> DataFrame:
    """rows joined with a staged table that has each key once and, in size, how many of
    the rows have it.  Hot keys, fewer than HOT by their definition, are broadcast to
    the rows, whose place then hangs on a hash of `by` too, so that the rows of one key
    are dealt to PIECES tasks; the hot ones of unique are there once for each piece."""
    keys = [key] if isinstance(key, str) else key
    total = unique.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    hot = F.col(size) * HOT > total
    marked = rows.join(F.broadcast(unique.filter(hot).select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    placed = marked.withColumn("_piece", F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(PIECES)).cast("int")).otherwise(0)).drop("_hot")
    dealt = unique.withColumn("_piece", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))))
    return placed.join(dealt, [*keys, "_piece"]).drop("_piece")


def spread_join(rows: DataFrame, unique: DataFrame, key: str, by: str, pieces: int = 8) -> DataFrame:
    """The same for a unique side that is small against the rows: all of it is there once
    for each piece, and the rows of every key are dealt by a hash of `by`; no sizes are needed."""
    placed = rows.withColumn("_piece", F.pmod(F.xxhash64(by), F.lit(pieces)).cast("int"))
    dealt = unique.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    return placed.join(dealt, [key, "_piece"]).drop("_piece")


def blank_as_empty(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents_like(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])
