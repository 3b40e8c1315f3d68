"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# White space of the word definition used by the contracts: space and \x09-\x0D.
SPACE = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def words(text: Column) -> Column:
    """Words of a text (runs without white space) as an array; null text: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def fenced(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)`` on the finished columns of ``df``.

    A plain filter is pushed below the projections, where its copy of their
    expressions is evaluated again, inside lambdas once per element; a
    nondeterministic column keeps it above them."""
    return df.withColumn("_fence", F.monotonically_increasing_id()).filter(condition & (F.col("_fence") >= 0)).drop("_fence")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, so that a lost executor costs only its own tasks."""
    return reread(df.sparkSession, write(df, name), df.schema)


def write(df: DataFrame, name: str) -> str:
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def reread(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of ``write`` that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def sliced(batch: pa.RecordBatch, column: str, most: int, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose values of a string, binary or list column hold
    ``most`` characters, bytes or elements at most (or are one row), and ``rows`` rows."""
    values = batch.column(column)
    if pa.types.is_list(values.type):
        size = pc.list_value_length(values)
    else:
        size = pc.binary_length(values)
    ends = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, before + most, "right"))), at + rows)
        yield batch.slice(at, end - at)
        at = end
