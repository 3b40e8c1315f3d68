"""Writing and re-reading results.

``write_by_month`` stores a dated table partitioned by month, so later reads
of a date range prune whole folders (``PartitionFilters`` in the plan)
instead of scanning the table.  ``write_table`` / ``read_table`` keep
intermediate results in the shared folder named by ``spark.checkpoint.dir``,
which also cuts long lineages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def write_by_month(df: DataFrame, path: str, date_col: str, mode: str = "overwrite") -> None:
    """Write ``df`` partitioned by the first day of the month of ``date_col``.

    Rows are clustered by month before the write so each task writes few
    files per month folder; the clustering is a rebalance, whose large
    partitions adaptive execution splits, so a hot month is not one task."""
    month = F.trunc(F.col(date_col), "month")
    (df.withColumn("month", month).hint("rebalance", "month")
       .write.mode(mode).partitionBy("month").parquet(path))


def read_months(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Read a month-partitioned table, keeping months in [start, end] (dates,
    inclusive); the filter is on the partition column, so folders outside
    the range are never listed or read."""
    df = spark.read.parquet(path)
    if start:
        df = df.filter(F.col("month") >= F.trunc(F.lit(start).cast("date"), "month"))
    if end:
        df = df.filter(F.col("month") <= F.lit(end).cast("date"))
    return df


def write_table(df: DataFrame, name: str) -> str:
    """Materialise ``df`` under the session's checkpoint folder; returns the path."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def create_table(spark: SparkSession, table: str, columns: list[tuple[str, str]], replace: bool = False) -> None:
    """An empty catalogue table with the declared columns; with ``replace`` an
    existing one is dropped first, otherwise it is an error."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({', '.join(f'{c} {t}' for c, t in columns)}) USING parquet")


def widen_column(spark: SparkSession, table: str, column: str, to: str) -> None:
    """Give a column of a catalogue table a wider type by rewriting the table: the
    rows go to a new table with the new type, which then takes the old one's name.
    A value that the new type cannot hold is an error before anything is dropped."""
    old = spark.table(table)
    if column not in old.columns:
        raise ValueError(f"{table} has no column {column}")
    new = f"{table}_{uuid.uuid4().hex[:8]}"
    create_table(spark, new, [(f.name, to if f.name == column else f.dataType.simpleString()) for f in old.schema.fields])
    wider = F.col(column).cast(to)
    lost = F.col(column).isNotNull() & (wider.isNull() | (wider.cast(old.schema[column].dataType) != F.col(column)))
    value = F.when(lost, F.raise_error(F.concat(F.lit(f"{table}.{column} is no {to}: "), F.col(column).cast("string"))).cast(to)).otherwise(wider)
    old.select(*[value.alias(c) if c == column else F.col(c) for c in old.columns]).write.insertInto(new)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, mode: str = "overwrite") -> None:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``keys``.

    Two tables bucketed the same way on their join key -- e.g. order items and
    deliveries by ``order_id`` -- join without a shuffle on either side, which
    removes the largest exchange from every order query that joins them."""
    (df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
