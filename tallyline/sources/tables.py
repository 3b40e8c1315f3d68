"""Readers for the Parquet tables.

Tables are read lazily; Catalyst prunes columns and pushes filters into the
Parquet scan, so callers only ``select`` what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Declared schemas of the tables the queries read (fixed values, as stored).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


TASK_ROWS = 250_000     # rows of a large table that one shuffle task takes
LEAST_TASKS = 16        # smaller tables are left to the session's own partitions


def tasks_for(df: DataFrame) -> int | None:
    """How many tasks a shuffle of the table is dealt to, so that a task holds about
    ``TASK_ROWS`` rows at any size; None for a small table."""
    n = -(-df.count() // TASK_ROWS)
    return n if n >= LEAST_TASKS else None


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` is a DataFrame over orders.parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        """Scan of one table; declared tables are read with their schema, so no
        footer has to be sampled to infer it (many files at scale)."""
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def tasks(self, name: str) -> int | None:
        """``tasks_for`` a table, whose rows are counted from the files' footers."""
        return tasks_for(self.read(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)

    def register_views(self, names=TABLES) -> None:
        for n in names:
            self.read(n).createOrReplaceTempView(n)
