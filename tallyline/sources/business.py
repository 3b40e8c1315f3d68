"""Typed readers for the business tables in their original shapes.

Files are read with every column as text (CSV) or as stored (Parquet) and
then cast to the declared types.  Keys and amounts are BIGINT.  A value that
does not convert is never hidden: ``read_business`` fails on it like the
original loads would, ``read_split`` puts the row aside with the names of the
columns at fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import to_int
from ..operators.numbering import numbered

# Declared or inferred column types of the business tables (fixed values).
SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "regions": [("region_id", "bigint"), ("region_name", "string")],
    "customer_nodes": [("customer_id", "bigint"), ("region_id", "bigint"), ("node_id", "bigint"),
                       ("start_date", "date"), ("end_date", "date")],
    "customer_transactions": [("customer_id", "bigint"), ("txn_date", "date"), ("txn_type", "string"),
                              ("txn_amount", "bigint")],
    "pizza_ratings": [("order_id", "bigint"), ("customer_id", "bigint"), ("rating", "bigint")],
    "customer_orders": [("order_id", "bigint"), ("customer_id", "bigint"), ("pizza_id", "bigint"),
                        ("exclusions", "string"), ("extras", "string"), ("order_time", "timestamp_ntz")],
    "runner_orders": [("order_id", "bigint"), ("runner_id", "bigint"), ("pickup_time", "string"),
                      ("distance", "string"), ("duration", "string"), ("cancellation", "string")],
    "runners": [("runner_id", "bigint"), ("registration_date", "date")],
    "pizza_names": [("pizza_id", "bigint"), ("pizza_name", "string")],
    "pizza_recipes": [("pizza_id", "bigint"), ("toppings", "string")],
    "pizza_toppings": [("topping_id", "bigint"), ("topping_name", "string")],
}
OPEN_END = "9999-12-31"   # end_date of a stint that is still open


def _typed(col: str, typ: str) -> Column:
    """The value in its declared type, NULL where it does not convert."""
    c = F.col(col)
    if typ == "bigint":
        return to_int(c.cast("string"))
    if typ == "string":
        return c.cast("string")
    return F.trim(c.cast("string")).try_cast(typ)


def _fails(col: str, typ: str) -> Column:
    """True for a value (neither NULL nor blank) that does not convert."""
    return F.coalesce((F.trim(F.col(col).cast("string")) != "") & _typed(col, typ).isNull(), F.lit(False))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto the declared columns and types of ``table``; a value
    that does not convert raises an error that names it."""
    return df.select(*[F.when(_fails(c, t), F.raise_error(F.concat(F.lit(f"{table}.{c} is no {t}: "), F.col(c).cast("string"))))
                       .otherwise(_typed(c, t)).alias(c) for c, t in SCHEMAS[table]])


def split_rejected(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that convert, with declared types; the others as they came, with
    ``rejected_columns``, the names of the columns at fault)."""
    bad = F.filter(F.array(*[F.when(_fails(c, t), F.lit(c)) for c, t in SCHEMAS[table]]), lambda x: x.isNotNull())
    good = df.filter(F.size(bad) == 0).select(*[_typed(c, t).alias(c) for c, t in SCHEMAS[table]])
    return good, df.filter(F.size(bad) > 0).withColumn("rejected_columns", bad)


def _raw(spark: SparkSession, path: str, table: str, fmt: str, header: bool, sep: str) -> DataFrame:
    if fmt == "csv":
        return (spark.read.option("header", header).option("sep", sep)
                .schema(", ".join(f"{c} string" for c, _ in SCHEMAS[table])).csv(path))
    return spark.read.format(fmt).load(path)


def read_business(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
                  header: bool = True, sep: str = ",") -> DataFrame:
    return conform(_raw(spark, path, table, fmt, header, sep), table)


def read_split(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
               header: bool = True, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows) of a file; see ``split_rejected``."""
    return split_rejected(_raw(spark, path, table, fmt, header, sep), table)


def with_txn_ids(txns: DataFrame) -> DataFrame:
    """Tie-break id for ledgers without one, among the customer's transactions
    of the same day by (type, amount).  Equal rows are interchangeable, so any
    order among them gives the same balances."""
    return numbered(txns, ["customer_id", "txn_date"], ["txn_type", "txn_amount"], "txn_id")


def open_stint(end_date: str = "end_date"):
    """True for a stint whose end date is the open-ended sentinel."""
    return F.col(end_date) == F.lit(OPEN_END).cast("date")


def load_report(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """Every row of a file with its fate: the columns as text (of accepted rows in
    their types' own form) and ``rejected_columns`` (comma-joined; null if accepted)."""
    good, bad = read_split(spark, path, table, fmt)
    names = [c for c, _ in SCHEMAS[table]]
    accepted = good.select(*[F.col(c).cast("string").alias(c) for c in names], F.lit(None).cast("string").alias("rejected_columns"))
    return accepted.unionByName(bad.select(*names, F.array_join("rejected_columns", ",").alias("rejected_columns")))
