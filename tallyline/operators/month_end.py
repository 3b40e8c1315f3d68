"""A stored table of month-end balances that grows by periods.

``MonthEndTable`` keeps the rows of ``ledger.closing_balance`` partitioned by month.
``append`` takes the transactions of the months after the last stored one: their
nets are added to the balances carried out of that last month, which is the only
stored partition that is read.  Customers that are new in a period get their empty
earlier months as files of their own beside the stored ones.

Rows lie under month=.../load=N, and a load overwrites its own folders only, so a
load that is repeated counts once.  Months before the first load's are not kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ledger import monthly_net

SCHEMA = "customer_id bigint, end_date date, transactions bigint, closing_balance bigint, month date, load int"


class MonthEndTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _months(self, load: int) -> list[str]:
        """Months stored by the loads before this one, from the folders' names."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/month=*/load=*")
        found = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(fs_path) or []
        pairs = [(s.getPath().getParent().getName()[6:], int(s.getPath().getName()[5:])) for s in found]
        return sorted({month for month, n in pairs if n < load})

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(*paths)

    def append(self, txns: DataFrame, load: int) -> None:
        """Add the months of ``txns`` (and quiet ones before them); ``load`` numbers the periods from 0."""
        stored = self._months(load)
        nets = monthly_net(txns)
        bounds = nets.agg(F.min("end_date").alias("lo"), F.max("end_date").alias("hi")).first()
        if bounds["hi"] is None:
            return
        if stored and str(bounds["lo"])[:7] <= stored[-1][:7]:
            raise ValueError(f"transactions of {str(bounds['lo'])[:7]} came after {stored[-1][:7]} was stored")
        per = nets.groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("end_date", "net"))).alias("m"))
        carried = (self._read([f"{self.path}/month={stored[-1]}"]).filter(F.col("load") < load).select("customer_id", F.col("closing_balance").alias("carried"))
                   if stored else self.spark.createDataFrame([], "customer_id bigint, carried bigint"))
        known = carried.withColumn("known", F.lit(True))
        both = known.join(per, "customer_id", "full_outer")
        first = F.add_months(F.lit(stored[-1]).cast("date"), 1) if stored else F.trunc(F.lit(bounds["lo"]), "month")
        start = F.when(F.col("known"), first).otherwise(F.lit(stored[0]).cast("date") if stored else first)
        grid = both.select("customer_id", "carried", "m", F.explode(F.sequence(start, F.trunc(F.lit(bounds["hi"]), "month"), F.expr("INTERVAL 1 MONTH"))).alias("month"))
        net = F.try_element_at("m", F.last_day("month"))
        w = Window.partitionBy("customer_id").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
        moved = F.sum("net").over(w)
        rows = grid.withColumn("net", net).select(
            "customer_id", F.last_day("month").alias("end_date"), F.coalesce("net", F.lit(0)).cast("bigint").alias("transactions"),
            F.when(F.col("carried").isNotNull() | moved.isNotNull(), F.coalesce("carried", F.lit(0)) + F.coalesce(moved, F.lit(0))).cast("bigint").alias("closing_balance"),
            "month", F.lit(load).alias("load"))
        (rows.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("month", "load").parquet(self.path))

    def read(self) -> DataFrame:
        return self._read([self.path]).drop("month", "load")


def appended_in_periods(spark: SparkSession, txns: DataFrame, path: str, periods: int = 3) -> DataFrame:
    """The ledger appended in periods of whole months; equals ``closing_balance``."""
    b = txns.agg(F.trunc(F.min("txn_date"), "month").alias("lo"), F.trunc(F.max("txn_date"), "month").alias("hi")).first()
    table = MonthEndTable(spark, path)
    month = F.months_between(F.trunc("txn_date", "month"), F.lit(b["lo"]))
    n = F.months_between(F.lit(b["hi"]), F.lit(b["lo"])) + 1
    for k in range(periods):
        table.append(txns.filter(F.floor(month * periods / n) == k), k)
    return table.read()
