"""Live balances with Structured Streaming (the "real-time" allocation option).

* ``live_balance(stream)`` -- running balance per customer as a streaming
  aggregation (update mode).  State is one row per customer.
* ``live_monthly_net(stream)`` -- net flow per customer and month
  (update mode, no watermark, so late rows still count).
* ``PeakStore`` (module ``peak_store``) -- the peak balance each customer reaches
  in each month, the balance carried in included.  A late transaction corrects
  its month and the months after.
* ``month_total`` -- the monthly requirement over all customers, quiet months
  included, from the emitted peaks.

Sources are folders that grow; ``replay`` feeds a ledger in date ranges, so a
customer's history crosses micro-batches.  Every batch writes its own folder,
which a retry overwrites.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators.allocation import monthly_total
from ..session import ensure_checkpoint_dir
from .peak_store import TXN_SCHEMA, PeakStore

PERIODS = 3        # date ranges of a replay
REPLAY_BUCKETS = 2 # a replayed test ledger has few customers


def live_balance(stream: DataFrame) -> DataFrame:
    return stream.groupBy("customer_id").agg(
        F.sum(C.signed_amount("txn_type", "txn_amount")).cast("bigint").alias("balance"),
        F.count("*").alias("txn_count"),
        F.max("txn_date").alias("as_of"))


def live_monthly_net(stream: DataFrame) -> DataFrame:
    """Net flow and transaction count per customer and calendar month, as a
    streaming aggregation in update mode.  No watermark: a late transaction
    still updates its month (state is one row per customer-month)."""
    return stream.groupBy("customer_id", F.last_day("txn_date").alias("month")).agg(
        F.sum(C.signed_amount("txn_type", "txn_amount")).cast("bigint").alias("net"),
        F.count("*").alias("txn_count"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def latest(spark: SparkSession, sink: str, schema: str, keys: list[str]) -> DataFrame:
    """The newest version of each key among the batch folders of a sink."""
    out = spark.read.schema(f"{schema}, batch_id bigint").parquet(sink)
    rest = [c for c in out.columns if c not in (*keys, "batch_id")]
    return out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r")).select(*keys, "r.*")


def month_total(peaks: DataFrame, floor_at_zero: bool = True) -> DataFrame:
    """month, data_required over all customers, quiet months included."""
    return monthly_total(peaks, floor_at_zero)


class Replay:
    """A ledger fed to streams as a folder that grows by one range at a time.  The
    ledger is written once, by ranges of its dates; each range then joins the
    source.  With ``delay``, one transaction in so many arrives one or two ranges
    after its own."""

    def __init__(self, spark: SparkSession, txns: DataFrame, name: str, periods: int = PERIODS, delay: int | None = None):
        self.spark, self.base, self.periods = spark, _folder(spark, name), periods + (2 if delay else 0)
        rows = txns.select("customer_id", "txn_id", "txn_date", "txn_type", "txn_amount")
        bounds = txns.agg(F.struct(F.min("txn_date").alias("lo"), F.max("txn_date").alias("hi")).alias("b")).scalar()
        share = F.datediff("txn_date", bounds["lo"]) / F.greatest(F.datediff(bounds["hi"], bounds["lo"]) + 1, F.lit(1))
        period = F.coalesce(F.floor(share * periods), F.lit(0)).cast("int")
        if delay:
            h = F.xxhash64("customer_id", "txn_id", "txn_date")
            period = period + F.when(F.pmod(h, F.lit(delay)) == 0, F.lit(1) + F.pmod(F.shiftright(h, 20), F.lit(2))).otherwise(F.lit(0)).cast("int")
        rows.withColumn("_p", period).write.partitionBy("_p").parquet(f"{self.base}/ranges")
        self.rows = spark.read.schema(f"{TXN_SCHEMA}, _p int").parquet(f"{self.base}/ranges")

    def _stream(self) -> DataFrame:
        return self.spark.readStream.schema(TXN_SCHEMA).parquet(f"{self.base}/source")

    def run(self, query, sink, mode: str = "update") -> None:
        """Append a range, process it as one micro-batch, and so on; ``query``
        maps the stream to the streamed rows, ``sink`` takes each batch."""
        for p in range(self.periods):
            self.rows.filter(F.col("_p") == p).drop("_p").write.mode("append").parquet(f"{self.base}/source")
            q = (query(self._stream()).writeStream.outputMode(mode).foreachBatch(sink)
                 .option("checkpointLocation", f"{self.base}/checkpoint").trigger(availableNow=True).start())
            q.awaitTermination()


def _updates(spark: SparkSession, txns: DataFrame, name: str, query, schema: str, keys: list[str]) -> DataFrame:
    r = Replay(spark, txns, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{r.base}/sink/batch_id={batch_id}")

    r.run(query, write)
    return latest(spark, f"{r.base}/sink", schema, keys)


def replay_live_balance(spark: SparkSession, txns: DataFrame) -> DataFrame:
    return _updates(spark, txns, "live-balance", live_balance, "customer_id bigint, balance bigint, txn_count bigint, as_of date", ["customer_id"])


def replay_monthly_net(spark: SparkSession, txns: DataFrame) -> DataFrame:
    return _updates(spark, txns, "monthly-net", live_monthly_net, "customer_id bigint, month date, net bigint, txn_count bigint",
                    ["customer_id", "month"])


def replay_peaks(spark: SparkSession, txns: DataFrame, periods: int = PERIODS, delay: int | None = None, buckets: int = REPLAY_BUCKETS) -> PeakStore:
    r = Replay(spark, txns, "month-peaks", periods, delay)
    sink = PeakStore(spark, r.base, buckets, period="year")      # a range spans years
    r.run(lambda stream: stream, sink, mode="append")
    return sink


def replay_month_peaks(spark: SparkSession, txns: DataFrame, delay: int | None = None) -> DataFrame:
    return replay_peaks(spark, txns, delay=delay).peaks()


def replay_month_total(spark: SparkSession, txns: DataFrame) -> DataFrame:
    return month_total(replay_peaks(spark, txns).peaks())
