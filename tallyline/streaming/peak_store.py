"""Month peaks of a live ledger that late transactions correct.

The state is the table of month summaries (customer, month -> net, top, first
and last transaction; see ``ledger.month_summary``), kept in *cells*: one folder
per month and hash bucket of the customers.  A micro-batch

1. is written once, by month and bucket, to the log;
2. is summed up to its own month summaries;
3. reads the cells it touches, and only those.  A summary whose transactions all
   come after the stored ones combines with it.  Otherwise transactions came late:
   the summary of that customer's month is made anew from the log of its cell;
4. writes a new version of the touched cells and a manifest that names the
   current version of every cell.

So what a batch reads and writes follows what it touches: the usual batch touches
the cells of the current period, a late transaction one cell more.  Peaks and
balances are not stored.  ``peaks`` adds up each customer's nets in month order,
which is how a correction reaches all months after it.

A batch that is processed again reads the manifest of the batch before it and
overwrites its own folders, so every result counts once.  Cell versions that no
such retry can need are deleted.  The manifest holds one row per cell, which is
bounded by the calendar and the number of buckets.

Transactions without a customer or a date go to a table of their own and change
nothing.  Transactions that tie in date and id are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import month_summary, summary_peaks
from ..sources.sinks import remove

TXN_SCHEMA = "customer_id bigint, txn_id bigint, txn_date date, txn_type string, txn_amount bigint"
PLACE = "struct<txn_date:date,txn_id:bigint>"
CELL_SCHEMA = f"customer_id bigint, month date, net bigint, top bigint, first {PLACE}, last {PLACE}"
BUCKETS = 16


class PeakStore:
    """Sink of micro-batches (``foreachBatch``) under the folder ``base``."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS, period: str = "month"):
        self.spark, self.base, self.buckets, self.period = spark, base, buckets, period

    # -- folders
    def _log(self, batch_id: int, cell: tuple[str, int] | None = None) -> str:
        return f"{self.base}/log/batch_id={batch_id}" + (f"/period={cell[0]}/bucket={cell[1]}" if cell else "")

    def _cell(self, version: int, cell: tuple[str, int] | None = None) -> str:
        return f"{self.base}/cells/version={version}" + (f"/period={cell[0]}/bucket={cell[1]}" if cell else "")

    def _read(self, folder: str, schema: str, paths: list[str]) -> DataFrame:
        schema = f"{schema}, period date, bucket int"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.base}/{folder}").parquet(*paths)

    def _manifest(self, batch_id: int) -> dict[tuple[str, int], tuple[int, list[int]]]:
        """Cell -> its current version, the batches with transactions of it."""
        if batch_id < 0:
            return {}
        rows = self.spark.read.parquet(f"{self.base}/manifest/batch_id={batch_id}").collect()
        return {(r["period"], r["bucket"]): (r["version"], r["batches"]) for r in rows}

    # -- a micro-batch
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._manifest(batch_id - 1)
        touched = self._append(batch, batch_id)
        rows = self._read("log", TXN_SCHEMA, [self._log(batch_id, c) for c in touched])
        old = self._read("cells", CELL_SCHEMA, [self._cell(before[c][0], c) for c in touched if c in before])
        now = {c: (batch_id, [*before.get(c, (0, []))[1], batch_id]) for c in touched}
        if touched:
            self._write_cells(self._merged(rows, old, batch_id, now), batch_id)
        self._commit(batch_id, {**before, **now})
        self._vacuum(batch_id, before)

    def _append(self, batch: DataFrame, batch_id: int) -> list[tuple[str, int]]:
        """Write the batch to the log; returns the cells it touches."""
        rows = batch.select("customer_id", "txn_id", "txn_date", "txn_type", "txn_amount").withColumn(
            "period", F.trunc("txn_date", self.period)).withColumn(
            "bucket", F.when(F.col("period").isNotNull() & F.col("customer_id").isNotNull(), self._bucket()).otherwise(-1))
        # A rebalance, whose large partitions adaptive execution splits: a hot cell is not one task.
        rows.hint("rebalance", "period", "bucket").write.mode("overwrite").partitionBy("period", "bucket").parquet(self._log(batch_id))
        cells = self.spark.read.schema(f"{TXN_SCHEMA}, period string, bucket int").parquet(self._log(batch_id)).select("period", "bucket").distinct().collect()
        return sorted((r["period"], r["bucket"]) for r in cells if r["bucket"] >= 0)

    def _merged(self, rows: DataFrame, old: DataFrame, batch_id: int, now: dict) -> DataFrame:
        key = ["customer_id", "month"]
        stored = old.select(*key, *[F.col(c).alias(f"_{c}") for c in ("net", "top", "first", "last")])
        new = month_summary(rows).join(stored, key, "full_outer")
        late = F.coalesce(F.col("first") <= F.col("_last"), F.lit(False))
        found = self._work(new.withColumn("late", late), "work", batch_id)
        on_time = found.filter("not late").select(
            *key, (F.coalesce("_net", F.lit(0)) + F.coalesce("net", F.lit(0))).alias("net"),
            F.greatest("_top", F.coalesce("_net", F.lit(0)) + F.col("top")).alias("top"),
            F.coalesce("_first", "first").alias("first"), F.coalesce("last", "_last").alias("last"))
        corrected = self._work(found.filter("late").select(*key), "corrected", batch_id)
        cells = corrected.select(F.trunc("month", self.period).cast("string").alias("period"), self._bucket().alias("bucket")).distinct().collect()
        cells = [(r["period"], r["bucket"]) for r in cells]
        if not cells:
            return on_time
        log = self._read("log", TXN_SCHEMA, [self._log(b, c) for c in cells for b in now[c][1]])
        again = month_summary(log.withColumn("month", F.last_day("txn_date")).join(corrected, key, "left_semi"))
        return on_time.unionByName(again)

    def _bucket(self):
        return F.pmod(F.xxhash64("customer_id"), F.lit(self.buckets)).cast("int")

    def _work(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = f"{self.base}/{name}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _write_cells(self, summaries: DataFrame, batch_id: int) -> None:
        (summaries.withColumn("period", F.trunc("month", self.period)).withColumn("bucket", self._bucket()).hint("rebalance", "period", "bucket")
         .write.mode("overwrite").partitionBy("period", "bucket").parquet(self._cell(batch_id)))

    def _commit(self, batch_id: int, cells: dict) -> None:
        rows = [(p, b, v, batches) for (p, b), (v, batches) in sorted(cells.items())]
        self.spark.createDataFrame(rows, "period string, bucket int, version bigint, batches array<bigint>").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.base}/manifest/batch_id={batch_id}")

    def _vacuum(self, batch_id: int, before: dict) -> None:
        """Delete what the batch before this one replaced: no retry reads it."""
        remove(self.spark, f"{self.base}/work/batch_id={batch_id}")
        for cell, (version, _) in self._manifest(batch_id - 2).items():
            if before[cell][0] != version:
                remove(self.spark, self._cell(version, cell))

    # -- results
    def last_batch(self) -> int:
        """The last committed batch; -1 before the first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return -1
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        done = [int(n.split("=")[1]) for n in names if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest/{n}/_SUCCESS"))]
        return max(done, default=-1)

    def summaries(self) -> DataFrame:
        cells = self._manifest(self.last_batch())
        return self._read("cells", CELL_SCHEMA, [self._cell(v, c) for c, (v, _) in cells.items()]).drop("period", "bucket")

    def peaks(self) -> DataFrame:
        """customer_id, month, peak, balance of the months with transactions."""
        return summary_peaks(self.summaries())

    def corrections(self) -> DataFrame:
        """customer_id, month, batch_id of the months that late transactions corrected."""
        return self.spark.read.schema("customer_id bigint, month date, batch_id bigint").parquet(f"{self.base}/corrected")

    def rejected(self) -> DataFrame:
        """Transactions without a customer or a date."""
        return self.spark.read.schema(f"{TXN_SCHEMA}, batch_id bigint, period date, bucket int").parquet(f"{self.base}/log").filter("bucket = -1").drop("period", "bucket")
