"""Session helpers.

Cluster settings win: every value here is applied only when the running
session has not set it already.  The checkpoint directory is read from
``spark.checkpoint.dir``; a scratch folder is used only where that is unset in
a single-process local session.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE coalesces the many small shuffle
# partitions of tiny inputs, splits skewed join partitions and turns
# sort-merge joins into broadcast joins once a side is measured small.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tallyline", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in library defaults that the session does not set itself."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a session whose executors run inside this very process
    (master ``local[...]``: tests, bench) gets a fresh scratch folder; on any
    other master an error is raised, since a folder of one machine would be
    written and read by many."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:                                   # no SparkContext on a Spark Connect session
        sc = spark.sparkContext
    except Exception:
        pass
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset: intermediate tables need a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tallyline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path
