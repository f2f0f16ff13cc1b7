"""Session settings the library is designed for.

Only ``build_session`` creates a session (tests, bench, local runs). On a
cluster the platform owns the session; ``recommended_conf`` lists the
settings to put in its configuration, sized for a large shuffle.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def recommended_conf(shuffle_partitions: int) -> dict[str, str]:
    """Settings for the DataFrame plans in this package.

    * AQE re-plans at every shuffle: coalesces small partitions, splits
      skewed ones (hot encounter keys), and turns sort-merge joins into
      broadcast joins when a side is small at runtime.
    * ``shuffle_partitions`` is the *upper* bound AQE coalesces down from;
      size it so the largest shuffle (diagnosis facts) gives ~128-256 MB per
      partition before coalescing.
    * Timestamps are rendered in UTC (driver tables are zone-less anyway).
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "indicata", **extra: str) -> SparkSession:
    """Local session for tests and benchmarks (UI and progress bar off)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = {
        **recommended_conf(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        **extra,
    }
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        # Local runs only: a cluster names shared storage in spark.checkpoint.dir.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="indicata-ckpt-"))
    return spark
