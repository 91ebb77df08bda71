"""Session construction for tests, benchmarks and scripts.

On a cluster the session comes from the platform; the library only reads
its settings (for example ``spark.checkpoint.dir``).  ``local_session`` is
for tests and the benchmark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hourglass.sources.io import shared_folder


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "hourglass", driver_memory: str = "16g",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", driver_memory)
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    return spark
