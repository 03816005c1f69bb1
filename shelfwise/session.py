"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

# Partition counts are left to AQE: many small initial partitions, merged at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfwise",
                  **extra: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter brings its own."""
    # In local mode the driver is the one executor; the default of 1g spends its time in GC.
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.driver.memory", "8g"))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below spark.checkpoint.dir, else below the session's warehouse folder.

    Both are shared by all machines of a cluster. A warehouse on the driver's own disk, which is
    Spark's default, is not: on a cluster it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        own = urlparse(warehouse).scheme in ("", "file")
        if own and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{warehouse} is no folder that all machines share; set spark.checkpoint.dir")
        base = os.path.join(warehouse, "scratch")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
