"""Session settings for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """``GRIDPANEL_CHECKPOINT_DIR`` names the folder of staged tables, else the working folder's ``.checkpoints``."""
    checkpoints = os.environ.get("GRIDPANEL_CHECKPOINT_DIR", os.path.join(os.getcwd(), ".checkpoints"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gridpanel")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", checkpoints)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
