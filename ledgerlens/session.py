"""Session helpers.

``get_spark`` is only a convenience for tests, the bench and local runs; on a
cluster the caller owns the session and its configuration.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every local run uses. AQE re-plans joins (broadcast when a side is
# measured small at runtime), coalesces small shuffle partitions and splits
# skewed ones; UTC keeps timestamp_ntz arithmetic identical to the oracle.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "ledgerlens", cpus: int | str = "*",
              shuffle_partitions: int = 8, memory: str = "8g",
              extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a ``local[...]``
    master, where driver and executors share one disk, gets a temporary folder
    when the session has none (as in tests); anywhere else that is an error,
    since executors would write to disks nobody else can read.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set and the master is {master}: name a folder that "
                "the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder
    (with its scheme, so the default file system does not matter)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"
