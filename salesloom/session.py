"""Session settings shared by the tests, the benchmark and local runs.

A cluster session normally arrives from outside; nothing in the library depends on these
settings for right results.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Run-time replanning: coalesce small shuffle partitions, split skewed join partitions,
    # switch to a broadcast join when the measured size of a side allows it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, memory: str = "8g", name: str = "salesloom") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(cpus)).config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir("/tmp/checkpoints")  # one machine: a folder all tasks reach
    return spark


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings to submit a job of the given input size with.

    A shuffle partition stands for about 2 GB of input files, which column pruning and map-side
    combining bring to a few hundred megabytes; there are at least three per core, and adaptive execution
    merges the ones that turn out small. Scans read half a gigabyte per task once there is that much.
    """
    partitions = max(3 * cores, input_bytes // (2 << 30))
    scan = 512 << 20 if input_bytes // (512 << 20) >= 3 * cores else 128 << 20
    return {
        **{k: v for k, v in SETTINGS.items() if k.startswith("spark.sql.")},
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan),
    }
