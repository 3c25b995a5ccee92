"""Session settings sized from the input."""

from __future__ import annotations

from pyspark.sql import SparkSession

SHUFFLE_INPUT_BYTES = 128 << 20
MIN_SHUFFLE_PARTITIONS, MAX_SHUFFLE_PARTITIONS = 8, 40_000
MIN_SCAN_BYTES, MAX_SCAN_TASKS = 128 << 20, 200_000


def recommended_conf(input_bytes: int = 0) -> dict[str, str]:
    """Settings the jobs rely on, sized from the raw input.

    A shuffle partition for every 128 MB of input, up to a number whose map
    output the driver can still track; from there on the partitions grow and
    sorts spill. Scan tasks grow once there would be more than 200,000 of them.
    AQE merges small shuffle partitions and splits those of hot join keys.
    """
    shuffles = -(-input_bytes // SHUFFLE_INPUT_BYTES)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(min(max(shuffles, MIN_SHUFFLE_PARTITIONS), MAX_SHUFFLE_PARTITIONS)),
        "spark.sql.files.maxPartitionBytes": str(max(MIN_SCAN_BYTES, -(-input_bytes // MAX_SCAN_TASKS))),
        "spark.sql.session.timeZone": "UTC",
    }


def build_session(app_name: str = "sedimenta", master: str | None = None, input_bytes: int = 0,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**recommended_conf(input_bytes), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
