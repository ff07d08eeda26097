"""Session settings the library is tuned for. Callers may bring any session of their own."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE is what splits hot join keys, merges small shuffle partitions and, once the real size of
# a side is known, turns a planned sort-merge join into a broadcast, or into a hash join per
# partition where each one's smaller side is below the local map threshold: the stop times
# are then never sorted.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def get_session(
    app_name: str = "stopwise", master: str | None = None, **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


MB = 1 << 20


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs whose largest input has ``input_bytes``; set them at any time.

    Shuffle partitions are the one size AQE cannot raise: it merges them and splits skewed
    ones, but a stage never gets more than planned. They are planned at 256 MB of input each.
    Scan splits grow past 128 MB only where there would be more than 100,000 of them, which
    together with at most 50,000 partitions keeps the number of shuffle blocks in bounds.
    """
    split = min(max(input_bytes // 100_000, 128 * MB), 1024 * MB)
    partitions = min(max(input_bytes // (256 * MB), cores), 50_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }
