"""Session settings the report relies on, and a local session for tests and benches."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tollgate.operators.joins import PUSHED_KEYS

# Runtime SQL settings: adaptive execution re-plans joins from measured sizes, splits
# skewed shuffle partitions and coalesces small ones. An aggregate (the report's
# DISTINCTs) shuffles on all of its keys instead of inheriting the partitioning of
# the join below it: a project or milestone holding a third of the rows is then
# spread over many tasks, and AQE stays free to split that skewed join (it does
# not split a join whose output partitioning a later operator relies on).
# Timestamps in the report are TIMESTAMP_NTZ; UTC keeps any zoned conversion stable.
RECOMMENDED_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.session.timeZone": "UTC",
    # the keys of a small request reach Parquet's Bloom filters and dictionaries one by one
    "spark.sql.parquet.pushdown.inFilterThreshold": str(PUSHED_KEYS),
}


def apply_recommended(spark: SparkSession) -> SparkSession:
    for k, v in RECOMMENDED_SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, app: str = "tollgate") -> SparkSession:
    """A local[cpus] session for tests and benches (no UI, no progress bar)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_recommended(spark)


def scale_conf(input_bytes: int, shuffled_fraction: float = 0.1, target_partition_bytes: int = 256 << 20,
               max_shuffle_partitions: int = 200_000) -> dict[str, str]:
    """Sizes for a run over `input_bytes` of parquet.

    Scan splits of `target_partition_bytes`; initial shuffle partitions sized so the
    largest shuffle (about `shuffled_fraction` of the input: the report shuffles
    pruned, projected rows, not whole tables) lands near that size per partition,
    with AQE coalescing small partitions back to the same advisory size. Partitions
    of this size sort and aggregate in executor memory without spilling on
    typical 4-8 GB per-core executors.
    """
    shuffled = max(1, int(input_bytes * shuffled_fraction))
    partitions = min(max_shuffle_partitions, max(200, -(-shuffled // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
