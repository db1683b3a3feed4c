"""Position of every row in a total order, without a single-task window.

A window with no partition key sorts everything in one task. Here the rows are
range-partitioned on the order (balanced partitions, sampled bounds), the
partitioning is fixed by a checkpoint (sampling is not repeatable), each
partition's row count is taken (one small row per partition reaches the
driver), and a row's position is its partition's offset plus its row number
within the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.plans.materialize import materialize


def with_ordinal(df: DataFrame, order_cols: list[str], name: str = "ordinal",
                 n_partitions: int | None = None) -> DataFrame:
    """df plus `name`: the 1-based position (bigint) of each row when sorted by
    `order_cols` (ascending, NULLs first). `order_cols` must break every tie."""
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    counts = sorted((r["_part"], r["count"]) for r in ranged.groupBy("_part").count().collect())
    offsets, total = [], 0
    for part, c in counts:
        offsets.append((part, total))
        total += c
    off = spark.createDataFrame(offsets, "_part INT, _offset BIGINT")
    w = Window.partitionBy("_part").orderBy(*order)
    return (
        ranged.join(F.broadcast(off), "_part")
        .withColumn(name, F.col("_offset") + F.row_number().over(w))
        .drop("_part", "_offset")
    )
