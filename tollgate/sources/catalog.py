"""Domain relations as bucketed catalog tables (co-located joins at scale).

The report joins most relations on roadmap_id. Stored bucketed on that key with
one bucket count, their scans are already hash-partitioned the same way, so the
sort-merge joins between them and the computed milestone keys shuffle only the
computed side; the stored sides are never shuffled. Relations keyed otherwise are
bucketed on their own key (milestone attributes on milestone_id, projects on
project_id). Tables are external (their files live under `root`), registered in
the session catalog under `database`.

A bucket is read by one task: with a key holding a large share of the rows (a hot
roadmap) the plain layout of `read_tables` is safer, since AQE can split a skewed
shuffle partition but not a bucket.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tollgate.sources.tables import RELATIONS, Tables

# relation -> bucketing key
BUCKET_KEYS = {
    "roadmap": "roadmap_id",
    "roadmap_view": "roadmap_id",
    "roadmap_stage": "roadmap_id",
    "milestone": "roadmap_id",
    "impact": "roadmap_id",
    "roadmap_audit": "roadmap_id",
    "filtered_roadmap": "roadmap_id",
    "milestone_attribute": "milestone_id",
    "project": "project_id",
    "tree": "project_id",
}


def save_catalog_tables(tables: Tables, database: str, root: str, n_buckets: int, mode: str = "overwrite") -> None:
    spark = tables.milestone.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in RELATIONS:
        w = getattr(tables, name).write.mode(mode).format("parquet").option("path", f"{root.rstrip('/')}/{name}")
        key = BUCKET_KEYS.get(name)
        if key is not None:
            w = w.bucketBy(n_buckets, key).sortBy(key)
        w.saveAsTable(f"{database}.{name}")


def read_catalog_tables(spark: SparkSession, database: str) -> Tables:
    return Tables(**{name: spark.table(f"{database}.{name}") for name in RELATIONS})
