"""Build domain Tables from a few hand rows; every other relation is empty."""

from __future__ import annotations

from tollgate.sources.tables import RELATIONS, Tables


def make_tables(spark, **rows) -> Tables:
    frames = {}
    for name, ddl in RELATIONS.items():
        data = rows.get(name, [])
        frames[name] = spark.createDataFrame(data, ddl)
    return Tables(**frames)
