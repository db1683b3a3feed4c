"""Fill the report cache from a stream of report requests.

Each request names project snapshots that need computing (the `snapshot_needed`
relation of one report call). A Structured Streaming query reads request files
as they arrive and, per micro-batch, computes the report rows of those
projects, merges them into the cache (insert-if-absent) and marks the projects.

Replays are safe: after a failure the micro-batch is processed again, and the
merge only appends rows whose key is not in the cache yet, and the markers are
insert-if-absent too. (Rows with a NULL key are appended again, as in any merge.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tollgate.operators.cache import ReportCache
from tollgate.params import ReportParams
from tollgate.plans.run import compute_cache_rows
from tollgate.sources.tables import RELATIONS, Tables


def fill_batch(tables: Tables, params: ReportParams, cache: ReportCache):
    """The foreachBatch function: one micro-batch of requested snapshots."""

    def fill(batch: DataFrame, batch_id: int) -> None:
        needed = batch.dropDuplicates().persist()
        try:
            if needed.isEmpty():
                return
            cache.merge(compute_cache_rows(tables, params, needed), params, needed)
            cache.mark(needed, params)
        finally:
            needed.unpersist()

    return fill


def start_cache_fill(
    spark: SparkSession,
    tables: Tables,
    params: ReportParams,
    cache: ReportCache,
    requests_path: str,
    checkpoint_location: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream over parquet request files under `requests_path`.

    `checkpoint_location` must be on storage every node can reach (the stream's
    progress and offsets live there). With `available_now` the query processes
    what has arrived and stops; otherwise it keeps running.
    """
    requests = spark.readStream.schema(RELATIONS["snapshot_needed"]).parquet(requests_path)
    writer = (
        requests.writeStream.foreachBatch(fill_batch(tables, params, cache))
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
