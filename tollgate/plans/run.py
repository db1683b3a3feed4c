"""Run the report end to end: compute what the cache lacks, store it, read it back.

  1. gate: if no project snapshot is needed, nothing is computed (cache hit);
  2. compute: report rows restricted to the needed projects before any join or
     aggregation (a semi join at the start, not a filter at the end);
  3. store: insert-if-absent into the cache table, then mark the projects cached;
  4. read: cache rows of the report's snapshots, in project-tree order.
Every result comes from the cache, so a cache hit and a cache miss return the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tollgate.operators.cache import ReportCache, cache_rows, in_tree_order
from tollgate.params import ReportParams
from tollgate.plans.report import report_rows
from tollgate.sources.tables import Tables


def compute_cache_rows(t: Tables, p: ReportParams, needed: DataFrame) -> DataFrame:
    return cache_rows(report_rows(t, p, projects=needed), needed, p)


def run_report(t: Tables, p: ReportParams, cache: ReportCache) -> DataFrame:
    needed = t.snapshot_needed
    if not needed.isEmpty():
        cache.merge(compute_cache_rows(t, p, needed), p, needed)
        cache.mark(needed, p)
    return in_tree_order(cache.read_back(t.snapshot_in_report, p), t.tree, p.text_collation)
