"""tollgate: a PySpark library for the due / overdue / upcoming milestone report.

The report lists milestones that are due soon or overdue, values the impact of the
initiative (roadmap) they belong to, looks up the roadmap status as of earlier dates,
and keeps the rows in an insert-if-absent cache that is read back in tree order.

Layout:
  sources/    domain relations (read from parquet, or derived from the test tables)
  functions/  Column -> Column helpers (labels, names, dates, HTML text)
  operators/  DataFrame operators (hierarchy, due window, attributes, as-of status,
              valuation, enrichment, cache, ordering)
  plans/      the report wiring and the named query registry
  streaming/  cache filling from a stream of report requests

Entry points: `run_report` (a whole request through the cache), `report_rows` (the
48-column report), `valued_milestones` (the valuation alone).
"""

from tollgate.params import ImpactMode, ReportParams

__all__ = ["ImpactMode", "ReportCache", "ReportParams", "report_rows", "run_report", "valued_milestones"]


def __getattr__(name: str):
    # the Spark-facing entry points are imported on first use
    if name == "ReportCache":
        from tollgate.operators.cache import ReportCache
        return ReportCache
    if name in ("report_rows", "valued_milestones"):
        from tollgate.plans import report
        return getattr(report, name)
    if name == "run_report":
        from tollgate.plans.run import run_report
        return run_report
    raise AttributeError(name)
