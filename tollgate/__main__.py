"""Run one report request from the command line (spark-submit friendly).

  python -m tollgate --tables <root> --cache <root> --out <path> \\
      --program-id 1 --base-impact N3 --today 2000-01-01 ...
  (or spark-submit tollgate/__main__.py with the same arguments)

`--tables` holds one parquet directory per domain relation (sources.tables), the
request's snapshots (snapshot_in_report) included; which of them are still needed follows
from the cache's completion markers. `--today` and `--status-as-of` default to the
current date. The result (cache rows in tree order) is written as parquet to `--out`.
"""

from __future__ import annotations

import argparse
import datetime as dt
from decimal import Decimal

from tollgate.params import DEFAULT_PARAMS, ReportParams, impact_choice


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


DATE_FIELDS = [
    "filter_date_start", "filter_date_end", "today", "one_time_start", "one_time_end", "recurring_start",
    "recurring_end", "calculation_date_as_of", "default_milestone_date", "status_as_of",
]
CURRENT_DATE_FIELDS = ("today", "status_as_of")
INT_FIELDS = [
    "due_in_next_n_days", "multiplier_set_id", "multiplier_set_id_to_date", "multiplier_per_year",
    "report_cache_id", "report_filter_cache_id",
]
ID_FIELDS = ["program_id", "report_currency_id", "gate_stage_id"]


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tollgate", description=__doc__.splitlines()[0])
    ap.add_argument("--tables", required=True, help="root of the domain relations (parquet)")
    ap.add_argument("--cache", required=True, help="root of the report cache and markers")
    ap.add_argument("--out", required=True, help="where to write the result (parquet)")
    ap.add_argument("--base-impact", action="append", default=[],
                    help="picked base impact id (repeatable; none = unset; the all-zero id = none)")
    ap.add_argument("--numeric-factor", type=Decimal, default=None)
    ap.add_argument("--exclude-one-time", action="store_true")
    ap.add_argument("--exclude-recurring", action="store_true")
    ap.add_argument("--text-collation", default=None,
                    help="collation of the report's text keys and DISTINCTs, e.g. UNICODE_CI_RTRIM (default: binary)")
    ap.add_argument("--text-ids", action="store_true", help="the tables' ids are texts (GUIDs), not numbers")
    ap.add_argument("--fold-multi-valued", action="store_true",
                    help="one cell for several holders of a role or tied statuses, not one row each")
    for f in DATE_FIELDS:
        default = dt.date.today() if f in CURRENT_DATE_FIELDS else getattr(DEFAULT_PARAMS, f)
        ap.add_argument("--" + f.replace("_", "-"), type=_date, default=default)
    for f in ID_FIELDS:
        ap.add_argument("--" + f.replace("_", "-"), default=str(getattr(DEFAULT_PARAMS, f)))
    for f in INT_FIELDS:
        ap.add_argument("--" + f.replace("_", "-"), type=int, default=getattr(DEFAULT_PARAMS, f))
    return ap


def params_from_args(args: argparse.Namespace) -> ReportParams:
    mode, bi = impact_choice([b.lower() for b in args.base_impact] if args.text_ids else args.base_impact)
    values = {f: getattr(args, f) for f in DATE_FIELDS + INT_FIELDS}
    values |= {f: getattr(args, f).lower() if args.text_ids else int(getattr(args, f)) for f in ID_FIELDS}
    return ReportParams(
        **values, impact_mode=mode, base_impact_id=bi, numeric_factor=args.numeric_factor,
        include_one_time=not args.exclude_one_time, include_recurring=not args.exclude_recurring,
        text_collation=args.text_collation, fold_multi_valued=args.fold_multi_valued,
    )


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    p = params_from_args(args)
    from pyspark.sql import SparkSession

    from tollgate.operators.cache import ReportCache
    from tollgate.plans.run import run_report
    from tollgate.session import apply_recommended
    from tollgate.sources import read_tables

    spark = apply_recommended(SparkSession.builder.appName("tollgate").getOrCreate())
    cache = ReportCache(spark, args.cache, id_type="string" if args.text_ids else "bigint")
    tables = read_tables(spark, args.tables, text_ids=args.text_ids)
    tables = tables.replace(snapshot_needed=cache.needed(tables.snapshot_in_report, p))
    result = run_report(tables, p, cache)
    result.write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
