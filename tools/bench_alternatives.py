"""Measure the plan choices against the literal forms of the source report.

  valuation: one unpivoted, bounded-broadcast rate lookup + one aggregation per
             roadmap (ours) vs six left joins of the rate table per impact row and a
             group-by per milestone key (the source's literal form);
  project restriction: semi join of the needed projects first (ours) vs a join at
             the end (the source's);
Usage: python tools/bench_alternatives.py [sf_dir]   (prints one JSON line)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from literal import literal_valuation  # noqa: E402
from tollgate.session import local_session  # noqa: E402


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(
            spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tollgate-alt-"))
    from tollgate.operators.valuation import value_keys
    from tollgate.plans.queries import KEY_COLUMNS, P, _t
    from tollgate.plans.report import filtered_milestones, report_rows

    t = _t(spark, sf)
    keys = filtered_milestones(t, P).select(*KEY_COLUMNS).distinct()
    ours = value_keys(keys, t, P).select(*KEY_COLUMNS, F.col("numeric_factor").cast("double"),
                                          "Plan", "Actual", "Update", "Plan_To_Date", "Actual_To_Date",
                                          "Update_To_Date")
    lit = literal_valuation(t, P, keys)
    timed(ours)  # warm-up
    res = {"valuation_unpivoted_one_lookup": timed(ours), "valuation_literal_six_joins": timed(lit)}
    same = sorted(map(tuple, ours.collect())) == sorted(map(tuple, lit.select(*ours.columns).collect()))
    res["valuation_results_equal"] = same

    needed = t.snapshot_needed
    for rep in range(2):
        late = report_rows(t, P).join(needed.select(F.col("project_id").alias("A_FK_Project")), "A_FK_Project",
                                      "left_semi")
        res[f"report_restricted_late_{rep}"] = timed(late)
        early = report_rows(t, P, projects=needed)
        res[f"report_restricted_early_{rep}"] = timed(early)
    print(json.dumps({"sf": sf, **res}))
    spark.stop()


if __name__ == "__main__":
    main()
