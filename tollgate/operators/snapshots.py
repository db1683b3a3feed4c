"""Status history that grows: batches of audit rows, and snapshots of the latest rows.

A status as of a date needs each roadmap's latest audit rows before a cut-off. A snapshot holds
just those for one instant, so a request reads the last snapshot before its
cut-off and the audit rows since, not the whole history.

Layout below one folder: `history/batch=<k>/month=<yyyymm>` has the audit rows of batch k (0,
1, ...), sorted by time, so that partitions and row groups outside a time range are
skipped; `snapshots/at=<date>/batches=<n>` has the latest rows before that date among the
first n batches. Rows that arrive late, in a batch after a snapshot was taken, are read
beside it until it is taken again, so no answer misses them. Writing a batch or a snapshot
again replaces it: a job that failed is repeated.

Rows that tie for the latest time of a roadmap are all kept, repeated ones too. Rows without
a time are never before a cut-off. One writer at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.operators.asof import age_cutoff, status_as_of
from tollgate.operators.joins import KeyBound

COLUMNS = ["roadmap_id", "traffic_light", "audit_time"]


def _instant(day: dt.date) -> F.Column:
    return F.lit(dt.datetime(day.year, day.month, day.day)).cast("timestamp_ntz")


def latest_rows(rows: DataFrame) -> DataFrame:
    """Each roadmap's rows of its latest time, ties kept (a group limit before the shuffle)."""
    w = Window.partitionBy("roadmap_id").orderBy(F.col("audit_time").desc())
    return rows.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")


class StatusSnapshots:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _stored(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{name}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def batches(self) -> int:
        """The number of the next batch: from the folders' names alone."""
        rows = self._stored("history")
        top = None if rows is None else rows.agg(F.max("batch")).first()[0]
        return 0 if top is None else top + 1

    def taken(self) -> dict[dt.date, int]:
        """Date of each snapshot and how many batches its latest version covers (a row per folder)."""
        rows = self._stored("snapshots")
        if rows is None:
            return {}
        return {r["at"]: r["n"] for r in rows.groupBy("at").agg(F.max("batches").alias("n")).collect()}

    def add(self, rows: DataFrame, batch: int | None = None) -> int:
        """Stores audit rows as a batch (the next one, or an earlier one again)."""
        k = self.batches() if batch is None else batch
        month = F.coalesce(F.date_format("audit_time", "yyyyMM").cast("int"), F.lit(0))
        (rows.select(*COLUMNS, month.alias("month")).repartition("month", "roadmap_id").sortWithinPartitions("month", "audit_time")
         .write.mode("overwrite").partitionBy("month").parquet(f"{self.folder}/history/batch={k}"))
        return k

    def take(self, at: dt.date) -> None:
        """Takes (again) the snapshot of all rows before `at`, from the snapshot before it."""
        n = self.batches()
        latest_rows(self.rows_before(dt.datetime(at.year, at.month, at.day), earlier_than=at)).write.mode("overwrite").parquet(
            f"{self.folder}/snapshots/at={at.isoformat()}/batches={n}")

    def rows_before(self, cutoff: dt.datetime, earlier_than: dt.date | None = None) -> DataFrame:
        """Rows that hold every roadmap's latest ones before the cut-off: the last snapshot at
        or before it, the rows since, and the batches that came after it was taken."""
        limit = F.lit(cutoff).cast("timestamp_ntz")
        history = self._stored("history")
        if history is None:
            raise ValueError(f"no history below {self.folder}")
        usable = {at: n for at, n in self.taken().items()
                  if dt.datetime(at.year, at.month, at.day) <= cutoff and (earlier_than is None or at < earlier_than)}
        if not usable:
            return history.where(F.col("audit_time") < limit).select(*COLUMNS)
        at = max(usable)
        n = usable[at]
        snapshot = self.spark.read.parquet(f"{self.folder}/snapshots/at={at.isoformat()}/batches={n}")
        since = history.where((F.col("batch") < n) & (F.col("month") >= at.year * 100 + at.month)
                              & (F.col("audit_time") >= _instant(at)) & (F.col("audit_time") < limit))
        late = history.where((F.col("batch") >= n) & (F.col("audit_time") < limit))
        return snapshot.select(*COLUMNS).unionByName(since.select(*COLUMNS)).unionByName(late.select(*COLUMNS))

    def status_as_of(self, as_of: dt.date, min_age_days: int, roadmaps: DataFrame | None = None,
                     n_roadmaps: KeyBound | None = None) -> DataFrame:
        """As `asof.status_as_of` over the whole history."""
        return status_as_of(self.rows_before(age_cutoff(as_of, min_age_days)), roadmaps, as_of, min_age_days, n_roadmaps=n_roadmaps)
