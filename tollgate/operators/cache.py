"""Insert-if-absent report cache keyed by project snapshot, and its read-back.

The cache is a parquet table partitioned by (A_FK_REPORT_CACHE,
A_FK_REPORT_FILTER_CACHE), so a read-back for one report prunes to its own
directories. Within one, each merge's files are range-clustered on the project and hold Bloom
filters of it, so the anti join of a merge and a read-back skip the row groups and pages of
other projects: the table grows with every project cached, a request touches a few. A merge appends only the rows whose 8-column key is not in the
table yet (there is no update or delete branch). Keys compare with plain
equality: a row with a NULL key column (a NULL base impact) never matches and is
appended again on every run, as the source semantics require.

Failure behaviour: the new rows are computed by an anti join against the table
as it was when the job started and written through Spark's file commit
protocol, so a lost executor re-runs tasks and a failed job leaves the table as
it was. There is one writer per report cache id; concurrent writers to the same
id are not serialised.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.joins import key_bounds, stored_rows_of
from tollgate.operators.ordering import with_ordinal
from tollgate.params import ReportParams

SNAPSHOT_COLUMNS = ["A_FK_SNAPSHOT", "A_LAST_MODIFIED_FOR_CACHE_UTC", "A_ROADMAP_SUBSET_HASH"]
ID_COLUMNS = ["A_FK_REPORT_CACHE", "A_FK_REPORT_FILTER_CACHE"]
# The 52 cache columns, in table order.
CACHE_COLUMNS = [
    *ID_COLUMNS, *SNAPSHOT_COLUMNS,
    "PROJ_PARENT", "P_ID", "WS_OWNER", "PJ_Num", "RM_ID", "RM_TL_DICE", "RM_TL_MS", "RM_TL_IM",
    "RM_TL_OVERALL", "RM_NUMBER", "RM_OWNER", "RM_APPROVER", "MEMBER_NAME", "ROADMAP_DESCRIPTION",
    "Status_2Weeks_ago", "Status_1Weeks_ago", "A_Milestone", "Milestone_Sort_order", "A_Plan",
    "A_Forecast", "DELAY_OVERDUE", "MilestoneDueInNextNDays", "Milestone_Owner", "BI_NAME", "BI_UNIT",
    "CURRENCY_CODE", "RM_STAGE", "G4_DueDate", "PG_START_YEAR", "PG_END_YEAR",
    "Project_Status_Rationale", "Project_Decisions_Needed", "Project_TMO_Comments",
    "Project_Actions_for_Next_Week", "Project_Actions_from_Last_Week", "Roadmap_Interdependency",
    "Plan", "Actual", "Update", "Plan_To_Date", "Actual_To_Date", "Update_To_Date",
    "A_FK_Milestone", "A_FK_BASE_IMPACT", "A_DICE_ENABLED", "ProjectURL", "RoadmapURL",
]
# Types of the cache columns that are not text. ID columns take the tables' id type.
ID_TYPED = ("P_ID", "RM_ID", "A_FK_Milestone")
_TYPES = {
    **dict.fromkeys((*ID_COLUMNS, "A_FK_SNAPSHOT", "Milestone_Sort_order", "DELAY_OVERDUE", "MilestoneDueInNextNDays",
                     "PG_START_YEAR", "PG_END_YEAR"), "int"),
    **dict.fromkeys(("A_LAST_MODIFIED_FOR_CACHE_UTC", "A_Plan", "A_Forecast", "G4_DueDate"), "timestamp_ntz"),
    **dict.fromkeys(("Plan", "Actual", "Update", "Plan_To_Date", "Actual_To_Date", "Update_To_Date"), "decimal(38,6)"),
    "A_ROADMAP_SUBSET_HASH": "bigint", "A_DICE_ENABLED": "boolean",
}
MERGE_KEY = [*ID_COLUMNS, *SNAPSHOT_COLUMNS, "P_ID", "A_FK_Milestone", "A_FK_BASE_IMPACT"]
TEXT_KEYS = ("A_FK_BASE_IMPACT",)  # of the merge key, those that are no ids of numbers or GUIDs
# Order of the rows in the files. The milestone splits a project that holds many of the rows.
CLUSTER_KEY = [*ID_COLUMNS, "P_ID", "A_FK_Milestone"]
# Row groups and pages small enough that a request's projects touch few; the size of a
# Bloom filter follows the number of values in its row group.
FILE_OPTIONS = {
    "parquet.block.size": str(32 << 20), "parquet.page.row.count.limit": "2000",
    "parquet.bloom.filter.enabled#P_ID": "true", "parquet.bloom.filter.adaptive.enabled": "true",
}
MARKER_COLUMNS = [*ID_COLUMNS, "project_id", "snapshot_id", "last_modified", "subset_hash", "marked_at"]
MARKER_KEY = MARKER_COLUMNS[:-1]


def cache_schema(id_type: str = "bigint") -> str:
    """The cache table's schema. Reads state it, so a table whose only merge so far was
    empty (a folder without data files) reads as an empty table."""
    types = {**_TYPES, **dict.fromkeys(ID_TYPED, id_type)}
    return ", ".join(f"`{c}` {types.get(c, 'string')}" for c in CACHE_COLUMNS)


def marker_schema(id_type: str = "bigint") -> str:
    return (f"A_FK_REPORT_CACHE int, A_FK_REPORT_FILTER_CACHE int, project_id {id_type}, snapshot_id int, "
            "last_modified timestamp_ntz, subset_hash bigint, marked_at timestamp_ntz")


def snapshot_columns(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "project_id",
        F.col("snapshot_id").alias("A_FK_SNAPSHOT"),
        F.col("last_modified").alias("A_LAST_MODIFIED_FOR_CACHE_UTC"),
        F.col("subset_hash").alias("A_ROADMAP_SUBSET_HASH"),
    )


def cache_rows(report: DataFrame, needed: DataFrame, p: ReportParams) -> DataFrame:
    """Report rows of the needed projects as cache rows (by column name, never by
    position). `report` must carry A_FK_Project."""
    src = report.join(snapshot_columns(needed), report.A_FK_Project == F.col("project_id"))
    return src.select(
        F.lit(p.report_cache_id).alias("A_FK_REPORT_CACHE"),
        F.lit(p.report_filter_cache_id).alias("A_FK_REPORT_FILTER_CACHE"),
        *[F.col(c) for c in CACHE_COLUMNS[2:]],
    )


def _key_match(new: DataFrame, old: DataFrame, collation: str | None = None):
    cond = None
    for k in MERGE_KEY:
        under = collation is not None and k in TEXT_KEYS
        c = (F.collate(new[k], collation) == F.collate(old[k], collation)) if under else new[k] == old[k]
        cond = c if cond is None else cond & c
    return cond


def rows_to_insert(new_rows: DataFrame, target: DataFrame, text_collation: str | None = None) -> DataFrame:
    """Rows of `new_rows` whose merge key is absent from `target` (NULL keys never
    match). Duplicate source rows are all kept, like an insert without a unique key.
    The key's text compares under `text_collation`, its ids and times stay binary."""
    tgt = target.select(*MERGE_KEY)
    return new_rows.join(tgt, _key_match(new_rows, tgt, text_collation), "left_anti")


def merged(new_rows: DataFrame, target: DataFrame, text_collation: str | None = None) -> DataFrame:
    """The cache table after the merge: the old rows plus the inserted ones."""
    return target.select(*CACHE_COLUMNS).unionByName(rows_to_insert(new_rows, target, text_collation).select(*CACHE_COLUMNS))


def markers(needed: DataFrame, p: ReportParams, marked_at: dt.datetime | None = None) -> DataFrame:
    """One completion marker per needed project snapshot."""
    return needed.select(
        F.lit(p.report_cache_id).alias("A_FK_REPORT_CACHE"),
        F.lit(p.report_filter_cache_id).alias("A_FK_REPORT_FILTER_CACHE"),
        "project_id", "snapshot_id", "last_modified", "subset_hash",
        (F.lit(marked_at).cast("timestamp_ntz") if marked_at else F.lit(None).cast("timestamp_ntz"))
        .alias("marked_at"),
    )


def _ids_match(p: ReportParams):
    """The cache ids of a request: a partition filter on the cache table."""
    return ((F.col("A_FK_REPORT_CACHE") == p.report_cache_id)
            & (F.col("A_FK_REPORT_FILTER_CACHE") == p.report_filter_cache_id))


def read_back(cache: DataFrame, in_report: DataFrame, p: ReportParams) -> DataFrame:
    """Cache rows of the report's project snapshots (all 52 columns). The cache partition
    is first cut to their projects."""
    projects = in_report.select(F.col("project_id").alias("P_ID"))
    c = stored_rows_of(cache.where(_ids_match(p)), projects, "P_ID", key_bounds(projects, "P_ID")["P_ID"])
    r = snapshot_columns(in_report).withColumnRenamed("project_id", "r_project_id")
    cond = (
        (c.A_FK_SNAPSHOT == r.A_FK_SNAPSHOT)
        & (c.A_LAST_MODIFIED_FOR_CACHE_UTC == r.A_LAST_MODIFIED_FOR_CACHE_UTC)
        & (c.A_ROADMAP_SUBSET_HASH == r.A_ROADMAP_SUBSET_HASH)
        & (c.P_ID == r.r_project_id)
    )
    return c.join(r, cond).select(*[c[k] for k in CACHE_COLUMNS])


# The report's order, and what breaks its ties (the source leaves them open).
TREE_ORDER = ["A_PATH", "DELAY_OVERDUE"]
TIE_BREAK = ["A_FK_Milestone", "RM_ID", "RM_OWNER", "RM_APPROVER", "WS_OWNER", "Status_2Weeks_ago", "Status_1Weeks_ago",
             "G4_DueDate"]


def _with_path(rows: DataFrame, tree: DataFrame) -> DataFrame:
    t = tree.select(F.col("project_id").alias("tree_project_id"), F.col("path").alias("A_PATH"))
    return rows.join(t, rows.P_ID == t.tree_project_id)


def in_tree_order(rows: DataFrame, tree: DataFrame, text_collation: str | None = None) -> DataFrame:
    """Rows joined to the project tree (a project with several tree rows repeats)
    and sorted by tree path, then delay, then the tie-break. The sort is a
    range-partitioned global sort, not a single-task one. Paths sort under `text_collation`."""
    path = F.col("A_PATH") if text_collation is None else F.collate("A_PATH", text_collation)
    order = [path.asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in [*TREE_ORDER[1:], *TIE_BREAK]]]
    return _with_path(rows, tree).orderBy(*order).select(*CACHE_COLUMNS)


def with_tree_position(rows: DataFrame, tree: DataFrame, name: str = "position") -> DataFrame:
    """Rows in the report's order with each one's position as a column."""
    return with_ordinal(_with_path(rows, tree), TREE_ORDER + TIE_BREAK, name).select(*CACHE_COLUMNS, name)


class ReportCache:
    """The cache table and its completion markers under one root directory."""

    def __init__(self, spark: SparkSession, root: str, id_type: str = "bigint"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.id_type = id_type
        self.table_path = f"{self.root}/report_cache"
        self.marker_path = f"{self.root}/cached_projects"

    def _read(self, path: str, schema: str) -> DataFrame:
        """The table at `path`; an empty one where nothing was written yet."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def table(self) -> DataFrame:
        return self._read(self.table_path, cache_schema(self.id_type)).select(*CACHE_COLUMNS)

    def marked(self) -> DataFrame:
        return self._read(self.marker_path, marker_schema(self.id_type)).select(*MARKER_COLUMNS)

    def merge(self, new_rows: DataFrame, p: ReportParams | None = None, needed: DataFrame | None = None) -> None:
        """Append the rows whose key is not cached yet.

        With the request's params the comparison reads only the table partition of
        its cache ids; with its needed snapshots (project_id) only the cached rows of
        those projects, since no other row can share a key with the new ones: the
        table grows with every project cached, a request touches a few of them.
        """
        target = self.table()
        if p is not None:
            target = target.where(_ids_match(p))
        if needed is not None:
            projects = needed.select(F.col("project_id").alias("P_ID"))
            target = stored_rows_of(target, projects, "P_ID", key_bounds(projects, "P_ID")["P_ID"])
        rows = rows_to_insert(new_rows.select(*CACHE_COLUMNS), target, None if p is None else p.text_collation)
        clustered = rows.repartitionByRange(*CLUSTER_KEY).sortWithinPartitions(*CLUSTER_KEY)
        clustered.write.mode("append").partitionBy(*ID_COLUMNS).options(**FILE_OPTIONS).parquet(self.table_path)

    def mark(self, needed: DataFrame, p: ReportParams) -> None:
        """Record the needed project snapshots as cached (after the merge committed).
        Insert-if-absent, so a replayed request adds no second marker."""
        rows = markers(needed, p, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).dropDuplicates(
            MARKER_KEY)
        old = self.marked().where(_ids_match(p)).select(*MARKER_KEY)
        cond = None
        for k in MARKER_KEY:
            c = rows[k] == old[k]
            cond = c if cond is None else cond & c
        rows.join(old, cond, "left_anti").write.mode("append").partitionBy(*ID_COLUMNS).parquet(self.marker_path)

    def needed(self, in_report: DataFrame, p: ReportParams) -> DataFrame:
        """The report's project snapshots that have no completion marker yet (the
        `snapshot_needed` relation of a request), by an anti join on the marker key."""
        done = self.marked().where(_ids_match(p)).select(
            F.col("project_id").alias("m_project_id"), F.col("snapshot_id").alias("m_snapshot_id"),
            F.col("last_modified").alias("m_last_modified"), F.col("subset_hash").alias("m_subset_hash"))
        cond = ((in_report.project_id == done.m_project_id) & (in_report.snapshot_id == done.m_snapshot_id)
                & (in_report.last_modified == done.m_last_modified) & (in_report.subset_hash == done.m_subset_hash))
        return in_report.join(done, cond, "left_anti")

    def read_back(self, in_report: DataFrame, p: ReportParams) -> DataFrame:
        return read_back(self.table(), in_report, p)
