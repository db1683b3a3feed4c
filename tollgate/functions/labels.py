"""Column -> Column helpers for the report's labels and derived fields.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference report's output text.
# Traffic light code -> label; any other code, and NULL, is "Red".
TRAFFIC_LIGHT_LABELS = {1: "Black", 2: "White", 3: "Green", 4: "Yellow"}
TRAFFIC_LIGHT_DEFAULT = "Red"
# URL prefixes of the project and initiative pages.
PROJECT_URL_PREFIX = "ng-program-tree/project?programId="
PROJECT_URL_KEY = "&projectId="
ROADMAP_URL_PREFIX = "ng-program-tree/initiative?programId="
ROADMAP_URL_KEY = "&roadmapId="
# Separator between last and first name.
NAME_SEPARATOR = ", "
# Dates whose year is not after this one are placeholders and report as NULL.
SENTINEL_YEAR = 1900


def traffic_light(code: Column) -> Column:
    """Code 1..4 -> label, anything else (NULL included) -> 'Red'."""
    out = F.lit(TRAFFIC_LIGHT_DEFAULT)
    for k in sorted(TRAFFIC_LIGHT_LABELS, reverse=True):
        out = F.when(code == k, F.lit(TRAFFIC_LIGHT_LABELS[k])).otherwise(out)
    return out


def person_name(last: Column, first: Column) -> Column:
    """'Last, First'; 'Last' when first is NULL or blank; '' when both are NULL.

    NULL parts concatenate as '' and a blank first name is kept as is (with no
    separator), like a NULL-tolerant CONCAT.
    """
    blank_first = first.isNull() | (F.ltrim(F.rtrim(first)) == "")
    sep = F.when(blank_first, F.lit("")).otherwise(F.lit(NAME_SEPARATOR))
    return F.concat(F.coalesce(last, F.lit("")), sep, F.coalesce(first, F.lit("")))


def flag(cond: Column) -> Column:
    """IIF(cond, 1, 0) as a boolean: NULL counts as false."""
    return F.coalesce(cond, F.lit(False))


def day_diff(start: Column, end: Column) -> Column:
    """Number of calendar-day boundaries from start to end (end - start, in days)."""
    return F.datediff(F.to_date(end), F.to_date(start))


def sentinel_datetime(d: Column) -> Column:
    """Placeholder dates (year <= 1900) -> NULL; others as a timestamp at midnight."""
    return F.when(F.year(d) > SENTINEL_YEAR, d).cast("timestamp_ntz")


def sort_segment(sort_order: Column) -> Column:
    """'::' + the last three digits of the zero-padded integer sort order."""
    n = F.rtrim(sort_order.cast("int").cast("string"))
    return F.concat(F.lit("::"), F.right(F.concat(F.lit("000"), n), F.lit(3)))


def project_url(program_id: Column, project_id: Column, parent_project_id: Column) -> Column:
    """Project page link; the project id is blank for a project without a parent."""
    pid = F.when(parent_project_id.isNull(), F.lit("")).otherwise(project_id.cast("string"))
    return F.concat(F.lit(PROJECT_URL_PREFIX), F.lower(program_id.cast("string")), F.lit(PROJECT_URL_KEY), pid)


def roadmap_url(program_id: Column, roadmap_id: Column) -> Column:
    """Initiative page link; NULL when the roadmap is missing."""
    return F.concat(
        F.lit(ROADMAP_URL_PREFIX), F.lower(program_id.cast("string")), F.lit(ROADMAP_URL_KEY),
        F.lower(roadmap_id.cast("string")),
    )
