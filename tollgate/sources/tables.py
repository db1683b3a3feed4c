"""The domain relations the report reads, and parquet I/O for them.

In production every relation is a parquet table (one directory per relation);
`read_tables` opens them lazily so Catalyst prunes columns and pushes filters
into each scan. `derive_tables` (testdata.py) builds the same relations from the
TPC-H-like test tables instead.
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.text import collated

# relation name -> DDL schema
RELATIONS: dict[str, str] = {
    "program": "program_id INT, program_name STRING, start_date DATE, end_date DATE, dice_enabled BOOLEAN",
    "project": "project_id BIGINT, project_name STRING, project_number STRING, parent_project_id BIGINT, program_id INT",
    "roadmap": "roadmap_id BIGINT, roadmap_name STRING, description STRING, stage_id INT",
    "roadmap_view": "roadmap_id BIGINT, roadmap_number STRING, tl_dice INT, tl_milestone INT, tl_impact INT, tl_overall INT",
    "stage": "stage_id INT, stage_name STRING",
    "roadmap_stage": "roadmap_id BIGINT, stage_id INT, plan_date DATE",
    "milestone": (
        "roadmap_id BIGINT, milestone_id BIGINT, program_id INT, milestone_name STRING, plan_date DATE, "
        "forecast_date DATE, update_date DATE, sort_order INT, tl_overall INT"
    ),
    "impact": (
        "roadmap_id BIGINT, milestone_id BIGINT, base_impact_id STRING, program_id INT, program_currency_id INT, "
        "financial BOOLEAN, plan_date DATE, actual_date DATE, forecast_date DATE, "
        "plan_intercept DECIMAL(19,4), plan_slope DECIMAL(19,4), actual_intercept DECIMAL(19,4), "
        "actual_slope DECIMAL(19,4), forecast_intercept DECIMAL(19,4), forecast_slope DECIMAL(19,4)"
    ),
    "base_impact": (
        "base_impact_id STRING, parent_id STRING, program_id INT, base_impact_name STRING, unit STRING, "
        "sort_order DECIMAL(10,2), financial BOOLEAN, calculated BOOLEAN, timing INT"
    ),
    "base_impact_factor": "base_impact_id STRING, program_currency_id INT, numeric_factor DECIMAL(19,4)",
    "program_currency": "program_currency_id INT, currency_id INT",
    "currency": "currency_id INT, code STRING",
    "multiplier_set_day": (
        "day DATE, program_currency_id INT, multiplier_set INT, exchange_rate DECIMAL(18,6), "
        "financial_multiplier DECIMAL(18,6), multiplier DECIMAL(18,6)"
    ),
    "milestone_attribute": "milestone_id BIGINT, attribute_id INT, text_value STRING",
    "roadmap_audit": "roadmap_id BIGINT, traffic_light INT, audit_time TIMESTAMP_NTZ",
    "users": "user_id BIGINT, last_name STRING, first_name STRING",
    "user_role": "roadmap_id BIGINT, project_id BIGINT, role INT, user_id BIGINT",
    "tree": "project_id BIGINT, path STRING",
    # parameter relations of one report request
    "filtered_roadmap": "roadmap_id BIGINT, program_id INT, project_id BIGINT",
    "snapshot_in_report": "project_id BIGINT, snapshot_id INT, last_modified TIMESTAMP_NTZ, subset_hash BIGINT",
    "snapshot_needed": "project_id BIGINT, snapshot_id INT, last_modified TIMESTAMP_NTZ, subset_hash BIGINT",
}


@dataclasses.dataclass(frozen=True)
class Tables:
    program: DataFrame
    project: DataFrame
    roadmap: DataFrame
    roadmap_view: DataFrame
    stage: DataFrame
    roadmap_stage: DataFrame
    milestone: DataFrame
    impact: DataFrame
    base_impact: DataFrame
    base_impact_factor: DataFrame
    program_currency: DataFrame
    currency: DataFrame
    multiplier_set_day: DataFrame
    milestone_attribute: DataFrame
    roadmap_audit: DataFrame
    users: DataFrame
    user_role: DataFrame
    tree: DataFrame
    filtered_roadmap: DataFrame
    snapshot_in_report: DataFrame
    snapshot_needed: DataFrame

    def replace(self, **changes: DataFrame) -> "Tables":
        return dataclasses.replace(self, **changes)


# The id columns: numbers in the declared schemas, or texts (GUIDs) with `text_ids`.
ID_COLUMNS = ("program_id", "project_id", "parent_project_id", "roadmap_id", "stage_id", "milestone_id", "base_impact_id",
              "parent_id", "program_currency_id", "currency_id", "attribute_id", "user_id")


def relation_schema(name: str, text_ids: bool = False) -> str:
    """The relation's DDL; with `text_ids` every id column is a STRING."""
    columns = re.findall(r"(\w+) ([A-Z_]+(?:\([\d,]+\))?)", RELATIONS[name])
    return ", ".join(f"{c} {'STRING' if text_ids and c in ID_COLUMNS else kind}" for c, kind in columns)


def lower_ids(df: DataFrame) -> DataFrame:
    """Text ids in lower case, so that GUIDs compare as the source database compares them."""
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name in ID_COLUMNS}
    return df.select(*[F.lower(c).alias(c) if c in text else F.col(c) for c in df.columns])


# The id columns that are texts in the declared schemas: not numbers, so the source
# database compares them under its collation.
TEXT_KEYS = tuple(sorted({c for ddl in RELATIONS.values() for c in re.findall(r"(\w+) STRING", ddl) if c in ID_COLUMNS}))


def collate_keys(tables: Tables, collation: str | None) -> Tables:
    """The relations with their text keys compared under the collation. Number ids stay binary, and so do
    GUIDs (`lower_ids` spells each one way), so the large joins keep their hashes and pushed filters."""
    if collation is None:
        return tables
    return Tables(**{f.name: collated(getattr(tables, f.name), TEXT_KEYS, collation) for f in dataclasses.fields(tables)})


def read_tables(spark: SparkSession, root: str, text_ids: bool = False) -> Tables:
    """Open every relation as `<root>/<name>` parquet with its declared schema; with
    `text_ids` all ids are texts (GUIDs), read in lower case. The parameters' ids are
    then lower-case texts too."""
    frames = {}
    for name in RELATIONS:
        df = spark.read.schema(relation_schema(name, text_ids)).parquet(f"{root.rstrip('/')}/{name}")
        frames[name] = lower_ids(df) if text_ids else df
    return Tables(**frames)


def write_tables(tables: Tables, root: str, mode: str = "errorifexists") -> None:
    for name in RELATIONS:
        getattr(tables, name).write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")
