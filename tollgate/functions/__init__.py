from tollgate.functions.html import strip_html
from tollgate.functions.labels import (
    day_diff,
    flag,
    person_name,
    project_url,
    roadmap_url,
    sentinel_datetime,
    sort_segment,
    traffic_light,
)

__all__ = [
    "day_diff",
    "flag",
    "person_name",
    "project_url",
    "roadmap_url",
    "sentinel_datetime",
    "sort_segment",
    "strip_html",
    "traffic_light",
]
