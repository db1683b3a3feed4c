"""Report parameters (the scalar and mode arguments of the report)."""

from __future__ import annotations

import dataclasses
import datetime as dt
import enum
from decimal import Decimal


class ImpactMode(enum.Enum):
    """How the picked base impact restricts the milestones.

    SELECTED: keep milestones whose roadmap has an impact of the picked base impact.
    UNSET:    no base impact was picked; keep every milestone, base impact NULL.
    NONE:     the "none" entry was picked; keep milestones whose roadmap has no impact.
    """

    SELECTED = "selected"
    UNSET = "unset"
    NONE = "none"


@dataclasses.dataclass(frozen=True)
class ReportParams:
    # ids are numbers or texts, as in the tables (sources.tables.read_tables)
    program_id: int | str = 1
    # milestone plan-date window and the due horizon
    filter_date_start: dt.date = dt.date(1997, 1, 1)
    filter_date_end: dt.date = dt.date(2000, 12, 31)
    today: dt.date = dt.date(2000, 1, 1)
    due_in_next_n_days: int = 30
    # impact valuation windows
    one_time_start: dt.date = dt.date(1996, 1, 1)
    one_time_end: dt.date = dt.date(1999, 12, 31)
    recurring_start: dt.date = dt.date(1997, 1, 1)
    recurring_end: dt.date = dt.date(2001, 12, 31)
    calculation_date_as_of: dt.date = dt.date(1999, 6, 30)
    default_milestone_date: dt.date = dt.date(1998, 6, 15)
    include_one_time: bool = True
    include_recurring: bool = True
    multiplier_set_id: int = 1
    multiplier_set_id_to_date: int = 2
    multiplier_per_year: int = 12
    report_currency_id: int | str = 1
    numeric_factor: Decimal | None = None
    # picked base impact and how it applies
    impact_mode: ImpactMode = ImpactMode.SELECTED
    base_impact_id: str | None = "N3"
    # status history: the wall clock of the reference, made explicit
    status_as_of: dt.date = dt.date(2024, 1, 20)
    # cache identity
    report_cache_id: int = 11
    report_filter_cache_id: int = 7
    # the stage whose plan date is reported as the gate due date
    gate_stage_id: int | str = 4
    # one cell for several holders of a role or several tied statuses, instead of the
    # source's one report row each
    fold_multi_valued: bool = False
    # attribute id -> narrative column, where the ids differ from the default ones
    attribute_ids: dict | None = None
    # collation of text in the report's DISTINCTs, groups and text keys (number and GUID
    # ids stay binary); None = binary. The source
    # database's is case-insensitive, trailing blanks ignored: 'UNICODE_CI_RTRIM'
    text_collation: str | None = None

    def __post_init__(self) -> None:
        if self.impact_mode is ImpactMode.SELECTED and self.base_impact_id is None:
            raise ValueError("impact_mode SELECTED needs base_impact_id")
        if not 0 < self.multiplier_per_year < 10_000:
            raise ValueError("multiplier_per_year must be 1 to 9999")

    def with_(self, **changes) -> "ReportParams":
        return dataclasses.replace(self, **changes)

    @property
    def valuation_date_range(self) -> tuple[dt.date, dt.date]:
        """Smallest date range that holds every window the valuation sums over."""
        lo = min(self.one_time_start, self.recurring_start)
        hi = max(self.one_time_end, self.recurring_end, self.calculation_date_as_of)
        return lo, hi


DEFAULT_PARAMS = ReportParams()


# Fixed value: the base-impact id that stands for "none" in a request.
NONE_BASE_IMPACT_ID = "00000000-0000-0000-0000-000000000000"


def impact_choice(base_impact_ids: list) -> tuple[ImpactMode, str | None]:
    """Mode and base impact from a request's picked base impacts (0 or 1 ids).

    No id -> UNSET; the all-zero id -> NONE; any other id -> SELECTED. Several ids
    are ambiguous (the source picks an arbitrary one) and raise.
    """
    if len(base_impact_ids) > 1:
        raise ValueError("at most one base impact can be picked")
    if not base_impact_ids or base_impact_ids[0] is None:
        return ImpactMode.UNSET, None
    b = str(base_impact_ids[0])
    if b.lower() == NONE_BASE_IMPACT_ID:
        return ImpactMode.NONE, None
    return ImpactMode.SELECTED, b
