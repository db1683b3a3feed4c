"""DuckDB SQL oracles, written independently of the Spark code.

The domain relations are re-derived from the test tables in plain SQL (the same
rules as sources/testdata.py), and each query is written the way the source
report states it: six literal multiplier joins instead of one unpivoted lookup,
plain left joins to role holders and tied statuses, a milestone re-join, and so
on. One thing is folded here as in the library: several values of a milestone's
attribute stand in one cell, sorted, where the source makes a row per combination. The driver registers the test tables as views and runs these strings.
"""

from __future__ import annotations

from tollgate.params import DEFAULT_PARAMS, ImpactMode, ReportParams

P = DEFAULT_PARAMS
P_UNSET = P.with_(impact_mode=ImpactMode.UNSET, base_impact_id=None)
P_NONE = P.with_(impact_mode=ImpactMode.NONE, base_impact_id=None)
from decimal import Decimal  # noqa: E402

P_FACTOR = P.with_(numeric_factor=Decimal("2.5000"))

NARR = [
    "Milestone_Owner", "Project_Status_Rationale", "Project_Decisions_Needed", "Project_TMO_Comments",
    "Project_Actions_for_Next_Week", "Project_Actions_from_Last_Week", "Roadmap_Interdependency",
]

DOMAIN = """
cust_prog AS (
  SELECT c_custkey, c_name, c_nationkey, n_regionkey AS program_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
program AS (
  SELECT r_regionkey AS program_id, r_name AS program_name,
         make_date(1995 + r_regionkey, 1, 1) AS start_date, make_date(2000 + r_regionkey, 12, 31) AS end_date,
         r_regionkey % 2 = 0 AS dice_enabled
  FROM region),
project AS (
  SELECT c_custkey AS project_id, c_name AS project_name, 'PJ-' || CAST(c_custkey AS VARCHAR) AS project_number,
         CASE WHEN c_custkey % 10 <> 0 THEN c_custkey - c_custkey % 10 END AS parent_project_id, program_id
  FROM cust_prog),
order_prog AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date, program_id
  FROM orders JOIN cust_prog ON o_custkey = c_custkey),
roadmap AS (
  SELECT o_orderkey AS roadmap_id, 'Roadmap ' || CAST(o_orderkey AS VARCHAR) AS roadmap_name, html AS description,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS stage_id
  FROM orders LEFT JOIN pages ON o_orderkey = page_id),
roadmap_view AS (
  SELECT o_orderkey AS roadmap_id, 'RM-' || CAST(o_orderkey AS VARCHAR) AS roadmap_number,
         CAST(o_orderkey % 6 AS INTEGER) AS tl_dice,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey % 5 + 1 AS INTEGER) END AS tl_milestone,
         CAST((o_orderkey // 7) % 5 + 1 AS INTEGER) AS tl_impact,
         CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 4 WHEN 'P' THEN 2 END AS tl_overall
  FROM orders),
stage AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS stage_id, o_orderpriority AS stage_name FROM orders),
roadmap_stage AS (
  SELECT o_orderkey AS roadmap_id, 4 AS stage_id,
         CASE WHEN o_orderkey % 13 = 0 THEN DATE '1900-05-01' WHEN o_orderkey % 17 = 0 THEN DATE '1901-01-01'
              ELSE CAST(o_orderdate AS DATE) + 90 END AS plan_date
  FROM orders WHERE o_orderstatus <> 'P'),
milestone AS (
  SELECT l_orderkey AS roadmap_id, l_orderkey * 10 + l_linenumber AS milestone_id, program_id,
         'Milestone ' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS milestone_name,
         order_date + 30 AS plan_date, first_ship AS forecast_date,
         CASE WHEN l_orderkey % 19 = 0 THEN DATE '1900-05-01' ELSE first_ship + 7 END AS update_date,
         l_linenumber AS sort_order, CASE WHEN l_linenumber <> 6 THEN l_linenumber END AS tl_overall
  FROM (SELECT l_orderkey, l_linenumber, CAST(min(l_shipdate) AS DATE) AS first_ship FROM lineitem GROUP BY 1, 2) m
  JOIN order_prog ON l_orderkey = o_orderkey),
impact AS (
  SELECT o_orderkey AS roadmap_id, l_orderkey * 10 + l_linenumber AS milestone_id,
         'N' || CAST(p_size % 25 AS VARCHAR) AS base_impact_id, program_id,
         CAST(l_suppkey % 3 AS INTEGER) AS program_currency_id, p_size % 2 = 1 AS financial,
         CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS plan_date,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS actual_date,
         CAST(l_shipdate AS DATE) + 30 AS forecast_date,
         CAST(l_extendedprice AS DECIMAL(19,4)) AS plan_intercept,
         CAST(l_quantity AS DECIMAL(19,4)) AS plan_slope,
         CAST(CAST(l_extendedprice AS DECIMAL(19,4)) - CAST(p_retailprice AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS actual_intercept,
         CAST(CAST(l_quantity AS DECIMAL(19,4)) - 1 AS DECIMAL(19,4)) AS actual_slope,
         CAST(CAST(l_extendedprice AS DECIMAL(19,4)) + CAST(p_retailprice AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS forecast_intercept,
         CAST(CAST(l_quantity AS DECIMAL(19,4)) + 1 AS DECIMAL(19,4)) AS forecast_slope
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN order_prog ON o_orderkey = l_orderkey - CASE WHEN l_orderkey > 0 AND l_orderkey % 4 = 0 THEN 1 ELSE 0 END
  WHERE l_discount > 0),
base_impact AS (
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS base_impact_id, CAST(NULL AS VARCHAR) AS parent_id,
         r_regionkey AS program_id, r_name AS base_impact_name,
         CASE WHEN r_regionkey % 2 = 1 THEN 'USD' ELSE 'units' END AS unit,
         CAST(CAST(r_regionkey AS DECIMAL(10,2)) + CAST(0.7 AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS sort_order,
         r_regionkey % 2 = 1 AS financial, r_regionkey % 3 = 0 AS calculated, CAST(1 + r_regionkey % 2 AS INTEGER) AS timing
  FROM region
  UNION ALL
  SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), n_regionkey, n_name,
         CASE WHEN n_nationkey % 2 = 1 THEN 'USD' ELSE 'units' END,
         CAST(CAST(n_nationkey AS DECIMAL(10,2)) + CAST(0.25 AS DECIMAL(10,2)) AS DECIMAL(10,2)),
         n_nationkey % 2 = 1, n_nationkey % 3 = 0, CAST(1 + n_nationkey % 2 AS INTEGER)
  FROM nation
  UNION ALL
  SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR),
         CASE WHEN c_custkey % 9 = 0 THEN CAST((program_id + 1) % 5 AS INTEGER) ELSE program_id END, c_name,
         CASE WHEN c_custkey % 2 = 1 THEN 'USD' ELSE 'units' END,
         CAST(c_custkey AS DECIMAL(10,2)),
         CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 2 = 1 END, c_custkey % 3 = 0, CAST(1 + c_custkey % 2 AS INTEGER)
  FROM cust_prog),
currencies AS (SELECT CAST(x AS INTEGER) AS cur FROM range(0, 3) t(x)),
base_impact_factor AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS base_impact_id, cur AS program_currency_id,
         CAST(1 + (n_nationkey + cur) % 4 AS DECIMAL(19,4)) AS numeric_factor
  FROM nation CROSS JOIN currencies),
program_currency AS (
  SELECT n_nationkey AS program_currency_id, n_nationkey AS currency_id FROM nation WHERE n_nationkey < 3),
currency AS (SELECT n_nationkey AS currency_id, upper(substr(n_name, 1, 3)) AS code FROM nation),
multiplier_set_day AS (
  SELECT day, cur AS program_currency_id, s AS multiplier_set,
         CAST(CAST(100 + dayofyear(day) % 50 + 10 * cur + s AS DECIMAL(18,6)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS exchange_rate,
         CAST(1 + dayofyear(day) % 12 AS DECIMAL(18,6)) AS financial_multiplier,
         CAST(12 + cur AS DECIMAL(18,6)) AS multiplier
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem) d
  CROSS JOIN currencies CROSS JOIN (SELECT 1 AS s UNION ALL SELECT 2) sets
  WHERE s = 1 OR day(day) <= 28),
milestone_attribute AS (
  SELECT l_orderkey * 10 + l_linenumber AS milestone_id, CAST(1 + l_partkey % 7 AS INTEGER) AS attribute_id,
         l_returnflag || l_linestatus || '-' || CAST(l_partkey AS VARCHAR) AS text_value FROM lineitem
  UNION ALL
  SELECT l_orderkey * 10 + l_linenumber, CAST(1 + l_suppkey % 7 AS INTEGER),
         l_returnflag || l_linestatus || '-' || CAST(l_partkey AS VARCHAR) FROM lineitem),
roadmap_audit AS (
  SELECT user_id * 100 + event_id % 10 AS roadmap_id,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4
                         WHEN 'error' THEN 5 END AS traffic_light,
         ts AS audit_time
  FROM events),
users AS (
  SELECT s_suppkey AS user_id, s_name AS last_name,
         CASE WHEN s_suppkey % 3 = 1 THEN '  ' WHEN s_suppkey % 3 = 2 THEN lower(n_name) END AS first_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
user_role AS (
  SELECT DISTINCT l_orderkey AS roadmap_id, CAST(NULL AS BIGINT) AS project_id, CAST(l_linenumber + 4 AS INTEGER) AS role,
         l_suppkey AS user_id
  FROM lineitem WHERE l_linenumber <= 2
  UNION ALL
  SELECT CAST(NULL AS BIGINT), c_custkey, 4, s_suppkey
  FROM (SELECT c_custkey, c_custkey // 15 + 1 AS owner FROM customer UNION ALL
        SELECT c_custkey, c_custkey // 15 + 2 FROM customer WHERE c_custkey % 3 = 0) o
  JOIN supplier ON s_suppkey = owner),
tree AS (
  SELECT c_custkey AS project_id,
         lpad(CAST(program_id AS VARCHAR), 19, '0') || '/' || lpad(CAST(c_custkey AS VARCHAR), 19, '0') AS path
  FROM cust_prog),
filtered_roadmap AS (SELECT o_orderkey AS roadmap_id, program_id, o_custkey AS project_id FROM order_prog),
snapshot_in_report AS (
  SELECT c_custkey AS project_id, CAST(length(c_mktsegment) AS INTEGER) AS snapshot_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS last_modified,
         (c_custkey * 7919) % 10007 AS subset_hash
  FROM customer),
snapshot_needed AS (
  SELECT c_custkey AS project_id, CAST(length(c_mktsegment) AS INTEGER) AS snapshot_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS last_modified,
         (c_custkey * 7919) % 10007 AS subset_hash
  FROM customer WHERE c_acctbal > 0)
"""

# The relations in several spellings (plans/queries.py `_spelled`) with one spelling a key: lower case
# without trailing blanks; an attribute's value as the first of its spellings. Second accounts
# of holders differ in case only, so their names are those of the first.
_TYPED = DOMAIN.strip()
for _name in ("impact", "base_impact", "base_impact_factor", "milestone_attribute"):
    _TYPED = _TYPED.replace(f"\n{_name} AS (", f"\n{_name}_given AS (")
SPELLED_DOMAIN = _TYPED + """,
impact AS (
  SELECT * REPLACE (rtrim(lower(CASE WHEN financial THEN lower(base_impact_id) || '  ' ELSE base_impact_id END)) AS base_impact_id)
  FROM impact_given),
base_impact AS (
  SELECT * REPLACE (
    rtrim(lower(CASE WHEN timing = 2 THEN lower(parent_id) || '  ' ELSE parent_id END)) AS parent_id,
    rtrim(lower(CASE WHEN calculated THEN lower(base_impact_id) ELSE base_impact_id END)) AS base_impact_id)
  FROM base_impact_given),
base_impact_factor AS (SELECT * REPLACE (rtrim(lower(base_impact_id || ' ')) AS base_impact_id) FROM base_impact_factor_given),
milestone_attribute AS (
  SELECT milestone_id, attribute_id,
         min(text_value) OVER (PARTITION BY milestone_id, attribute_id, rtrim(lower(text_value))) AS text_value
  FROM (SELECT * FROM milestone_attribute_given UNION ALL
        SELECT milestone_id, attribute_id, lower(text_value) || '  ' FROM milestone_attribute_given))"""


def spelled(sql: str) -> str:
    """The same query over the relations in several spellings."""
    return sql.replace(DOMAIN.strip(), SPELLED_DOMAIN)


def with_domain(*ctes: str) -> str:
    body = DOMAIN.strip()
    extra = ",\n".join(c.strip() for c in ctes if c.strip())
    return "WITH " + body + ((",\n" + extra) if extra else "")


def q(d) -> str:
    return f"DATE '{d.isoformat()}'"


def tl(expr: str) -> str:
    return (f"CASE WHEN {expr} = 1 THEN 'Black' WHEN {expr} = 2 THEN 'White' WHEN {expr} = 3 THEN 'Green' "
            f"WHEN {expr} = 4 THEN 'Yellow' ELSE 'Red' END")


def person(last: str, first: str) -> str:
    return (f"COALESCE({last}, '') || CASE WHEN {first} IS NULL OR ltrim(rtrim({first})) = '' THEN '' ELSE ', ' END "
            f"|| COALESCE({first}, '')")


def sentinel(expr: str) -> str:
    return f"CAST(CASE WHEN year({expr}) > 1900 THEN {expr} END AS TIMESTAMP)"


def strip_html(expr: str) -> str:
    """The constructs and references that the pages hold; tests/test_functions.py has the others."""
    closed = "([^>]*>.*?(</{0}\\b[^>]*(>|\\z)|\\z)|[^>]*\\z)"
    markup = "|".join([r"<!--.*?(-->|\z)", "<script\\b" + closed.format("script"), "<style\\b" + closed.format("style"),
                       r"</?[a-z][^>]*(>|\z)", r"<[!?/][^>]*(>|\z)"])
    s = f"regexp_replace({expr}, '(?is){markup}', ' ', 'g')"
    for name, ch in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("copy", "\u00a9"),
                     ("middot", "\u00b7"), ("amp", "&")]:
        s = f"regexp_replace({s}, '&{name};?', '{ch}', 'g')"
    s = f"regexp_replace({s}, '[ \\t\\n\\r\\f]+', ' ', 'g')"
    return f"trim({s})"


def day_diff(start: str, end: str) -> str:
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INTEGER)"


def attr_cte() -> str:
    cols = ",\n    ".join(
        f"CASE WHEN count(text_value) FILTER (WHERE attribute_id = {k}) > 0 THEN "
        f"string_agg(DISTINCT text_value, ' | ' ORDER BY text_value) FILTER (WHERE attribute_id = {k}) END AS {n}"
        for k, n in enumerate(NARR, start=1)
    )
    return f"""attr AS (
  SELECT milestone_id,
    {cols}
  FROM milestone_attribute GROUP BY milestone_id)"""


def fm_cte(p: ReportParams, name: str = "fm") -> str:
    """The filtered milestone set (mode, window, status, attributes), program filter applied."""
    if p.impact_mode is ImpactMode.SELECTED:
        mode = f"EXISTS (SELECT 1 FROM impact i WHERE i.roadmap_id = fr.roadmap_id AND i.base_impact_id = '{p.base_impact_id}')"
        bi = f"'{p.base_impact_id}'"
    elif p.impact_mode is ImpactMode.NONE:
        mode = "NOT EXISTS (SELECT 1 FROM impact i WHERE i.roadmap_id = fr.roadmap_id)"
        bi = "CAST(NULL AS VARCHAR)"
    else:
        mode = "TRUE"
        bi = "CAST(NULL AS VARCHAR)"
    narr = ", ".join(f"a.{n}" for n in NARR)
    return f"""{name} AS (
  SELECT DISTINCT fr.program_id, fr.project_id, fr.roadmap_id, m.milestone_id, {bi} AS base_impact_id,
         m.milestone_name, {day_diff('m.forecast_date', q(p.today))} AS datedif, {narr}
  FROM filtered_roadmap fr
  JOIN milestone m ON m.roadmap_id = fr.roadmap_id
  LEFT JOIN attr a ON a.milestone_id = m.milestone_id
  WHERE {mode}
    AND date_diff('day', m.forecast_date, {q(p.today)}) >= -{p.due_in_next_n_days}
    AND m.plan_date >= {q(p.filter_date_start)} AND m.plan_date <= {q(p.filter_date_end)}
    AND m.tl_overall <> 1 AND m.plan_date IS NOT NULL
    AND fr.program_id = {p.program_id})"""


METRIC_DEFS = [
    # name, date column, measure prefix, window end param, multiplier alias suffix
    ("Plan", "plan", False), ("Actual", "actual", False), ("Update", "forecast", False),
    ("Plan_To_Date", "plan", True), ("Actual_To_Date", "actual", True), ("Update_To_Date", "forecast", True),
]


def unscaled(decimal: str, scale: int, default: int | None = 0) -> str:
    """A decimal's digits as an integer (DuckDB divides decimals as doubles)."""
    digits = f"CAST(replace(CAST(CAST({decimal} AS DECIMAL(38,{scale})) AS VARCHAR), '.', '') AS HUGEINT)"
    return digits if default is None else f"COALESCE({digits}, {default})"


def decimal_quotient(n: str, d: str) -> str:
    """n / 10^10 over d / 10^4, rounded half away from zero to six decimals, by whole numbers."""
    n, d = f"({n})", f"({d})"
    size = f"((2 * abs({n}) + abs({d})) // (2 * abs({d})))"
    return f"CAST(sign({n}) * sign({d}) * {size} AS DECIMAL(31,0)) * CAST(0.000001 AS DECIMAL(7,6))"


def imp_cte(p: ReportParams, fm: str = "fm", name: str = "imp") -> str:
    """Valuation, literally: keys x impact x factor x six multiplier joins, grouped."""
    D = q(p.default_milestone_date)
    sums = []
    for metric, k, td in METRIC_DEFS:
        m = f"m_{k}_{'t' if td else 'w'}"
        ot_end = q(p.calculation_date_as_of) if td else q(p.one_time_end)
        re_end = q(p.calculation_date_as_of) if td else q(p.recurring_end)
        dd = f"COALESCE(i.{k}_date, {D})"
        ot = (f"CASE WHEN {dd} BETWEEN {q(p.one_time_start)} AND {ot_end} AND {str(p.include_one_time).upper()} "
              f"THEN i.{k}_intercept * CASE WHEN i.financial THEN {m}.exchange_rate ELSE 1 END END")
        re = (f"CASE WHEN {dd} BETWEEN {q(p.recurring_start)} AND {re_end} AND {str(p.include_recurring).upper()} "
              f"THEN i.{k}_slope * CASE WHEN i.financial THEN {m}.financial_multiplier ELSE {m}.multiplier END END")
        sums.append(f"SUM(CAST({ot} AS DECIMAL(38,10))) AS ot_{metric}")
        sums.append(f"SUM(CAST({re} AS DECIMAL(38,10))) AS re_{metric}")
    joins = []
    for k in ("plan", "actual", "forecast"):
        for td, set_id in ((False, p.multiplier_set_id), (True, p.multiplier_set_id_to_date)):
            m = f"m_{k}_{'t' if td else 'w'}"
            joins.append(
                f"LEFT JOIN multiplier_set_day {m} ON {m}.day = COALESCE(i.{k}_date, {D}) "
                f"AND {m}.program_currency_id = i.program_currency_id AND {m}.multiplier_set = {set_id}"
            )
    if p.impact_mode is ImpactMode.SELECTED:
        on = f"i.base_impact_id = '{p.base_impact_id}'"
    elif p.impact_mode is ImpactMode.NONE:
        on = "TRUE"
    else:
        on = "FALSE"
    nf = f"CAST({p.numeric_factor} AS DECIMAL(19,4))" if p.numeric_factor is not None else "f.numeric_factor"
    metrics = ",\n    ".join(
        decimal_quotient(f"{unscaled(f'ot_{m}', 10)} * {p.multiplier_per_year} + {unscaled(f're_{m}', 10)}",
                         f"{p.multiplier_per_year} * {unscaled(nf.replace('f.numeric_factor', 'numeric_factor'), 4, None)}")
        + f" AS {m}" for m, _, _ in METRIC_DEFS
    )
    s = ",\n    ".join(sums)
    j = "\n  ".join(joins)
    return f"""{name}_sums AS (
  SELECT k.program_id, k.project_id, k.base_impact_id, k.roadmap_id, k.milestone_id, f.numeric_factor,
    {s}
  FROM (SELECT DISTINCT program_id, project_id, roadmap_id, milestone_id, base_impact_id FROM {fm}) k
  LEFT JOIN impact i ON i.roadmap_id = k.roadmap_id AND ({on}) AND i.program_id = {p.program_id}
  LEFT JOIN base_impact_factor f ON f.base_impact_id = i.base_impact_id AND f.program_currency_id = {p.report_currency_id}
  {j}
  GROUP BY k.program_id, k.project_id, k.base_impact_id, k.roadmap_id, k.milestone_id, f.numeric_factor),
{name} AS (
  SELECT program_id, project_id, base_impact_id, roadmap_id, milestone_id, numeric_factor,
    {metrics}
  FROM {name}_sums)"""


def status_cte(p: ReportParams, days: int, fm: str = "fm", name: str | None = None) -> str:
    name = name or f"s{days}"
    asof = f"TIMESTAMP '{p.status_as_of.isoformat()} 00:00:00'"
    return f"""{name} AS (
  SELECT roadmap_id, traffic_light, audit_time, tl_rank FROM (
    SELECT a.roadmap_id, a.traffic_light, a.audit_time,
           CAST(rank() OVER (PARTITION BY a.roadmap_id ORDER BY a.audit_time DESC) AS INTEGER) AS tl_rank
    FROM roadmap_audit a JOIN (SELECT DISTINCT roadmap_id FROM {fm}) fms ON fms.roadmap_id = a.roadmap_id
    WHERE date_diff('day', a.audit_time, {asof}) >= {days}) x
  WHERE tl_rank = 1)"""


def result_ctes(p: ReportParams, suffix: str = "", fm_where: str = "") -> list[str]:
    """CTEs up to `res{suffix}`, the 48-column report."""
    fm, imp, s14, s7, res = (f"fm{suffix}", f"imp{suffix}", f"s14{suffix}", f"s7{suffix}", f"res{suffix}")
    fmc = fm_cte(p, fm)
    if fm_where:
        fmc = fmc[:-1] + f"\n    AND {fm_where})"
    code = (f"(SELECT c.code FROM program_currency pc JOIN currency c ON c.currency_id = pc.currency_id "
            f"WHERE pc.program_currency_id = {p.report_currency_id})")
    narr = ",\n    ".join(f"frms.{n}" for n in NARR)
    res_sql = f"""{res} AS (
  SELECT DISTINCT
    pj.project_name AS PROJ_PARENT, pj.project_id AS P_ID, {person('u4.last_name', 'u4.first_name')} AS WS_OWNER,
    pj.project_number AS PJ_Num, rm.roadmap_id AS RM_ID,
    {tl('rmv.tl_dice')} AS RM_TL_DICE, {tl('rmv.tl_milestone')} AS RM_TL_MS,
    {tl('rmv.tl_impact')} AS RM_TL_IM, {tl('rmv.tl_overall')} AS RM_TL_OVERALL,
    rmv.roadmap_number AS RM_NUMBER, {person('u5.last_name', 'u5.first_name')} AS RM_OWNER,
    {person('u6.last_name', 'u6.first_name')} AS RM_APPROVER,
    rm.roadmap_name AS MEMBER_NAME, {strip_html('rm.description')} AS ROADMAP_DESCRIPTION,
    {tl('s14.traffic_light')} AS Status_2Weeks_ago, {tl('s7.traffic_light')} AS Status_1Weeks_ago,
    msv.milestone_name AS A_Milestone, msv.sort_order AS Milestone_Sort_order,
    {sentinel('msv.plan_date')} AS A_Plan, {sentinel('msv.update_date')} AS A_Forecast,
    {day_diff('msv.plan_date', q(p.today))} AS DELAY_OVERDUE, {p.due_in_next_n_days} AS MilestoneDueInNextNDays,
    bi.base_impact_name AS BI_NAME, bi.unit AS BI_UNIT,
    CASE WHEN bi.financial THEN {code} ELSE '' END AS CURRENCY_CODE,
    stg.stage_name AS RM_STAGE, {sentinel('rs.plan_date')} AS G4_DueDate,
    CAST(year(pg.start_date) AS INTEGER) AS PG_START_YEAR, CAST(year(pg.end_date) AS INTEGER) AS PG_END_YEAR,
    {imp}.Plan, {imp}.Update, {imp}.Actual, {imp}.Plan_To_Date, {imp}.Actual_To_Date, {imp}.Update_To_Date,
    msv.milestone_id AS A_FK_Milestone, {imp}.project_id AS A_FK_Project, {imp}.base_impact_id AS A_FK_BASE_IMPACT,
    pg.dice_enabled AS A_DICE_ENABLED,
    {narr},
    'ng-program-tree/project?programId=' || lower('{p.program_id}') || '&projectId=' ||
      CASE WHEN pj.parent_project_id IS NULL THEN '' ELSE CAST(pj.project_id AS VARCHAR) END AS ProjectURL,
    'ng-program-tree/initiative?programId=' || lower('{p.program_id}') || '&roadmapId=' ||
      lower(CAST(rm.roadmap_id AS VARCHAR)) AS RoadmapURL
  FROM {imp}
  LEFT JOIN roadmap rm ON {imp}.roadmap_id = rm.roadmap_id
  LEFT JOIN roadmap_view rmv ON rmv.roadmap_id = {imp}.roadmap_id
  LEFT JOIN milestone msv ON {imp}.roadmap_id = msv.roadmap_id AND {imp}.milestone_id = msv.milestone_id
  LEFT JOIN base_impact bi ON bi.base_impact_id = {imp}.base_impact_id
  LEFT JOIN {s14} s14 ON s14.roadmap_id = {imp}.roadmap_id
  LEFT JOIN {s7} s7 ON s7.roadmap_id = {imp}.roadmap_id
  LEFT JOIN {fm} frms ON frms.roadmap_id = {imp}.roadmap_id AND frms.milestone_id = {imp}.milestone_id
                     AND frms.base_impact_id = {imp}.base_impact_id
  LEFT JOIN stage stg ON rm.stage_id = stg.stage_id
  LEFT JOIN roadmap_stage rs ON rs.roadmap_id = rmv.roadmap_id AND rs.stage_id = {p.gate_stage_id}
  LEFT JOIN program pg ON {imp}.program_id = pg.program_id
  LEFT JOIN project pj ON {imp}.project_id = pj.project_id
  LEFT JOIN user_role r5 ON r5.roadmap_id = {imp}.roadmap_id AND r5.role = 5 LEFT JOIN users u5 ON u5.user_id = r5.user_id
  LEFT JOIN user_role r6 ON r6.roadmap_id = {imp}.roadmap_id AND r6.role = 6 LEFT JOIN users u6 ON u6.user_id = r6.user_id
  LEFT JOIN user_role r4 ON r4.project_id = pj.project_id AND r4.role = 4 LEFT JOIN users u4 ON u4.user_id = r4.user_id
  WHERE {imp}.program_id = {p.program_id})"""
    return [fmc, imp_cte(p, fm, imp), status_cte(p, 14, fm, s14), status_cte(p, 7, fm, s7), res_sql]


COMMON = [attr_cte()]

CACHE_COLS = [
    "A_FK_REPORT_CACHE", "A_FK_REPORT_FILTER_CACHE", "A_FK_SNAPSHOT", "A_LAST_MODIFIED_FOR_CACHE_UTC",
    "A_ROADMAP_SUBSET_HASH", "PROJ_PARENT", "P_ID", "WS_OWNER", "PJ_Num", "RM_ID", "RM_TL_DICE", "RM_TL_MS",
    "RM_TL_IM", "RM_TL_OVERALL", "RM_NUMBER", "RM_OWNER", "RM_APPROVER", "MEMBER_NAME", "ROADMAP_DESCRIPTION",
    "Status_2Weeks_ago", "Status_1Weeks_ago", "A_Milestone", "Milestone_Sort_order", "A_Plan", "A_Forecast",
    "DELAY_OVERDUE", "MilestoneDueInNextNDays", "Milestone_Owner", "BI_NAME", "BI_UNIT", "CURRENCY_CODE",
    "RM_STAGE", "G4_DueDate", "PG_START_YEAR", "PG_END_YEAR", "Project_Status_Rationale",
    "Project_Decisions_Needed", "Project_TMO_Comments", "Project_Actions_for_Next_Week",
    "Project_Actions_from_Last_Week", "Roadmap_Interdependency", "Plan", "Actual", "Update", "Plan_To_Date",
    "Actual_To_Date", "Update_To_Date", "A_FK_Milestone", "A_FK_BASE_IMPACT", "A_DICE_ENABLED", "ProjectURL",
    "RoadmapURL",
]
MERGE_KEY = ["A_FK_REPORT_CACHE", "A_FK_REPORT_FILTER_CACHE", "A_FK_SNAPSHOT", "A_LAST_MODIFIED_FOR_CACHE_UTC",
             "A_ROADMAP_SUBSET_HASH", "P_ID", "A_FK_Milestone", "A_FK_BASE_IMPACT"]


def cache_src_cte(p: ReportParams, res: str, needed: str, name: str) -> str:
    cols = ", ".join(f"vr.{c}" for c in CACHE_COLS[5:])
    return f"""{name} AS (
  SELECT {p.report_cache_id} AS A_FK_REPORT_CACHE, {p.report_filter_cache_id} AS A_FK_REPORT_FILTER_CACHE,
         n.snapshot_id AS A_FK_SNAPSHOT, n.last_modified AS A_LAST_MODIFIED_FOR_CACHE_UTC,
         n.subset_hash AS A_ROADMAP_SUBSET_HASH, {cols}
  FROM {res} vr JOIN {needed} n ON n.project_id = vr.A_FK_Project)"""


def cache_ctes(p: ReportParams) -> list[str]:
    """res (all projects) -> src (needed), target (projects of a previous run), ins, merged."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in MERGE_KEY)
    cols = ", ".join(CACHE_COLS)
    return [
        *result_ctes(p),
        "prior_needed AS (SELECT * FROM snapshot_needed WHERE snapshot_id = 8)",
        cache_src_cte(p, "res", "snapshot_needed", "src"),
        cache_src_cte(p, "res", "prior_needed", "target"),
        f"ins AS (SELECT s.* FROM src s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {on}))",
        f"merged AS (SELECT {cols} FROM target UNION ALL SELECT {cols} FROM ins)",
        f"""readback AS (
  SELECT o.* FROM snapshot_in_report r JOIN merged o
    ON o.A_FK_REPORT_CACHE = {p.report_cache_id} AND o.A_FK_REPORT_FILTER_CACHE = {p.report_filter_cache_id}
   AND o.A_FK_SNAPSHOT = r.snapshot_id AND o.A_LAST_MODIFIED_FOR_CACHE_UTC = r.last_modified
   AND o.A_ROADMAP_SUBSET_HASH = r.subset_hash AND o.P_ID = r.project_id)""",
    ]


KEYS = "program_id, project_id, roadmap_id, milestone_id, base_impact_id"
FM_COLS = f"{KEYS}, milestone_name, datedif, " + ", ".join(NARR)
METRICS = "Plan, Actual, Update, Plan_To_Date, Actual_To_Date, Update_To_Date"


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    W = with_domain
    o["milestone_due_window"] = W() + f"""
SELECT fr.roadmap_id, m.milestone_id, fr.project_id, m.milestone_name, m.plan_date, m.forecast_date,
       {day_diff('m.forecast_date', q(P.today))} AS datedif
FROM filtered_roadmap fr JOIN milestone m ON m.roadmap_id = fr.roadmap_id
WHERE fr.program_id = {P.program_id}
  AND date_diff('day', m.forecast_date, {q(P.today)}) >= -{P.due_in_next_n_days}
  AND m.plan_date >= {q(P.filter_date_start)} AND m.plan_date <= {q(P.filter_date_end)}
  AND m.tl_overall <> 1 AND m.plan_date IS NOT NULL"""

    lo, hi = P.valuation_date_range
    D = q(P.default_milestone_date)
    unp = " UNION ALL ".join(
        f"SELECT roadmap_id, base_impact_id, program_currency_id, financial, '{k}' AS kind, "
        f"COALESCE({k}_date, {D}) AS d, {k}_intercept AS intercept, {k}_slope AS slope FROM picked"
        for k in ("plan", "actual", "forecast")
    )
    # computed once each: the picked impacts, and the rates of the days in reach
    picked = f"""picked AS MATERIALIZED (
  SELECT * FROM impact WHERE program_id = {P.program_id} AND base_impact_id = '{P.base_impact_id}'),
reach AS MATERIALIZED (SELECT * FROM multiplier_set_day WHERE day BETWEEN {q(lo)} AND {q(hi)})"""
    o["multiplier_lookup"] = W(picked) + f"""
SELECT u.roadmap_id, u.base_impact_id, u.program_currency_id, u.financial, u.kind, u.d,
       CAST(u.intercept AS DOUBLE) AS intercept, CAST(u.slope AS DOUBLE) AS slope,
       CAST(w.exchange_rate AS DOUBLE) AS ex_w, CAST(w.financial_multiplier AS DOUBLE) AS fin_w,
       CAST(w.multiplier AS DOUBLE) AS mul_w,
       CAST(t.exchange_rate AS DOUBLE) AS ex_t, CAST(t.financial_multiplier AS DOUBLE) AS fin_t,
       CAST(t.multiplier AS DOUBLE) AS mul_t
FROM ({unp}) u
LEFT JOIN reach w ON w.day = u.d AND w.program_currency_id = u.program_currency_id AND w.multiplier_set = {P.multiplier_set_id}
LEFT JOIN reach t ON t.day = u.d AND t.program_currency_id = u.program_currency_id AND t.multiplier_set = {P.multiplier_set_id_to_date}"""

    def valuation(p: ReportParams, cols: str) -> str:
        return W(*COMMON, fm_cte(p), imp_cte(p)) + f"""
SELECT {KEYS}, CAST(numeric_factor AS DOUBLE) AS numeric_factor, {cols} FROM imp"""

    o["impact_rollup_plan"] = valuation(P, "Plan")
    for key, p in (("impact_mode_selected", P), ("impact_mode_unset", P_UNSET), ("impact_mode_none", P_NONE)):
        o[key] = W(*COMMON, fm_cte(p)) + f"\nSELECT {FM_COLS} FROM fm"
    o["distinct_keys"] = W(*COMMON, fm_cte(P)) + f"\nSELECT DISTINCT {KEYS} FROM fm"
    o["numeric_factor"] = valuation(P_FACTOR, METRICS)
    o["impact_rollup"] = valuation(P, METRICS)
    o["impact_rollup_stored"] = o["impact_rollup"]
    # one request after the other
    from tollgate.plans.queries import REQUESTS

    o["impact_rollup_requests"] = W(*COMMON, *[c for i, p in REQUESTS.items() for c in (fm_cte(p, f"fm{i}"), imp_cte(p, f"fm{i}", f"imp{i}"))]) + \
        "\n" + "\nUNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS request_id, {KEYS}, CAST(numeric_factor AS DOUBLE) AS numeric_factor, {METRICS} FROM imp{i}"
            for i in REQUESTS)

    for days in (7, 14):
        o[f"status_asof_{days}"] = W(*COMMON, fm_cte(P_UNSET), status_cte(P, days)) + \
            f"\nSELECT roadmap_id, traffic_light, audit_time, tl_rank FROM s{days}"
    # plain forms of what the library reads through a key filter and from snapshots
    o["status_asof_bloom"] = o["status_asof_snapshot"] = o["status_asof_14"]
    asof = f"TIMESTAMP '{P.status_as_of.isoformat()} 00:00:00'"
    o["status_asof_ties"] = W() + f"""
SELECT roadmap_id, traffic_light, audit_time, tl_rank FROM (
  SELECT roadmap_id, traffic_light, audit_time, CAST(rank() OVER (PARTITION BY roadmap_id ORDER BY audit_time DESC) AS INTEGER) AS tl_rank
  FROM (SELECT roadmap_id, traffic_light, date_trunc('day', audit_time) AS audit_time FROM roadmap_audit) a
  WHERE date_diff('day', audit_time, {asof}) >= 14) x
WHERE tl_rank = 1"""
    o["status_trend"] = W(*COMMON, fm_cte(P_UNSET), status_cte(P, 14), status_cte(P, 7)) + f"""
SELECT DISTINCT r.roadmap_id, {tl('s14.traffic_light')} AS Status_2Weeks_ago, {tl('s7.traffic_light')} AS Status_1Weeks_ago
FROM (SELECT DISTINCT roadmap_id FROM fm) r
LEFT JOIN s14 ON s14.roadmap_id = r.roadmap_id LEFT JOIN s7 ON s7.roadmap_id = r.roadmap_id"""

    seg = "'::' || right('000' || rtrim(CAST(CAST(trunc(sort_order) AS INTEGER) AS VARCHAR)), 3)"
    tree_cte = f"""tp AS (
  WITH RECURSIVE t(base_impact_id, parent_id, sort_path, depth) AS (
    SELECT base_impact_id, parent_id, {seg}, 1 FROM base_impact
    WHERE parent_id IS NULL AND program_id = {P.program_id}
    UNION ALL
    SELECT c.base_impact_id, c.parent_id, t.sort_path || {seg.replace('sort_order', 'c.sort_order')}, t.depth + 1
    FROM base_impact c JOIN t ON c.parent_id = t.base_impact_id)
  SELECT * FROM t)"""
    o["tree_path"] = W(tree_cte) + "\nSELECT base_impact_id, parent_id, sort_path, depth FROM tp"
    attrs_sql = f"""ta AS (
  SELECT DISTINCT bi.base_impact_id AS BaseImpactID, bi.base_impact_name AS BaseImpactName,
         COALESCE(bi.financial = TRUE, FALSE) AS IsFinancial, COALESCE(bi.calculated = TRUE, FALSE) AS IsCalculated,
         COALESCE(bi.timing = 2, FALSE) AS IsRecurring, bi.unit AS Unit, tp.depth AS BaseImpactLevel,
         tp.sort_path AS BaseImpactPath, bi.parent_id AS BaseImpactParentBaseImpactID
  FROM base_impact bi JOIN tp ON tp.base_impact_id = bi.base_impact_id
  WHERE bi.program_id = {P.program_id})"""
    o["tree_attributes"] = W(tree_cte, attrs_sql) + "\nSELECT * FROM ta"
    o["tree_sorted"] = W(tree_cte, attrs_sql) + """
SELECT *, row_number() OVER (ORDER BY BaseImpactPath, BaseImpactID) AS PathPosition FROM ta"""

    key = "seg || ' ' || base_impact_id"
    o["tree_order"] = W(f"""tp AS (
  WITH RECURSIVE b AS (SELECT *, {seg} AS seg FROM base_impact),
  t(base_impact_id, parent_id, path) AS (
    SELECT base_impact_id, parent_id, [{key}] FROM b WHERE parent_id IS NULL AND program_id = {P.program_id}
    UNION ALL
    SELECT c.base_impact_id, c.parent_id, list_append(t.path, c.seg || ' ' || c.base_impact_id) FROM b c JOIN t ON c.parent_id = t.base_impact_id)
  SELECT * FROM t)""") + """
SELECT base_impact_id, parent_id, row_number() OVER (ORDER BY path) AS position, CAST(len(path) AS INTEGER) AS depth FROM tp"""

    # the literal seven joins, counted; the lists by attribute
    fan_joins = "\n  ".join(
        f"LEFT JOIN milestone_attribute a{k} ON a{k}.milestone_id = m.milestone_id AND a{k}.attribute_id = {k}" for k in range(1, 8))
    fan_values = ", ".join(f"a{k}.text_value AS v{k}" for k in range(1, 8))
    fan_lists = ",\n    ".join(
        f"COALESCE(string_agg(text_value || ' x' || CAST(times AS VARCHAR), ' | ' ORDER BY text_value) FILTER (WHERE attribute_id = {k}), '') AS {n}"
        for k, n in enumerate(NARR, start=1))
    fan_names = ", ".join(f"COALESCE(l.{n}, '') AS {n}" for n in NARR)
    o["attr_join_fanout"] = W(f"""joined AS (
  SELECT m.milestone_id, {fan_values} FROM milestone m
  {fan_joins}),
counted AS (
  SELECT milestone_id, count(*) AS literal_rows, count(DISTINCT (v1, v2, v3, v4, v5, v6, v7)) AS distinct_rows FROM joined GROUP BY 1),
lists AS (
  SELECT milestone_id,
    {fan_lists}
  FROM (SELECT milestone_id, attribute_id, text_value, count(*) AS times FROM milestone_attribute GROUP BY ALL) GROUP BY 1)""") + f"""
SELECT c.milestone_id, literal_rows, distinct_rows, {fan_names}
FROM counted c LEFT JOIN lists l ON l.milestone_id = c.milestone_id"""

    o["attr_pivot"] = W(attr_cte()) + "\nSELECT * FROM attr"
    narr = ", ".join(f"n.{c}" for c in NARR)
    o["null_key_join"] = W(*COMMON, fm_cte(P_UNSET)) + f""",
half AS (SELECT * REPLACE (CASE WHEN milestone_id % 2 = 0 THEN '{P.base_impact_id}' END AS base_impact_id) FROM fm)
SELECT k.program_id, k.project_id, k.roadmap_id, k.milestone_id, k.base_impact_id, {narr}
FROM (SELECT DISTINCT {KEYS} FROM half) k
LEFT JOIN half n ON n.roadmap_id = k.roadmap_id AND n.milestone_id = k.milestone_id AND n.base_impact_id = k.base_impact_id"""

    o["traffic_light"] = W() + f"""
SELECT roadmap_id, {tl('tl_dice')} AS RM_TL_DICE, {tl('tl_milestone')} AS RM_TL_MS, {tl('tl_impact')} AS RM_TL_IM,
       {tl('tl_overall')} AS RM_TL_OVERALL FROM roadmap_view"""
    o["owner_name"] = W() + f"""
SELECT ur.roadmap_id, ur.project_id, ur.role, ur.user_id, {person('u.last_name', 'u.first_name')} AS owner_name
FROM user_role ur LEFT JOIN users u ON u.user_id = ur.user_id"""
    o["sentinel_date"] = W() + f"\nSELECT roadmap_id, stage_id, plan_date, {sentinel('plan_date')} AS G4_DueDate FROM roadmap_stage"
    o["delay_days"] = W() + f"""
SELECT milestone_id, {day_diff('plan_date', q(P.today))} AS DELAY_OVERDUE, {day_diff('forecast_date', q(P.today))} AS datedif,
       {sentinel('update_date')} AS A_Forecast
FROM milestone"""
    o["year_columns"] = W() + """
SELECT pj.project_id, pj.program_id, CAST(year(pg.start_date) AS INTEGER) AS PG_START_YEAR,
       CAST(year(pg.end_date) AS INTEGER) AS PG_END_YEAR, pg.dice_enabled AS A_DICE_ENABLED
FROM project pj LEFT JOIN program pg ON pg.program_id = pj.program_id"""
    o["url_build"] = W() + """
SELECT fr.roadmap_id, fr.project_id,
  'ng-program-tree/project?programId=' || lower(CAST(fr.program_id AS VARCHAR)) || '&projectId=' ||
    CASE WHEN pj.parent_project_id IS NULL THEN '' ELSE CAST(pj.project_id AS VARCHAR) END AS ProjectURL,
  'ng-program-tree/initiative?programId=' || lower(CAST(fr.program_id AS VARCHAR)) || '&roadmapId=' ||
    lower(CAST(rm.roadmap_id AS VARCHAR)) AS RoadmapURL
FROM filtered_roadmap fr LEFT JOIN project pj ON pj.project_id = fr.project_id
LEFT JOIN roadmap rm ON rm.roadmap_id = fr.roadmap_id"""
    o["html_text"] = W() + f"""
SELECT roadmap_id, {strip_html('description')} AS ROADMAP_DESCRIPTION FROM roadmap"""
    o["currency_lookup"] = W() + f"""
SELECT base_impact_id, CASE WHEN financial THEN
  (SELECT c.code FROM program_currency pc JOIN currency c ON c.currency_id = pc.currency_id
   WHERE pc.program_currency_id = {P.report_currency_id}) ELSE '' END AS CURRENCY_CODE
FROM base_impact"""

    o["role_owner"] = W() + f"""
SELECT DISTINCT fr.roadmap_id, fr.project_id, {person('u5.last_name', 'u5.first_name')} AS RM_OWNER,
       {person('u6.last_name', 'u6.first_name')} AS RM_APPROVER, {person('u4.last_name', 'u4.first_name')} AS WS_OWNER
FROM filtered_roadmap fr
LEFT JOIN user_role r5 ON r5.roadmap_id = fr.roadmap_id AND r5.role = 5 LEFT JOIN users u5 ON u5.user_id = r5.user_id
LEFT JOIN user_role r6 ON r6.roadmap_id = fr.roadmap_id AND r6.role = 6 LEFT JOIN users u6 ON u6.user_id = r6.user_id
LEFT JOIN user_role r4 ON r4.project_id = fr.project_id AND r4.role = 4 LEFT JOIN users u4 ON u4.user_id = r4.user_id"""
    o["stage_gate"] = W() + f"""
SELECT rm.roadmap_id, stg.stage_name AS RM_STAGE, {sentinel('rs.plan_date')} AS G4_DueDate
FROM roadmap rm LEFT JOIN stage stg ON stg.stage_id = rm.stage_id
LEFT JOIN roadmap_view rmv ON rmv.roadmap_id = rm.roadmap_id
LEFT JOIN roadmap_stage rs ON rs.roadmap_id = rmv.roadmap_id AND rs.stage_id = {P.gate_stage_id}"""
    o["star_enrichment"] = W(*COMMON, *result_ctes(P_UNSET)) + "\nSELECT * FROM res"
    o["report_result"] = W(*COMMON, *result_ctes(P)) + "\nSELECT * FROM res"
    o["report_mode_none"] = W(*COMMON, *result_ctes(P_NONE)) + "\nSELECT * FROM res"

    p_ci = P.with_(base_impact_id="n3")  # typed as 'n3 '
    o["report_collated"] = spelled(W(*COMMON, *result_ctes(p_ci))) + "\nSELECT * REPLACE ('n3 ' AS A_FK_BASE_IMPACT) FROM res"
    o["impact_rollup_collated"] = f"SELECT * REPLACE ('n3 ' AS base_impact_id) FROM ({spelled(valuation(p_ci, METRICS))})"
    o["tree_attributes_collated"] = spelled(o["tree_attributes"])
    o["attr_fanout_collated"] = spelled(o["attr_join_fanout"])

    o["exists_gate"] = W() + """
SELECT project_id, EXISTS (SELECT 1 FROM snapshot_needed) AS gate_open FROM snapshot_in_report"""
    cols = ", ".join(CACHE_COLS)
    o["cache_insert_if_absent"] = W(*COMMON, *cache_ctes(P)) + f"\nSELECT {cols} FROM ins"
    o["cache_null_key_reinsert"] = W(*COMMON, *cache_ctes(P_UNSET)) + f"\nSELECT {cols} FROM ins"
    o["cache_after_merge"] = W(*COMMON, *cache_ctes(P)) + f"\nSELECT {cols} FROM merged"
    o["cached_project_markers"] = W() + f"""
SELECT {P.report_cache_id} AS A_FK_REPORT_CACHE, {P.report_filter_cache_id} AS A_FK_REPORT_FILTER_CACHE,
       project_id, snapshot_id, last_modified, subset_hash FROM snapshot_needed"""
    o["cache_read_back"] = W(*COMMON, *cache_ctes(P)) + f"\nSELECT {cols} FROM readback"
    o["cache_stored_read_back"] = o["cache_read_back"]
    rcols = ", ".join(f"r.{c}" for c in CACHE_COLS)
    order = ", ".join(f"{c} NULLS FIRST" for c in (
        "t.path", "r.DELAY_OVERDUE", "r.A_FK_Milestone", "r.RM_ID", "r.RM_OWNER", "r.RM_APPROVER", "r.WS_OWNER",
        "r.Status_2Weeks_ago", "r.Status_1Weeks_ago", "r.G4_DueDate"))
    o["final_report"] = W(*COMMON, *cache_ctes(P)) + f"""
SELECT {rcols}, row_number() OVER (ORDER BY {order}) AS position FROM readback r JOIN tree t ON r.P_ID = t.project_id"""
    return o


ORACLES = _oracles()
