"""Domain relations derived from the TPC-H-like test tables.

The report's own tables (programs, projects, roadmaps, milestones, impacts, ...)
do not exist in the test data, so each one is derived from the given tables by a
Spark plan whose size grows with them. The rules are listed per relation below;
checks/oracle.py states the same rules in DuckDB SQL.

  program            region                      one program per region
  project            customer + nation           parent = key rounded down to tens
  roadmap            orders (+ pages.html)       description = page with page_id = order key
  roadmap_view       orders                      four traffic lights
  stage              orders.o_orderpriority      stage id = leading digit
  roadmap_stage      orders                      gate plan date, sentinel years on some
  milestone          lineitem + orders           one per (order, line number)
  impact             lineitem + part + orders    lines with a discount; base impact = nation node; the
                                                 impacts of every fourth order (keys 4, 8, ...) belong
                                                 to the order before it, whose roadmap carries both
  base_impact        region, nation, customer    three-level tree R / N / C
  base_impact_factor nation                      per nation node and currency
  program_currency,  nation                      first three nations are currencies
  currency
  multiplier_set_day lineitem ship dates         calendar x currency x set
  milestone_attribute lineitem                   two attribute rows per line
  roadmap_audit      events                      status history
  users, user_role   supplier, lineitem, customer
  tree               customer                    path program / project
  filtered_roadmap   orders                      every roadmap
  snapshot_*         customer                    snapshot keys per project; needed = positive balance
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.sources.tables import Tables

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events pages".split()
)

# number of program currencies in the derived data (nation keys 0, 1, 2)
N_CURRENCIES = 3
# event type -> traffic light of the status history
EVENT_LIGHT = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}
SENTINEL_DATE = "1900-05-01"
EARLY_KEPT_DATE = "1901-01-01"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c: Column, p: int = 19, s: int = 4) -> Column:
    return c.cast(f"decimal({p},{s})")


def _id(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def path_segment(c: Column) -> Column:
    """An id at the width of the widest bigint, so that text order is id order."""
    return F.lpad(c.cast("string"), 19, "0")


def derive_tables(spark: SparkSession, sf_dir: str) -> Tables:
    region = _read(spark, sf_dir, "region")
    nation = _read(spark, sf_dir, "nation")
    customer = _read(spark, sf_dir, "customer")
    supplier = _read(spark, sf_dir, "supplier")
    part = _read(spark, sf_dir, "part")
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")
    events = _read(spark, sf_dir, "events")
    pages = _read(spark, sf_dir, "pages")

    # nation is a fixed 25-row dimension: broadcasting it is bounded by definition
    nation_b = F.broadcast(nation.select("n_nationkey", "n_name", "n_regionkey"))

    program = region.select(
        F.col("r_regionkey").alias("program_id"),
        F.col("r_name").alias("program_name"),
        F.make_date(1995 + F.col("r_regionkey"), F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(2000 + F.col("r_regionkey"), F.lit(12), F.lit(31)).alias("end_date"),
        ((F.col("r_regionkey") % 2) == 0).alias("dice_enabled"),
    )

    cust_prog = customer.join(nation_b, customer.c_nationkey == nation_b.n_nationkey).select(
        "c_custkey", "c_name", "c_nationkey", F.col("n_regionkey").alias("program_id")
    )

    project = cust_prog.select(
        F.col("c_custkey").alias("project_id"),
        F.col("c_name").alias("project_name"),
        F.concat(F.lit("PJ-"), F.col("c_custkey").cast("string")).alias("project_number"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey") - F.col("c_custkey") % 10)
        .alias("parent_project_id"),
        "program_id",
    )

    order_prog = orders.join(
        cust_prog.select("c_custkey", "program_id"), orders.o_custkey == F.col("c_custkey")
    ).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.to_date("o_orderdate").alias("order_date"), "program_id",
    )

    stage_id = F.substring("o_orderpriority", 1, 1).cast("int")
    roadmap = (
        orders.join(pages.select("page_id", "html"), orders.o_orderkey == F.col("page_id"), "left")
        .select(
            F.col("o_orderkey").alias("roadmap_id"),
            F.concat(F.lit("Roadmap "), F.col("o_orderkey").cast("string")).alias("roadmap_name"),
            F.col("html").alias("description"),
            stage_id.alias("stage_id"),
        )
    )

    roadmap_view = orders.select(
        F.col("o_orderkey").alias("roadmap_id"),
        F.concat(F.lit("RM-"), F.col("o_orderkey").cast("string")).alias("roadmap_number"),
        (F.col("o_orderkey") % 6).cast("int").alias("tl_dice"),
        F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_custkey") % 5 + 1).cast("int")).alias("tl_milestone"),
        ((F.col("o_orderkey") / 7).cast("bigint") % 5 + 1).cast("int").alias("tl_impact"),
        F.when(F.col("o_orderstatus") == "F", 3)
        .when(F.col("o_orderstatus") == "O", 4)
        .when(F.col("o_orderstatus") == "P", 2)
        .cast("int")
        .alias("tl_overall"),
    )

    stage = (
        orders.select(stage_id.alias("stage_id"), F.col("o_orderpriority").alias("stage_name"))
        .distinct()
    )

    roadmap_stage = orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("roadmap_id"),
        F.lit(4).alias("stage_id"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(SENTINEL_DATE).cast("date"))
        .when(F.col("o_orderkey") % 17 == 0, F.lit(EARLY_KEPT_DATE).cast("date"))
        .otherwise(F.date_add(F.to_date("o_orderdate"), 90))
        .alias("plan_date"),
    )

    # one milestone per (order, line number); the pair repeats in lineitem, so group
    ms_lines = lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.to_date(F.min("l_shipdate")).alias("first_ship")
    )
    milestone = ms_lines.join(order_prog, ms_lines.l_orderkey == order_prog.o_orderkey).select(
        F.col("l_orderkey").alias("roadmap_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("milestone_id"),
        "program_id",
        F.concat(F.lit("Milestone "), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("milestone_name"),
        F.date_add("order_date", 30).alias("plan_date"),
        F.col("first_ship").alias("forecast_date"),
        F.when(F.col("l_orderkey") % 19 == 0, F.lit(SENTINEL_DATE).cast("date"))
        .otherwise(F.date_add("first_ship", 7))
        .alias("update_date"),
        F.col("l_linenumber").alias("sort_order"),
        F.when(F.col("l_linenumber") != 6, F.col("l_linenumber")).alias("tl_overall"),
    )

    ship = F.to_date("l_shipdate")
    # every line counts: some roadmaps have no impact because another carries theirs
    carrier = F.when((F.col("l_orderkey") % 4 == 0) & (F.col("l_orderkey") > 0), F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey"))
    impact = (
        lineitem.where(F.col("l_discount") > 0)
        .join(part.select("p_partkey", "p_size", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("carrier", carrier)
        .join(order_prog.select("o_orderkey", "program_id"), F.col("carrier") == F.col("o_orderkey"))
        .select(
            F.col("carrier").alias("roadmap_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("milestone_id"),
            _id("N", F.col("p_size") % 25).alias("base_impact_id"),
            "program_id",
            (F.col("l_suppkey") % N_CURRENCIES).cast("int").alias("program_currency_id"),
            ((F.col("p_size") % 2) == 1).alias("financial"),
            F.when(F.col("l_returnflag") != "R", ship).alias("plan_date"),
            F.when(F.col("l_linestatus") == "F", ship).alias("actual_date"),
            F.date_add(ship, 30).alias("forecast_date"),
            _dec(F.col("l_extendedprice")).alias("plan_intercept"),
            _dec(F.col("l_quantity")).alias("plan_slope"),
            _dec(_dec(F.col("l_extendedprice")) - _dec(F.col("p_retailprice"))).alias("actual_intercept"),
            _dec(_dec(F.col("l_quantity")) - 1).alias("actual_slope"),
            _dec(_dec(F.col("l_extendedprice")) + _dec(F.col("p_retailprice"))).alias("forecast_intercept"),
            _dec(_dec(F.col("l_quantity")) + 1).alias("forecast_slope"),
        )
    )

    def bi_node(key: Column, node_id: Column, parent: Column, program: Column, name: Column,
                sort_order: Column, financial: Column | None = None) -> list[Column]:
        fin = (key % 2) == 1
        return [
            node_id.alias("base_impact_id"),
            parent.alias("parent_id"),
            program.alias("program_id"),
            name.alias("base_impact_name"),
            F.when(fin, "USD").otherwise("units").alias("unit"),
            sort_order.cast("decimal(10,2)").alias("sort_order"),
            (fin if financial is None else financial).alias("financial"),
            ((key % 3) == 0).alias("calculated"),
            (1 + key % 2).cast("int").alias("timing"),
        ]

    rk, nk, ck = F.col("r_regionkey"), F.col("n_nationkey"), F.col("c_custkey")
    bi_r = region.select(*bi_node(
        rk, _id("R", rk), F.lit(None).cast("string"), rk, F.col("r_name"),
        _dec(rk, 10, 2) + F.lit(0.7).cast("decimal(10,2)"),
    ))
    bi_n = nation.select(*bi_node(
        nk, _id("N", nk), _id("R", F.col("n_regionkey")), F.col("n_regionkey"), F.col("n_name"),
        _dec(nk, 10, 2) + F.lit(0.25).cast("decimal(10,2)"),
    ))
    # every ninth customer node sits in another program than its root
    bi_c = cust_prog.select(*bi_node(
        ck, _id("C", ck), _id("N", F.col("c_nationkey")),
        F.when(ck % 9 == 0, ((F.col("program_id") + 1) % 5).cast("int")).otherwise(F.col("program_id")),
        F.col("c_name"), ck, financial=F.when(ck % 7 != 0, (ck % 2) == 1),
    ))
    base_impact = bi_r.unionByName(bi_n).unionByName(bi_c)

    cur = F.explode(F.sequence(F.lit(0), F.lit(N_CURRENCIES - 1))).alias("program_currency_id")
    base_impact_factor = (
        nation.select("n_nationkey", cur)
        .select(
            _id("N", F.col("n_nationkey")).alias("base_impact_id"),
            "program_currency_id",
            _dec(1 + (F.col("n_nationkey") + F.col("program_currency_id")) % 4).alias("numeric_factor"),
        )
    )

    program_currency = nation.where(F.col("n_nationkey") < N_CURRENCIES).select(
        F.col("n_nationkey").alias("program_currency_id"), F.col("n_nationkey").alias("currency_id")
    )
    currency = nation.select(
        F.col("n_nationkey").alias("currency_id"),
        F.upper(F.substring("n_name", 1, 3)).alias("code"),
    )

    # calendar: every day something shipped; set 2 has no rates after the 28th
    days = lineitem.select(ship.alias("day")).distinct()
    sets = F.when(F.dayofmonth("day") <= 28, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    doy = F.dayofyear("day")
    multiplier_set_day = (
        days.select("day", cur)
        .select("day", "program_currency_id", F.explode(sets).alias("multiplier_set"))
        .select(
            "day", "program_currency_id", "multiplier_set",
            _dec(_dec(100 + doy % 50 + 10 * F.col("program_currency_id") + F.col("multiplier_set"), 18, 6)
                 * F.lit(0.01).cast("decimal(3,2)"), 18, 6).alias("exchange_rate"),
            _dec(1 + doy % 12, 18, 6).alias("financial_multiplier"),
            _dec(12 + F.col("program_currency_id"), 18, 6).alias("multiplier"),
        )
    )

    attr_pair = F.explode(F.array(
        F.struct((1 + F.col("l_partkey") % 7).cast("int").alias("attribute_id")),
        F.struct((1 + F.col("l_suppkey") % 7).cast("int").alias("attribute_id")),
    )).alias("a")
    milestone_attribute = lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("milestone_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus"), F.lit("-"),
                 F.col("l_partkey").cast("string")).alias("text_value"),
        attr_pair,
    ).select("milestone_id", F.col("a.attribute_id").alias("attribute_id"), "text_value")

    light = F.lit(None).cast("int")
    for ev, tl in reversed(list(EVENT_LIGHT.items())):
        light = F.when(F.col("event_type") == ev, F.lit(tl)).otherwise(light)
    roadmap_audit = events.select(
        (F.col("user_id") * 100 + F.col("event_id") % 10).alias("roadmap_id"),
        light.alias("traffic_light"),
        F.col("ts").alias("audit_time"),
    )

    users = supplier.join(nation_b, supplier.s_nationkey == nation_b.n_nationkey).select(
        F.col("s_suppkey").alias("user_id"),
        F.col("s_name").alias("last_name"),
        F.when(F.col("s_suppkey") % 3 == 1, F.lit("  "))
        .when(F.col("s_suppkey") % 3 == 2, F.lower("n_name"))
        .alias("first_name"),
    )

    line_roles = lineitem.where(F.col("l_linenumber") <= 2).select(
        F.col("l_orderkey").alias("roadmap_id"),
        F.lit(None).cast("bigint").alias("project_id"),
        (F.col("l_linenumber") + 4).cast("int").alias("role"),
        F.col("l_suppkey").alias("user_id"),
    ).distinct()
    # one workstream owner per project, every third project two: a relation that
    # grows with the customers (there are fifteen times as many as suppliers)
    owner = F.floor(F.col("c_custkey") / 15) + 1
    ws_roles = customer.select(
        F.col("c_custkey").alias("project_id"),
        F.explode(F.when(F.col("c_custkey") % 3 == 0, F.array(owner, owner + 1)).otherwise(F.array(owner))).alias("owner"),
    ).join(supplier.select("s_suppkey"), F.col("owner") == F.col("s_suppkey")).select(
        F.lit(None).cast("bigint").alias("roadmap_id"), "project_id", F.lit(4).alias("role"),
        F.col("s_suppkey").alias("user_id"),
    )
    user_role = line_roles.unionByName(ws_roles)

    tree = cust_prog.select(
        F.col("c_custkey").alias("project_id"),
        F.concat(path_segment(F.col("program_id")), F.lit("/"), path_segment(F.col("c_custkey"))).alias("path"),
    )

    filtered_roadmap = order_prog.select(
        F.col("o_orderkey").alias("roadmap_id"), "program_id", F.col("o_custkey").alias("project_id")
    )

    # one snapshot per project; the snapshot id encodes the market segment (length of
    # its name), so "the projects a previous run cached" can be a data predicate
    snap_cols = [
        F.col("c_custkey").alias("project_id"),
        F.length("c_mktsegment").cast("int").alias("snapshot_id"),
        F.timestamp_add("MINUTE", F.col("c_custkey"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .alias("last_modified"),
        ((F.col("c_custkey") * 7919) % 10007).alias("subset_hash"),
    ]
    snapshot_in_report = customer.select(*snap_cols)
    # projects whose data changed since their snapshot was cached: positive balance
    snapshot_needed = customer.where(F.col("c_acctbal") > 0).select(*snap_cols)

    return Tables(
        program=program,
        project=project,
        roadmap=roadmap,
        roadmap_view=roadmap_view,
        stage=stage,
        roadmap_stage=roadmap_stage,
        milestone=milestone,
        impact=impact,
        base_impact=base_impact,
        base_impact_factor=base_impact_factor,
        program_currency=program_currency,
        currency=currency,
        multiplier_set_day=multiplier_set_day,
        milestone_attribute=milestone_attribute,
        roadmap_audit=roadmap_audit,
        users=users,
        user_role=user_role,
        tree=tree,
        filtered_roadmap=filtered_roadmap,
        snapshot_in_report=snapshot_in_report,
        snapshot_needed=snapshot_needed,
    )
