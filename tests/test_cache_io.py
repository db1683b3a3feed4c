"""The cache writer and the whole request flow, on the sf0.001 test tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollgate.operators.cache import CACHE_COLUMNS, ReportCache, cache_schema, read_back
from tollgate.operators.joins import PUSHED_KEYS, KeyBound, stored_rows_of
from tollgate.params import DEFAULT_PARAMS, ImpactMode
from tollgate.plans.run import compute_cache_rows, run_report
from tollgate.sources import derive_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return derive_tables(spark, SF)


def rows(df):
    return sorted(tuple(r) for r in df.select(*CACHE_COLUMNS).collect())


def test_run_report_miss_then_hit(spark, tables, tmp_path):
    cache = ReportCache(spark, str(tmp_path))
    first = rows(run_report(tables, DEFAULT_PARAMS, cache))
    assert first, "the flagship report has rows at sf0.001"
    n_cached = cache.table().count()
    # a second request with nothing needed computes nothing and reads the same rows
    hit = tables.replace(snapshot_needed=tables.snapshot_needed.limit(0))
    assert rows(run_report(hit, DEFAULT_PARAMS, cache)) == first
    assert cache.table().count() == n_cached
    # running the miss again inserts nothing new (all keys non-NULL in this mode)
    run_report(tables, DEFAULT_PARAMS, cache)
    assert cache.table().count() == n_cached
    # markers are insert-if-absent: one per needed snapshot however often it ran
    assert spark.read.parquet(cache.marker_path).count() == tables.snapshot_needed.count()


def test_null_key_rows_are_reinserted(spark, tables, tmp_path):
    p = DEFAULT_PARAMS.with_(impact_mode=ImpactMode.UNSET, base_impact_id=None)
    cache = ReportCache(spark, str(tmp_path))
    new = compute_cache_rows(tables, p, tables.snapshot_needed)
    n = new.count()
    cache.merge(new)
    cache.merge(new)
    assert cache.table().count() == 2 * n


def test_read_back_is_in_tree_order(spark, tables, tmp_path):
    cache = ReportCache(spark, str(tmp_path))
    out = run_report(tables, DEFAULT_PARAMS, cache)
    got = [(r.P_ID, r.DELAY_OVERDUE) for r in out.select("P_ID", "DELAY_OVERDUE").collect()]
    path = {r.project_id: r.path for r in tables.tree.collect()}
    keys = [(path[p], d) for p, d in got]
    assert keys == sorted(keys)


def test_restricting_projects_early_equals_filtering_late(spark, tables):
    from tollgate.plans.report import report_rows

    needed = tables.snapshot_needed
    early = report_rows(tables, DEFAULT_PARAMS, projects=needed)
    late = report_rows(tables, DEFAULT_PARAMS).join(
        needed.select(F.col("project_id").alias("A_FK_Project")), "A_FK_Project", "left_semi")
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.select(*early.columns).collect()))


def test_stream_fills_cache_from_requests(spark, tables, tmp_path):
    from tollgate.streaming.cache_fill import start_cache_fill

    req = tmp_path / "requests"
    needed = tables.snapshot_needed
    # two request files; the second repeats part of the first
    needed.where(F.col("snapshot_id") == 8).write.parquet(str(req / "a"))
    needed.write.parquet(str(req / "b"))
    cache = ReportCache(spark, str(tmp_path / "cache"))
    q = start_cache_fill(spark, tables, DEFAULT_PARAMS, cache, str(req) + "/*", str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    expected = compute_cache_rows(tables, DEFAULT_PARAMS, needed)
    assert rows(cache.table()) == rows(expected)
    assert spark.read.parquet(cache.marker_path).count() == needed.count()


def test_report_from_stored_tables(spark, tables, tmp_path):
    """The production path: domain relations stored as parquet, read lazily."""
    from tollgate.plans.report import report_rows
    from tollgate.sources import read_tables, write_tables

    write_tables(tables, str(tmp_path / "tables"))
    stored = read_tables(spark, str(tmp_path / "tables"))
    a = sorted(map(tuple, report_rows(tables, DEFAULT_PARAMS).collect()))
    b = sorted(map(tuple, report_rows(stored, DEFAULT_PARAMS).collect()))
    assert a == b and a


def test_report_from_bucketed_tables(spark, tables, tmp_path):
    """Bucketed storage: same rows, and fewer shuffles (stored sides stay put)."""
    from tollgate.plans.report import report_rows
    from tollgate.sources.catalog import read_catalog_tables, save_catalog_tables
    from tollgate.sources import read_tables, write_tables

    save_catalog_tables(tables, "tollgate_test", str(tmp_path / "bucketed"), n_buckets=8)
    bucketed = read_catalog_tables(spark, "tollgate_test")
    write_tables(tables, str(tmp_path / "plain"))
    plain = read_tables(spark, str(tmp_path / "plain"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # show the sort-merge plan
    try:
        a_df, b_df = report_rows(plain, DEFAULT_PARAMS), report_rows(bucketed, DEFAULT_PARAMS)
        a, b = sorted(map(tuple, a_df.collect())), sorted(map(tuple, b_df.collect()))

        def shuffles(df):
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
            return plan.count("Exchange hashpartitioning")
        n_plain, n_bucketed = shuffles(a_df), shuffles(b_df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert a == b and a
    assert n_bucketed <= n_plain, (n_bucketed, n_plain)


def test_join_of_bucketed_tables_is_not_shuffled(spark, tables, tmp_path):
    """The join of two stored relations on their bucketing key: same rows, no shuffle."""
    from tollgate.operators.filters import due_window
    from tollgate.sources import read_tables, write_tables
    from tollgate.sources.catalog import read_catalog_tables, save_catalog_tables

    save_catalog_tables(tables, "tollgate_join_test", str(tmp_path / "bucketed"), n_buckets=8)
    write_tables(tables, str(tmp_path / "plain"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = []
        for t in (read_tables(spark, str(tmp_path / "plain")), read_catalog_tables(spark, "tollgate_join_test")):
            due = due_window(t.milestone, DEFAULT_PARAMS).select("roadmap_id", "milestone_id")
            df = t.filtered_roadmap.join(due, "roadmap_id")
            rows = sorted(map(str, df.collect()))
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
            found.append((rows, plan.count("Exchange hashpartitioning")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plain, n_plain), (bucketed, n_bucketed) = found
    assert plain == bucketed and plain
    assert (n_plain, n_bucketed) == (2, 0)


def test_command_line_request(spark, tables, tmp_path):
    """The command-line entry: arguments -> params -> request over stored tables."""
    from tollgate.__main__ import main, parser, params_from_args
    from tollgate.params import ImpactMode
    from tollgate.sources import write_tables

    p = params_from_args(parser().parse_args(["--tables", "t", "--cache", "c", "--out", "o"]))
    assert p.impact_mode is ImpactMode.UNSET and p.program_id == DEFAULT_PARAMS.program_id
    write_tables(tables, str(tmp_path / "tables"))
    main(["--tables", str(tmp_path / "tables"), "--cache", str(tmp_path / "cache"), "--out", str(tmp_path / "out"),
          "--base-impact", DEFAULT_PARAMS.base_impact_id, "--today", DEFAULT_PARAMS.today.isoformat(),
          "--status-as-of", DEFAULT_PARAMS.status_as_of.isoformat()])
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*CACHE_COLUMNS).collect()))
    every = tables.replace(snapshot_needed=tables.snapshot_in_report)  # nothing is marked as cached yet
    ref = sorted(map(tuple, run_report(every, DEFAULT_PARAMS, ReportCache(spark, str(tmp_path / "c2")))
                     .select(*CACHE_COLUMNS).collect()))
    assert got == ref and got


def test_report_with_case_insensitive_distinct(spark, tables):
    """The collation option runs end to end (the test data has no case-only clashes)."""
    from tollgate.plans.report import report_rows

    a = sorted(map(tuple, report_rows(tables, DEFAULT_PARAMS).collect()))
    b = sorted(map(tuple, report_rows(tables, DEFAULT_PARAMS.with_(text_collation="UNICODE_CI_RTRIM")).collect()))
    assert a == b and a


def test_needed_snapshots_from_markers(spark, tables, tmp_path):
    cache = ReportCache(spark, str(tmp_path))
    in_report = tables.snapshot_in_report
    assert cache.needed(in_report, DEFAULT_PARAMS).count() == in_report.count()
    run_report(tables, DEFAULT_PARAMS, cache)  # marks the needed snapshots
    left = cache.needed(in_report, DEFAULT_PARAMS)
    expected = in_report.join(tables.snapshot_needed.select("project_id"), "project_id", "left_anti")
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, expected.collect()))
    # a snapshot that changed (new last-modified) is needed again
    bumped = in_report.withColumn("last_modified", F.timestamp_add("DAY", F.lit(1), "last_modified"))
    assert cache.needed(bumped, DEFAULT_PARAMS).count() == in_report.count()


def test_empty_report_leaves_a_usable_cache(spark, tables, tmp_path):
    """A base impact nobody uses: zero rows, twice; a later request works."""
    cache = ReportCache(spark, str(tmp_path / "cache"))
    unused = DEFAULT_PARAMS.with_(base_impact_id="NOSUCH", report_cache_id=99)
    for _ in range(2):
        t = tables.replace(snapshot_needed=cache.needed(tables.snapshot_in_report, unused))
        assert run_report(t, unused, cache).count() == 0
    assert cache.needed(tables.snapshot_in_report, unused).isEmpty()
    t = tables.replace(snapshot_needed=cache.needed(tables.snapshot_in_report, DEFAULT_PARAMS))
    assert run_report(t, DEFAULT_PARAMS, cache).count() > 0


def test_text_ids_run_the_whole_request(spark, tables, tmp_path):
    """Relations keyed by GUID-like texts in mixed case give the same report."""
    import hashlib

    from pyspark.sql import functions as F

    from tollgate.operators.attributes import NARRATIVE_ATTRIBUTES
    from tollgate.sources import read_tables
    from tollgate.sources.tables import ID_COLUMNS, RELATIONS

    def kind(c):
        return {"parent_project_id": "project_id", "parent_id": "base_impact_id"}.get(c, c)

    def as_guid(c):
        h = F.md5(F.concat(F.lit(kind(c)), F.col(c).cast("string")))
        return F.when(F.col(c).isNotNull(), F.upper(h)).alias(c)

    def text(c, value):
        return hashlib.md5(f"{kind(c)}{value}".encode()).hexdigest()

    for name in RELATIONS:
        df = getattr(tables, name)
        df.select(*[as_guid(c) if c in ID_COLUMNS else F.col(c) for c in df.columns]).write.parquet(str(tmp_path / name))
    stored = read_tables(spark, str(tmp_path), text_ids=True)
    P = DEFAULT_PARAMS
    p = P.with_(program_id=text("program_id", P.program_id), report_currency_id=text("program_currency_id", P.report_currency_id),
                gate_stage_id=text("stage_id", P.gate_stage_id), base_impact_id=text("base_impact_id", P.base_impact_id),
                attribute_ids={text("attribute_id", k): v for k, v in NARRATIVE_ATTRIBUTES.items()})
    got = run_report(stored, p, ReportCache(spark, str(tmp_path / "cache_text"), id_type="string")).collect()
    want = run_report(tables, P, ReportCache(spark, str(tmp_path / "cache_num"))).collect()
    plain = ("PROJ_PARENT", "WS_OWNER", "RM_OWNER", "RM_APPROVER", "A_Milestone", "Plan", "Update_To_Date", "RM_STAGE",
             "G4_DueDate", "Milestone_Owner", "CURRENCY_CODE", "Status_2Weeks_ago", "ROADMAP_DESCRIPTION")
    key = lambda r: tuple(repr(r[c]) for c in plain)
    assert sorted(map(key, got)) == sorted(map(key, want)) and got
    assert {r.RM_ID for r in got} == {text("roadmap_id", r.RM_ID) for r in want}
    assert all(r.ProjectURL.startswith("ng-program-tree/project?programId=" + p.program_id) for r in got)


def _filler(spark, projects, per_project, snapshot):
    """Cache rows of so many projects, their ids scattered over the whole range."""
    df = spark.range(projects * per_project).select(
        (F.col("id") % projects * 7919 % 1_000_003).alias("P_ID"), F.col("id").alias("A_FK_Milestone"))
    given = {"A_FK_REPORT_CACHE": DEFAULT_PARAMS.report_cache_id, "A_FK_REPORT_FILTER_CACHE": DEFAULT_PARAMS.report_filter_cache_id,
             "A_FK_SNAPSHOT": snapshot, "A_ROADMAP_SUBSET_HASH": 5, "A_FK_BASE_IMPACT": "N3"}
    types = dict(c.split(" ", 1) for c in cache_schema().replace("`", "").split(", "))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return df.select(*[
        F.col(c) if c in df.columns else at.alias(c) if c == "A_LAST_MODIFIED_FOR_CACHE_UTC"
        else F.lit(given.get(c)).cast(types[c]).alias(c) for c in CACHE_COLUMNS])


def _rows_read(df):
    """Rows that the file scans of df, a plan without shuffles, hand on by their own metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numOutputRows").value() for s in scans if s.metrics().contains("numFiles"))


def _request(spark, ids, snapshot):
    ddl = "project_id bigint, snapshot_id int, last_modified timestamp_ntz, subset_hash bigint"
    return spark.createDataFrame([(i, snapshot, dt.datetime(2024, 1, 1), 5) for i in ids], ddl)


def test_small_request_reads_few_rows_of_a_large_cache(spark, tmp_path):
    cache, plain = ReportCache(spark, str(tmp_path / "cache")), str(tmp_path / "plain")
    cache.merge(_filler(spark, 3000, 20, 1))
    cache.merge(_filler(spark, 3000, 20, 2))
    n = cache.table().count()
    assert n == 120_000
    cache.table().repartition(4).write.partitionBy("A_FK_REPORT_CACHE", "A_FK_REPORT_FILTER_CACHE").parquet(plain)
    ids = [7919 * k % 1_000_003 for k in (5, 1700, 2999)]
    for wanted in ([ids[0]], ids, [None, -4], []):
        request = _request(spark, wanted, 2)
        got = cache.read_back(request, DEFAULT_PARAMS).collect()
        expected = read_back(spark.read.schema(cache_schema()).parquet(plain).select(*CACHE_COLUMNS), request, DEFAULT_PARAMS)
        assert sorted((r.P_ID, r.A_FK_Milestone) for r in got) == sorted((r.P_ID, r.A_FK_Milestone) for r in expected.collect())
        assert len(got) == 20 * len([w for w in wanted if w in ids])
        projects = request.select(F.col("project_id").alias("P_ID"))
        read = _rows_read(stored_rows_of(cache.table(), projects, "P_ID", KeyBound(len(wanted))))
        assert len(got) <= read <= n // 5, (wanted, read)


def test_request_beyond_the_pushed_keys(spark, tmp_path):
    """More projects than are pushed one by one: their range is pushed, the join does the rest."""
    cache = ReportCache(spark, str(tmp_path))
    cache.merge(_filler(spark, 3000, 4, 1))
    ids = sorted(7919 * k % 1_000_003 for k in range(3000))[:2 * PUSHED_KEYS:2]
    ids += [i + 1 for i in ids if i + 1 not in ids]
    got = cache.read_back(_request(spark, ids, 1), DEFAULT_PARAMS).collect()
    expected = {r.P_ID for r in cache.table().select("P_ID").distinct().collect()} & set(ids)
    assert {r.P_ID for r in got} == expected and len(got) == 4 * len(expected)


def test_cache_files_have_bloom_filters_and_sorted_projects(spark, tmp_path):
    import pyarrow.parquet as pq

    cache = ReportCache(spark, str(tmp_path))
    cache.merge(_filler(spark, 3000, 20, 1))
    files = list((tmp_path / "report_cache").rglob("*.parquet"))
    assert files
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i) for i in range(meta.num_columns)}
            # the reader looks a value up in a chunk's dictionary, or, without one, in its Bloom filter
            assert columns["P_ID"].has_dictionary_page or columns["P_ID"].bloom_filter_offset is not None
        ids = pq.read_table(f, columns=["P_ID"]).column("P_ID").to_pylist()
        assert ids == sorted(ids)
