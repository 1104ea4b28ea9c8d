"""The views, checks, gate and metrics on small clean tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.plans import analytics, metrics, quality
from millrace.specs import API_A, API_B

NOW = "2024-03-10 12:00:00"


def at(text):
    return dt.datetime.fromisoformat(text) if text else None


@pytest.fixture
def clean_a(spark):
    """Rows of (id, created_at, updated_at, status, category, ingested_at, batch_id, file_name)."""

    def make(*rows):
        full = [
            (i, at(c), at(u), None, s, None, None, None, k, None, at(g), b, f, at("2024-03-10 11:00:00"))
            for i, c, u, s, k, g, b, f in rows
        ]
        return spark.createDataFrame(full, API_A.clean_schema)

    return make


@pytest.fixture
def clean_b(spark):
    def make(*rows):
        full = [
            (i, at(c), at(c), None, s, p, Decimal(a) if a else None, None, None, None, at(c), "b", "f", at("2024-03-10 11:00:00"))
            for i, c, s, p, a in rows
        ]
        return spark.createDataFrame(full, API_B.clean_schema)

    return make


def aged(hours):
    return (dt.datetime.fromisoformat(NOW) - dt.timedelta(hours=hours)).isoformat()


@pytest.mark.parametrize(
    "hours, passed, status",
    [(0, True, "HEALTHY"), (6, True, "HEALTHY"), (7, False, "WARNING"), (24, False, "WARNING"), (25, False, "STALE"), (None, None, "HEALTHY")],
)
def test_freshness_limits(clean_a, clean_b, hours, passed, status):
    rows = [] if hours is None else [("1", aged(hours), aged(hours), None, None, aged(hours), "b", "f")]
    a = clean_a(*rows)
    view = analytics.data_freshness(a, clean_b(), NOW).where("source = 'api_a'").first()
    assert view.freshness_status == status
    check = quality.check_table(a, "t", NOW).where("check_name = 'freshness_check'").first()
    assert check.passed is passed
    expected = {True: None, None: "No data found - cannot check freshness", False: f"Data is {hours} hours old (threshold: 6 hours)"}
    assert check.error_message == expected[passed]


def test_lag_and_today(clean_a, clean_b):
    a = clean_a(
        ("1", "2024-03-10", "2024-03-10 09:59:59", None, None, "2024-03-10 10:00:00", "b", "f"),
        ("2", "2024-03-01", "2024-03-09 10:00:00", None, None, "2024-03-09 10:03:59", "b", "f"),
        ("3", "2024-03-01", None, None, None, None, "b", "f"),
    )
    row = analytics.data_freshness(a, clean_b(), NOW).where("source = 'api_a'").first()
    assert (row.avg_ingestion_lag_minutes, row.max_ingestion_lag_minutes) == (2.0, 3)
    assert (row.total_records, row.records_today, row.event_age_minutes) == (3, 1, 121)


def test_dashboards_agree_and_leave_a_quiet_week_null(clean_a, clean_b):
    a = clean_a(
        ("1", "2024-03-03 00:00:00", aged(1), None, None, aged(1), "b", "f"),
        ("2", "2024-03-02 23:59:59", aged(1), None, None, aged(1), "b", "f"),
        ("2", None, aged(1), None, None, aged(1), "b", "f"),
    )
    b = clean_b(("1", "2024-01-01", "s", "p", "1"))
    one_pass = {r.source: r for r in analytics.executive_dashboard(a, b, NOW).collect()}
    joined = analytics.dashboard_of(analytics.data_freshness(a, b, NOW), analytics.daily_event_counts(a, b), NOW)
    assert {r.source: r for r in joined.collect()} == one_pass
    assert one_pass["api_a"].events_last_7_days == 1 and one_pass["api_b"].events_last_7_days is None


def test_shares_and_null_groups(clean_a):
    rows = [(str(i), None, None, s, k, None, "b", "f") for i, (s, k) in enumerate([("x", "k1"), ("x", "k2"), (None, None), ("y", "k1"), ("x", "k1"), ("x", "k1")])]
    a = clean_a(*rows)
    assert [(r.status, r["count"], float(r.percentage)) for r in analytics.status_distribution(a).collect()] == [("x", 4, 66.67), ("y", 1, 16.67), (None, 1, 16.67)]
    assert [(r.category, r.event_count, float(r.pct_of_total)) for r in analytics.top_categories(a).collect()] == [("k1", 4, 80.0), ("k2", 1, 20.0)]
    assert analytics.top_categories(a.limit(0)).collect() == []
    assert [r.category for r in analytics.top_k_categories(a, 1).collect()] == ["k1"]


def test_unique_ids_need_no_distinct_count(clean_a, clean_b):
    a = clean_a(*[(i, "2024-03-01", None, None, "k", "2024-03-01", b, f) for i, b, f in (("1", "b1", "f2"), ("2", "b1", "f1"), (None, "b2", None), ("3", None, "f3"))])
    b = clean_b(("1", "2024-03-01", "s", "p", "1.5"), ("2", None, "s", "p", None))
    for view in (analytics.daily_event_counts, analytics.ingestion_history):
        assert view(a, b, ids_unique=True).collect() == view(a, b).collect()
    assert analytics.top_categories(a, ids_unique=True).collect() == analytics.top_categories(a).collect()
    history = {(r.source, r.batch_id): (r.record_count, r.unique_ids, r.file_name) for r in analytics.ingestion_history(a, b).collect()}
    assert history[("api_a", "b1")] == (2, 2, "f1") and history[("api_a", "b2")] == (1, 0, None)
    assert history[("api_a", None)] == (1, 1, "f3")


def test_nulls_come_first_in_descending_views(clean_a, clean_b):
    b = clean_b(("1", None, "s", "p", None), ("2", "2024-03-02", "s", None, "2"), ("3", "2024-03-01", None, "p", "1"))
    days = [r.event_date for r in analytics.daily_event_counts(clean_a(), b).collect()]
    assert days == [None, dt.date(2024, 3, 2), dt.date(2024, 3, 1)]
    assert [(r.priority, r.state) for r in analytics.priority_distribution(b).collect()] == [("p", "s"), ("p", None), (None, "s")]
    hours = {(r.hour_of_day, r.day_of_week) for r in analytics.hourly_activity(clean_a(), b).collect()}
    assert hours == {(None, None), (0, "Sat"), (0, "Fri")}


def test_volume_boundary(clean_a, clean_b):
    daily = analytics.daily_event_counts(clean_a(), clean_b(("1", "2024-03-03", "s", "p", "1"), ("2", "2024-03-04", "s", "p", "1")))
    assert analytics.volume_trend(daily, NOW).count() == 1
    assert analytics.volume_trend(daily, NOW, inclusive=True).count() == 2


def test_all_views_can_be_queried(spark, clean_a, clean_b):
    a, b = clean_a(("1", "2024-03-01", "2024-03-01", "s", "k", "2024-03-01", "b", "f")), clean_b(("1", "2024-03-01", "s", "p", "1"))
    names = analytics.register_views(a, b, NOW)
    assert len(names) == 8 and all(spark.table(n).count() > 0 for n in names)


def test_checks_of_an_empty_table(clean_a):
    rows = {r.check_name: r for r in quality.check_table(clean_a(), "CLEAN.CLN_API_A_EVENTS", NOW, batch_id="r").collect()}
    assert (rows["row_count_check"].passed, rows["row_count_check"].error_message) == (False, "Table is empty - no records found")
    assert rows["null_primary_key_check"].passed and rows["duplicate_primary_key_check"].passed
    assert rows["freshness_check"].passed is None and rows["freshness_check"].result_value is None
    assert len({r.check_id for r in rows.values()}) == 4 and {r.batch_id for r in rows.values()} == {"r"}


def test_checks_find_null_and_repeated_keys(clean_a):
    ids = ["1", "1", "1", None, None, "2"]
    a = clean_a(*[(i, None, None, None, None, aged(1), "b", "f") for i in ids])
    rows = {r.check_name: r for r in quality.check_table(a, "t", NOW).collect()}
    assert rows["row_count_check"].result_value == 6
    assert rows["null_primary_key_check"].error_message == "Found 2 records with NULL id"
    # Keys are counted, not rows, and NULL is one of them.
    assert rows["duplicate_primary_key_check"].error_message == "Found 2 duplicate id values"


def test_reports_over_checks(clean_a):
    results = quality.check_table(clean_a(), "t", NOW, batch_id="r").unionByName(quality.check_table(clean_a(), "t", "2024-03-09 12:00:00", batch_id="q"))
    row = quality.summary(results, NOW).first()
    assert (row.total_checks, row.passed_checks, row.failed_checks, row.unknown_checks, float(row.pass_rate_pct)) == (4, 2, 1, 1, 50.0)
    none = quality.summary(results, "2025-01-01").first()
    assert (none.total_checks, none.passed_checks, none.pass_rate_pct) == (0, None, None)
    assert quality.summary(results, batch_id="q").first().total_checks == 4
    assert [r.check_name for r in quality.alerts(results, NOW).collect()] == ["row_count_check"]
    assert quality.latest_results(results, NOW).count() == 4
    assert [(r.check_date.day, r.total_checks, r.passed, r.failed) for r in quality.per_day(results, NOW).collect()] == [(10, 4, 2, 1), (9, 4, 2, 1)]


def test_gate_stops_for_critical_failures_only(clean_a):
    quality.gate(quality.check_table(clean_a(), "t", NOW))
    bad = clean_a((None, None, None, None, None, aged(1), "b", "f"))
    with pytest.raises(quality.QualityGateError, match="Found 1 records with NULL id"):
        quality.gate(quality.check_table(bad, "t", NOW))


def test_request_metrics_of_no_durations(spark):
    log = spark.createDataFrame([("a", "b", None, 1, True), ("a", "b", None, None, False)], "source string, batch_id string, duration_ms double, retry_count int, success boolean")
    row = metrics.request_metrics(log).first()
    assert tuple(row)[2:] == (2, 1, 1, 1, 0.0, 0.0)


def test_step_logs(spark, tmp_path):
    lines = [
        '{"source": "a", "batch_id": "b", "step": "s", "status": "started", "timestamp": "1"}',
        '{"source": "a", "batch_id": "b", "step": "s", "status": "error", "error": "first", "timestamp": "2"}',
        '{"source": "a", "batch_id": "b", "step": "s", "status": "error", "error": "last", "timestamp": "3", "duration_ms": 1.5}',
        '{"source": "a", "batch_id": "b", "step": "t", "status": "success", "row_count": 5, "request_duration_ms": 2}',
        "free text", "{}",
    ]
    (tmp_path / "log").write_text("\n".join(lines))
    rows = {r.step: r for r in metrics.step_log_rollup(metrics.read_step_logs(spark, str(tmp_path / "log"))).collect()}
    assert (rows["s"].status, rows["s"].last_error, rows["s"].total_duration_ms, rows["s"].log_lines) == ("error", "last", 1.5, 3)
    assert (rows["t"].status, rows["t"].row_count) == ("success", 5)


def test_runs(spark):
    results = spark.createDataFrame([("r1", 5, 4, "success"), ("r1", None, None, "error"), ("r2", 1, 1, "success")], "batch_id string, records_fetched int, records_staged int, status string")
    checks = spark.createDataFrame([("r1", True), ("r1", False), ("r1", None)], "batch_id string, passed boolean")
    rows = {r.batch_id: tuple(r)[1:] for r in metrics.run_metrics(metrics.run_summary(results), checks).collect()}
    assert rows == {"r1": (2, 5, 4, "partial_failure", 3, 1, 1), "r2": (1, 1, 1, "success", 0, 0, 0)}
