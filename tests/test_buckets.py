"""Clean tables in key buckets: what a load touches, replays, and the states kept beside the table."""

import datetime as dt
import random

import pytest

from millrace.operators import clean
from millrace.plans import analytics, quality
from millrace.sinks import buckets
from millrace.specs import API_A
from tests.test_clean import raw_of  # noqa: F401

COLUMNS = API_A.clean_columns


@pytest.fixture
def slices(spark):
    """Clean rows from (id, updated, name, day)."""

    def make(*rows):
        out = []
        for key, updated, name, day in rows:
            row = dict.fromkeys(COLUMNS)
            at = None if updated is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=updated)
            row.update(id=key, updated_at=at, name=name, created_at=dt.datetime(2024, 1, day), ingested_at=dt.datetime(2024, 2, day), _loaded_at=dt.datetime(2024, 3, 1))
            out.append(tuple(row[c] for c in COLUMNS))
        return spark.createDataFrame(out, API_A.clean_schema)

    return make


def rows_of(spark, path):
    return sorted(((r.id, r.name) for r in buckets.read_buckets(spark, path, API_A).collect()), key=str)


def files(path):
    """Data files of a table with their times."""
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_only_buckets_of_the_slice_are_rewritten(spark, slices, tmp_path):
    path = tmp_path / "t"
    buckets.upsert_buckets(slices(*[(f"k{i}", 1, "old", 1 + i % 9) for i in range(400)], (None, 1, "lost", 1)), str(path), API_A, 0, 32)
    before, parts = files(path), {p: files(tmp_path / p) for p in ("t_days", "t_facts")}
    assert len(buckets.bucket_names(spark, str(path))) == 33
    buckets.upsert_buckets(slices(("k7", 2, "new", 3), ("k8", 0, "late", 3), ("fresh", 1, "new", 9), (None, 5, "again", 2)), str(path), API_A, 1, 999)
    after = files(path)
    hit = {f.parent.name for f in set(before) - set(after)}
    assert 1 <= len(hit) <= 3 and not any("null" in h for h in hit)
    made = {f.parent.name for f in set(after) - set(before)}
    assert hit <= made and made - hit <= {"bucket=null-1", f"bucket={_bucket(spark, 'fresh')}"}
    kept = set(before) & set(after)
    assert all(before[f] == after[f] for f in kept) and len({f.parent.name for f in kept}) == 33 - len(hit)
    for name, old in parts.items():
        now = files(tmp_path / name)
        assert {f.parent.name for f in set(old) - set(now)} == hit and all(old[f] == now[f] for f in set(old) & set(now))
    names = dict(r for r in rows_of(spark, str(path)) if r[0])
    assert names["k7"] == "new" and names["k8"] == "old" and names["fresh"] == "new" and len(names) == 401
    assert [r for r in rows_of(spark, str(path)) if r[0] is None] == [(None, "again"), (None, "lost")]


def _bucket(spark, key):
    return spark.createDataFrame([(key,)], "id string").select(buckets.bucket_of("id", 32, 1)).first()[0]


def test_loads_equal_a_full_rebuild(spark, raw_of, tmp_path):  # noqa: F811
    rng = random.Random(8)
    rows = [(f'{{"id": "{rng.randrange(25)}", "updated_at": "2024-01-01 00:{i // 60:02d}:{i % 60:02d}", "created_at": "2024-01-{1 + i % 28:02d}", "name": "{i}"}}', "2024-02-01") for i in range(120)]
    rng.shuffle(rows)
    path = str(tmp_path / "t")
    for load, cut in enumerate((0, 40, 80)):
        part = clean.clean_full(raw_of(*rows[cut : cut + 40]), API_A, "2024-02-02")
        assert buckets.upsert_buckets(part, path, API_A, load, 8)
    full = clean.clean_full(raw_of(*rows), API_A, "2024-02-02")
    assert rows_of(spark, path) == sorted(((r.id, r.name) for r in full.collect()), key=str)
    assert buckets.loads(spark, path) == [0, 1, 2]


def test_a_finished_load_is_not_repeated_and_a_cut_one_is_made_good(spark, slices, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    buckets.upsert_buckets(slices(("a", 1, "old", 1), ("b", 1, "old", 1)), path, API_A, 0, 4)
    new = slices(("a", 2, "new", 1), (None, 1, "lost", 1))
    real = buckets._replace

    def cut(df, where):
        real(df, where)
        raise RuntimeError("lost")

    monkeypatch.setattr(buckets, "_replace", cut)
    with pytest.raises(RuntimeError):
        buckets.upsert_buckets(new, path, API_A, 1)
    monkeypatch.setattr(buckets, "_replace", real)
    want = [("a", "new"), ("b", "old"), (None, "lost")]
    for expected in (True, False):
        assert buckets.upsert_buckets(new, path, API_A, 1) is expected
        assert rows_of(spark, path) == sorted(want, key=str)
    assert not (tmp_path / "t_pending" / "load_id=1").exists()


def test_states_follow_the_table(spark, slices, tmp_path):
    path = str(tmp_path / "t")
    buckets.upsert_buckets(slices(*[(f"k{i}", 1, "x", 1 + i % 5) for i in range(50)], (None, 1, "n", 2)), path, API_A, 0, 8)
    # k1 moves from day 2 to day 9; two more rows come without a key.
    buckets.upsert_buckets(slices(("k1", 2, "y", 9), ("z", 1, "y", 9), (None, 1, "m", 9)), path, API_A, 1)
    table = buckets.read_buckets(spark, path, API_A)
    order = lambda df: sorted(map(tuple, df.drop("check_id", "_refreshed_at").collect()), key=str)
    days = buckets.day_states(spark, path)
    assert order(analytics.summary_of_days(days, days, "2024-03-01")) == order(analytics.daily_summary(table, table, "2024-03-01"))
    facts = buckets.fact_states(spark, path)
    assert order(quality.check_states(facts, "t", "2024-02-09 09:00:00")) == order(quality.check_table(table, "t", "2024-02-09 09:00:00"))
    plan = quality.check_states(facts, "t", "2024-02-09")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "t_facts" in plan
    buckets.rebuild_states(spark, path, API_A)
    assert order(buckets.day_states(spark, path).groupBy("event_date").sum("event_count")) == order(table.selectExpr("to_date(created_at) d").groupBy("d").count())


def test_states_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert buckets.read_buckets(spark, path, API_A).count() == 0 and buckets.loads(spark, path) == []
    rows = {r.check_name: r for r in quality.check_states(buckets.fact_states(spark, path), "t", "2024-02-09").collect()}
    assert rows["row_count_check"].passed is False and rows["freshness_check"].passed is None


def test_slice_reads_only_its_buckets(spark, slices, tmp_path):
    path = str(tmp_path / "t")
    buckets.upsert_buckets(slices(*[(f"k{i}", 1, "x", 1) for i in range(100)]), path, API_A, 0, 16)
    rows = buckets._read(spark, path, f"{API_A.clean_schema}, bucket string").where("bucket in ('0003-of-0016')")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and len(rows.inputFiles()) <= 16
    assert {r[0] for r in rows.select("bucket").distinct().collect()} == {"0003-of-0016"}
