"""Upkeep of RAW: packing and dropping, across loads, streams and calls that were cut short."""

import json

import pytest

from millrace.sinks import raw as raw_sink
from millrace.sinks.buckets import read_buckets
from millrace.specs import API_A
from millrace.streaming.landing import land, read_history, read_raw, read_rejected
from millrace.streaming.upsert import stream_upsert


@pytest.fixture
def place(spark, tmp_path):
    """Loads records into RAW at a time, one file a load."""

    class Place:
        stage, raw, seen, clean, taken = (str(tmp_path / n) for n in ("stage", "raw", "seen", "clean", "taken"))
        n = 0

        def load(self, at, *lines):
            folder = tmp_path / "stage" / "source=api_a" / "batch_id=b"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{self.n:03d}.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
            self.n += 1
            land(spark, self.stage, "api_a", self.raw, self.seen, at).awaitTermination()

        def upsert(self):
            stream_upsert(spark, self.raw, self.clean, self.taken, API_A, "2024-02-01", buckets=4).awaitTermination()
            return sorted(((r.id, r.name) for r in read_buckets(spark, self.clean, API_A).collect()), key=str)

        def rows(self):
            return sorted(str(r.payload.toJson()) for r in read_raw(spark, self.raw).collect())

    return Place()


def version(n, name, key="k"):
    return {"id": key, "updated_at": f"2024-01-01 00:00:0{n}", "name": name}


def test_packing_keeps_rows_bad_lines_and_bounds(spark, place):
    place.load("2024-01-05 10:00:00", {"id": "a"}, "{bad")
    place.load("2024-01-05 11:00:00", {"id": "b"}, "")
    place.load("2024-01-06 11:00:00", {"id": "c"})
    rows, bad = place.rows(), read_rejected(spark, place.raw).collect()
    history = sorted(map(tuple, read_history(spark, place.raw).collect()), key=str)
    # The good rows of the 5th lie in two loads; its bad and blank lines in one each.
    assert raw_sink.compact_raw(spark, place.raw, "2024-01-06 12:00:00") == 2
    left = raw_sink.day_folders(spark, place.raw)
    assert left == [("0", "bad", "2024-01-05"), ("1", "blank", "2024-01-05"), ("2", "good", "2024-01-06"), ("c0", "good", "2024-01-05")]
    assert place.rows() == rows and read_rejected(spark, place.raw).collect() == bad
    assert sorted(map(tuple, read_history(spark, place.raw).collect()), key=str) == history
    assert [str(r.ingested_at) for r in read_raw(spark, place.raw, "2024-01-05 11:00:00").orderBy("ingested_at").collect()] == ["2024-01-05 11:00:00", "2024-01-06 11:00:00"]
    assert raw_sink.compact_raw(spark, place.raw, "2024-01-06 12:00:00") == 0
    # Packed days are packed again when later loads add to them.
    place.load("2024-01-05 23:00:00", {"id": "late"})
    assert raw_sink.compact_raw(spark, place.raw, "2024-01-07") == 2 and ("c1", "good", "2024-01-05") in raw_sink.day_folders(spark, place.raw)
    assert len(place.rows()) == 4


def test_a_stream_across_packing_loses_and_repeats_nothing(spark, place):
    place.load("2024-01-05", version(1, "one"), {"id": None, "name": "lost"})
    place.load("2024-01-05", version(2, "two"), version(1, "x", "m"))
    assert place.upsert() == [("k", "two"), ("m", "x"), (None, "lost")]
    taken = raw_sink.load_ids(spark, place.raw)
    place.load("2024-01-05", version(3, "three"), {"id": None, "name": "new"})
    # The third load has not been taken yet, so it is not packed.
    assert raw_sink.compact_raw(spark, place.raw, "2024-01-06", loads=taken) == 2
    assert {f[0] for f in raw_sink.day_folders(spark, place.raw)} == {"2", "c0"}
    want = [("k", "three"), ("m", "x"), (None, "lost"), (None, "new")]
    assert place.upsert() == want and place.upsert() == want
    assert raw_sink.compact_raw(spark, place.raw, "2024-01-06", loads=raw_sink.load_ids(spark, place.raw)) == 2
    place.load("2024-01-06", version(4, "four"))
    assert place.upsert() == [("k", "four"), *want[1:]]


@pytest.mark.parametrize("step", ["drop_folder", "move_folder"])
def test_a_swap_that_was_cut_is_made_good(spark, place, monkeypatch, step):
    for n in range(3):
        place.load("2024-01-05", {"id": str(n)})
    rows, real = place.rows(), getattr(raw_sink, step)
    calls = []

    def cut(session, path, *more):
        calls.append(path)
        # Dropping: the second folder of RAW fails. Moving: the packed folder is not moved.
        if step == "move_folder" or len([c for c in calls if "load_id=" in c]) == 2:
            raise RuntimeError("lost")
        return real(session, path, *more)

    monkeypatch.setattr(raw_sink, step, cut)
    with pytest.raises(RuntimeError):
        raw_sink.compact_raw(spark, place.raw, "2024-01-06")
    monkeypatch.setattr(raw_sink, step, real)
    assert raw_sink.compact_raw(spark, place.raw, "2024-01-06") == 3
    assert place.rows() == rows and {f[0] for f in raw_sink.day_folders(spark, place.raw)} == {"c0"}


def test_days_past_retention_are_dropped_whole(spark, place):
    for day in ("2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-03-01"):
        place.load(day, {"id": day})
    assert raw_sink.purge_raw(spark, place.raw, "2024-04-01 12:00:00") == 1
    assert [json.loads(r)["id"][:10] for r in place.rows()] == ["2024-01-02", "2024-03-01"]
    assert raw_sink.purge_raw(spark, place.raw, "2024-04-01 12:00:00") == 0
    assert raw_sink.purge_raw(spark, place.raw, "2024-04-01", days=0) == 2


def test_upkeep_of_nothing(spark, tmp_path):
    assert raw_sink.compact_raw(spark, str(tmp_path / "none")) == 0 and raw_sink.purge_raw(spark, str(tmp_path / "none")) == 0
