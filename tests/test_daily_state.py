"""What is carried from day to day: landed documents, nested drift, versions, history, run days."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.checks import run_queries
from tallymark.operators import nested_drift as nd
from tallymark.operators.versions import latest_version
from tallymark.runs import monitoring
from tallymark.sinks.history import ConcurrentRefresh, History
from tallymark.sinks.version_state import VersionState
from tallymark.sources.incremental import Landing

DAY = dt.date(2001, 8, 1)


def arrive(base, day, name, records, raw=None):
    folder = base / str(day.year) / str(day.month) / str(day.day)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(raw if raw is not None else json.dumps({"records": records}).encode())


@pytest.fixture
def landing(spark, tmp_path):
    (tmp_path / "base").mkdir()
    return Landing(spark, str(tmp_path / "base"), str(tmp_path / "landed"), "acc*.json")


def landed(landing):
    return sorted((r.day, r.batch, r.id, r.name) for r in landing.records("id long, name string").collect())


def test_documents_land_once(landing, tmp_path):
    base = tmp_path / "base"
    assert landing.texts().count() == 0 and landing.drift().count() == 0
    arrive(base, DAY, "acc.json", [{"id": 1, "name": "a"}, {"id": 2}])
    arrive(base, DAY, "other.json", [{"id": 9}])
    assert landing.ingest() == 1 and landing.ingest() == 0
    # a document that was read is not read again, even if it is broken by now
    arrive(base, DAY, "acc.json", None, b"{broken")
    later = DAY + dt.timedelta(days=1)
    arrive(base, later, "acc.json", None, b'{"records": [{"id": 3, "name": "n\xe9\x7fw \xef\xbf\xbd"}]}')
    arrive(base, later, "acc2.json", [])
    assert landing.ingest() == 2
    assert landed(landing) == [(DAY, 0, 1, "a"), (DAY, 0, 2, None), (later, 1, 3, "nw �")]


def test_a_broken_document_is_tried_again(landing, tmp_path):
    base = tmp_path / "base"
    arrive(base, DAY, "acc.json", [{"id": 1, "name": "a"}])
    landing.ingest()
    for raw in (b'{"records": [{"id": 2', b'{"rows": []}'):
        arrive(base, DAY, "acc2.json", None, raw)
        with pytest.raises(Exception, match="(?i)malformed|without records|foreachBatch"):
            landing.ingest()
    arrive(base, DAY, "acc2.json", [{"id": 2, "name": "b"}])
    landing.ingest()
    assert landed(landing) == [(DAY, 0, 1, "a"), (DAY, 1, 2, "b")]


def test_a_repeated_batch_replaces_itself(spark, landing, tmp_path):
    documents = spark.createDataFrame([(f"/{DAY.year}/{DAY.month}/{DAY.day}/acc.json", bytearray(b'{"records": [{"id": 1}]}'))], "path string, content binary")
    for _ in range(2):
        landing._land(documents, 0)
    landing._land(documents, 1)
    assert [x[:3] for x in landed(landing)] == [(DAY, 0, 1), (DAY, 1, 1)]
    assert landing.drift().count() == 1


def test_batches_are_bounded_and_drift_is_known(landing, tmp_path):
    for n, record in enumerate([{"id": 1, "m": {"a": 1}}, {"id": 1, "m": {"a": 1, "b": [{"c": None}]}}, {"id": "x", "m": {"a": 1.5}}]):
        arrive(tmp_path / "base", DAY + dt.timedelta(days=n), "acc.json", [record])
    assert landing.ingest(files_per_batch=1) == 3
    assert {r.batch for r in landing.texts().collect()} == {0, 1, 2}
    rows = [tuple(r) for r in landing.drift().orderBy("day").collect()]
    assert [r[1:] for r in rows] == [(0, [], [], []), (1, ["m.b"], [], []), (2, [], ["m.b"], ["id"])]


def test_drift_of_nested_records(spark):
    rows = [
        (DAY, {"a": 1, "b": {"c": "x", "d": [{"e": 1}]}}),
        (DAY, {"a": None}),
        (DAY + dt.timedelta(days=1), {"a": 2.5, "b": {"c": {"z": 1}, "d": [{"e": 1, "f": True}, {}]}, "we ird.x": {"y`z": 1}}),
        (DAY + dt.timedelta(days=2), {"b": {"c": {"z": 2}, "d": []}}),
        (DAY + dt.timedelta(days=3), {"a": "text", "b": {"c": {"z": 2}, "d": "none"}}),
    ]
    frame = spark.createDataFrame([(d, json.dumps(r)) for d, r in rows] + [(None, "{}"), (DAY, None)], "day date, record string")
    got = [tuple(r)[1:] for r in nd.nested_drift(frame, "day").orderBy("day").collect()]
    assert got == [
        (0, [], [], []),
        (1, ["`we ird.x`", "b.d[].f"], [], ["b.c"]),
        (2, [], ["`we ird.x`", "a"], []),
        (2, [], ["`we ird.x`"], ["a", "b.d"]),
    ]
    assert nd.nested_drift(frame.limit(0), "day").count() == 0
    with pytest.raises(Exception, match="(?i)json"):
        nd.nested_drift(spark.createDataFrame([(DAY, "{broken")], "day date, record string"), "day")


def test_schemas_take_one_shuffle(spark):
    frame = spark.createDataFrame([(DAY, "{}")], "day date, record string")
    text = nd.day_schemas(frame, "day")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_schema_of_variant_agg" in text


fields = st.recursive(st.sampled_from(["BIGINT", "STRING", "BOOLEAN", "VOID"]), lambda x: st.one_of(x.map(lambda e: f"ARRAY<{e}>"), st.dictionaries(st.sampled_from("abc"), x, max_size=3).map(lambda d: f"OBJECT<{', '.join(f'{k}: {v}' for k, v in d.items())}>")), max_leaves=6)
objects = st.dictionaries(st.sampled_from("xyz"), fields, max_size=3).map(lambda d: f"OBJECT<{', '.join(f'{k}: {v}' for k, v in d.items())}>")


@settings(max_examples=60, deadline=None)
@given(objects, objects)
def test_differences_hold(spark, first, second):
    a, b = nd.schema_of(first), nd.schema_of(second)
    there, back = nd.difference(a, b), nd.difference(b, a)
    assert (there.added, there.removed, there.retyped) == (back.removed, back.added, back.retyped)
    assert nd.difference(a, a) == ([], [], [])
    both = nd.combined(a, b)
    assert nd.difference(both, b).added == [] and nd.difference(both, b).retyped == []


def versions_of(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, at int, extra string")


def test_versions_are_kept_up_to_date(spark):
    days = [
        [(1, "a", 5, "x"), (1, "a", 7, "x"), (2, "b", 1, "x"), (None, "n", 1, "x"), (None, None, 4, None)],
        [(1, "a", 6, "y"), (2, "b2", 9, "y"), (None, "n", 3, "y"), (3, None, None, "y")],
        [(3, None, 2, "z"), (None, None, 1, "z"), (1, "a", 7, "z")],
    ]
    state = VersionState(spark, "test_versions", ["id", "name"], "at", ["id"], buckets=4)
    state.create(versions_of(spark, days[0]).limit(0))
    for n, day in enumerate(days):
        state.merge(versions_of(spark, day))
        want = latest_version(versions_of(spark, [r for d in days[: n + 1] for r in d]), ["id", "name"], "at")
        assert sorted(map(tuple, state.read().collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    state.merge(versions_of(spark, days[0]))
    assert state.read().count() == want.count(), "a repeated day changes nothing"


def test_the_state_is_not_shuffled(spark):
    state = VersionState(spark, "test_plan", ["id", "name"], "at", ["id"], buckets=4)
    state.create(versions_of(spark, [(1, "a", 5, "x")]))
    text = state.merged(versions_of(spark, [(1, "a", 5, "x")]))._jdf.queryExecution().executedPlan().toString()
    state_side = text[text.index("Union") : text.index("REPARTITION_BY_NUM")]
    assert "Bucketed: true" in state_side and "Exchange" not in text[: text.index("Union")]
    assert state_side.count("Exchange") == 1, "the day's own"
    with pytest.raises(ValueError):
        VersionState(spark, "test_plan", ["id"], "at", ["name"])


SCHEMA = "Name string, Size long, Fecha string"


def test_a_history_is_swapped_whole(spark, tmp_path):
    history = History(spark, str(tmp_path / "h"))
    assert history.read(SCHEMA).count() == 0
    rows = lambda day: spark.createDataFrame([("a", 1, day), ("b", None, day)], SCHEMA)
    assert history.refresh(rows("1")) == 1
    broken = rows("2").withColumn("Size", F.when(F.col("Name") == "b", F.raise_error(F.lit("broke off"))).otherwise(F.col("Size")))
    with pytest.raises(Exception, match="broke off"):
        history.refresh(broken)
    assert {r.Fecha for r in history.read(SCHEMA).collect()} == {"1"}
    assert history.refresh(rows("3")) == 2
    assert sorted((r.Name, r.Fecha) for r in history.read(SCHEMA).collect()) == [("a", "1"), ("a", "3"), ("b", "1"), ("b", "3")]
    assert history.keep(1) >= 1 and history.read(SCHEMA).count() == 4
    assert history.refresh(rows("4")) == 3


def test_a_second_refresh_from_the_same_version_fails(spark, tmp_path, monkeypatch):
    history = History(spark, str(tmp_path / "h"))
    rows = spark.createDataFrame([("a", 1, "1")], SCHEMA)
    history.refresh(rows)
    monkeypatch.setattr(History, "_current", lambda *_: (0, ""))
    with pytest.raises(ConcurrentRefresh):
        history.refresh(rows)
    monkeypatch.undo()
    assert history.refresh(rows.withColumn("Fecha", F.lit("2"))) == 2 and history.read(SCHEMA).count() == 2


def test_run_days_as_bits(spark):
    first, last = dt.date(2059, 9, 1), dt.date(2059, 10, 5)  # a span ends in between
    every = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    ran = {"a": every[::2], "b": every[:1], "c": every}
    rows = [(c, d) for c, days in ran.items() for d in days]
    one = monitoring.day_bitmaps(spark.createDataFrame(rows[::2] + rows[:3], "control string, day date"))
    two = monitoring.day_bitmaps(spark.createDataFrame(rows[1::2], "control string, day date"))
    both = monitoring.merged_bitmaps(one, two, two)
    assert both.where("control = 'c'").count() == 2
    assert {r.control: r.n_days for r in monitoring.days_run(both).collect()} == {c: len(d) for c, d in ran.items()}
    missed = {(r.control, r.day) for r in monitoring.missed_days(both, first, last).collect()}
    assert missed == {(c, d) for c, days in ran.items() for d in every if d not in days}
    working = {(r.control, r.day) for r in monitoring.missed_days(both, first, last, weekdays=True).collect()}
    assert working == {(c, d) for c, d in missed if d.weekday() < 5}
    assert monitoring.missed_days(both.limit(0), first, last).count() == 0


def test_the_number_of_documents_follows_the_records(spark, tmp_path, monkeypatch):
    """Ids that come in no order of time made a document per 200 ids and day; null times and keys stay, repeated rows too."""
    day = "case when id % 50 = 0 then null else timestamp'2024-01-01' + make_dt_interval(cast(id % 30 as int)) end"
    events = spark.range(6000).selectExpr("nullif(id % 3000, 7) event_id", f"{day} ts", "id % 7 user_id", "'view' event_type", "cast(id as double) value", "'' props")
    events.write.parquet(str(tmp_path / "events.parquet"))
    for records, most in ((20_000, 31), (100, 31 + 6000 // 100)):
        monkeypatch.setattr(run_queries, "RECORDS_PER_DOCUMENT", records)
        documents = run_queries._event_documents(spark, str(tmp_path))
        assert 31 <= documents.count() <= most
        ids = documents.select("day", F.explode(F.from_json("content", "records array<struct<event_id: long, user: string>>")["records"]).alias("r"))
        found = ids.select("day", "r.event_id", F.regexp_extract("r.user", r"(\d+)", 1).cast("long").alias("user_id"))
        wanted = events.select(F.col("ts").cast("date").alias("day"), "event_id", "user_id")
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
