"""Incremental tables and type-2 history."""

import shutil
import threading
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.incremental import DayTable, since
from sparkmart.operators.scd2 import History, as_of, changed_only, in_order, recorded_and_source
from sparkmart.sources.catalog import publish, use_schema, versions
from sparkmart.sources.files import Files

D = date(2024, 1, 10)


def day(n):
    return D + timedelta(days=n)


def frame(spark, rows, schema="id string, d date, v int"):
    return spark.createDataFrame(rows, schema)


def load(table, df, lookback=2, **kw):
    return table.load(lambda first: df.where(since(F.col("d"), first)), lookback, **kw)


def content(table, columns=("id", "d", "v")):
    return sorted(map(tuple, table.read().select(*columns).collect()), key=str)


@pytest.fixture(params=["days", "keys"])
def table(request, spark, tmp_path):
    keys = ["id", "d"] if request.param == "keys" else None
    return DayTable(spark, f"file://{tmp_path}/t", "d", keys)


def test_late_rows_inside_the_lookback_replace_older_ones(spark, table):
    load(table, frame(spark, [("a", day(0), 1), ("a", day(3), 1), ("a", day(5), 1)]))
    changed = [("a", day(0), 2), ("a", day(3), 2), ("a", day(5), 2), ("a", day(6), 2)]
    assert load(table, frame(spark, changed)) == day(3)
    assert content(table) == [("a", day(0), 1), ("a", day(3), 2), ("a", day(5), 2), ("a", day(6), 2)]


def test_row_gone_from_the_source(spark, table):
    load(table, frame(spark, [("a", day(5), 1), ("b", day(5), 1), (None, day(5), 1)]))
    load(table, frame(spark, [("a", day(5), 2)]))
    kept = [("a", day(5), 2)]
    if table.keys:  # delete and insert only touches keys in the batch
        kept += [("b", day(5), 1), (None, day(5), 1)]
    assert content(table) == sorted(kept, key=str)


def test_full_refresh_drops_everything_else(spark, table):
    load(table, frame(spark, [("a", day(0), 1), ("a", day(5), 1)]))
    load(table, frame(spark, [("z", day(1), 9)]), full_refresh=True)
    assert content(table) == [("z", day(1), 9)]


def test_new_column_is_appended(spark, table):
    load(table, frame(spark, [("a", day(0), 1), ("b", day(5), 1)]))
    load(table, frame(spark, [("c", day(6), 2, "x")], "id string, d date, v int, extra string"))
    load(table, frame(spark, [("d", day(7), 3)]))  # and may be missing again
    got = content(table, ("id", "v", "extra"))
    assert got == [("a", 1, None), ("b", 1, None), ("c", 2, "x"), ("d", 3, None)]


def test_changed_type_is_refused(spark, table):
    load(table, frame(spark, [("a", day(0), 1)]))
    with pytest.raises(ValueError, match="column v changed"):
        load(table, frame(spark, [("a", day(0), "x")], "id string, d date, v string"))
    assert content(table) == [("a", day(0), 1)]


@pytest.mark.parametrize("cuts", [(3, 6, 9), (1, 2, 3, 4, 5, 6, 7, 8, 9), (9,)])
def test_any_split_inside_the_lookback_equals_a_full_load(spark, tmp_path, cuts):
    data = [(f"r{i % 4}", day(i), i) for i in range(10)] * 2
    split = DayTable(spark, f"file://{tmp_path}/split", "d")
    for cut in cuts:
        load(split, frame(spark, [r for r in data if r[1] <= day(cut)]), lookback=3)
    full = DayTable(spark, f"file://{tmp_path}/full", "d")
    load(full, frame(spark, data))
    assert content(split) == content(full)


T0, T1, T2 = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)
RUN1, RUN2, RUN3 = (t + timedelta(hours=1) for t in (T0, T1, T2))
SCHEMA = "id bigint, name string, status string, budget int, updated_time timestamp"


def campaigns(**changes):
    base = {
        "A": (1, "A", "ACTIVE", 660, T0),
        "B": (2, "B", "ACTIVE", 100, T0),
        "C": (3, "C", "ACTIVE", 400, T0),
        "E": (5, "E", "ACTIVE", 50, T0),
        "U": (6, "U", "ACTIVE", 10, T0),
    }
    return [r for r in (base | changes).values() if r]


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    h = History(spark, f"file://{tmp_path_factory.mktemp('scd2')}/h", "id", "updated_time")
    round1 = {
        "A": (1, "A", "ACTIVE", 900, T1),
        "B": (2, "B", "PAUSED", 100, T1),
        "C": (3, "C", "ACTIVE", 450, T0),  # edited without a new time
        "D": (4, "D", "ACTIVE", 70, T1),
        "E": None,
    }
    round2 = round1 | {
        "A": (1, "A", "ACTIVE", 660, T2),
        "D": (4, "D", "ACTIVE", 750, T2),
        "E": (5, "E", "ACTIVE", 50, T2),
    }
    for rows, run in ((campaigns(), RUN1), (campaigns(**round1), RUN2), (campaigns(**round2), RUN3)):
        h.snapshot(spark.createDataFrame(rows, SCHEMA), run)
    h.source = spark.createDataFrame(campaigns(**round2), SCHEMA)
    return h


def versions_of(history, name):
    rows = history.versions().where(F.col("name") == name).orderBy("dbt_valid_from").collect()
    return [(r.budget, r.status, r.dbt_valid_from, r.dbt_valid_to, r.dbt_is_deleted) for r in rows]


def test_scd2_scenario(history):
    assert versions_of(history, "A") == [
        (660, "ACTIVE", T0, T1, "False"),
        (900, "ACTIVE", T1, T2, "False"),
        (660, "ACTIVE", T2, None, "False"),
    ]
    assert versions_of(history, "B") == [
        (100, "ACTIVE", T0, T1, "False"),
        (100, "PAUSED", T1, None, "False"),
    ]
    assert versions_of(history, "C") == [(400, "ACTIVE", T0, None, "False")]
    assert versions_of(history, "D") == [
        (70, "ACTIVE", T1, T2, "False"),
        (750, "ACTIVE", T2, None, "False"),
    ]
    assert versions_of(history, "E") == [
        (50, "ACTIVE", T0, RUN2, "False"),
        (50, "ACTIVE", RUN2, T2, "True"),
        (50, "ACTIVE", T2, None, "False"),
    ]
    assert versions_of(history, "U") == [(10, "ACTIVE", T0, None, "False")]


def test_scd2_reads(history):
    versions = history.versions()
    assert versions.select("dbt_scd_id").distinct().count() == versions.count() == 12
    names = lambda df: sorted(r.name for r in df.select("name").distinct().collect())
    assert names(changed_only(versions, "id")) == ["A", "B", "D", "E"]
    between = as_of(versions, datetime(2026, 2, 15))
    assert sorted((r.name, r.budget) for r in between.collect()) == [
        ("A", 900), ("B", 100), ("C", 400), ("D", 70), ("U", 10),
    ]
    both = recorded_and_source(versions, history.source, ["name", "budget"])
    assert sorted(map(tuple, both.where("name = 'C'").collect())) == [
        ("history", "C", 400), ("source", "C", 450),
    ]


def test_unchanged_source_adds_nothing_and_a_failed_run_is_invisible(spark, tmp_path):
    h = History(spark, f"file://{tmp_path}/h", "id", "updated_time")
    source = spark.createDataFrame(campaigns(), SCHEMA)
    h.snapshot(source, RUN1)
    h.snapshot(source, RUN2)
    assert h.versions().count() == 5 and h.runs() == [1, 2]
    (tmp_path / "h" / "run=2" / "_SUCCESS").unlink()
    assert h.runs() == [1] and h.versions().count() == 5


def test_new_source_column_joins_the_history(spark, tmp_path):
    h = History(spark, f"file://{tmp_path}/h", "id", "updated_time")
    h.snapshot(spark.createDataFrame(campaigns(), SCHEMA), RUN1)
    wider = spark.createDataFrame(campaigns(A=(1, "A", "ACTIVE", 900, T1)), SCHEMA)
    h.snapshot(wider.withColumn("goal", F.lit("x")), RUN2)
    got = {(r.name, r.budget): r.goal for r in h.versions().collect()}
    assert got[("A", 660)] is None and got[("A", 900)] == "x"


@pytest.mark.parametrize("key", [1, None])
def test_repeated_and_null_keys_stop_the_run(spark, tmp_path, key):
    h = History(spark, f"file://{tmp_path}/h", "id", "updated_time")
    bad = campaigns(X=(key, "X", "ACTIVE", 1, T0))
    with pytest.raises(Exception, match="history needs one row per id"):
        h.snapshot(spark.createDataFrame(bad, SCHEMA), RUN1)
    assert h.runs() == [] and h.versions().count() == 0
    h.snapshot(spark.createDataFrame(campaigns(), SCHEMA), RUN1)
    with pytest.raises(Exception, match="history needs one row per id"):
        h.snapshot(spark.createDataFrame(bad, SCHEMA), RUN2)
    for run in (RUN2, RUN2, RUN3):
        h.snapshot(spark.createDataFrame(campaigns(), SCHEMA), run)
    assert h.versions().count() == 5


def test_times_do_not_depend_on_the_system_zone(spark, tmp_path, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        h = History(spark, f"file://{tmp_path}/h", "id", "updated_time")
        source = spark.sql("SELECT 1L AS id, timestamp'2026-01-01 00:00:00' AS updated_time")
        h.snapshot(source, T1)
        h.snapshot(source.where("false"), T2)
        stamps = h.versions().selectExpr("cast(dbt_valid_from AS string) AS f", "cast(dbt_valid_to AS string) AS t")
        assert sorted((r.f, r.t or "") for r in stamps.collect()) == [
            ("2026-01-01 00:00:00", "2026-03-01 00:00:00"), ("2026-03-01 00:00:00", ""),
        ]
        assert as_of(h.versions(), T2 - timedelta(hours=1)).count() == 1
        assert as_of(h.versions(), T2 + timedelta(hours=1)).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_versions_in_order(history):
    rows = in_order(history.versions(), "name").select("name", "dbt_valid_from").collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows)


class Crash(Exception):
    pass


def crash_after(monkeypatch, step, folder, lost):
    """Let the driver be lost after so many writes. A lost overwrite leaves some of its days missing
    and the others in place, as a commit does that moves one folder after the other."""
    left = [step]

    def broken(owner, name):
        call = getattr(owner, name)

        def run(self, *args):
            result = call(self, *args)
            left[0] -= 1
            if left[0] == 0:
                if name == "_write":
                    for day_left in lost:
                        shutil.rmtree(folder / f"d={day_left}", ignore_errors=True)
                raise Crash
            return result

        monkeypatch.setattr(owner, name, run)

    for owner, name in ((Files, "write_text"), (DayTable, "_written"), (DayTable, "_write")):
        broken(owner, name)


@pytest.mark.parametrize("lost", [[], [day(5)], [day(4), day(5), day(6), day(7)]])
@pytest.mark.parametrize("step", range(1, 6))
@pytest.mark.parametrize("refresh", [False, True])
def test_a_lost_driver_costs_nothing(spark, table, tmp_path, monkeypatch, step, refresh, lost):
    """The next load finds the source as it is then, some days later."""
    old = [("a", day(0), 1), ("a", day(4), 1), ("a", day(5), 1), ("x", day(5), 1), (None, day(4), 1)]
    new = [("a", day(n), 2) for n in range(4, 15)]  # x and the row without id are gone
    load(table, frame(spark, old))
    with monkeypatch.context() as m:
        crash_after(m, step, tmp_path / "t", lost)
        try:
            load(table, frame(spark, new), full_refresh=refresh)
        except Crash:
            pass
    later = [*new, ("a", day(15), 3)]
    load(table, frame(spark, later), full_refresh=refresh)
    kept = [] if refresh else [("a", day(0), 1)]
    if table.keys and not refresh:
        kept += [("x", day(5), 1), (None, day(4), 1)]
    got = content(table)
    if not refresh:  # the first day of a refresh that was lost is made from the source, which has lost it
        assert got == sorted(later + kept, key=str)
    assert set(later) <= set(got)
    assert load(table, frame(spark, later)) == day(13)


def test_only_spark_changes_the_table(spark, table, tmp_path):
    load(table, frame(spark, [("a", day(0), 1), ("a", day(5), 1)]))
    untouched = sorted((tmp_path / "t" / f"d={day(0)}").iterdir())
    load(table, frame(spark, [("a", day(5), 2)]))
    assert sorted((tmp_path / "t" / f"d={day(0)}").iterdir()) == untouched
    assert not hasattr(Files, "swap") and content(table) == [("a", day(0), 1), ("a", day(5), 2)]


def test_keys_without_the_day_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="must hold the day"):
        DayTable(spark, f"file://{tmp_path}/t", "d", ["id"])


@pytest.fixture
def schema(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    use_schema(spark, name, f"file://{tmp_path}/it's here")
    return name


def test_a_published_table_is_replaced_as_a_whole(spark, schema, tmp_path):
    other = spark.newSession()
    shown = lambda: sorted(r[0] for r in other.sql(f"SELECT id FROM {schema}.mart").collect())
    assert publish(spark.range(3), schema, "mart").count() == 3 and shown() == [0, 1, 2]
    started = other.table(f"{schema}.mart")  # a query that is already planned
    with pytest.raises(Exception, match="broken"):
        publish(spark.range(5).selectExpr("id", "raise_error('broken') AS x"), schema, "mart")
    assert shown() == [0, 1, 2]
    publish(spark.range(4).selectExpr("id + 10 AS id", "'more' AS text"), schema, "mart")
    assert shown() == [10, 11, 12, 13] and other.table(f"{schema}.mart").columns == ["id", "text"]
    assert started.count() == 3
    for n in range(10):  # versions 9 and 10 differ in their number of digits
        publish(spark.range(n), schema, "mart")
    assert shown() == list(range(9))
    assert len(versions(spark, schema, "mart")) == len(list((tmp_path / "it's here").glob("mart__v*/_SUCCESS"))) == 2
    publish(spark.range(1), schema, "mart_2")
    assert len(versions(spark, schema, "mart")) == 2 and shown() == list(range(9))


def test_readers_see_old_or_new_rows_during_refreshes(spark, schema):
    publish(spark.range(50), schema, "t")
    other, seen, done = spark.newSession(), [], threading.Event()

    def reader():
        while not done.is_set():
            seen.append(tuple(other.sql(f"SELECT count(*), min(id) FROM {schema}.t").first()))

    thread = threading.Thread(target=reader)
    thread.start()
    for n in range(1, 6):
        publish(spark.range(100 * n, 100 * n + 50), schema, "t")
    done.set()
    thread.join()
    assert seen and set(seen) <= {(50, 100 * n) for n in range(6)}


def test_a_publish_that_was_lost_is_not_in_the_way(spark, schema, tmp_path, monkeypatch):
    publish(spark.range(2), schema, "t")
    lost = spark.range(9).write.format("parquet")
    lost.saveAsTable(f"`{schema}`.`t__v2_lost`")  # written, but the view wasn't replaced
    assert spark.table(f"{schema}.t").count() == 2
    publish(spark.range(5), schema, "t")
    assert spark.table(f"{schema}.t").count() == 5 and len(versions(spark, schema, "t")) == 2


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_a_run_writes_only_what_changed(spark, tmp_path):
    h = History(spark, f"file://{tmp_path}/h", "id", "updated_time")
    source = spark.range(1000).selectExpr("id", "cast('2026-01-01' AS timestamp) AS updated_time", "0 AS v")
    h.snapshot(source, RUN1)
    for run in range(1, 10):
        moved = (F.col("id") == run) | (F.col("id") == 0)
        at = F.lit(T1 + timedelta(days=run))
        source = source.withColumn("updated_time", F.when(moved, at).otherwise(F.col("updated_time"))).checkpoint()
        h.snapshot(source, RUN2 + timedelta(days=run))
    stored = [spark.read.parquet(f"{tmp_path}/h/run={r}") for r in range(1, 11)]
    assert [df.count() for df in stored] == [1000] + [4] * 9
    assert all(df.where("_is_open").count() == 2 for df in stored[1:])
    h.snapshot(source, RUN3)  # nothing moved
    assert spark.read.parquet(f"{tmp_path}/h/run=11").count() == 0
    versions = h.versions()
    assert versions.count() == 1000 + 18 and versions.where("dbt_valid_to IS NULL").count() == 1000
    assert as_of(versions, T1 + timedelta(days=3, hours=1)).where("id IN (0, 3)").selectExpr("date_format(updated_time, 'd')").distinct().collect()[0][0] == "4"


@pytest.mark.parametrize("drop", [True, False])
def test_compacted_history_is_the_same(spark, tmp_path, drop):
    plain, compacted = (History(spark, f"file://{tmp_path}/{n}", "id", "updated_time") for n in ("p", "c"))
    states = [
        campaigns(),
        campaigns(A=(1, "A", "ACTIVE", 900, T1), E=None),
        campaigns(A=(1, "A", "ACTIVE", 900, T1), E=None),
        campaigns(A=(1, "A", "ACTIVE", 1, T2), E=(5, "E", "ACTIVE", 50, T0), B=None),
    ]
    for i, rows in enumerate(states):
        df = spark.createDataFrame(rows, SCHEMA)
        if i == 3:
            df = df.withColumn("goal", F.lit("x"))
        for h in (plain, compacted):
            h.snapshot(df, RUN2 + timedelta(days=i))
        assert compacted.compact(after_runs=2) == (i in (1, 3)) and not compacted.compact(after_runs=2)
        if drop:
            compacted.drop_superseded()
        shown = [sorted(map(str, h.versions().collect())) for h in (plain, compacted)]
        assert shown[0] == shown[1]
        moment = RUN2 + timedelta(days=i, hours=-1)
        assert as_of(plain.versions(), moment).count() == as_of(compacted.versions(), moment).count()
    want = ["closed=0-2", "closed=2-4", "open=4"]
    assert folders(tmp_path / "c") == (want if drop else sorted([*want, "open=2", *[f"run={r}" for r in range(1, 5)]]))


def test_a_compaction_that_broke_off_is_invisible(spark, tmp_path):
    h = History(spark, f"file://{tmp_path}/h", "id", "updated_time")
    h.snapshot(spark.createDataFrame(campaigns(), SCHEMA), RUN1)
    h.snapshot(spark.createDataFrame(campaigns(A=(1, "A", "ACTIVE", 900, T1)), SCHEMA), RUN2)
    before = sorted(map(str, h.versions().collect()))
    h.compact(after_runs=1)
    (tmp_path / "h" / "open=2" / "_SUCCESS").unlink()
    h.drop_superseded()
    assert h.runs() == [1, 2] and sorted(map(str, h.versions().collect())) == before
    h.snapshot(spark.createDataFrame(campaigns(A=(1, "A", "ACTIVE", 900, T1), U=None), SCHEMA), RUN3)
    before = sorted(map(str, h.versions().collect()))
    assert h.compact(after_runs=1)  # closed=0-2 stays behind and doesn't count
    h.drop_superseded()
    assert h.runs() == [] and sorted(map(str, h.versions().collect())) == before
    h.snapshot(spark.createDataFrame(campaigns(), SCHEMA), RUN3 + timedelta(days=9))
    assert h.runs() == [4] and h.versions().where("name = 'U' AND dbt_valid_to IS NULL").count() == 1


def test_a_first_load_writes_its_rows_once(spark, table, monkeypatch):
    written = []
    call = DayTable._written
    monkeypatch.setattr(DayTable, "_written", lambda self, rows, folder: written.append(folder) or call(self, rows, folder))
    load(table, frame(spark, [("a", day(0), 1), ("a", day(5), 1), (None, None, 2)]))
    assert written == [] and content(table) == [("a", day(0), 1), ("a", day(5), 1), (None, None, 2)]
    # a refresh drops the old rows, so its own are made before that
    table.load(lambda first: table.read().where("v = 1"), 2, full_refresh=True)
    assert len(written) == 1 and content(table) == [("a", day(0), 1), ("a", day(5), 1)]


def test_a_first_load_that_failed_is_a_first_load_again(spark, table):
    with pytest.raises(Exception, match="broken"):
        load(table, frame(spark, [("a", day(0), 1)]).withColumn("v", F.expr("cast(raise_error('broken') AS int)")))
    assert load(table, frame(spark, [("b", day(1), 2)])) is None and content(table) == [("b", day(1), 2)]
