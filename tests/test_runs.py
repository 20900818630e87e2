"""Whole runs: paging, time zones, files that a merge touches, children, keys, locks, sequences."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_sync import KEYED, SCHEMA, at, place  # noqa: F401

from tidemark.functions import values
from tidemark.functions.names import Sequence
from tidemark.plans import sync
from tidemark.sources.guards import Hooks, Lock
from tidemark.sources.snapshots import Conflict, Snapshot

INSTANTS = "id int, at timestamp, v string"
MODES = {
    "keyed": KEYED,
    "append": {"load_type": "incremental", "incremental_column": "at", "insert_only": True, "allow_duplicates": True},
    "full": {"load_type": "full", "business_key_columns": ["at", "id"]},
}


@pytest.mark.parametrize("size", [None, 2])
def test_lookback_ends_and_changes_nothing(place, size):  # noqa: F811
    table = KEYED | {"lookback_minutes": 3 * 24 * 60}
    place.put([(k, at(k), "a") for k in range(1, 6)])
    assert place.run(table, batch_size=size).stats.inserted == 5
    rows = place.rows()
    for _ in range(2):
        r = place.run(table, batch_size=size)
        assert (r.status, r.stats.processed, r.stats.updated) == ("WAITING_FOR_NEXT_RUN", 4, 4), r.error
        assert place.rows() == rows
    place.put([(k, at(k), "a" if k != 4 else "late") for k in range(1, 7)])
    r = place.run(table, batch_size=size)
    assert (r.stats.processed, r.stats.inserted) == (5, 1)
    assert (4, at(4), "late") in place.rows() and len(place.rows()) == 6


@pytest.mark.parametrize("zone, size", [("UTC", None), ("Asia/Kolkata", None), ("America/Los_Angeles", 4)])
@pytest.mark.parametrize("mode", sorted(MODES))
def test_instants_in_any_zone(place, spark, mode, zone, size):  # noqa: F811
    # An hour that the clocks of one zone pass twice is among them.
    moments = [1_793_520_000 + 1800 * k for k in range(6)]
    df = spark.createDataFrame([(k, m) for k, m in enumerate(moments)], "id int, s long").select("id", F.timestamp_seconds("s").alias("at"), F.lit("x").alias("v"))
    df.write.mode("overwrite").parquet(f"{place.source}/t.parquet")
    for run in range(3):
        r = place.run(MODES[mode], batch_size=size, timezone=zone)
        assert r.status in ("WAITING_FOR_NEXT_RUN", "COMPLETED", "ALREADY_COMPLETED"), r.error
        got = Snapshot(spark, place.target, "t").read().select("id", F.unix_seconds("at").alias("s")).collect()
        assert sorted((x["id"], x["s"]) for x in got) == list(enumerate(moments))
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_merge_leaves_other_files_alone(place, spark):  # noqa: F811
    for day in (1, 2, 3):
        place.put([(10 * d + k, at(d), "a") for d in range(1, day + 1) for k in range(5)])
        assert place.run(KEYED).stats.inserted == 5
    before = Snapshot(spark, place.target, "t").manifest["parts"]
    place.put([(10 * d + k, at(d), "a") for d in range(1, 4) for k in range(5)] + [(11, at(9), "moved"), (99, at(9), "new")])
    table = KEYED | {"source_primary_key": ["id"]}
    r = place.run(table)
    assert (r.stats.updated, r.stats.inserted) == (1, 1), r.error
    after = Snapshot(spark, place.target, "t").manifest["parts"]
    touched = [p for p in before if p not in after]
    assert 0 < len(touched) < len(before)
    assert len(place.rows()) == 16 and (11, at(9), "moved") in place.rows()


def test_rows_go_to_their_children(place, spark):  # noqa: F811
    table = {**KEYED, "partition_column": "v", "partition_type": "list"}
    place.put([(1, at(1), "a b"), (2, at(2), "c"), (3, at(2), None)])
    assert place.run(table).stats.inserted == 3
    place.put([(1, at(3), "c"), (2, at(2), "c")])
    assert place.run(table).stats.updated == 1
    t = Snapshot(spark, place.target, "t")
    held = {name: sorted(r["id"] for r in t.read_child(name).collect()) for name in t.children()}
    assert {k: v for k, v in held.items() if v} == {"t_c": [1, 2], "t_default": [3]}
    assert place.rows()[0][0] == 1 and len(place.rows()) == 3


def test_every_unique_key_counts(place):  # noqa: F811
    place.put([(1, at(1), "a"), (2, at(1), "b")])
    table = KEYED | {"unique": {"u": ["v"]}}
    assert place.run(table).stats.inserted == 2
    place.put([(1, at(1), "a"), (2, at(1), "b"), (3, at(2), "a"), (4, at(2), "new"), (5, at(2), "new"), (2, at(3), "b2"), (6, at(2), None), (7, at(2), None)])
    r = place.run(table | {"source_primary_key": ["id"]})
    assert (r.stats.inserted, r.stats.updated, r.stats.conflict_skipped, r.stats.unaccounted) == (3, 1, 2, 0), r.error
    assert sorted((x[0], x[2]) for x in place.rows() if x[2]) == [(1, "a"), (2, "b2"), (4, "new")]
    assert sorted(x[1] for x in place.rows("migration_error_log")) == ["3", "5"]


def test_second_unique_key_of_an_append(place):  # noqa: F811
    table = {"load_type": "full", "insert_only": True, "unique": {"a": ["id"], "b": ["v"]}}
    place.put([(1, at(1), "a"), (2, at(1), "a"), (3, at(1), None), (4, at(1), None), (1, at(2), "c")])
    r = place.run(table)
    assert (r.stats.inserted, r.stats.conflict_skipped) == (3, 2), r.error


def test_checks_and_references(place):  # noqa: F811
    place.put([(1, at(1), "a"), (2, at(1), "b")])
    place.run(KEYED | {"target_table": "kinds", "business_key_columns": ["id"]})
    place.put([(1, at(1), "a"), (2, at(1), "b"), (3, at(1), "a"), (-1, at(1), "a"), (4, at(1), None)])
    table = KEYED | {"checks": [{"message": "id is negative", "condition": "id >= 0"}], "references": [{"columns": ["id"], "table": "kinds"}]}
    r = place.run(table)
    assert (r.stats.inserted, r.stats.rejected) == (2, 3), r.error
    assert sorted(x[2] for x in place.rows("migration_error_log")) == ["id has no row in kinds", "id has no row in kinds", "id is negative; id has no row in kinds"]


def test_lapsed_lock_is_taken_over(place, spark):  # noqa: F811
    dead = Lock(spark, place.target, 7, lease=0.5)
    assert dead.acquire()
    dead._ended.set()  # as if its process had ended
    assert not Lock(spark, place.target, 7).acquire()
    time.sleep(0.7)
    a, b = Lock(spark, place.target, 7), Lock(spark, place.target, 7)
    assert a.acquire() and not b.acquire()
    dead.release()
    assert not b.acquire()
    a.release()
    assert b.acquire()
    b.release()


def test_live_lock_is_renewed(place, spark):  # noqa: F811
    lock = Lock(spark, place.target, 8, lease=0.6)
    assert lock.acquire()
    time.sleep(1.5)
    assert not Lock(spark, place.target, 8).acquire()
    lock.release()


def test_commits_are_exclusive_and_found(place, spark):  # noqa: F811
    schema = spark.createDataFrame([], SCHEMA).schema
    a, b = Snapshot(spark, place.target, "x", schema), Snapshot(spark, place.target, "x", schema)
    part = a.write_part(spark.createDataFrame([(1, at(1), "a")], SCHEMA))
    a.commit([part], {"n": 1})
    with pytest.raises(Conflict):
        b.commit([], {"n": 2})
    a.files.delete(f"{a.path}/manifest.json")  # a writer stopped before the copy
    assert Snapshot(spark, place.target, "x").checkpoint == {"n": 1}


def test_vacuum_keeps_what_is_in_use(place, spark):  # noqa: F811
    for day in (1, 2, 3):
        place.put([(1, at(day), f"v{day}"), (day + 1, at(day), "x")])
        place.run(KEYED)
    t = Snapshot(spark, place.target, "t")
    rows = place.rows()
    assert t.vacuum(keep_hours=1) == []
    assert any(f.endswith(".parquet") for f in t.vacuum(keep_hours=-1))
    assert place.rows() == rows
    held = [f for f, _ in t.files.walk(t.path) if f.endswith(".parquet")]
    assert set(held) == set(Snapshot(spark, place.target, "t").without([])) or len(held) >= 1


@pytest.mark.parametrize("declared, want", [({}, (3, True)), ({"last_value": 50, "is_called": True}, (50, True)), ({"increment": -1, "last_value": -1}, (1, True))])
def test_sequences_are_kept(place, spark, declared, want):  # noqa: F811
    place.put([(1, at(1), "a"), (3, at(1), "b")])
    table = KEYED | {"sequence_column": "id", "sequence": declared}
    r = place.run(table)
    store = sync.Sequences(Snapshot(spark, place.target, "t").files, place.target)
    kept = store.all()["t.id"]
    if declared.get("increment", 1) > 0:
        assert (kept["last_value"], kept["is_called"]) == want and r.sequence.next_value == want[0] + 1
    else:
        assert r.sequence.next_value == -1  # below the smallest value, and never back up
    place.put([(1, at(1), "a"), (3, at(1), "b"), (60, at(2), "c")])
    again = place.run(table).sequence
    assert again == (Sequence(61) if declared.get("increment", 1) > 0 else r.sequence)


def test_hooks_that_stay_off_are_told(place, spark):  # noqa: F811
    place.put([(1, at(1), "a")])
    states = {"a": "O", "b": "D"}
    hooks = Hooks(spark, place.target, lambda t, h, s: states.update({h: s}) if s == "D" else None)
    job = place.job(KEYED, disable_triggers_globally=True)
    r = sync.run_job(spark, job, hooks, lambda t: dict(states), wait=lambda s: None).tables[0]
    assert r.warnings[-1] == "hooks are still off: a"


def test_checkpoint_texts(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(datetime(2026, 1, 2, 3, 4, 5, 6), bytearray(b"\x00\xff"), "us:1", "")], "t timestamp, b binary, s string, e string")
    row = df.select(*(values.stored(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns)).first()
    back = df.where(" and ".join(f"{c} = {c}" for c in df.columns))
    for c in df.columns:
        back = back.where(F.col(c) == values.recalled(row[c], df.schema[c].dataType))
    assert back.count() == 1 and row["t"].startswith("us:")
    assert values.recalled(None, T.StringType()) is None


def test_array_texts(spark):
    good = {"{1,2,NULL}": [1, 2, None], "[1, None, 3]": [1, None, 3], "(4,)": [4], "5": [5], '{"1", "2"}': [1, 2], "{}": [], " ": None, None: None}
    bad = ["{1,x}", "[1, 'x']", "nonsense here", "{1,,2}", '{"1}', "{{1},{2}}"]
    df = spark.createDataFrame([(k,) for k in [*good, *bad]], "v string")
    got = {r["v"]: (r["x"]["items"], r["x"]["error"]) for r in df.select("v", values.array_checked(F.col("v"), spark.createDataFrame([], "a int").schema["a"].dataType).alias("x")).collect()}
    assert {k: got[k] for k in good} == {k: (v, None) for k, v in good.items()}
    assert all(got[k][0] is None and got[k][1] for k in bad)
    assert values.array_items('{"a\\"b", c d ,NULL,"NULL"}') == ['a"b', "c d", None, "NULL"]


def test_arrays_are_loaded_from_texts(place, spark):  # noqa: F811
    place.put([(1, at(1), "[1, 2]"), (2, at(1), "{3}"), (3, at(1), "oops"), (4, at(1), None)])
    target = Snapshot(spark, place.target, "t", spark.createDataFrame([], "id int, at timestamp_ntz, v array<int>").schema)
    target.commit([], None)
    r = place.run(KEYED | {"source_columns": {"v": {"type": "array<int>"}}})
    assert (r.stats.inserted, r.stats.rejected) == (3, 1), r.error
    assert {x[0]: x[2] for x in place.rows()} == {1: [1, 2], 2: [3], 4: None}


def test_nested_values_in_logs(spark):
    from decimal import Decimal

    df = spark.createDataFrame([([Decimal("1.50")], {"k": bytearray(b"ab")}, (timedelta(days=1), datetime(2026, 1, 2)))], "a array<decimal(10,2)>, m map<string,binary>, s struct<d:interval day to second,t:timestamp_ntz>")
    assert df.select(values.row_json(df.schema)).first()[0] == '{"a":["1.50"],"m":{"k":"YWI="},"s":{"d":"INTERVAL \'1 00:00:00\' DAY TO SECOND","t":"2026-01-02T00:00:00"}}'


def test_statements_on_a_database(spark):
    from tidemark.sources.readers import Statements, jdbc_options, switch_statement

    where = {"url": "jdbc:derby:memory:hooks;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    db = Statements(spark, where)
    db.run("CREATE TABLE S (NAME VARCHAR(9), STATE CHAR(1))")
    db.run("INSERT INTO S VALUES ('a', 'O')")
    assert db.rows("SELECT NAME, STATE FROM S", 2) == [("a", "O")]
    db.close()
    assert switch_statement("p", 't"x', "h", "A") == 'ALTER TABLE "p"."t""x" ENABLE ALWAYS TRIGGER "h"'
    options = jdbc_options({"url": "jdbc:postgresql://h/d"}, "t", reading=True)
    assert (options["loginTimeout"], options["ApplicationName"]) == ("10", "tidemark")


def test_accuracy_tells_columns_of_one_side(place, spark):  # noqa: F811
    import json

    from tidemark.plans import accuracy

    place.put([(1, at(1), "a")])
    table = KEYED | {"columns": {"w": {"spark_type": "int"}}}
    place.run(table)
    place.put([(1, at(1), "a", 5)], SCHEMA + ", x int")
    row = accuracy.check_job(spark, place.job(table, timezone="Asia/Kolkata"))[0].first()
    assert row["status"] == "MATCH" and json.loads(row["details"]) == {"missing_in_target_schema": ["x"], "missing_in_source_schema": ["w"]}
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
