import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import cli, config
from tidemark.plans import accuracy, sync
from tidemark.sources.guards import Hooks, Lock
from tidemark.sources.snapshots import Conflict, Snapshot
from tidemark.streaming.feed import merge_stream

SCHEMA = "id int, at timestamp_ntz, v string"


def at(day):
    return datetime(2026, 1, day)


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        source, target = str(tmp_path / "source"), str(tmp_path / "target")

        def put(self, rows, schema=SCHEMA, table="t"):
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{self.source}/{table}.parquet")

        def job(self, table, **settings):
            tables = [{"source_table": "t", "target_table": "t", **table}]
            return config.parse({"source": {"path": self.source}, "target": {"path": self.target}, "migration": {"retry_delay": 0, **settings, "tables": tables}})

        def run(self, table, **settings):
            return sync.run_job(spark, self.job(table, **settings), wait=lambda s: None).tables[0]

        def rows(self, table="t"):
            return sorted((tuple(r) for r in Snapshot(spark, self.target, table).read().collect()), key=str)

    return Place()


KEYED = {"load_type": "incremental", "incremental_column": "at", "business_key_columns": ["id"], "primary_key": ["id"]}


@pytest.mark.parametrize("size", [None, 2])
def test_incremental_by_key(place, size):
    place.put([(1, at(1), "a"), (2, at(2), "b"), (3, None, "never")])
    r = place.run(KEYED, batch_size=size)
    assert (r.status, r.stats.inserted, r.stats.unaccounted) == ("WAITING_FOR_NEXT_RUN", 2, 0), r.error
    place.put([(1, at(1), "a"), (2, at(4), "B"), (3, at(3), "c"), (4, at(4), "d"), (5, at(4), "e")])
    r = place.run(KEYED, batch_size=size)
    assert (r.stats.source_window, r.stats.updated, r.stats.inserted) == (4, 1, 3), r.error
    assert place.rows() == [(1, at(1), "a"), (2, at(4), "B"), (3, at(3), "c"), (4, at(4), "d"), (5, at(4), "e")]
    assert place.run(KEYED, batch_size=size).stats.processed == 0


def test_stale_rows_are_skipped_and_logged(place, spark):
    place.put([(1, at(5), "new")])
    place.run(KEYED)
    part = Snapshot(spark, place.target, "t")
    part.commit([part.write_part(spark.createDataFrame([(2, at(9), "newer")], SCHEMA))], part.checkpoint, append=True)
    place.put([(1, at(5), "new"), (2, at(6), "older")])
    r = place.run(KEYED)
    assert (r.stats.conflict_skipped, r.stats.unaccounted) == (1, 0), r.error
    assert (2, at(9), "newer") in place.rows()
    assert [x[1] for x in place.rows("migration_error_log")] == ["2"]


def test_bad_rows(place):
    table = KEYED | {"columns": {"v": {"nullable": False, "max_length": 3}}}
    place.put([(1, at(1), "a"), (2, at(1), None), (3, at(1), "toolong"), (4, at(2), "d")])
    r = place.run(table)
    assert (r.stats.inserted, r.stats.rejected, r.stats.unaccounted) == (2, 2, 0), r.error
    assert [x[1] for x in place.rows("migration_error_log")] == ["2", "3"]
    place.put([(9, at(9), None)])
    assert place.run(table, skip_bad_rows=False).status == "FAILED"


@pytest.mark.parametrize("size", [None, 1, 3])
def test_append_with_repeats(place, size):
    table = {"load_type": "incremental", "incremental_column": "at", "insert_only": True, "allow_duplicates": True}
    rows = [(1, at(1), "a"), (1, at(1), "a"), (2, at(2), "b"), (2, at(2), "c")]
    place.put(rows)
    r = place.run(table, batch_size=size)
    assert (r.status, r.stats.inserted) == ("WAITING_FOR_NEXT_RUN", 4), r.error
    place.put(rows + [(3, at(2), "late, same value"), (4, at(3), "d")])
    r = place.run(table, batch_size=size)
    assert r.stats.inserted == 2, r.error
    assert len(place.rows()) == 6


@pytest.mark.parametrize("size", [None, 2])
def test_full_load_completes_once(place, spark, size):
    table = {"load_type": "full", "business_key_columns": ["id"]}
    place.put([(k, at(1), "x") for k in (-5, 0, 7)])
    assert place.run(table, batch_size=size).status == "COMPLETED"
    assert len(place.rows()) == 3
    assert place.run(table, batch_size=size).status == "ALREADY_COMPLETED"
    job = place.job(table)
    assert sync.run_job(spark, job, force=True).tables[0].stats.updated == 3


@pytest.mark.parametrize("size", [None, 2])
def test_full_load_without_key(place, size):
    place.put([(1, at(1), "x")] * 3 + [(2, at(1), "y")])
    r = place.run({"load_type": "full"}, batch_size=size)
    assert (r.status, r.stats.inserted) == ("COMPLETED", 4), r.error


def test_copies_of_a_key_in_one_window(place):
    place.put([(1, at(1), "a"), (1, at(3), "c"), (1, at(2), "b")])
    r = place.run(KEYED | {"allow_incremental_without_target_unique_index": True})
    assert r.status == "SKIPPED" and "duplicates" in r.error


def test_crash_before_commit_changes_nothing(place, monkeypatch):
    place.put([(1, at(1), "a")])
    place.run(KEYED)
    before = place.rows()
    place.put([(1, at(1), "a"), (2, at(2), "b")])
    with monkeypatch.context() as m:
        m.setattr(Snapshot, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("crash")))
        assert place.run(KEYED).status == "FAILED"
    assert place.rows() == before
    assert place.run(KEYED).stats.inserted == 1


def test_empty_source(place):
    place.put([])
    assert place.run(KEYED).status == "NO_DATA"


def test_no_key_skips_the_table(place):
    place.put([(1, at(1), "a")])
    r = place.run({"load_type": "incremental", "incremental_column": "at"})
    assert r.status == "SKIPPED"


def test_partitions_of_a_load(place):
    table = KEYED | {"partition_column": "at", "partition_type": "range", "partition_granularity": "daily", "create_default_partition": True, "trigger_partition_targets": [{"target_table": "audit", "partition_type": "list", "partition_column": "kind", "source_column": "v"}]}
    place.put([(1, at(1), "a"), (2, at(1), "b"), (3, at(3), "a")])
    r = place.run(table)
    assert sorted(p[1] for p in r.partitions) == ["audit_a", "audit_b", "t_2026_01_01", "t_2026_01_03", "t_default"], r.error
    assert place.run(table).partitions == []


def test_lock(place, spark):
    place.put([(1, at(1), "a")])
    lock = Lock(spark, place.target, 5)
    assert lock.acquire() and not Lock(spark, place.target, 5).acquire()
    assert sync.run_job(spark, place.job(KEYED, advisory_lock_key=5)).exit_code == 3
    lock.release()
    assert sync.run_job(spark, place.job(KEYED, advisory_lock_key=5)).exit_code == 0


def test_hooks_survive_a_crash(place, spark):
    done = []
    h = Hooks(spark, place.target, lambda *x: done.append(x))
    h.disable("t", {"a": "O", "b": "D"})
    assert done == [("t", "a", "D")]
    again = Hooks(spark, place.target, lambda *x: done.append(x))
    assert again.recover() == ["t"] and done[1:] == [("t", "a", "O"), ("t", "b", "D")] and again.recorded() == {}


def test_two_writers_conflict(place, spark):
    place.put([(1, at(1), "a")])
    place.run(KEYED)
    a, b = Snapshot(spark, place.target, "t"), Snapshot(spark, place.target, "t")
    a.commit([], a.checkpoint, append=True)
    with pytest.raises(Conflict):
        b.commit([], b.checkpoint, append=True)


def test_accuracy(place, spark):
    place.put([(1, at(1), "a"), (2, at(2), "b")])
    place.run(KEYED)
    tables, buckets = accuracy.check_job(spark, place.job(KEYED), bucket=True)
    assert tables.first()["status"] == "MATCH" and {r["status"] for r in buckets.collect()} == {"MATCH"}
    place.put([(1, at(1), "a"), (2, at(2), "changed")])
    tables, buckets = accuracy.check_job(spark, place.job(KEYED), bucket=True)
    assert tables.first()["status"] == "CONTENT_MISMATCH"
    assert {r["bucket_value"]: r["status"] for r in buckets.collect()} == {"2026-01-01": "MATCH", "2026-01-02": "CONTENT_MISMATCH"}
    broken = place.job(KEYED | {"source_table": "missing"})
    assert accuracy.check_job(spark, broken)[0].first()["status"] == "VALIDATION_FAILED"


def test_stream(place, spark, tmp_path):
    place.put([(1, at(1), "a"), (1, at(3), "c"), (1, at(2), "b"), (2, at(1), "x")])
    stream = spark.readStream.schema(SCHEMA).parquet(f"{place.source}/t.parquet")
    merge_stream(stream, place.target, "t", ["id"], "at", str(tmp_path / "cp")).awaitTermination()
    assert place.rows() == [(1, at(3), "c"), (2, at(1), "x")]


def test_config(tmp_path):
    for raw in ({}, {"source": {}, "target": {}, "migration": {}}, {"source": {}, "target": {}, "migration": {"migration": {}, "tables": [{}]}}, {"source": {}, "target": {}, "migration": {"tables": [{}]}}):
        with pytest.raises(config.ConfigError):
            config.parse(raw)
    ok = {"source": {}, "target": {}, "migration": {"tables": [{"source_table": "a", "target_table": "b", "load_type": "FULL"}, {"source_table": "a", "target_table": "b", "enabled": False}]}}
    job = config.parse(ok)
    assert [job.load_type(t) for t in job.tables] == ["full", "skip"]
    ok["migration"]["max_retries"] = 0
    with pytest.raises(config.ConfigError):
        config.parse(ok)
    ok["migration"]["max_retries"] = 1
    (tmp_path / "j.json").write_text(json.dumps(ok))
    assert config.load(tmp_path / "j.json") == job
    assert cli.arguments(["check", "--config", "x", "--bucket"]).bucket


def test_jdbc_round_trip(spark):
    from tidemark.sources.readers import read_table, write_jdbc

    where = {"format": "jdbc", "url": "jdbc:derby:memory:tidemark;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(20).select(F.col("id").cast("int").alias("ID"), (F.col("id") * 2).alias("V"))
    write_jdbc(df, where, "T1", "overwrite")
    back = read_table(spark, where | {"partition": {"T1": {"column": "ID", "lower": 0, "upper": 20, "number": 3}}}, "T1")
    assert back.rdd.getNumPartitions() == 3 and back.where("ID > 14").count() == 5
