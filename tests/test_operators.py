from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import columns, compare, cursors, merge, partitions, probes, reports, validate
from tidemark.sources import catalog
from tidemark.sources.catalog import describe


def test_first_pages_have_no_sentinels(spark):
    df = spark.createDataFrame([(-5, date(1800, 1, 1), ""), (7, date(2026, 1, 1), "x")], "id int, d date, s string")
    assert cursors.key_page(df, ["id"], 10).count() == 2
    assert cursors.key_page(df, ["s"], 10).count() == 2
    assert cursors.keyed_page(df, "d", ["id"], date(2026, 1, 1), 10).count() == 2
    assert cursors.seen_page(df, "d", date(2026, 1, 1), 10).count() == 2


@pytest.mark.parametrize("size", [2, 5, 50])
def test_pages_of_repeats_lose_and_repeat_nothing(spark, size):
    rows = [(k % 4, k // 3, None if k % 5 == 0 else "v") for k in range(12)] + [(2, 1, "v")] * 3
    df = spark.createDataFrame(rows, "c int, a int, v string").persist()
    got, last, seen = [], None, 0
    while page := cursors.seen_page(df, "c", 3, size, last, seen).persist():
        part = page.collect()
        if not part:
            break
        got += [tuple(r) for r in part]
        end = cursors.seen_at_end(page, "c", last, seen).first()
        left = cursors.seen_count_left(df, "c", 3, end["last"], end["seen"]).first()[0]
        last, seen = end["last"], end["seen"]
        assert left == len(rows) - len(got)
        page.unpersist()
    assert sorted(map(repr, got)) == sorted(map(repr, rows))


@pytest.mark.parametrize("size", [4, 100])
def test_keyed_pages_are_the_window(spark, size):
    rows = [(k % 3, k, f"n{k}") for k in range(17)] + [(None, 99, "never")]
    df = spark.createDataFrame(rows, "c int, k int, v string").persist()
    got, last, keys = [], None, None
    while part := cursors.keyed_page(df, "c", ["k"], 2, size, last, keys).collect():
        got += part
        last, keys = part[-1]["c"], [part[-1]["k"]]
    assert len(got) == 17 and len(set(got)) == 17


def test_after_needs_as_many_values():
    with pytest.raises(ValueError):
        cursors.after(["a"], [1, 2])


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, v string")


def test_key_safety(spark):
    unique, twice, null = (frame(spark, r) for r in ([(1, "a"), (2, "b")], [(1, "a"), (1, "b")], [(None, "a")]))
    safe = probes.key_safety
    assert safe([], unique, unique, True).safe
    assert not safe(["id", "id"], unique, unique, False).safe
    assert not safe(["id"], null, unique, False, source_nullable=["id"]).safe
    assert safe(["id"], unique, unique, False, source_nullable=["id"]).warnings
    assert not safe(["id"], twice, unique, False).safe
    v = safe(["id"], unique, unique, False)
    assert v.safe and len(v.warnings) == 2
    assert not safe(["id"], unique, unique, True).safe
    assert safe(["id"], twice, unique, True, source_indexes=[["id"]], target_indexes=[["id"]]).safe
    assert safe(["id"], unique, unique, True, allow_without_target_index=True).safe
    assert not safe(["id"], unique, twice, True, allow_without_target_index=True).safe
    assert safe(["a", "b"], unique, unique, True, source_indexes=[["b", "a"]], target_indexes=[["b", "a"]]).safe


def test_detect_key(spark):
    df = frame(spark, [])
    plain, keyed = describe("t", df), describe("t", df, primary_key=["id"])
    uniq = describe("t", df, unique={"u2": ["id", "v"], "u1": ["v"]})
    assert catalog.detect_key(["v"], plain, keyed) == ("v",)
    assert catalog.detect_key(None, plain, keyed) == ("id",)
    assert catalog.detect_key(None, keyed, uniq) == ("id",)
    assert catalog.detect_key([], uniq, plain) == ("v",)
    assert catalog.detect_key_for_check([], uniq, keyed) == ()
    assert catalog.detect_key_for_check(None, plain, plain) == ()
    with pytest.raises(LookupError):
        catalog.detect_key(None, plain, plain)


def test_unique_indexes(spark):
    rows = [("a", True, True, False, False, 2, ["x", "y", "z"]), ("b", True, False, False, False, 1, ["x"]), ("c", True, True, True, False, 1, ["x"])]
    df = spark.createDataFrame(rows, "name string, unique boolean, valid boolean, partial boolean, expression boolean, key_columns int, columns array<string>")
    assert [tuple(r) for r in catalog.index_columns(df).collect()] == [("a", ["x", "y"])]


def tables(spark):
    source = spark.createDataFrame([(1, "a", 2.0)], "id int, v string, extra double")
    target = spark.createDataFrame([], "id long, v string, note string, n int")
    return source, target


def test_column_plan(spark):
    source, target = tables(spark)
    s, t = describe("s", source), describe("t", target, {"n": {"nullable": False}})
    with pytest.raises(columns.PreflightError, match="NOT NULL"):
        columns.plan_columns(s, t)
    plan = columns.plan_columns(s, t, {"n": 7, "v": "none"})
    assert plan.common == ["id", "v"] and plan.loaded == ["id", "v", "n"]
    assert [tuple(r) for r in plan.project(source, t).collect()] == [(1, "a", 7)]
    with pytest.raises(columns.PreflightError, match="lacks"):
        columns.plan_columns(s, t, {"zzz": 1})
    with pytest.raises(columns.PreflightError, match="incompatible"):
        columns.plan_columns(describe("s", spark.createDataFrame([], "id string")), t)
    with pytest.raises(columns.PreflightError, match="in common"):
        columns.plan_columns(describe("s", spark.createDataFrame([], "q int")), t)
    always = describe("t", target, {"id": {"identity": "always"}, "n": {"default": 0, "nullable": False}})
    assert columns.plan_columns(s, always).loaded == ["v"]


def test_preflight(spark):
    source, target = tables(spark)
    s, t = describe("s", source), describe("t", target, primary_key=["id"])
    go = lambda kind, **k: columns.preflight(s, t, source, target, kind, **k)
    with pytest.raises(columns.PreflightError, match="incremental column"):
        go("incremental")
    with pytest.raises(columns.PreflightError, match="not a column"):
        go("incremental", cursor="extra")
    assert go("incremental", cursor="v").keys == ("id",)
    plan = go("incremental", cursor="v", insert_only=True, allow_duplicates=True)
    assert plan.append_only and plan.keys == ()
    assert not go("incremental", cursor="v", insert_only=True).append_only
    assert go("full", insert_only=True).append_only
    plain = describe("t", target)
    assert columns.preflight(s, plain, source, target, "full").append_only
    with pytest.raises(columns.PreflightError, match="no business key"):
        columns.preflight(s, plain, source, target, "incremental", cursor="v")
    with pytest.raises(columns.PreflightError, match="not common"):
        go("full", configured_keys=["note"])


def test_validation(spark):
    df = spark.createDataFrame([(1, "ok", "{}"), (2, None, "{}"), (3, "toolong", "{'a': 1}"), (4, "x", "[1,")], "id int, v string, j string")
    meta = {"v": {"nullable": False, "max_length": 5}, "j": {"json": True}}
    s, t = describe("s", df), describe("t", df, meta, primary_key=["id"])
    got = validate.checked(df, s, t)
    assert [r["id"] for r in validate.accepted(got).collect()] == [1]
    bad = {r["business_key"]: r["error_message"] for r in validate.rejected(got, "t", ["id"]).collect()}
    assert bad == {"2": "v must not be null", "3": "v has 7 characters, 5 are allowed", "4": "j not valid JSON"}
    cut = {r["id"]: (r["v"], r["j"]) for r in validate.accepted(validate.checked(df, s, t, truncate=True)).collect()}
    assert cut == {1: ("ok", "{}"), 3: ("toolo", '{"a": 1}')}
    ruled = validate.checked(df.select("id"), s, describe("t", df.select("id")), rules={"id is odd": F.col("id") % 2 == 0})
    assert sorted(r["id"] for r in validate.accepted(ruled).collect()) == [2, 4]


def test_merge(spark):
    t = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, None, "c"), (4, 40, "d")], "k int, c int, v string")
    s = spark.createDataFrame([(1, 11, "A"), (2, 19, "B"), (3, 30, "C"), (5, 50, "E")], "k int, c int, v string")
    a = merge.upsert_actions(t, s, ["k"], "c").persist()
    assert {r["k"]: r["action"] for r in a.collect()} == {1: "update", 2: "stale", 3: "stale", 4: "keep", 5: "insert"}
    new = merge.upserted(a, ["k", "c", "v"], ["k"], ["k", "c", "v"])
    assert sorted(map(tuple, new.collect()), key=str) == [(1, 11, "A"), (2, 20, "b"), (3, None, "c"), (4, 40, "d"), (5, 50, "E")]
    again = merge.upserted(merge.upsert_actions(new, s, ["k"], "c"), ["k", "c", "v"], ["k"], ["k", "c", "v"])
    assert merge.differences(new, again).count() == 0
    r = reports.reconciliation(a).first()
    assert (r["processed"], r["inserted"], r["updated"], r["conflict_skipped"], r["unaccounted"]) == (4, 1, 1, 2, 0)
    keys_only = merge.upsert_actions(t.select("k"), s.select("k"), ["k"])
    assert {r["k"]: r["action"] for r in keys_only.collect()}[1] == "conflict"


def test_append(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n"), (None, "n")], "k int, v string")
    t = spark.createDataFrame([(1, "z")], "k int, v string")
    assert {r["action"]: r["n"] for r in merge.action_counts(merge.append_actions(t, s, ["k"])).collect()} == {"insert": 3, "conflict": 2}
    assert merge.append_actions(t, s).where("action = 'insert'").count() == 5


def test_reconciliation():
    r = reports.Reconciliation("t", source_window=10, processed=10, inserted=4, updated=3, rejected=2, conflict_skipped=1, source_total=100, target_total=98)
    assert (r.unaccounted, r.difference, r.window_difference) == (0, -2, 0)


def test_partition_planning(spark):
    df = spark.createDataFrame([(1, date(2020, 1, 2), 31), (2, date(2026, 7, 1), 32), (3, date(2026, 7, 9), 31), (4, None, None)], "id int, d date, c int")
    p = partitions.Planner()
    made = p.plan(df, "t", "d", "range", "monthly")
    assert [r[1] for r in made] == ["t_2020_01", "t_2026_07"]
    assert p.plan(df, "t", "d", "range", "monthly") == []
    assert [r[1] for r in p.plan(df, "u", "c", "list", form="{table}_p{value}")] == ["u_p31", "u_p32"]
    registry = spark.createDataFrame([("t", "other", "RANGE", "2020-01-01", "2020-02-01"), ("t", "rest", "DEFAULT", None, None)], partitions.REGISTRY)
    assert [r[1] for r in partitions.Planner().plan(df, "t", "d", "range", "monthly", registry=registry)] == ["t_2026_07"]
    assert partitions.Planner().plan_default(registry, "t") == []
    q = partitions.Planner()
    assert q.plan_default(None, "u") == [("u", "u_default", "DEFAULT", None, None)] and q.plan_default(None, "u") == []


def test_compare(spark):
    a = spark.createDataFrame([(1, datetime(2024, 1, 1), "x"), (2, datetime(2024, 1, 2), "y"), (3, None, "z")], "k int, t timestamp_ntz, v string")
    cols = ["k", "t", "v"]
    assert compare.compare_tables(a, a, cols, ["k"]).first()["status"] == "MATCH"
    changed = a.withColumn("v", F.when(F.col("k") == 2, "Y").otherwise(F.col("v")))
    assert compare.compare_tables(a, changed, cols, ["k"]).first()["status"] == "CONTENT_MISMATCH"
    assert compare.compare_tables(a, a.where("k > 1"), cols, ["k"]).first()["status"] == "COUNT_MISMATCH"
    scoped = compare.compare_tables(a, a, cols, ["k"], "t").first()
    assert (scoped["status"], scoped["source_total"], scoped["source_row_count"], scoped["source_null_cursors"]) == ("COUNT_MISMATCH", 3, 2, 1)
    got = {r["bucket_value"]: r["status"] for r in compare.compare_buckets(a, changed.where("k <> 1"), "t", "daily", cols, ["k"]).collect()}
    assert got == {"2024-01-01": "COUNT_MISMATCH", "2024-01-02": "CONTENT_MISMATCH"}
    with pytest.raises(ValueError):
        compare.bucket("t", "hourly")


def test_reports(spark):
    log = spark.createDataFrame([("b", datetime(2026, 1, 1)), ("a", datetime(2026, 1, 2)), ("a", datetime(2026, 1, 3))], "table_name string, error_time timestamp")
    assert [r["table_name"] for r in reports.error_summary(log).collect()] == ["a", "b"]
    df = frame(spark, [(5, "x"), (9, "y")])
    assert reports.sequence_report(df, "id").first()["next_value"] == 10
    assert reports.sequence_report(df, "id", -1).first()["next_value"] == 4
