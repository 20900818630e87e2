"""Every query of the engine over the sample tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.functions.values import row_json, strict_json
from tidemark.operators import compare, cursors, merge, partitions, probes, reports, validate
from tidemark.sources.catalog import describe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None):
    """Register a query under its function's name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


# --- windows and pages ---------------------------------------------------------------------------

UPPER, LAST = datetime(2000, 1, 1), datetime(1998, 1, 1)
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LINE_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
LINE_ORDER = "l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query("SELECT min(ts) AS min_value, max(ts) AS max_value FROM events")
def min_max_watermark(spark, sf_dir):
    return cursors.bounds(read(spark, sf_dir, "events"), "ts")


@query("SELECT * FROM orders WHERE o_orderdate IS NOT NULL AND o_orderdate <= TIMESTAMP '2000-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 500")
def keyed_incremental_first_page(spark, sf_dir):
    return cursors.keyed_page(read(spark, sf_dir, "orders"), "o_orderdate", ["o_orderkey"], UPPER, 500)


@query("""SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01' AND (o_orderdate > TIMESTAMP '1998-01-01'
    OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderkey > 1000)) ORDER BY o_orderdate, o_orderkey LIMIT 500""")
def keyed_incremental_next_page(spark, sf_dir):
    return cursors.keyed_page(read(spark, sf_dir, "orders"), "o_orderdate", ["o_orderkey"], UPPER, 500, LAST, [1000])


@query("""SELECT count(*) AS eligible FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01' AND (o_orderdate > TIMESTAMP '1998-01-01'
    OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderkey > 1000))""")
def keyed_incremental_window_count(spark, sf_dir):
    return cursors.keyed_window(read(spark, sf_dir, "orders"), "o_orderdate", ["o_orderkey"], UPPER, LAST, [1000]).agg(F.count("*").alias("eligible"))


@query(f"SELECT {LINE_COLUMNS} FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-01-01' ORDER BY {LINE_ORDER} LIMIT 700")
def insert_only_first_page(spark, sf_dir):
    return cursors.seen_page(read(spark, sf_dir, "lineitem"), "l_shipdate", UPPER, 700)


_SEEN = f"""SELECT *, row_number() OVER (PARTITION BY l_shipdate ORDER BY {LINE_ORDER}) AS rn FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate <= TIMESTAMP '2000-01-01'"""


@query(f"SELECT {LINE_COLUMNS} FROM ({_SEEN}) WHERE l_shipdate > TIMESTAMP '1998-01-01' OR rn > 5 ORDER BY l_shipdate, rn LIMIT 700")
def insert_only_resume_page(spark, sf_dir):
    return cursors.seen_page(read(spark, sf_dir, "lineitem"), "l_shipdate", UPPER, 700, LAST, 5)


@query(f"SELECT count(*) AS eligible FROM ({_SEEN}) WHERE l_shipdate > TIMESTAMP '1998-01-01' OR rn > 5")
def insert_only_window_count(spark, sf_dir):
    return cursors.seen_count_left(read(spark, sf_dir, "lineitem"), "l_shipdate", UPPER, LAST, 5)


@query(f"""WITH p AS (SELECT l_shipdate FROM ({_SEEN}) WHERE l_shipdate > TIMESTAMP '1998-01-01' OR rn > 5 ORDER BY l_shipdate, rn LIMIT 700)
SELECT l_shipdate AS last, count(*) + CASE WHEN l_shipdate = TIMESTAMP '1998-01-01' THEN 5 ELSE 0 END AS seen FROM p WHERE l_shipdate = (SELECT max(l_shipdate) FROM p) GROUP BY l_shipdate""")
def seen_count_at_cursor(spark, sf_dir):
    page = cursors.seen_page(read(spark, sf_dir, "lineitem"), "l_shipdate", UPPER, 700, LAST, 5)
    return cursors.seen_at_end(page, "l_shipdate", LAST, 5)


@query("SELECT * FROM customer ORDER BY c_custkey LIMIT 200")
def full_keyset_first_page(spark, sf_dir):
    return cursors.key_page(read(spark, sf_dir, "customer"), ["c_custkey"], 200)


@query("SELECT * FROM conversations WHERE conv_id > 10 OR (conv_id = 10 AND turn > 1) ORDER BY conv_id, turn LIMIT 200")
def full_keyset_next_page(spark, sf_dir):
    return cursors.key_page(read(spark, sf_dir, "conversations"), ["conv_id", "turn"], 200, [10, 1])


@query("SELECT * FROM labels ORDER BY doc_id, quality, toxic LIMIT 50 OFFSET 100")
def full_offset_page(spark, sf_dir):
    return cursors.offset_page(read(spark, sf_dir, "labels"), 100, 50)


@query("SELECT greatest(count(*) - 100, 0)::BIGINT AS eligible FROM labels")
def full_offset_count(spark, sf_dir):
    return read(spark, sf_dir, "labels").agg(F.greatest(F.count("*") - 100, F.lit(0)).cast("long").alias("eligible"))


@query("SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL ORDER BY 1")
def distinct_partition_values(spark, sf_dir):
    return cursors.distinct_values(read(spark, sf_dir, "orders"), "o_orderstatus")


# --- probes ----------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_business_keys(spark, sf_dir):
    return probes.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS null_keys FROM events WHERE event_id % 13 = 0")
def null_key_probe(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("user_id", F.expr("CASE WHEN event_id % 13 <> 0 THEN user_id END"))
    return probes.rows_with_null_key(events, ["event_id", "user_id"]).agg(F.count("*").alias("null_keys"))


CONSTRAINTS = "(VALUES ('s', 'a', 'u_b', 'UNIQUE'), ('s', 'a', 'u_c', 'UNIQUE'), ('s', 'b', 'u_d', 'UNIQUE'), ('s', 'b', 'pk', 'PRIMARY KEY'))"
USAGE = "(VALUES ('s', 'a', 'u_b', 'y', 2), ('s', 'a', 'u_b', 'x', 1), ('s', 'a', 'u_c', 'z', 1), ('s', 'b', 'u_d', 'q', 1), ('s', 'b', 'pk', 'k', 1))"


@query(f"""WITH c AS (SELECT * FROM {CONSTRAINTS} v("schema", "table", name, kind)), u AS (SELECT * FROM {USAGE} v("schema", "table", name, "column", position)),
g AS (SELECT "schema", "table", name, string_agg("column", ',' ORDER BY position) AS columns, count(*) AS n FROM c JOIN u USING ("schema", "table", name) WHERE kind = 'UNIQUE' GROUP BY ALL)
SELECT "schema", "table", name, columns FROM (SELECT *, row_number() OVER (PARTITION BY "schema", "table" ORDER BY n, name) AS r FROM g) WHERE r = 1""")
def smallest_unique_constraints(spark, sf_dir):
    from tidemark.sources import catalog

    c = spark.sql(f"SELECT * FROM {CONSTRAINTS} v(`schema`, `table`, name, kind)")
    u = spark.sql(f"SELECT * FROM {USAGE} v(`schema`, `table`, name, `column`, position)")
    return catalog.smallest_constraint(catalog.constraint_columns(c, u, "UNIQUE")).withColumn("columns", F.array_join("columns", ","))


# --- partitions --------------------------------------------------------------------------------------


@query("""SELECT DISTINCT 'events' AS table_name, 'events_p' || strftime(ts, '%Y%m%d') AS partition_name, 'RANGE' AS bound_kind,
    ts::DATE::VARCHAR AS lower_bound, (ts::DATE + 1)::VARCHAR AS upper_bound FROM events""")
def range_partitions_daily(spark, sf_dir):
    return partitions.plan_ranges(read(spark, sf_dir, "events"), "events", "ts", "daily", "{table}_p{yyyymmdd}")


@query("""SELECT DISTINCT 'orders' AS table_name, 'orders_' || strftime(o_orderdate, '%Y_%m') AS partition_name, 'RANGE' AS bound_kind,
    date_trunc('month', o_orderdate)::DATE::VARCHAR AS lower_bound, (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::DATE::VARCHAR AS upper_bound FROM orders""")
def range_partitions_monthly(spark, sf_dir):
    return partitions.plan_ranges(read(spark, sf_dir, "orders"), "orders", "o_orderdate", "monthly")


@query("""SELECT DISTINCT 'orders' AS table_name, 'orders_p' || translate(o_orderpriority, '- :.', '____') AS partition_name, 'LIST' AS bound_kind,
    o_orderpriority AS lower_bound, NULL::VARCHAR AS upper_bound FROM orders""")
def list_partitions(spark, sf_dir):
    return partitions.plan_lists(read(spark, sf_dir, "orders"), "orders", "o_orderpriority", "{table}_p{value}")


@query("""WITH b AS (SELECT min(date_trunc('month', o_orderdate)) AS a, max(date_trunc('month', o_orderdate)) AS z FROM orders)
SELECT x::DATE AS lower_bound, (x + INTERVAL 1 MONTH)::DATE AS upper_bound FROM (SELECT unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS x FROM b)""")
def all_range_periods(spark, sf_dir):
    return partitions.all_periods(read(spark, sf_dir, "orders"), "o_orderdate", "monthly")


# --- validation ----------------------------------------------------------------------------------------


def dirty_customers(spark, sf_dir):
    """Names null for keys divisible by 17, too long for those by 19."""
    return read(spark, sf_dir, "customer").withColumn("c_name", F.expr("CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN concat(c_name, '-', repeat('x', 40)) ELSE c_name END"))


def customer_checks(spark, sf_dir):
    df = dirty_customers(spark, sf_dir)
    source = describe("customer", df)
    target = describe("customer", df, {"c_name": {"type": "varchar(25)", "nullable": False, "max_length": 25}}, primary_key=["c_custkey"])
    return validate.checked(df, source, target)


_DIRTY = "SELECT * REPLACE (CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN c_name || '-' || repeat('x', 40) ELSE c_name END AS c_name) FROM customer"
_ERRORS = f"""SELECT *, CASE WHEN c_name IS NULL THEN 'c_name must not be null'
    WHEN length(c_name) > 25 THEN 'c_name has ' || length(c_name) || ' characters, 25 are allowed' END AS e FROM ({_DIRTY})"""


@query(f"SELECT 'customer' AS table_name, c_custkey::VARCHAR AS business_key, e AS error_message FROM ({_ERRORS}) WHERE e IS NOT NULL")
def validation_errors(spark, sf_dir):
    return validate.rejected(customer_checks(spark, sf_dir), "customer", ["c_custkey"]).drop("row_data")


@query(f"SELECT * EXCLUDE (e) FROM ({_ERRORS}) WHERE e IS NULL")
def validated_rows(spark, sf_dir):
    return validate.accepted(customer_checks(spark, sf_dir))


@query(f"SELECT * REPLACE (substr(c_name, 1, 25) AS c_name) FROM ({_DIRTY}) WHERE c_name IS NOT NULL")
def truncated_rows(spark, sf_dir):
    df = dirty_customers(spark, sf_dir)
    target = describe("customer", df, {"c_name": {"nullable": False, "max_length": 25}})
    return validate.accepted(validate.checked(df, describe("customer", df), target, truncate=True))


@query(f"""SELECT 'customer' AS table_name, count(*) AS bad_row_count, TIMESTAMP '2026-01-01' + INTERVAL 1 SECOND * min(c_custkey % 60) AS first_error_time,
    TIMESTAMP '2026-01-01' + INTERVAL 1 SECOND * max(c_custkey % 60) AS last_error_time FROM ({_ERRORS}) WHERE e IS NOT NULL""")
def error_log_summary(spark, sf_dir):
    log = validate.rejected(customer_checks(spark, sf_dir), "customer", ["c_custkey"])
    at = F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, cast(business_key as bigint) % 60)")
    return reports.error_summary(log.withColumn("error_time", at))


@query("SELECT event_id, coalesce(CASE WHEN event_id % 7 <> 0 THEN event_type END, 'unknown') AS event_type, 0.5::DOUBLE AS weight FROM events")
def column_defaults_filled(spark, sf_dir):
    from tidemark.operators.columns import plan_columns

    source = read(spark, sf_dir, "events").select("event_id", F.expr("CASE WHEN event_id % 7 <> 0 THEN event_type END").alias("event_type"))
    shape = source.withColumn("weight", F.lit(1.0))
    target = describe("events", shape, {"weight": {"nullable": False}})
    return plan_columns(describe("events", source), target, {"event_type": "unknown", "weight": 0.5}).project(source, target)


#: A dirty JSON text by event_id % 50; all others keep theirs.
DIRTY_JSON = {1: "{'a': 1}", 2: '{"a":NaN}', 3: '{"a":1} x', 4: "[1,2", 5: ""}


@query("""SELECT event_id, event_id % 50 NOT IN (1, 2, 3, 4, 5) AS valid FROM events""")
def json_valid_events(spark, sf_dir):
    dirty = F.col("props")
    for k, v in DIRTY_JSON.items():
        dirty = F.when(F.col("event_id") % 50 == k, F.lit(v)).otherwise(dirty)
    return read(spark, sf_dir, "events").select("event_id", strict_json(dirty).alias("valid"))


@query("""SELECT r_regionkey, '{"r_regionkey":' || r_regionkey || ',"r_name":' || to_json(r_name) || '}' AS row_data FROM region""")
def rejected_row_json(spark, sf_dir):
    df = read(spark, sf_dir, "region")
    return df.select("r_regionkey", row_json(df.schema).alias("row_data"))


# --- merges ----------------------------------------------------------------------------------------------


def orders_target(spark, sf_dir):
    """Orders without keys divisible by 11; a price more where divisible by 7."""
    return read(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0").withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"))


def orders_source(spark, sf_dir):
    """Orders with keys not divisible by 3; a day earlier where divisible by 5."""
    return read(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").withColumn("o_orderdate", F.expr("CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate - interval 1 day ELSE o_orderdate END"))


_TARGET = "(SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderkey % 11 <> 0)"
_SOURCE = "(SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate) FROM orders WHERE o_orderkey % 3 <> 0)"
_ACTIONS = f"""(SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'keep'
    WHEN s.o_orderdate >= t.o_orderdate THEN 'update' ELSE 'stale' END AS action FROM {_TARGET} t FULL JOIN {_SOURCE} s ON t.o_orderkey = s.o_orderkey)"""


def order_actions(spark, sf_dir):
    return merge.upsert_actions(orders_target(spark, sf_dir), orders_source(spark, sf_dir), ["o_orderkey"], "o_orderdate")


@query(f"SELECT * FROM {_ACTIONS}")
def upsert_actions(spark, sf_dir):
    return order_actions(spark, sf_dir).select("o_orderkey", "action")


@query(f"""SELECT {ORDER_COLUMNS} FROM {_SOURCE} JOIN (SELECT o_orderkey FROM {_ACTIONS} WHERE action IN ('insert', 'update')) USING (o_orderkey)
UNION ALL SELECT {ORDER_COLUMNS} FROM {_TARGET} JOIN (SELECT o_orderkey FROM {_ACTIONS} WHERE action IN ('keep', 'stale')) USING (o_orderkey)""")
def upsert_result(spark, sf_dir):
    columns = read(spark, sf_dir, "orders").columns
    return merge.upserted(order_actions(spark, sf_dir), columns, ["o_orderkey"], columns)


@query(f"SELECT {ORDER_COLUMNS} FROM {_SOURCE} s WHERE NOT EXISTS (SELECT 1 FROM {_TARGET} t WHERE t.o_orderkey = s.o_orderkey)")
def upsert_insert_only_new(spark, sf_dir):
    return merge.unseen(orders_source(spark, sf_dir), orders_target(spark, sf_dir), ["o_orderkey"])


@query(f"SELECT {ORDER_COLUMNS} FROM {_SOURCE} s WHERE EXISTS (SELECT 1 FROM {_TARGET} t WHERE t.o_orderkey = s.o_orderkey)")
def upsert_matched(spark, sf_dir):
    return merge.matched(orders_source(spark, sf_dir), orders_target(spark, sf_dir), ["o_orderkey"])


@query(f"""SELECT * EXCLUDE (r) FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE r = 1""")
def merge_last_write_wins(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return merge.last_write(df, ["l_orderkey", "l_linenumber"], [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")])


@query(f"""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem)
SELECT CASE WHEN r = 1 AND l_orderkey % 2 = 1 THEN 'insert' ELSE 'conflict' END AS action, count(*) AS n FROM s GROUP BY 1""")
def insert_only_conflict_skip(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return merge.action_counts(merge.append_actions(df.where("l_orderkey % 2 = 0"), df, ["l_orderkey", "l_linenumber"]))


@query(f"""SELECT count(*) FILTER (action <> 'keep') AS processed, count(*) FILTER (action = 'insert') AS inserted, count(*) FILTER (action = 'update') AS updated,
    count(*) FILTER (action = 'stale') AS conflict_skipped, 0::BIGINT AS unaccounted FROM {_ACTIONS}""")
def reconciliation_summary(spark, sf_dir):
    return reports.reconciliation(order_actions(spark, sf_dir))


# --- fingerprints and comparison -----------------------------------------------------------------------------


def _text(columns: str) -> str:
    return "concat_ws(chr(31), " + ", ".join(f"coalesce({c.strip()}::VARCHAR, chr(30))" for c in columns.split(",")) + ")"


def _hash(columns: str) -> str:
    m = f"md5({_text(columns)})"
    signed = lambda a: f"(('0x' || substr({m}, {a}, 16))::UBIGINT::HUGEINT - CASE WHEN substr({m}, {a}, 1) >= '8' THEN 18446744073709551616::HUGEINT ELSE 0 END)"
    return f"coalesce(sum({signed(1)}), 0)::VARCHAR || ':' || coalesce(sum({signed(17)}), 0)::VARCHAR"


def _fingerprint(table: str, columns: str, keys: str, cursor: str) -> str:
    return f"""SELECT count(*) AS total_count, count(*) AS row_count, min({cursor})::VARCHAR AS min_cursor, max({cursor})::VARCHAR AS max_cursor,
    count(*) FILTER ({cursor} IS NULL) AS null_cursors, {_hash(keys)} AS key_hash, {_hash(columns)} AS row_hash FROM {table}"""


@query(_fingerprint("orders", ORDER_COLUMNS, "o_orderkey", "o_orderdate"))
def table_fingerprint_orders(spark, sf_dir):
    df = read(spark, sf_dir, "orders")
    return compare.fingerprint(df, df.columns, ["o_orderkey"], "o_orderdate")


@query(_fingerprint("lineitem", LINE_COLUMNS, "l_orderkey, l_linenumber", "l_shipdate"))
def table_fingerprint_lineitem(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    return compare.fingerprint(df, df.columns, ["l_orderkey", "l_linenumber"], "l_shipdate")


EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


def _buckets(table: str, bucket: str, columns: str, key: str) -> str:
    return f"SELECT {bucket} AS bucket_value, count(*) AS row_count, {_hash(key)} AS key_hash, {_hash(columns)} AS row_hash FROM {table} WHERE {bucket} IS NOT NULL GROUP BY 1"


@query(_buckets("events", "ts::DATE::VARCHAR", EVENT_COLUMNS, "event_id"))
def bucket_fingerprint_daily(spark, sf_dir):
    df = read(spark, sf_dir, "events")
    return compare.bucket_fingerprints(df, "ts", "daily", df.columns, ["event_id"])


@query(_buckets("orders", "date_trunc('month', o_orderdate)::DATE::VARCHAR", ORDER_COLUMNS, "o_orderkey"))
def bucket_fingerprint_monthly(spark, sf_dir):
    df = read(spark, sf_dir, "orders")
    return compare.bucket_fingerprints(df, "o_orderdate", "monthly", df.columns, ["o_orderkey"])


@query(_buckets("orders", "o_orderstatus", ORDER_COLUMNS, "o_orderkey"))
def bucket_fingerprint_value(spark, sf_dir):
    df = read(spark, sf_dir, "orders")
    return compare.bucket_fingerprints(df, "o_orderstatus", "value", df.columns, ["o_orderkey"])


def altered_events(spark, sf_dir):
    """Events without those of 5 January and ids divisible by 1001; another type where divisible by 997."""
    changed = F.expr("CASE WHEN event_id % 997 = 0 THEN 'changed' ELSE event_type END")
    return read(spark, sf_dir, "events").where("event_id % 1001 <> 0 and cast(ts as date) <> date'2024-01-05'").withColumn("event_type", changed)


_ALTERED = "(SELECT * REPLACE (CASE WHEN event_id % 997 = 0 THEN 'changed' ELSE event_type END AS event_type) FROM events WHERE event_id % 1001 <> 0 AND ts::DATE <> DATE '2024-01-05')"
_COMPARED = f"""WITH s AS ({_buckets("events", "ts::DATE::VARCHAR", EVENT_COLUMNS, "event_id")}), t AS ({_buckets(_ALTERED, "ts::DATE::VARCHAR", EVENT_COLUMNS, "event_id")})
SELECT bucket_value, coalesce(s.row_count, 0) AS source_row_count, coalesce(s.key_hash, '0:0') AS source_key_hash, coalesce(s.row_hash, '0:0') AS source_row_hash,
    coalesce(t.row_count, 0) AS target_row_count, coalesce(t.key_hash, '0:0') AS target_key_hash, coalesce(t.row_hash, '0:0') AS target_row_hash,
    coalesce(s.row_count, 0) - coalesce(t.row_count, 0) AS count_difference,
    CASE WHEN coalesce(s.row_count, 0) <> coalesce(t.row_count, 0) THEN 'COUNT_MISMATCH' WHEN s.key_hash <> t.key_hash OR s.row_hash <> t.row_hash THEN 'CONTENT_MISMATCH' ELSE 'MATCH' END AS status
FROM s FULL JOIN t USING (bucket_value)"""


@query(_COMPARED)
def bucket_compare(spark, sf_dir):
    df = read(spark, sf_dir, "events")
    return compare.compare_buckets(df, altered_events(spark, sf_dir), "ts", "daily", df.columns, ["event_id"])


@query(f"SELECT count(*) AS buckets, count(*) FILTER (status <> 'MATCH') AS mismatches FROM ({_COMPARED})")
def bucket_mismatch_count(spark, sf_dir):
    return compare.mismatches(bucket_compare(spark, sf_dir))


@query(f"""WITH n AS (SELECT * REPLACE (CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS o_orderdate) FROM orders),
s AS ({_fingerprint("n WHERE o_orderdate IS NOT NULL", ORDER_COLUMNS, "o_orderkey", "o_orderdate")}), t AS ({_fingerprint(_TARGET, ORDER_COLUMNS, "o_orderkey", "o_orderdate")})
SELECT (SELECT count(*) FROM n) AS source_total, (SELECT count(*) FROM n WHERE o_orderdate IS NULL) AS source_null_cursors,
    s.row_count AS source_row_count, s.min_cursor AS source_min_cursor, s.max_cursor AS source_max_cursor, s.key_hash AS source_key_hash, s.row_hash AS source_row_hash,
    t.row_count AS target_row_count, t.min_cursor AS target_min_cursor, t.max_cursor AS target_max_cursor, t.key_hash AS target_key_hash, t.row_hash AS target_row_hash,
    s.row_count - t.row_count AS target_difference, CASE WHEN s.row_count <> t.row_count THEN 'COUNT_MISMATCH' WHEN s.row_hash <> t.row_hash OR s.key_hash <> t.key_hash THEN 'CONTENT_MISMATCH' ELSE 'MATCH' END AS status
FROM s, t""")
def table_compare(spark, sf_dir):
    source = read(spark, sf_dir, "orders").withColumn("o_orderdate", F.expr("CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END"))
    return compare.compare_tables(source, orders_target(spark, sf_dir), source.columns, ["o_orderkey"], "o_orderdate")


@query(f"""SELECT *, 'left' AS side FROM (SELECT {ORDER_COLUMNS} FROM orders EXCEPT ALL SELECT {ORDER_COLUMNS} FROM {_TARGET})
UNION ALL SELECT *, 'right' AS side FROM (SELECT {ORDER_COLUMNS} FROM {_TARGET} EXCEPT ALL SELECT {ORDER_COLUMNS} FROM orders)""")
def row_diff(spark, sf_dir):
    return merge.differences(read(spark, sf_dir, "orders"), orders_target(spark, sf_dir))


# --- operations ------------------------------------------------------------------------------------------------


@query("SELECT max(o_orderkey) AS table_value, max(o_orderkey) + 1 AS next_value FROM orders")
def sequence_next_value(spark, sf_dir):
    return reports.sequence_report(read(spark, sf_dir, "orders"), "o_orderkey")


TABLES = "region nation customer supplier part orders lineitem events".split()


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS live_rows FROM {t}" for t in TABLES))
def table_row_counts(spark, sf_dir):
    found = [read(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("live_rows")) for t in TABLES]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


HOOKS = "(VALUES ('s', 'b', 'h2', 'D'), ('s', 'a', 'h1', 'D'), ('s', 'a', 'h0', 'O'))"


@query(f"SELECT schema_name, table_name, hook_name FROM {HOOKS} v(schema_name, table_name, hook_name, state) WHERE state = 'D'")
def disabled_hooks(spark, sf_dir):
    return reports.disabled_hooks(spark.sql(f"SELECT * FROM {HOOKS} v(schema_name, table_name, hook_name, state)"))


@query("SELECT n_nationkey, n_regionkey, 'orders_' || translate(n_name, '- :.', '____') AS partition_name FROM nation")
def list_partition_names(spark, sf_dir):
    return read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", names.list_name_column("orders", F.col("n_name")).alias("partition_name"))


from tidemark.plans import catalogue_runs  # noqa: E402, F401  (registers the rest)
