"""More queries with their SQL: rules, keys, types, names, and whole runs of the engine over the sample tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark.functions import names, values
from tidemark.operators import compat, cursors, merge, partitions, probes, reports, validate
from tidemark.plans.catalogue import _SOURCE, _TARGET, LAST, LINE_COLUMNS, ORDER_COLUMNS, TABLES, customer_checks, orders_source, orders_target, query, read
from tidemark.sources.catalog import describe, detect_key, index_columns
from tidemark.sources.snapshots import Files, Snapshot

# --- windows and counts


@query("SELECT count(*) AS eligible FROM customer")
def full_first_count(spark, sf_dir):
    return read(spark, sf_dir, "customer").agg(F.count("*").alias("eligible"))


@query("SELECT count(*) AS eligible FROM conversations WHERE conv_id > 10 OR (conv_id = 10 AND turn > 1)")
def full_resume_count(spark, sf_dir):
    return read(spark, sf_dir, "conversations").where(cursors.after(["conv_id", "turn"], [10, 1])).agg(F.count("*").alias("eligible"))


@query(f"""SELECT {LINE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_shipdate ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE l_shipdate <= TIMESTAMP '1999-01-01' AND (l_shipdate > TIMESTAMP '1998-01-01' OR (l_shipdate = TIMESTAMP '1998-01-01' AND rn > 3))""")
def insert_only_window(spark, sf_dir):
    return cursors.seen_window(read(spark, sf_dir, "lineitem"), "l_shipdate", F.lit("1999-01-01").cast("timestamp_ntz"), LAST, 3)


@query("SELECT 'us:' || epoch_us(max(ts)) AS instant, max(o_orderdate)::VARCHAR AS wall_clock, max(o_orderkey)::VARCHAR AS number FROM (SELECT max(ts) AS ts FROM events), orders")
def checkpoint_texts(spark, sf_dir):
    """What a checkpoint holds of an instant, a wall clock time and a number."""
    instant = read(spark, sf_dir, "events").agg(F.max(F.expr("timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts))")).alias("v")).select(values.stored(F.col("v"), T.TimestampType()).alias("instant"))
    rest = read(spark, sf_dir, "orders").agg(values.stored(F.max("o_orderdate"), T.TimestampNTZType()).alias("wall_clock"), values.stored(F.max("o_orderkey"), T.LongType()).alias("number"))
    return instant.crossJoin(rest)  # one row each


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-02' - INTERVAL 90 MINUTE AND ts <= (SELECT max(ts) FROM events)")
def lookback_window(spark, sf_dir):
    df = read(spark, sf_dir, "events")
    last = values.recalled("2024-01-02 00:00:00", df.schema["ts"].dataType)
    upper = cursors.bounds(df, "ts").first()["max_value"]
    return df.where((F.col("ts") <= F.lit(upper)) & (F.col("ts") >= last - F.make_dt_interval(mins=F.lit(90))))


# --- keys


KEYS = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "customer": ["c_name"], "conversations": ["conv_id", "turn"], "events": ["user_id"], "nation": ["n_regionkey"]}
_KEY_ROWS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{', '.join(k)}' AS key_columns, count(*) FILTER (n > 1) > 0 AS has_duplicates, count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in k)}) > 0 AS has_nulls FROM (SELECT {', '.join(k)}, count(*) AS n FROM {t} GROUP BY ALL)"
    for t, k in KEYS.items()
)


@query(f"SELECT *, NOT has_nulls AND NOT has_duplicates AS safe FROM ({_KEY_ROWS})")
def key_safety(spark, sf_dir):
    """May these columns identify rows?  Probed where no index tells."""
    rows = []
    for t, keys in KEYS.items():
        df = read(spark, sf_dir, t)
        verdict = probes.key_safety(keys, df, df, False, source_nullable=keys)
        rows.append((t, ", ".join(keys), probes.has_duplicate_keys(df, keys), probes.has_null_key(df, keys), verdict.safe))
    return spark.createDataFrame(rows, "table_name string, key_columns string, has_duplicates boolean, has_nulls boolean, safe boolean")


@query("""SELECT 'configured' AS found_by, 'o_orderkey' AS key_columns UNION ALL SELECT 'target primary key', 'o_custkey, o_orderdate' UNION ALL SELECT 'source primary key', 'o_orderkey'
    UNION ALL SELECT 'smallest unique of the target', 'o_totalprice' UNION ALL SELECT 'smallest unique of the source', 'o_orderdate, o_custkey' UNION ALL SELECT 'nothing', NULL""")
def key_detection(spark, sf_dir):
    """The key that a table of orders gets, from each of the five places in turn."""
    df = read(spark, sf_dir, "orders")
    table = lambda key=(), unique=None: describe("orders", df, primary_key=key, unique=unique)
    two = {"b": ["o_orderdate", "o_custkey"], "c": ["o_orderkey", "o_custkey"]}
    cases = {
        "configured": (["o_orderkey"], table(["o_custkey"]), table(["o_custkey", "o_orderdate"])),
        "target primary key": (None, table(["o_orderkey"]), table(["o_custkey", "o_orderdate"])),
        "source primary key": (None, table(["o_orderkey"]), table(unique=two)),
        "smallest unique of the target": ([], table(unique=two), table(unique=two | {"z": ["o_totalprice"]})),
        "smallest unique of the source": (None, table(unique=two), table()),
        "nothing": (None, table(), table()),
    }
    rows = []
    for name, (configured, source, target) in cases.items():
        try:
            rows.append((name, ", ".join(detect_key(configured, source, target))))
        except LookupError:
            rows.append((name, None))
    return spark.createDataFrame(rows, "found_by string, key_columns string")


_INDEXES = "(VALUES ('a', true, true, false, false, 2, ['x', 'y', 'z']), ('b', false, true, false, false, 1, ['x']), ('c', true, false, false, false, 1, ['x']), ('d', true, true, true, false, 1, ['y']))"


@query(f"SELECT name, list_aggregate(columns[1:key_columns], 'string_agg', ', ') AS columns FROM {_INDEXES} v(name, uni, valid, partial, expression, key_columns, columns) WHERE uni AND valid AND NOT partial AND NOT expression")
def usable_unique_indexes(spark, sf_dir):
    """Whole, valid unique indexes and their key columns, without those that are only included."""
    found = spark.sql(f"SELECT * FROM {_INDEXES.replace('[', 'array(').replace(']', ')')} v(name, unique, valid, partial, expression, key_columns, columns)")
    return index_columns(found).select("name", F.array_join("columns", ", ").alias("columns"))


# --- types


_WIDER = ", ".join(f"('{a}', '{b}')" for a, bs in compat.WIDER.items() for b in bs)
_NAMES = "(SELECT DISTINCT unnest(['smallint', 'integer', 'bigint', 'numeric', 'real', 'double precision', 'text', 'character varying', 'date', 'timestamp without time zone', 'timestamp with time zone', 'boolean', 'json', 'jsonb']) AS n)"


@query(f"""SELECT a.n AS source_type, b.n AS target_type, a.n = b.n OR w.x IS NOT NULL AS allowed, a.n <> b.n AND w.x IS NOT NULL AS warned
    FROM {_NAMES} a CROSS JOIN {_NAMES} b LEFT JOIN (VALUES {_WIDER}) w(x, y) ON w.x = a.n AND w.y = b.n""")
def type_matrix(spark, sf_dir):
    kinds = ["smallint", "integer", "bigint", "numeric", "real", "double precision", "text", "character varying", "date", "timestamp without time zone", "timestamp with time zone", "boolean", "json", "jsonb"]
    rows = [(a, b, *compat.compatible(a, b)) for a in kinds for b in kinds]
    return spark.createDataFrame(rows, "source_type string, target_type string, allowed boolean, warned boolean")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice = floor(o_totalprice) THEN o_totalprice::BIGINT END AS whole, TRY_CAST(o_orderkey * 20 AS SMALLINT) AS small,
    TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN 'x' || o_orderkey ELSE o_orderkey::VARCHAR END AS INTEGER) AS number FROM orders""")
def converted_values(spark, sf_dir):
    """Values as another type; null where they have no exact one."""
    df = read(spark, sf_dir, "orders")
    text = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN concat('x', o_orderkey) ELSE cast(o_orderkey AS string) END")
    return df.select("o_orderkey", compat.converted(F.col("o_totalprice"), "double precision", T.LongType()).alias("whole"), compat.converted(F.col("o_orderkey") * 20, "bigint", T.ShortType()).alias("small"), compat.converted(text, "text", T.IntegerType()).alias("number"))


# --- values and rules


@query("""SELECT doc_id, CASE WHEN text IS NOT NULL THEN '{' || coalesce('"' || replace(replace(source, '\\', '\\\\'), '"', '\\"') || '"', 'NULL') || ',NULL,"' || replace(replace(substr(text, 1, 40), '\\', '\\\\'), '"', '\\"') || '"}' END AS literal FROM documents""")
def array_literals(spark, sf_dir):
    df = read(spark, sf_dir, "documents")
    items = F.when(F.col("text").isNotNull(), F.array("source", F.lit(None).cast("string"), F.substring("text", 1, 40)))
    return df.select("doc_id", values.array_literal(items).alias("literal"))


@query("""SELECT event_id, CASE WHEN event_id % 9 = 4 THEN NULL WHEN event_id % 9 = 5 THEN NULL ELSE event_id + user_id + CASE WHEN event_id % 9 = 1 THEN 0 ELSE 7 END END AS total,
    CASE event_id % 9 WHEN 4 THEN 'is not an array' WHEN 5 THEN 'holds an item of another type' END AS error FROM events""")
def array_texts(spark, sf_dir):
    """Arrays from braced, bracketed, quoted and broken texts."""
    df = read(spark, sf_dir, "events")
    a, b, m = F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_id") % 9
    text = F.when(m == 1, F.concat_ws("", F.lit("{"), a, F.lit(",NULL,"), b, F.lit("}"))).when(m == 2, F.concat_ws("", F.lit("["), a, F.lit(", "), b, F.lit(", 7]")))
    text = text.when(m == 3, F.concat_ws("", F.lit('{"'), a, F.lit('", "'), b, F.lit('",7}'))).when(m == 4, F.concat(F.lit("["), a)).when(m == 5, F.concat_ws("", F.lit("{"), a, F.lit(",x}")))
    checked = df.select("event_id", values.array_checked(text.otherwise(F.concat_ws("", F.lit("{"), a, F.lit(","), b, F.lit(",7}"))), T.LongType()).alias("x"))
    total = F.aggregate(F.filter("x.items", lambda i: i.isNotNull()), F.lit(0).cast("long"), lambda s, i: s + i)
    return checked.select("event_id", total.alias("total"), "x.error")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 2 THEN NULL WHEN event_id % 5 = 3 THEN NULL ELSE props END AS text, CASE WHEN event_id % 5 = 3 THEN 'not valid JSON' END AS error FROM events""")
def json_normal_forms(spark, sf_dir):
    """JSON as it is, Python literals as JSON, blank as null, and what is neither."""
    m = F.col("event_id") % 5
    text = F.when(m == 1, F.replace("props", F.lit('"'), F.lit("'"))).when(m == 2, F.lit("  ")).when(m == 3, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return read(spark, sf_dir, "events").select("event_id", values.json_checked(text).alias("x")).select("event_id", "x.text", "x.error")


@query("""SELECT o_orderkey, '{"key":' || o_orderkey || ',"price":"' || o_totalprice::DECIMAL(18, 2) || '","at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","raw":"' || base64(encode(o_orderstatus))
    || '","more":{"days":["' || strftime(o_orderdate, '%Y-%m-%d') || '",null]}}' AS row_data FROM orders""")
def nested_row_json(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderkey").alias("key"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"),
        F.col("o_orderstatus").cast("binary").alias("raw"), F.struct(F.array(F.col("o_orderdate").cast("date"), F.lit(None)).alias("days")).alias("more"),
    )
    return df.select("o_orderkey", values.row_json(T.StructType(df.schema.fields[1:])).alias("row_data"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('; ', CASE WHEN l_quantity > 45 THEN 'quantity above 45' END, CASE WHEN l_discount < 0.01 THEN 'no discount' END,
    CASE WHEN NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 40) THEN 'l_partkey has no row in part' END) AS error_message FROM lineitem l
    WHERE l_quantity > 45 OR l_discount < 0.01 OR NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 40)""")
def broken_rules(spark, sf_dir):
    """Rows that break a declared condition or a foreign key."""
    df = read(spark, sf_dir, "lineitem")
    table = describe("lineitem", df)
    rows = validate.checked(df, table, table, rules={"quantity above 45": "l_quantity <= 45", "no discount": "l_discount >= 0.01"})
    rows = validate.referenced(rows, ["l_partkey"], read(spark, sf_dir, "part").where("p_size <= 40"), ["p_partkey"], "l_partkey has no row in part")
    return rows.where(F.size("errors") > 0).select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("errors", "; ").alias("error_message"))


@query("SELECT count(*) AS bad_rows FROM (SELECT c_name FROM (SELECT CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN c_name || '-' || repeat('x', 40) ELSE c_name END AS c_name FROM customer)) WHERE c_name IS NULL OR length(c_name) > 25")
def bad_row_count(spark, sf_dir):
    return validate.rejected(customer_checks(spark, sf_dir), "customer", ["c_custkey"]).agg(F.count("*").alias("bad_rows"))


# --- merges


@query(f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY {ORDER_COLUMNS}) AS r1, row_number() OVER (PARTITION BY o_totalprice ORDER BY {ORDER_COLUMNS}) AS r2 FROM orders WHERE o_orderkey % 2 = 0),
t AS (SELECT * FROM orders WHERE o_orderkey % 2 = 1)
SELECT {ORDER_COLUMNS}, CASE WHEN r1 > 1 OR r2 > 1 OR EXISTS (SELECT 1 FROM t WHERE t.o_custkey = s.o_custkey AND t.o_orderdate = s.o_orderdate) OR EXISTS (SELECT 1 FROM t WHERE t.o_totalprice = s.o_totalprice)
    THEN 'conflict' ELSE 'insert' END AS action FROM s""")
def append_by_two_unique_keys(spark, sf_dir):
    df = read(spark, sf_dir, "orders")
    return merge.append_actions(df.where("o_orderkey % 2 = 1"), df.where("o_orderkey % 2 = 0"), [["o_custkey", "o_orderdate"], ["o_totalprice"]])


@query(f"""SELECT DISTINCT s.o_orderkey FROM {_SOURCE} s WHERE EXISTS (SELECT 1 FROM {_TARGET} t WHERE t.o_custkey = s.o_custkey AND t.o_orderdate = s.o_orderdate AND t.o_orderkey <> s.o_orderkey)
    OR EXISTS (SELECT 1 FROM {_SOURCE} b WHERE b.o_custkey = s.o_custkey AND b.o_orderdate = s.o_orderdate AND b.o_orderkey < s.o_orderkey)""")
def merge_unique_clashes(spark, sf_dir):
    return merge.clashing(orders_target(spark, sf_dir), orders_source(spark, sf_dir), ["o_orderkey"], [["o_custkey", "o_orderdate"]])


# --- names, children, sequences, reports


LONG = "a_table_whose_name_is_rather_long_so_that_its_children_need_short_ones"


@query(f"SELECT DISTINCT user_id, CASE WHEN length(n) <= 63 THEN n ELSE left(n, 50) || '_' || left(sha256(n), 12) END AS partition_name FROM (SELECT user_id, '{LONG}_' || user_id AS n FROM events)")
def long_identifiers(spark, sf_dir):
    return read(spark, sf_dir, "events").select("user_id", names.list_name_column(LONG, F.col("user_id")).alias("partition_name")).distinct()


@query("""SELECT CASE WHEN event_id % 6 = 0 THEN 'events_default' ELSE 'events_' || strftime(ts, '%Y_%m_%d') END AS child, count(*) AS n FROM events GROUP BY ALL""")
def routed_rows(spark, sf_dir):
    df = read(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_id") % 6 != 0, F.col("ts")))
    return df.groupBy(partitions.child_of("events", "ts", "range", "daily").alias("child")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT 'orders' AS table_name, 'orders_' || o_orderstatus AS partition_name, 'LIST' AS bound_kind, o_orderstatus AS lower_bound, NULL::VARCHAR AS upper_bound FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'orders', 'orders_default', 'DEFAULT', NULL, NULL")
def partitions_still_missing(spark, sf_dir):
    """Children that a batch needs and the registry lacks, and the default one."""
    df = read(spark, sf_dir, "orders")
    registry = spark.createDataFrame([("orders", "old name", "LIST", "F", None)], partitions.REGISTRY)
    planner = partitions.Planner()
    rows = planner.plan(df, "orders", "o_orderstatus", "list", registry=registry) + planner.plan_default(registry, "orders")
    assert not planner.plan(df, "orders", "o_orderstatus", "list", registry=registry) and not planner.plan_default(registry, "orders")
    return spark.createDataFrame(rows, partitions.REGISTRY)


_SEQUENCES = "(VALUES ('orders', 'o_orderkey', 10, true, 1), ('customer', 'c_custkey', 1000000000, false, 1), ('events', 'event_id', -5, true, -1), ('gone', 'id', 1, false, 1))"
_EXTREMES = "(SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders UNION ALL SELECT 'customer', 'c_custkey', min(c_custkey), max(c_custkey) FROM customer UNION ALL SELECT 'events', 'event_id', min(event_id), max(event_id) FROM events)"


@query(f"""SELECT s.table_name, s.column_name, CASE WHEN inc > 0 THEN high ELSE low END AS table_value, (CASE WHEN called THEN last + inc ELSE last END)::BIGINT AS next_value,
    coalesce(CASE WHEN inc > 0 THEN (CASE WHEN called THEN last + inc ELSE last END) <= high ELSE (CASE WHEN called THEN last + inc ELSE last END) >= low END, false) AS behind
    FROM {_SEQUENCES} s(table_name, column_name, last, called, inc) LEFT JOIN {_EXTREMES} e ON e.table_name = s.table_name AND e.column_name = s.column_name ORDER BY 1, 2""")
def sequence_health(spark, sf_dir):
    sequences = spark.sql(f"SELECT table_name, column_name, cast(l AS bigint) AS last_value, c AS is_called, cast(i AS bigint) AS increment FROM {_SEQUENCES} v(table_name, column_name, l, c, i)")
    found = None
    for t, c in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("events", "event_id")):
        one = read(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.min(c).alias("low"), F.max(c).alias("high"))
        found = one if found is None else found.union(one)
    return reports.sequence_health(sequences, found)


_SERIALS = "(VALUES ('p', 'b', 'id', 's2'), ('p', 'a', 'id', 's1'), ('p', 'a', 'name', NULL))"


@query(f"SELECT * FROM {_SERIALS} v(table_schema, table_name, column_name, sequence_name) WHERE sequence_name IS NOT NULL ORDER BY 1, 2, 3")
def sequence_columns(spark, sf_dir):
    return reports.sequence_columns(spark.sql(f"SELECT * FROM {_SERIALS} v(table_schema, table_name, column_name, sequence_name)"))


@query("SELECT min(o_orderkey) AS table_value, min(o_orderkey) - 2 AS next_value FROM orders")
def sequence_next_value_down(spark, sf_dir):
    return reports.sequence_report(read(spark, sf_dir, "orders"), "o_orderkey", -2)


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT 'sample' AS schema_name, '{t}' AS table_name, count(*) AS live_rows FROM {t}" for t in TABLES) + ") ORDER BY table_name")
def ordered_row_counts(spark, sf_dir):
    found = None
    for t in TABLES:
        one = read(spark, sf_dir, t).agg(F.lit("sample").alias("schema_name"), F.lit(t).alias("table_name"), F.count("*").alias("live_rows"))
        found = one if found is None else found.union(one)
    return reports.table_counts(found)


_BEFORE, _AFTER = "(VALUES ('s', 'a', 'h0', 'O'), ('s', 'b', 'h2', 'D'))", "(VALUES ('s', 'b', 'h2', 'D'), ('s', 'a', 'h0', 'D'), ('s', 'a', 'h3', 'O'))"


@query("SELECT 's' AS schema_name, 'a' AS table_name, 'h0' AS hook_name")
def hooks_left_disabled(spark, sf_dir):
    of = lambda v: spark.sql(f"SELECT * FROM {v} v(schema_name, table_name, hook_name, state)")
    return reports.still_disabled(of(_AFTER), of(_BEFORE))


# --- whole runs


def workspace(spark: SparkSession) -> str:
    """A new folder that the whole cluster shares, removed at the end."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-runs-")
    path = f"{base.rstrip('/')}/tidemark-runs-{uuid.uuid4().hex}"

    def remove() -> None:
        try:
            Files(spark).delete(path)
        except Exception:  # the session has ended; the folder is the cluster's to clean
            pass

    atexit.register(remove)
    return path


ORDERS = {"source_table": "orders", "target_table": "orders", "load_type": "incremental", "incremental_column": "o_orderdate", "business_key_columns": ["o_orderkey"], "primary_key": ["o_orderkey"], "source_primary_key": ["o_orderkey"]}


def synced(spark: SparkSession, frames: list[DataFrame], table: dict, name: str, **settings):
    """Load the versions of a source one after the other; the place of the target and each run's result."""
    from tidemark.plans.sync import run_job

    root, results = workspace(spark), []
    for k, df in enumerate(frames):
        source = f"{root}/source{k}"
        df.write.parquet(f"{source}/{name}.parquet")
        job = config.parse({"source": {"path": source}, "target": {"path": f"{root}/target"}, "migration": {"tables": [table], **settings}})
        done = run_job(spark, job, wait=lambda s: None)
        if done.exit_code:
            raise RuntimeError(done.tables[0].error)
        results.append(done.tables[0])
    return f"{root}/target", results


def order_versions(spark, sf_dir) -> list[DataFrame]:
    """Orders up to 1998; then all of them, later by 30 years and dearer by one where the key is divisible by 10."""
    df = read(spark, sf_dir, "orders")
    moved = df.withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END")).withColumn("o_orderdate", F.expr("CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + interval 30 years ELSE o_orderdate END"))
    return [df.where(F.col("o_orderdate") <= F.lit(LAST)), moved]


_MOVED = "(SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 30 YEAR ELSE o_orderdate END AS o_orderdate) FROM orders)"


@query(f"SELECT {ORDER_COLUMNS} FROM {_MOVED}")
def run_incremental_by_key(spark, sf_dir):
    target, _ = synced(spark, order_versions(spark, sf_dir), ORDERS, "orders")
    return Snapshot(spark, target, "orders").read()


@query(f"""SELECT 1 AS run, count(*) AS source_window, count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unaccounted FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'
    UNION ALL SELECT 2, count(*), count(*) FILTER (o.o_orderkey IS NULL), count(*) FILTER (o.o_orderkey IS NOT NULL), 0 FROM {_MOVED} m
    LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01') o ON o.o_orderkey = m.o_orderkey,
    (SELECT max(o_orderdate) AS at, max(o_orderkey) FILTER (o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01')) AS k FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01') c
    WHERE m.o_orderdate > c.at OR (m.o_orderdate = c.at AND m.o_orderkey > c.k)""")
def run_reconciliation(spark, sf_dir):
    """What two runs by key did with their rows."""
    _, results = synced(spark, order_versions(spark, sf_dir), ORDERS, "orders")
    rows = [(k + 1, r.stats.source_window, r.stats.inserted, r.stats.updated, r.stats.unaccounted) for k, r in enumerate(results)]
    return spark.createDataFrame(rows, "run int, source_window long, inserted long, updated long, unaccounted long")


@query("SELECT * FROM labels UNION ALL SELECT * FROM labels WHERE doc_id % 4 = 0")
def run_append_with_repeats(spark, sf_dir):
    """Rows that may repeat, appended in pages; a third run finds nothing new."""
    df = read(spark, sf_dir, "labels")
    twice = df.union(df.where("doc_id % 4 = 0"))
    half = df.agg(F.expr("percentile_approx(doc_id, 0.5)").alias("m")).first()["m"] or 0
    pages = max(50, twice.count() // 3)
    table = {"source_table": "labels", "target_table": "labels", "load_type": "incremental", "incremental_column": "doc_id", "insert_only": True, "allow_duplicates": True}
    target, _ = synced(spark, [twice.where(F.col("doc_id") <= half), twice, twice], table, "labels", batch_size=pages)
    return Snapshot(spark, target, "labels").read()


@query("SELECT * FROM customer")
def run_full_load(spark, sf_dir):
    df = read(spark, sf_dir, "customer")
    table = {"source_table": "customer", "target_table": "customer", "load_type": "full", "business_key_columns": ["c_custkey"]}
    target, _ = synced(spark, [df, df], table, "customer")
    return Snapshot(spark, target, "customer").read()


@query("""SELECT 'orders_' || strftime(o_orderdate, '%Y_%m') AS child, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY ALL""")
def run_into_children(spark, sf_dir):
    """Rows of each child as they lie on disk."""
    table = ORDERS | {"partition_column": "o_orderdate", "partition_type": "range"}
    target, _ = synced(spark, [read(spark, sf_dir, "orders").coalesce(2)], table, "orders")
    t = Snapshot(spark, target, "orders")
    folder = F.regexp_extract("_metadata.file_path", r"/_child=([^/]*)/", 1)
    return t.read().select("o_orderkey", folder.alias("child")).groupBy("child").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("""SELECT DISTINCT 'orders' AS table_name, 'orders_' || strftime(o_orderdate, '%Y_%m') AS partition_name, 'RANGE' AS bound_kind, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS lower_bound,
    strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS upper_bound FROM orders UNION ALL SELECT 'orders', 'orders_default', 'DEFAULT', NULL, NULL""")
def run_partition_registry(spark, sf_dir):
    table = ORDERS | {"partition_column": "o_orderdate", "partition_type": "range", "create_default_partition": True}
    target, _ = synced(spark, [read(spark, sf_dir, "orders")], table, "orders")
    return Snapshot(spark, target, "_partitions").read()


@query("""SELECT 'customer' AS table_name, c_custkey::VARCHAR AS business_key, 'c_acctbal below zero' AS error_message FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'customer', c_custkey::VARCHAR, 'c_name has 30 characters, 25 are allowed' FROM customer WHERE c_acctbal >= 0 AND c_custkey % 19 = 0""")
def run_error_log(spark, sf_dir):
    """Rows that a run set aside, with their reasons."""
    df = read(spark, sf_dir, "customer").withColumn("c_name", F.expr("CASE WHEN c_custkey % 19 = 0 AND c_acctbal >= 0 THEN rpad(c_name, 30, '#') ELSE c_name END"))
    table = {"source_table": "customer", "target_table": "customer", "load_type": "full", "business_key_columns": ["c_custkey"], "columns": {"c_name": {"max_length": 25}}, "checks": [{"message": "c_acctbal below zero", "condition": "c_acctbal >= 0"}]}
    target, _ = synced(spark, [df], table, "customer")
    return Snapshot(spark, target, "migration_error_log", T._parse_datatype_string("table_name string, business_key string, error_message string, row_data string, error_time timestamp")).read().select("table_name", "business_key", "error_message")


@query(f"""SELECT 'CONTENT_MISMATCH' AS status, count(*) AS source_total, count(*) AS target_total, '["o_orderkey"]' AS key_columns FROM {_MOVED}""")
def run_accuracy_check(spark, sf_dir):
    """A check of a loaded target against a source that has changed since, in values alone."""
    from tidemark.plans.accuracy import check_job

    root, _ = synced(spark, [read(spark, sf_dir, "orders")], ORDERS, "orders")
    source = root.replace("/target", "/later")
    order_versions(spark, sf_dir)[1].write.parquet(f"{source}/orders.parquet")
    job = config.parse({"source": {"path": source}, "target": {"path": root}, "migration": {"tables": [ORDERS]}})
    return check_job(spark, job)[0].select("status", "source_total", "target_total", "key_columns")


@query("SELECT * EXCLUDE (r) FROM (SELECT user_id, ts, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, value DESC) AS r FROM events) WHERE r = 1")
def run_stream_merge(spark, sf_dir):
    """The newest event of every user, from a stream of files."""
    from tidemark.streaming.feed import merge_stream

    root = workspace(spark)
    df = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    df.repartition(3, "event_id").write.parquet(f"{root}/changes")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/changes")
    merge_stream(stream, f"{root}/target", "newest", ["user_id"], "ts", f"{root}/checkpoint").awaitTermination()
    return Snapshot(spark, f"{root}/target", "newest").read()
