"""Synchronisation of one table and of a whole job.

A run reads one window: what lies beyond the checkpoint, up to the highest cursor
value when it began.  The window is validated, merged or appended in set-based
plans, and data, checkpoint and counts are committed by one manifest.  With a
``batch_size`` the window is cut into pages, each committed on its own; a lookback
moves the first page's lower bound only.

A merge finds the target's files that hold the window's keys, joins those alone and
replaces them, so its cost follows the window and the files it touches, not the
target.  Checkpoints hold instants as microseconds, so they mean the same in every
time zone.  Keys are proven unique once: by a declared key, by a scan, or by the
version that a merge has made; later runs check the window's keys alone.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import JobConfig, TableConfig
from tidemark.functions.names import Sequence
from tidemark.functions.values import recalled, stored, typed
from tidemark.operators import cursors, merge, validate
from tidemark.operators.columns import ColumnPlan, PreflightError, preflight
from tidemark.operators.partitions import REGISTRY, Planner, child_of
from tidemark.operators.probes import has_duplicate_keys
from tidemark.operators.reports import Reconciliation
from tidemark.sources.catalog import Table, describe
from tidemark.sources.guards import Hooks, Lock
from tidemark.sources.readers import read_table
from tidemark.sources.snapshots import Snapshot

log = logging.getLogger("tidemark")

RUNNING, WAITING, COMPLETED, FAILED, NO_DATA, ALREADY = "RUNNING", "WAITING_FOR_NEXT_RUN", "COMPLETED", "FAILED", "NO_DATA", "ALREADY_COMPLETED"
ERROR_LOG = "table_name string, business_key string, error_message string, row_data string, error_time timestamp"


@dataclass
class TableResult:
    table: str
    status: str
    stats: Reconciliation | None = None
    warnings: list[str] = field(default_factory=list)
    error: str | None = None
    partitions: list[tuple] = field(default_factory=list)
    sequence: Sequence | None = None


@dataclass
class JobResult:
    tables: list[TableResult] = field(default_factory=list)
    locked_out: bool = False

    @property
    def exit_code(self) -> int:
        """0: all loaded; 1: a table failed; 2: a table was skipped by a check; 3: another run holds the lock."""
        if self.locked_out:
            return 3
        return 1 if any(t.status == FAILED for t in self.tables) else 2 if any(t.status == "SKIPPED" for t in self.tables) else 0


def usable(entry: dict | None, keys: tuple[str, ...], append_only: bool) -> bool:
    """Whether a checkpoint was made with these keys."""
    if not entry or list(entry.get("business_key_columns") or []) != list(keys):
        return False
    return append_only or not keys or entry.get("last_key_values") is not None


class TableSync:
    """One table's run."""

    def __init__(self, spark: SparkSession, job: JobConfig, config: TableConfig, planner: Planner, force: bool = False, wait: Callable[[float], None] = time.sleep):
        self.spark, self.job, self.config, self.planner, self.force, self.wait = spark, job, config, planner, force, wait
        self.source = read_table(spark, job.source, config.source_table)
        self.load_type = job.load_type(config)
        self.incremental = self.load_type == "incremental"
        root = job.target["path"]
        self.snapshot = Snapshot(spark, root, config.target_table, self.target_schema())
        self.errors = Snapshot(spark, root, job.error_table, T._parse_datatype_string(ERROR_LOG))
        self.registry = Snapshot(spark, root, "_partitions", T._parse_datatype_string(REGISTRY))
        target_df = self.snapshot.read()
        self.target_table: Table = describe(config.target_table, target_df, config.columns, config.primary_key, config.unique)
        self.source_table: Table = describe(config.source_table, self.source, config.source_columns, config.source_primary_key, config.source_unique)
        self.cursor = config.incremental_column if self.incremental else None
        self.plan: ColumnPlan = preflight(
            self.source_table, self.target_table, self.unproven(), target_df, self.load_type, config.column_defaults, self.cursor, config.business_key_columns,
            config.insert_only, config.allow_duplicates, config.allow_incremental_without_target_unique_index, config.partition_column,
        )
        self.stats = Reconciliation(config.target_table)
        self.partitions: list[tuple] = []

    def target_schema(self) -> T.StructType:
        """A new target's columns: the declared types where there are any, else the source's; then declared target-only columns."""
        declared = {k: v for k, v in self.config.columns.items() if "spark_type" in v}
        fields = [T.StructField(f.name, T._parse_datatype_string(declared[f.name]["spark_type"]) if f.name in declared else f.dataType) for f in self.source.schema]
        have = {f.name for f in fields}
        return T.StructType(fields + [T.StructField(k, T._parse_datatype_string(v["spark_type"])) for k, v in declared.items() if k not in have])

    def unproven(self) -> DataFrame:
        """Source rows whose keys no earlier run has checked: those of the window, or all in a first run."""
        entry = self.snapshot.checkpoint
        if not self.incremental or self.force or not entry or not self.cursor or self.cursor not in self.source.columns or not entry.get("last_incremental_value"):
            return self.source
        if list(entry.get("business_key_columns") or []) != list(self.config.business_key_columns or entry.get("business_key_columns") or []):
            return self.source
        return self.source.where(F.col(self.cursor) >= recalled(entry["last_incremental_value"], self.kind(self.cursor)))

    def kind(self, column: str) -> T.DataType:
        return self.source.schema[column].dataType

    # --- the window

    def run(self) -> TableResult:
        entry, config = self.snapshot.checkpoint, self.config
        keys = tuple(self.plan.keys)
        known = entry if usable(entry, keys, self.plan.append_only) and not self.force else None
        upper = None
        if not self.incremental:
            if known and known["status"] == COMPLETED:
                return TableResult(config.target_table, ALREADY, warnings=self.plan.warnings)
        else:
            upper = self.source.agg(stored(F.max(self.cursor), self.kind(self.cursor)).alias("v")).first()["v"]
            if upper is None:
                return TableResult(config.target_table, NO_DATA, self.stats, self.plan.warnings)
        self.upper = recalled(upper, self.kind(self.cursor)) if upper is not None else None
        window = self.window(known)
        if keys and self.snapshot.manifest.get("unique_by") != list(keys):
            if self.snapshot.manifest["parts"] and has_duplicate_keys(self.snapshot.read(), keys):
                raise RuntimeError(f"target {config.target_table} has duplicate keys; more rows than were read would change")
        base = known or {}
        state = {n: base.get(n, 0 if n in ("last_incremental_seen_count", "total_rows") else None) for n in ("last_incremental_value", "last_key_values", "last_incremental_seen_count", "total_rows")}
        if not self.job.batch_size:
            self.load(window, state, dict(state), upper, last=True)
            self.stats.source_window = self.stats.processed
        else:
            self.stats.source_window = window.count()
            place, first = dict(state), True
            while True:
                n = self.load(self.page(window if first else None, place), state, place, upper, last=False)
                if not n:
                    break
                first = False
                self.wait(self.job.sleep_seconds)
            self.snapshot.commit([], self.entry(state, upper, True), append=True, unique_by=self.snapshot.manifest.get("unique_by"))
        self.stats.source_total, self.stats.target_total = self.source.count(), self.snapshot.read().count()
        if self.job.setting(config, "create_default_partition") and self.incremental and config.partition_column:
            self.add_partitions(self.planner.plan_default(self.registry.read(), config.target_table, self.job.setting(config, "default_partition_name_format")))
        sequence = self.sequence()
        if self.job.vacuum_hours is not None:
            for s in (self.snapshot, self.errors, self.registry):
                s.vacuum(self.job.vacuum_hours)
        return TableResult(config.target_table, self.snapshot.checkpoint["status"], self.stats, self.plan.warnings, partitions=self.partitions, sequence=sequence)

    def last_value(self, entry: dict | None) -> Column | None:
        return recalled(entry["last_incremental_value"], self.kind(self.cursor)) if entry and self.cursor else None

    def last_keys(self, entry: dict) -> list[Column]:
        return [recalled(v, self.kind(k)) for k, v in zip(self.plan.keys, entry["last_key_values"])]

    def window(self, known: dict | None) -> DataFrame:
        """All that this run has to read."""
        keys, c = self.plan.keys, self.cursor
        if not self.incremental:
            if known and keys and known.get("last_key_values"):
                return self.source.where(cursors.after(keys, self.last_keys(known)))
            if known and not keys and known.get("total_rows"):
                return self.source.orderBy(*cursors.in_order(self.source.columns)).offset(known["total_rows"])
            return self.source
        last = self.last_value(known)
        if last is None:
            found = self.source.where(F.col(c).isNotNull() & (F.col(c) <= self.upper))
            start = typed(self.config.initial_incremental_value, self.kind(c))
            return found if start is None else found.where(F.col(c) > start)
        if self.plan.append_only:
            return cursors.seen_window(self.source, c, self.upper, last, known.get("last_incremental_seen_count", 0))
        if self.config.lookback_minutes:
            # A merge by key may read rows again; it changes nothing that is newer.
            return self.source.where(F.col(c).isNotNull() & (F.col(c) <= self.upper) & (F.col(c) >= last - F.make_dt_interval(mins=F.lit(self.config.lookback_minutes))))
        return cursors.keyed_window(self.source, c, keys, self.upper, last, self.last_keys(known))

    def page(self, window: DataFrame | None, place: dict) -> DataFrame:
        """The next page: the window's first one, or (without a window) what follows ``place``."""
        n, keys, c = self.job.batch_size, self.plan.keys, self.cursor
        if self.incremental and self.plan.append_only:
            if place["last_incremental_value"] is None:
                return cursors.seen_page(window, c, self.upper, n)
            return cursors.seen_page(self.source, c, self.upper, n, self.last_value(place), place["last_incremental_seen_count"])
        if self.incremental:
            rows = window if window is not None else cursors.keyed_window(self.source, c, keys, self.upper, self.last_value(place), self.last_keys(place))
            return rows.orderBy(*cursors.in_order([c, *keys])).limit(n)
        if keys:
            return cursors.key_page(self.source, keys, n, self.last_keys(place) if place["last_key_values"] else None)
        return cursors.offset_page(self.source, place["total_rows"], n)

    # --- the load

    def load(self, page: DataFrame, state: dict, place: dict, upper: str | None, last: bool) -> int:
        """Validate, merge or append and commit one page; the number of its rows.

        ``place`` follows the page; ``state``, which is committed, never falls behind the checkpoint."""
        config, job, keys = self.config, self.job, list(self.plan.keys)
        small = self.incremental or bool(job.batch_size)
        if small:  # read once; a whole table is read twice rather than kept
            page = page.persist()
        try:
            staged = self.plan.project(page, self.target_table)
            rules = {r["message"]: r["condition"] for r in config.checks}
            checked = validate.checked(staged, self.source_table, self.target_table, job.validate_not_null, job.validate_lengths, job.truncate_long_strings, rules)
            for ref in config.references:
                other = Snapshot(self.spark, job.target["path"], ref["table"]).read()
                checked = validate.referenced(checked, ref["columns"], other, ref.get("keys") or ref["columns"], f"{', '.join(ref['columns'])} has no row in {ref['table']}")
            n = self.advance(page, state, place)
            if job.batch_size and not n:
                return 0
            n_bad = checked.where(F.size("errors") > 0).count()
            good, bad = validate.accepted(checked), validate.rejected(checked, config.target_table, keys)
            if n_bad and not job.setting(config, "skip_bad_rows"):
                raise RuntimeError(f"{config.target_table}: {bad.first()['error_message']}")
            if job.create_missing_partitions and config.partition_column:
                self.ensure_partitions(good)
            unique = [u for u in self.target_table.indexes if set(u) <= set(good.columns) and set(u) != set(keys)]
            if self.plan.append_only or not keys:
                counts, parts, conflicts = self.append(good, unique)
                copies, known_key = 0, None
            else:
                counts, parts, conflicts, copies = self.merge(good, keys, unique)
                known_key = keys
            skipped = counts.get("stale", 0) + counts.get("conflict", 0)
            logged = [bad]
            if skipped:
                shown = T.StructType([f for f in conflicts.schema if f.name in good.columns])
                logged.append(conflicts.select(F.lit(config.target_table).alias("table_name"), validate.joined_key(keys).alias("business_key") if keys else F.lit(None).cast("string").alias("business_key"), F.lit("Row skipped: the target holds a newer row or the key is taken").alias("error_message"), validate.row_json(shown).alias("row_data")))
            self.log_errors(logged, n_bad + skipped)
            self.stats.processed += n
            self.stats.inserted += counts.get("insert", 0)
            self.stats.updated += counts.get("update", 0) + copies
            self.stats.rejected += n_bad
            self.stats.conflict_skipped += skipped
            self.snapshot.commit(parts, self.entry(state, upper, last), {"rows": n} | counts, unique_by=known_key)
            return n
        finally:
            if small:
                page.unpersist()

    def counted(self, actions: DataFrame, columns: list[Column]) -> tuple[dict[str, int], list[str]]:
        """Write the columns; how many rows of each action there were comes from the write itself."""
        seen = Observation()
        names = ("insert", "update", "keep")
        count = [F.count_if(F.col("_action") == a).alias(a) for a in names]
        files = self.snapshot.write_files(actions.select(*columns, F.col("action").alias("_action")), self.child(), lambda df: df.observe(seen, *count))
        return {a: seen.get[a] for a in names}, files

    def child(self) -> Column | None:
        c = self.config
        if not c.partition_column or c.partition_type not in ("range", "list"):
            return None
        form = self.job.setting(c, "range_partition_name_format" if c.partition_type == "range" else "list_partition_name_format")
        return child_of(c.target_table, c.partition_column, c.partition_type, self.job.setting(c, "partition_granularity"), form, self.job.setting(c, "default_partition_name_format"))

    def append(self, good: DataFrame, unique: list) -> tuple[dict[str, int], list[str], DataFrame]:
        actions = merge.append_actions(self.snapshot.read(), good, unique)
        counts, files = self.counted(actions.where("action = 'insert'"), self.wide(actions))
        if unique:
            counts["conflict"] = good.count() - counts["insert"]
        return counts, [*self.snapshot.manifest["parts"], *files], actions.where("action = 'conflict'")

    def merge(self, good: DataFrame, keys: list[str], unique: list) -> tuple[dict[str, int], list[str], DataFrame, int]:
        order = [F.col(self.cursor).desc_nulls_last()] if self.cursor else []
        ranked = merge.last_write(good, keys, [*order, *(F.col(c).desc_nulls_last() for c in good.columns if c not in keys)]).persist()
        try:
            row = ranked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("copies")).first()
            single = rest = ranked.drop("copies")
            clashes = merge.clashing(self.snapshot.read(), single, keys, unique).persist() if unique else None
            if clashes is not None:
                rest = single.join(clashes, keys, "left_anti").select(*single.columns)
            touched = self.snapshot.files_with(rest, keys)
            old = self.snapshot.read(touched)
            actions = merge.upsert_actions(old, rest, keys, self.cursor)
            cells = merge.upserted_cells(self.snapshot.schema.names, keys, single.columns)
            counts, files = self.counted(actions, cells)
            lost = row["n"] - counts["insert"] - counts["update"]
            others = [c for c in single.columns if c not in keys]
            conflicts = single.limit(0)
            if lost:
                stale = merge.upsert_actions(old, rest, keys, self.cursor).where("action in ('stale', 'conflict')").select(*keys, *(F.col(f"s_{c}").alias(c) for c in others))
                if clashes is not None:
                    stale = stale.unionByName(single.join(clashes, keys, "left_semi").select(*stale.columns))
                # Kept apart from the sources' cache, and no more than the rows that were left out.
                conflicts = self.spark.read.schema(stale.schema).parquet(f"{self.errors.path}/{self.errors_part(stale)}")
            counts = {"insert": counts["insert"], "update": counts["update"], "conflict": lost}
            return counts, [*self.snapshot.without(touched), *files], conflicts, row["copies"]
        finally:
            ranked.unpersist()

    def errors_part(self, rows: DataFrame) -> str:
        """A folder beside the error log's versions; ``vacuum`` removes it."""
        name = f"v={self.errors.manifest['version'] + 1}/{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.errors.path}/{name}")
        return name

    def wide(self, df: DataFrame) -> list[Column]:
        """All target columns; those that aren't loaded are null."""
        return [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.snapshot.schema]

    def advance(self, page: DataFrame, state: dict, place: dict) -> int:
        """Count a page and move the cursors behind it, from one aggregate."""
        keys, c = list(self.plan.keys), self.cursor
        if self.incremental and self.plan.append_only:
            top = page.agg(F.max(c).alias("top"), F.count("*").alias("all"))
            row = page.join(F.broadcast(top), F.col(c) == F.col("top"), "right").groupBy("top", "all").agg(F.count(c).alias("n")).select("all", "n", stored(F.col("top"), self.kind(c)).alias("last")).first()
            if row["all"]:
                before = place["last_incremental_seen_count"] if row["last"] == place["last_incremental_value"] else 0
                place["last_incremental_value"], place["last_incremental_seen_count"] = row["last"], row["n"] + before
                state.update(place)
            n = row["all"]
        else:
            order = [*([c] if self.incremental else []), *keys]
            if order:
                end = F.max(F.struct(*order))
                got = page.agg(F.count("*").alias("n"), end.alias("x"))
                old = [recalled(state["last_incremental_value"], self.kind(c))] if self.incremental else []
                old += self.last_keys(state) if state["last_key_values"] else [None] * len(keys)
                ahead = F.lit(True) if any(v is None for v in old) else F.col("x") >= F.struct(*(v.alias(o) for v, o in zip(old, order)))
                texts = [stored(F.col("x")[o], self.kind(o)).alias(f"v{k}") for k, o in enumerate(order)]
                row = got.select("n", ahead.alias("ahead"), *texts).first()
                n, values = row["n"], [row[f"v{k}"] for k in range(len(order))]
                if n:
                    reached = {"last_key_values": values[-len(keys) :]} if keys else {}
                    if self.incremental:
                        reached["last_incremental_value"] = values[0]
                    place.update(reached)
                    if row["ahead"]:
                        state.update(reached)
            else:
                n = page.count()
        state["total_rows"] += n
        place["total_rows"] = state["total_rows"]
        return n

    def entry(self, state: dict, upper: str | None, last: bool) -> dict:
        done = WAITING if self.incremental else COMPLETED
        return state | {"high_watermark": upper, "status": done if last else RUNNING, "load_type": self.load_type, "business_key_columns": list(self.plan.keys)}

    def log_errors(self, frames: list[DataFrame], n: int) -> None:
        if not n:
            return
        try:
            rows = frames[0]
            for f in frames[1:]:
                rows = rows.unionByName(f)
            part = self.errors.write_part(rows.withColumn("error_time", F.lit(datetime.now(timezone.utc)).cast("timestamp")))
            self.errors.commit([part], None, append=True)
        except Exception:
            if self.job.fail_on_error_log_failure:
                raise
            log.exception("rejected rows of %s could not be logged", self.config.target_table)

    def ensure_partitions(self, rows: DataFrame) -> None:
        c, job = self.config, self.job
        known = self.registry.read()
        targets = [(c.target_table, c.partition_column, c.partition_type, job.setting(c, "partition_granularity"), job.setting(c, "range_partition_name_format"), job.setting(c, "list_partition_name_format"))]
        for t in c.trigger_partition_targets:
            targets.append((t.target_table, t.source_column or t.partition_column, t.partition_type, t.partition_granularity or job.partition_granularity, t.range_partition_name_format or job.range_partition_name_format, t.list_partition_name_format or job.list_partition_name_format))
        for table, column, kind, granularity, range_form, list_form in targets:
            if kind in ("range", "list"):
                self.add_partitions(self.planner.plan(rows, table, column, kind, granularity, range_form if kind == "range" else list_form, known))
        if job.create_default_partition:
            for t in c.trigger_partition_targets:
                self.add_partitions(self.planner.plan_default(known, t.target_table, t.default_partition_name_format or job.default_partition_name_format))

    def add_partitions(self, rows: list[tuple]) -> None:
        if rows:
            part = self.registry.write_part(self.spark.createDataFrame(rows, REGISTRY))
            self.registry.commit([part], None, append=True)
            self.partitions += rows

    def sequence(self) -> Sequence | None:
        """The sequence behind a column, moved beyond the table's extreme value and stored."""
        c = self.config
        if not (self.job.reset_sequences and c.sequence_column):
            return None
        store = Sequences(self.snapshot.files, self.job.target["path"])
        live = store.read(c.target_table, c.sequence_column, c.sequence)
        extreme = F.max if live.increment > 0 else F.min
        moved = live.after(self.snapshot.read().agg(extreme(c.sequence_column).alias("v")).first()["v"])
        store.write(c.target_table, c.sequence_column, moved)
        return moved


class Sequences:
    """States of the target's sequences: last value, whether it was given out, increment and bounds."""

    def __init__(self, files, root: str):
        self.files, self.path = files, f"{root.rstrip('/')}/_sequences.json"

    def all(self) -> dict[str, dict]:
        return json.loads(self.files.read(self.path) or "{}")

    def read(self, table: str, column: str, declared: dict) -> Sequence:
        """As it was stored last, else as the job declares it."""
        s = declared | self.all().get(f"{table}.{column}", {})
        step = s.get("increment", 1)
        least, most = s.get("least", 1 if step > 0 else -(2**63)), s.get("most", 2**63 - 1 if step > 0 else -1)
        return Sequence.read(s.get("last_value", least if step > 0 else most), s.get("is_called", False), step, least, most)

    def write(self, table: str, column: str, s: Sequence) -> None:
        last, called = s.stored()
        made = {"last_value": last, "is_called": called, "increment": s.increment, "least": s.least, "most": s.most}
        self.files.replace(self.path, json.dumps(self.all() | {f"{table}.{column}": made}))


def sync_table(spark: SparkSession, job: JobConfig, table: TableConfig, planner: Planner | None = None, force: bool = False, wait: Callable[[float], None] = time.sleep) -> TableResult:
    """Load one table, with retries; a check that fails skips it, an error fails it."""
    error = ""
    for attempt in range(job.max_retries):
        try:
            return TableSync(spark, job, table, planner or Planner(), force, wait).run()
        except PreflightError as e:
            return TableResult(table.target_table, "SKIPPED", error=str(e))
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            log.warning("%s failed (attempt %d): %s", table.key, attempt + 1, error)
            if attempt + 1 < job.max_retries:
                wait(job.retry_delay)
    return TableResult(table.target_table, FAILED, error=error)


def run_job(spark: SparkSession, job: JobConfig, hooks: Hooks | None = None, hook_states: Callable[[str], dict[str, str]] | None = None, force: bool = False, wait: Callable[[float], None] = time.sleep) -> JobResult:
    """All tables in their order, under the job's lock."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", job.timezone)
    try:
        return _run_job(spark, job, hooks, hook_states or (lambda t: {}), force, wait)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _run_job(spark: SparkSession, job: JobConfig, hooks: Hooks | None, hook_states: Callable[[str], dict[str, str]], force: bool, wait: Callable[[float], None]) -> JobResult:
    lock = Lock(spark, job.target["path"], job.advisory_lock_key, job.lock_lease_seconds) if job.use_advisory_lock else None
    if lock and not lock.acquire():
        return JobResult(locked_out=True)
    result, planner = JobResult(), Planner()
    try:
        if hooks:
            hooks.recover()
        for table in job.tables:
            if job.load_type(table) == "skip":
                continue
            off = hooks and job.disable_triggers_globally and table.disable_triggers_during_load is not False
            if off:
                hooks.disable(table.target_table, hook_states(table.target_table))
            try:
                result.tables.append(sync_table(spark, job, table, planner, force, wait))
            finally:
                if off:
                    left = hooks.restore(table.target_table, hook_states)
            if off and left:
                result.tables[-1].warnings.append("hooks are still off: " + ", ".join(left))
            if result.tables[-1].status in (FAILED, "SKIPPED") and job.stop_on_table_error:
                break
    finally:
        if lock:
            lock.release()
    return result
