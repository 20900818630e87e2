"""Job files: sections ``source``, ``target`` and ``migration`` in YAML or JSON."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

LOAD_TYPES = ("full", "incremental", "skip")


class ConfigError(ValueError):
    """The job file can't be used."""


@dataclass(frozen=True)
class TriggerTarget:
    """A table that the target's triggers write to, whose partitions must exist."""

    target_table: str
    partition_type: str
    partition_column: str
    source_column: str | None = None
    range_partition_name_format: str | None = None
    list_partition_name_format: str | None = None
    default_partition_name_format: str | None = None
    partition_granularity: str | None = None


@dataclass(frozen=True)
class TableConfig:
    source_table: str
    target_table: str
    enabled: bool = True
    load_type: str | None = None
    incremental_column: str | None = None
    business_key_columns: list[str] | None = None
    insert_only: bool = False
    allow_duplicates: bool = False
    initial_incremental_value: Any = None
    allow_incremental_without_target_unique_index: bool = False
    partition_column: str | None = None
    partition_type: str | None = None
    partition_granularity: str | None = None
    range_partition_name_format: str | None = None
    list_partition_name_format: str | None = None
    default_partition_name_format: str | None = None
    create_default_partition: bool | None = None
    trigger_partition_targets: tuple[TriggerTarget, ...] = ()
    column_defaults: dict[str, Any] = field(default_factory=dict)
    skip_bad_rows: bool | None = None
    disable_triggers_during_load: bool | None = None
    lookback_minutes: int = 0
    columns: dict[str, dict] = field(default_factory=dict)
    primary_key: list[str] = field(default_factory=list)
    unique: dict[str, list[str]] = field(default_factory=dict)
    source_columns: dict[str, dict] = field(default_factory=dict)
    source_primary_key: list[str] = field(default_factory=list)
    source_unique: dict[str, list[str]] = field(default_factory=dict)
    #: Conditions of the target (``message``, ``condition``) and foreign keys (``columns``, ``table``, ``keys``).
    checks: list[dict] = field(default_factory=list)
    references: list[dict] = field(default_factory=list)
    sequence_column: str | None = None
    #: The sequence before its first run: ``last_value, is_called, increment, least, most``.
    sequence: dict = field(default_factory=dict)

    @property
    def key(self) -> str:
        return f"{self.source_table}_to_{self.target_table}"


@dataclass(frozen=True)
class JobConfig:
    source: dict[str, Any]
    target: dict[str, Any]
    tables: tuple[TableConfig, ...]
    batch_size: int | None = None
    sleep_seconds: float = 0
    max_retries: int = 1
    retry_delay: float = 10
    error_table: str = "migration_error_log"
    timezone: str = "UTC"
    default_load_type: str = "full"
    stop_on_table_error: bool = False
    create_missing_partitions: bool = True
    partition_granularity: str = "monthly"
    range_partition_name_format: str | None = None
    list_partition_name_format: str | None = None
    create_default_partition: bool = False
    default_partition_name_format: str | None = None
    disable_triggers_globally: bool = False
    validate_lengths: bool = True
    validate_not_null: bool = True
    truncate_long_strings: bool = False
    skip_bad_rows: bool = True
    fail_on_error_log_failure: bool = True
    use_advisory_lock: bool = True
    advisory_lock_key: int = 0
    lock_lease_seconds: float = 120
    reset_sequences: bool = True
    #: Files of past versions are removed after so many hours; None keeps them.
    vacuum_hours: float | None = 24

    def load_type(self, table: TableConfig) -> str:
        return "skip" if not table.enabled else (table.load_type or self.default_load_type).lower()

    def setting(self, table: TableConfig, name: str) -> Any:
        """A table's own value, else the job's."""
        own = getattr(table, name, None)
        return own if own is not None else getattr(self, name)


def _made(kind, values: dict, where: str):
    known = {f.name for f in fields(kind)}
    if not isinstance(values, dict):
        raise ConfigError(f"{where} must be a mapping")
    try:
        return kind(**{k: v for k, v in values.items() if k in known})
    except TypeError as e:
        raise ConfigError(f"{where}: {e}") from None


def parse(raw: Any) -> JobConfig:
    if not isinstance(raw, dict):
        raise ConfigError("the job must be a mapping")
    for section in ("source", "target", "migration"):
        if not isinstance(raw.get(section), dict):
            raise ConfigError(f"section {section} is missing")
    job = dict(raw["migration"])
    if "migration" in job:
        raise ConfigError("section migration holds another section migration")
    if not job.get("tables"):
        raise ConfigError("migration.tables is missing")
    tables = []
    for k, t in enumerate(job.pop("tables")):
        where = f"migration.tables[{k}]"
        t = dict(t) if isinstance(t, dict) else t
        if isinstance(t, dict):
            t["trigger_partition_targets"] = tuple(_made(TriggerTarget, x, where) for x in t.get("trigger_partition_targets") or ())
            t["column_defaults"] = t.get("column_defaults") or {}
        tables.append(_made(TableConfig, t, where))
    config = _made(JobConfig, {**job, "source": raw["source"], "target": raw["target"], "tables": tuple(tables)}, "migration")
    if config.max_retries < 1:
        raise ConfigError("max_retries must be at least 1")
    for t in config.tables:
        if config.load_type(t) not in LOAD_TYPES:
            raise ConfigError(f"{t.key}: no such load type: {config.load_type(t)}")
    return config


def load(path: str | Path) -> JobConfig:
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return parse(json.loads(text))
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("YAML job files need PyYAML; use JSON") from e
    return parse(yaml.safe_load(text))
