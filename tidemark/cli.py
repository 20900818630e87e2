"""``python -m tidemark.cli sync|check --config FILE``"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tidemark import config
from tidemark.operators.compare import MATCH


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)
    sync = sub.add_parser("sync", help="load the job's tables")
    sync.add_argument("--config", required=True)
    sync.add_argument("--force", action="store_true", help="start completed full loads again")
    check = sub.add_parser("check", help="compare sources and targets")
    check.add_argument("--config", required=True)
    check.add_argument("--table")
    check.add_argument("--validation-table", default="migration_accuracy_log")
    check.add_argument("--bucket", action="store_true")
    check.add_argument("--bucket-column")
    check.add_argument("--bucket-granularity", choices=("daily", "monthly", "value"), default="daily")
    check.add_argument("--bucket-validation-table", default="migration_accuracy_bucket_log")
    return p.parse_args(argv)


#: States of a table's own triggers, by name.
STATES = "SELECT t.tgname, t.tgenabled FROM pg_trigger t JOIN pg_class c ON c.oid = t.tgrelid JOIN pg_namespace n ON n.oid = c.relnamespace WHERE NOT t.tgisinternal AND n.nspname = '{schema}' AND c.relname = '{table}'"


def hooks_of(spark: SparkSession, job: config.JobConfig):
    """What switches the target's triggers, and what tells their states, where the job's target section has
    ``hooks``: a JDBC place (``url, user, password, driver, schema``), and its own ``states`` query if it needs one."""
    where = job.target.get("hooks")
    if not where:
        return None, None
    from tidemark.sources.guards import Hooks
    from tidemark.sources.readers import Statements, switch_statement

    database, schema = Statements(spark, where), where.get("schema", "public")
    escaped = lambda x: x.replace("'", "''")
    query = where.get("states", STATES)
    states = lambda table: dict(database.rows(query.format(schema=escaped(schema), table=escaped(table)), 2))
    return Hooks(spark, job.target["path"], lambda table, hook, state: database.run(switch_statement(schema, table, hook, state))), states


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    job = config.load(args.config)
    spark = SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
    if args.command == "sync":
        from tidemark.plans.sync import run_job

        hooks, states = hooks_of(spark, job)
        result = run_job(spark, job, hooks, states, force=args.force)
        for t in result.tables:
            print(t.table, t.status, t.error or "", t.stats.row() if t.stats else "")
        return result.exit_code
    from tidemark.plans.accuracy import check_job

    tables, _ = check_job(spark, job, args.table, args.bucket, args.bucket_column, args.bucket_granularity, args.validation_table, args.bucket_validation_table)
    found = tables.select("target_table", "status").collect()
    for r in found:
        print(r["target_table"], r["status"])
    return int(any(r["status"] != MATCH for r in found))


if __name__ == "__main__":
    sys.exit(main())
