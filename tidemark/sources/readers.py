"""Source tables: Parquet and other files, catalogue tables, JDBC."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

FILES = ("parquet", "orc", "csv", "json", "avro")


def read_table(spark: SparkSession, where: dict[str, Any], table: str) -> DataFrame:
    """A table of a source section: ``format`` (``parquet`` by default), and its place.

    Files lie in ``path/<table>`` or ``path/<table>.<format>``; ``format: table`` reads
    ``schema.table`` of the catalogue; ``format: jdbc`` needs ``url``, and reads in
    parallel where ``partition`` gives a column, its bounds and a number.
    """
    kind = where.get("format", "parquet")
    if kind == "table":
        return spark.table(f"{where['schema']}.{table}" if where.get("schema") else table)
    if kind == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(where, table, reading=True)).load()
    if kind not in FILES:
        raise ValueError(f"no such source format: {kind}")
    return spark.read.format(kind).options(**where.get("options", {})).load(f"{where['path']}/{table}{where.get('suffix', '.' + kind)}")


def jdbc_options(where: dict[str, Any], table: str, reading: bool = False) -> dict[str, Any]:
    name = f"{where['schema']}.{table}" if where.get("schema") else table
    options = {"url": where["url"], "dbtable": name, "queryTimeout": where.get("query_timeout", 0)} | connection_options(where) | {k: where[k] for k in ("user", "password", "driver") if where.get(k)}
    options |= {"fetchsize": where.get("fetchsize", 10_000)} if reading else {"batchsize": where.get("batchsize", 10_000)}
    own = (where.get("partition") or {}).get(table) if reading else None
    if own:
        options |= {"partitionColumn": own["column"], "lowerBound": own["lower"], "upperBound": own["upper"], "numPartitions": own.get("number", 16)}
    return options


def write_jdbc(df: DataFrame, where: dict[str, Any], table: str, mode: str = "append") -> None:
    df.write.format("jdbc").options(**jdbc_options(where, table)).mode(mode).save()


def connection_options(where: dict[str, Any]) -> dict[str, Any]:
    """How a driver names the time to connect and the application; by default as PostgreSQL's does."""
    named = where.get("connection") or ({"loginTimeout": 10, "ApplicationName": "tidemark"} if str(where["url"]).startswith("jdbc:postgresql:") else {})
    return {k: str(v) for k, v in named.items()}


class Statements:
    """Statements on a JDBC target that no frame expresses: trigger states, and switching them."""

    def __init__(self, spark: SparkSession, where: dict[str, Any]):
        self.spark, self.where = spark, where
        jvm = spark.sparkContext._jvm
        if where.get("driver"):
            jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(where["driver"])
        given = jvm.java.util.Properties()
        for k, v in ({n: where[n] for n in ("user", "password") if where.get(n)} | connection_options(where)).items():
            given.setProperty(k, v)
        self.connection = jvm.java.sql.DriverManager.getConnection(where["url"], given)

    def run(self, sql: str) -> None:
        s = self.connection.createStatement()
        try:
            s.execute(sql)
        finally:
            s.close()

    def rows(self, sql: str, columns: int) -> list[tuple]:
        s = self.connection.createStatement()
        try:
            got, out = s.executeQuery(sql), []
            while got.next():
                out.append(tuple(got.getString(k + 1) for k in range(columns)))
            return out
        finally:
            s.close()

    def close(self) -> None:
        self.connection.close()


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def switch_statement(schema: str | None, table: str, hook: str, state: str) -> str:
    """The statement that puts a trigger into a state: ``O`` on, ``D`` off, ``R`` for replicas, ``A`` always."""
    verb = {"D": "DISABLE TRIGGER", "O": "ENABLE TRIGGER", "R": "ENABLE REPLICA TRIGGER", "A": "ENABLE ALWAYS TRIGGER"}[state]
    name = f"{quoted(schema)}.{quoted(table)}" if schema else quoted(table)
    return f"ALTER TABLE {name} {verb} {quoted(hook)}"
