"""A target table as versions of Parquet, with one manifest that commits data and checkpoint together.

``<root>/<table>/v=N`` holds version N's files.  ``commits/N.json`` names the parts of
version N, its counts and the load's checkpoint; it is complete when it appears and is
never replaced, so of two writers of one version one fails.  ``manifest.json`` is a copy
of the newest, where a reader starts to look.  A part is a folder or a single file: an
append adds a part, a merge replaces the files that hold rows it changes, and nothing
else is rewritten.  Rows may be routed to children (partitions), one folder each.  Files
are reached through Hadoop's file systems, so the root may be any store that Spark can write.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another run has committed a version meanwhile."""


class Files:
    """Small files through Hadoop's file system."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str | None:
        p, fs = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, overwrite: bool = True) -> bool:
        """Whether the file was written; without ``overwrite`` only one writer succeeds."""
        p, fs = self._at(path)
        try:
            stream = fs.create(p, overwrite)
        except Exception as e:
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        try:
            stream.write(bytearray(text.encode("utf-8")))
            stream.hsync()
        finally:
            stream.close()
        return True

    def replace(self, path: str, text: str) -> None:
        """Written beside and renamed over, so readers see the old text or the new one."""
        self._publish(path, text, "OVERWRITE")

    def publish(self, path: str, text: str) -> bool:
        """Whether the whole text now stands at a path where there was nothing."""
        try:
            self._publish(path, text, "NONE")
        except Exception as e:
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        return True

    def _publish(self, path: str, text: str, option: str) -> None:
        beside = f"{path}.{uuid.uuid4().hex}"
        self.write(beside, text)
        try:
            self.rename(beside, path, option)
        finally:
            self.delete(beside)

    def rename(self, old: str, new: str, option: str = "NONE") -> None:
        a, _ = self._at(old)
        z, _ = self._at(new)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), self.conf)
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(self.jvm.org.apache.hadoop.fs.Options.Rename, option)
        context.rename(context.makeQualified(a), context.makeQualified(z), options)

    def walk(self, path: str) -> list[tuple[str, float]]:
        """Files below a folder, by their place in it, with the time they were written."""
        p, fs = self._at(path)
        if not fs.exists(p):
            return []
        base, out, found = fs.makeQualified(p).toUri().getPath().rstrip("/"), [], fs.listFiles(p, True)
        while found.hasNext():
            f = found.next()
            out.append((f.getPath().toUri().getPath()[len(base) + 1 :], f.getModificationTime() / 1000))
        return sorted(out)

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)


#: Folder of a child's rows within a part.
CHILD = "_child"


class Snapshot:
    """One target table."""

    def __init__(self, spark: SparkSession, root: str, table: str, schema: T.StructType | None = None):
        self.spark, self.files, self.path, self.table = spark, Files(spark), f"{root.rstrip('/')}/{table}", table
        self.manifest: dict[str, Any] = self._newest() or {"version": 0, "parts": [], "schema": None, "checkpoint": None, "counts": {}}
        if self.manifest["schema"] is None and schema is not None:
            self.manifest["schema"] = json.loads(schema.json())

    def _newest(self) -> dict[str, Any] | None:
        text = self.files.read(f"{self.path}/manifest.json")
        found = json.loads(text) if text else None
        # A writer may have stopped between its commit and the copy.
        while later := self.files.read(f"{self.path}/commits/{found['version'] + 1 if found else 1}.json"):
            found = json.loads(later)
        return found

    @property
    def schema(self) -> T.StructType:
        if self.manifest["schema"] is None:
            raise LookupError(f"target {self.table} has no schema yet")
        return T.StructType.fromJson(self.manifest["schema"])

    @property
    def checkpoint(self) -> dict[str, Any] | None:
        return self.manifest["checkpoint"]

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The table, or only some of its parts."""
        paths = [f"{self.path}/{p}" for p in (self.manifest["parts"] if parts is None else parts)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def children(self) -> dict[str, list[str]]:
        """Files by the child that they belong to."""
        out: dict[str, list[str]] = {}
        for p in self.manifest["parts"]:
            if found := re.search(f"/{CHILD}=([^/]*)/", p):
                out.setdefault(unquote(found[1]), []).append(p)
        return out

    def read_child(self, name: str) -> DataFrame:
        return self.read(self.children().get(name, []))

    def write_part(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Files of a new part, not yet part of the table."""
        name = f"v={self.manifest['version'] + 1}/{uuid.uuid4().hex[:12]}"
        df.select(*self.schema.names, *(partition_by or [])).write.parquet(f"{self.path}/{name}", partitionBy=partition_by or None)
        return name

    def write_files(self, df: DataFrame, child: Column | None = None, watch: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
        """As ``write_part``, but the files' own names; with ``child`` each row goes to its child's folder.

        ``watch`` sees the rows as they are written, after any exchange, so what it counts is counted once."""
        if child is not None:
            # One child's rows meet in few files; a large child is split, small ones share a task.
            df = df.withColumn(CHILD, child).hint("rebalance", CHILD)
        if watch:
            df = watch(df)
        return self._data_files(self.write_part(df, [CHILD] if child is not None else None))

    def _data_files(self, part: str) -> list[str]:
        return [f"{part}/{f}" for f, _ in self.files.walk(f"{self.path}/{part}") if f.endswith(".parquet")]

    def files_with(self, rows: DataFrame, keys: Sequence[str]) -> list[str]:
        """Files that hold a key of ``rows``: only key columns are read, and no more than file names reach the driver."""
        if not self.manifest["parts"]:
            return []
        held = self.read().select(*keys, F.col("_metadata.file_path").alias("_file")).join(rows.select(*keys), list(keys), "left_semi").select("_file").distinct()
        return sorted("v=" + unquote(r["_file"]).rsplit("/v=", 1)[1] for r in held.collect())

    def without(self, files: Iterable[str]) -> list[str]:
        """The table's parts but for these files; a folder that holds one of them is named file by file."""
        gone, out = set(files), []
        for p in self.manifest["parts"]:
            if p in gone:
                continue
            if not p.endswith(".parquet") and any(f.startswith(p + "/") for f in gone):
                out += [f for f in self._data_files(p) if f not in gone]
            else:
                out.append(p)
        return out

    def commit(self, parts: list[str], checkpoint: dict[str, Any] | None, counts: dict[str, int] | None = None, append: bool = False, unique_by: Sequence[str] | None = None) -> None:
        """Make ``parts`` (after the current ones, with ``append``) and the checkpoint the table's state.

        ``unique_by`` records a key that this version is known to be unique by."""
        new = self.manifest | {
            "version": self.manifest["version"] + 1,
            "parts": [*(self.manifest["parts"] if append else []), *parts],
            "checkpoint": checkpoint,
            "counts": counts or {},
            "unique_by": list(unique_by or []),
        }
        text = json.dumps(new, indent=1)
        if not self.files.publish(f"{self.path}/commits/{new['version']}.json", text):
            raise Conflict(f"{self.table} has a version that this run hasn't seen")
        self.files.replace(f"{self.path}/manifest.json", text)
        self.manifest = new

    def vacuum(self, keep_hours: float = 24.0) -> list[str]:
        """Remove files that are older than ``keep_hours`` and not part of the table: of past versions and of writers
        that failed.  Readers of a past version have that long to finish."""
        before, parts = time.time() - 3600 * keep_hours, self.manifest["parts"]
        files, folders = {p for p in parts if p.endswith(".parquet")}, {p for p in parts if not p.endswith(".parquet")}
        gone = []
        for f, at in self.files.walk(self.path):
            data = re.match(r"(v=\d+/[0-9a-f]{12})/", f)
            old = re.fullmatch(r"commits/(\d+)\.json", f)
            if at < before and (data and f not in files and data[1] not in folders or old and int(old[1]) < self.manifest["version"]):
                self.files.delete(f"{self.path}/{f}")
                gone.append(f)
        return gone
