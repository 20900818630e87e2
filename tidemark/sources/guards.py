"""Run guards: a lock for each key, and hooks that are switched off for a load and restored after it."""

from __future__ import annotations

import json
import logging
import os
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tidemark.sources.snapshots import Files

log = logging.getLogger("tidemark")


class Lock:
    """A file that one run at a time can create, and that is held for ``lease`` seconds after its last renewal.

    A thread renews it while the run lives; a run that crashes leaves a lock that the next
    one takes over once the lease has ended."""

    def __init__(self, spark: SparkSession, root: str, key: int | str, lease: float = 120.0):
        self.files, self.path, self.token, self.lease = Files(spark), f"{root.rstrip('/')}/_locks/{key}.lock", uuid.uuid4().hex, lease
        self._ended = threading.Event()

    def _text(self) -> str:
        return json.dumps({"token": self.token, "pid": os.getpid(), "until": time.time() + self.lease})

    def _holder(self, path: str) -> dict:
        try:
            return json.loads(self.files.read(path) or "{}")
        except ValueError:
            return {}

    def acquire(self) -> bool:
        if not self.files.publish(self.path, self._text()):
            held = self._holder(self.path)
            if held.get("until", 0) > time.time() or not self._evict(held):
                return False
            if not self.files.publish(self.path, self._text()):
                return False
        self._ended.clear()
        threading.Thread(target=self._renew, daemon=True).start()
        return True

    def _evict(self, held: dict) -> bool:
        """Move a lapsed lock away; of several runs that try, one does."""
        aside = f"{self.path}.{self.token}"
        try:
            self.files.rename(self.path, aside)
        except Exception:  # another run was quicker
            return False
        moved = self._holder(aside)
        if moved.get("token") != held.get("token"):  # not the one that lapsed: back it goes
            try:
                self.files.rename(aside, self.path)
            except Exception:
                log.warning("lock %s was taken twice", self.path)
            return False
        self.files.delete(aside)
        return True

    def _renew(self) -> None:
        while not self._ended.wait(self.lease / 3):
            if self._holder(self.path).get("token") != self.token:
                return
            self.files.replace(self.path, self._text())

    def release(self) -> None:
        self._ended.set()
        if self._holder(self.path).get("token") == self.token:
            self.files.delete(self.path)


class Hooks:
    """States of a target's triggers, recorded before they are switched off.

    ``apply(table, hook, state)`` acts on the target; the record survives a crash, and
    the next run restores what it finds."""

    def __init__(self, spark: SparkSession, root: str, apply: Callable[[str, str, str], None]):
        self.files, self.path, self.apply = Files(spark), f"{root.rstrip('/')}/_hooks.json", apply

    def recorded(self) -> dict[str, dict[str, str]]:
        return json.loads(self.files.read(self.path) or "{}")

    def disable(self, table: str, states: dict[str, str]) -> None:
        self.files.replace(self.path, json.dumps(self.recorded() | {table: states}))
        for hook, state in states.items():
            if state != "D":
                self.apply(table, hook, "D")

    def restore(self, table: str, states: Callable[[str], dict[str, str]] | None = None) -> list[str]:
        """Put a table's hooks back; with ``states`` (now), the names of those that are off all the same."""
        found = self.recorded()
        before = found.pop(table, {})
        for hook, state in before.items():
            self.apply(table, hook, state)
        self.files.replace(self.path, json.dumps(found))
        return sorted(h for h, state in states(table).items() if state == "D" and before.get(h, "O") != "D") if states else []

    def recover(self) -> list[str]:
        """Restore what a run that ended early has left; the tables that it was."""
        tables = list(self.recorded())
        for t in tables:
            self.restore(t)
        return tables
