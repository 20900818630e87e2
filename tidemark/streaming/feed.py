"""A stream of changed rows into a target: each micro-batch is merged like a page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources.snapshots import Snapshot


def merge_stream(changes: DataFrame, root: str, table: str, keys: Sequence[str], cursor: str, checkpoint: str, continuous: bool = False):
    """Start a query that upserts ``changes`` by key; stale rows never overwrite newer ones.

    A batch's number is kept in the manifest that commits its rows, so a batch that is
    delivered again after a crash changes nothing.  Without ``continuous`` it reads what
    there is and ends."""
    schema = changes.schema

    def apply(batch: DataFrame, number: int) -> None:
        target = Snapshot(batch.sparkSession, root, table, schema)
        done = (target.checkpoint or {}).get("batch", -1)
        if number <= done:
            return
        rows = merge.last_write(batch, keys, [F.col(cursor).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in batch.columns if c not in keys)]).drop("copies")
        rows = rows.persist()
        try:
            touched = target.files_with(rows, keys)
            actions = merge.upsert_actions(target.read(touched), rows, keys, cursor)
            files = target.write_files(merge.upserted(actions, target.schema.names, list(keys), rows.columns))
        finally:
            rows.unpersist()
        target.commit([*target.without(touched), *files], {"batch": number}, unique_by=list(keys))

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer if continuous else writer.trigger(availableNow=True)).start()
