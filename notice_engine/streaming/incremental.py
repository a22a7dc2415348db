"""Incremental loading: a stream of document rows, upserted into the store batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from notice_engine.operators.store import SnapshotStore


def upsert_stream(rows: DataFrame, store: SnapshotStore, checkpoint: str) -> DataStreamWriter:
    """``rows`` as for an upsert. A batch that is replayed after a failure gives the same keys and values again, so ids stay."""

    def one(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            store.upsert(batch)

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)


def page_counts(rows: DataFrame) -> DataFrame:
    """Notices by page of a stream of list rows, for progress."""
    return rows.groupBy("page_number").agg(F.count("*").alias("item_count"))
