"""Scores arriving records against a static side, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.pipeline import Trained, link


def stream_links(arriving: DataFrame, right: DataFrame, out: str, checkpoint: str, *, trained: Trained | None = None, **policy) -> StreamingQuery:
    """Writes match lists of a stream of records to Parquet, a folder for each batch, so that a replayed batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        found = trained.link(batch, right, **policy) if trained else link(batch, right, **policy)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
