"""File-source Structured Streaming over the bronze landing (ST1).

The reference refreshes the current day with an hourly batch that rewrites the whole day.
Here a file stream watches the bronze telemetry root; the stream itself only carries the
``dt`` partition value of each new file: the files are taken as binary ones whose content
column is not selected, so they are listed but not opened.
Every micro-batch recomputes the *whole* days it touched - silver, gold, the per-day
aggregate and the long export - with dynamic partition overwrite. State lives in the
tables, not in the stream: a replayed micro-batch (after a failure or a lost executor)
rewrites the same days with the same content, so the sink is idempotent. Late files for
an old day simply make that day part of a later micro-batch.

``trigger(availableNow=True)`` processes everything landed so far and stops, which gives
the hourly-job behaviour with exactly-once file tracking in the checkpoint; a
``processingTime`` trigger keeps it running.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from heliolake.plans import pipeline as P
from heliolake.session import checkpoint_dir
from heliolake.sources.tables import path_exists


def refresh_days(spark: SparkSession, layout: P.Layout, days: list[str]) -> None:
    """Recompute silver -> gold -> aggregate -> export for exactly ``days``."""
    if not days:
        return
    # the stream watches the readings; site tables are refreshed along with them if landed
    tables = [t for t in P.BRONZE_TABLES
              if t == P.INVERTERS or path_exists(spark, layout.b(t))]
    P.run_silver(spark, layout, days=days, tables=tables)
    gold = P.run_gold(spark, layout, days=days, tables=tables)
    P.run_export(spark, layout, days=days, gold=gold)


def _touched_days(batch: DataFrame) -> list[str]:
    # Distinct partition values of one micro-batch: a handful of dates, never rows.
    return sorted(r[0] for r in batch.select("dt").distinct().collect() if r[0] is not None)


def start_bronze_refresh(spark: SparkSession, layout: P.Layout, checkpoint: str | None = None,
                         available_now: bool = True, processing_time: str | None = None,
                         max_files_per_trigger: int = 10_000) -> StreamingQuery:
    """Start the refresh stream; returns the running query (``awaitTermination()`` it).
    ``max_files_per_trigger`` splits a backlog over micro-batches; it leaves nothing out."""
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "bronze-refresh")
    schema = "path string, modificationTime timestamp, length bigint, content binary, dt string"
    stream = (spark.readStream.format("binaryFile").schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .load(layout.b(P.INVERTERS)).select("dt"))

    def process(batch: DataFrame, epoch_id: int) -> None:
        refresh_days(batch.sparkSession, layout, _touched_days(batch))

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
