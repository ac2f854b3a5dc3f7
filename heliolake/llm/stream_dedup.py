"""Exact deduplication by a stateful stream with disk-backed keyed state."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm.shared import scratch, squeezed, written

#: State lives on the executors' disks (RocksDB) and in the shared checkpoint folder; the
#: memory of all stores of an executor is bounded together.
_STATE = "spark.sql.streaming.stateStore."
STATE_CONF = {
    _STATE + "providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STATE + "rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: no disk space laid out ahead for each one's logs
    _STATE + "rocksdb.allowFAllocate": "false",
    _STATE + "rocksdb.boundedMemoryUsage": "true",
    _STATE + "rocksdb.maxMemoryUsageMB": "200",
    _STATE + "rocksdb.writeBufferSizeMB": "4",
    _STATE + "rocksdb.maxWriteBufferNumber": "2",
}


@contextmanager
def _session_conf(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text after squeezing white space; null counts as empty."""
    return F.unhex(F.sha2(squeezed(F.coalesce(text, F.lit(""))), 256))


def exact_glob(path: str) -> str:
    """A pattern that matches ``path`` alone. A file stream takes a table that is one file only
    by a pattern; one with a wildcard would also take tables whose names begin alike."""
    path = path.rstrip("/")
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path[:-1]) + f"[{path[-1]}]"


def feed_state(spark: SparkSession, path: str, state: str,
               max_files_per_trigger: int | None = None) -> None:
    """Stream the Parquet files below ``path`` that ``state`` has not seen into keyed state.

    State per digest, without expiry: the stable identifier (smallest doc_id), how many rows
    had it, and the locator (file and byte block) of the row that stays. Rows of a digest
    combine within a task before they meet the state, so a hot digest is one state row and
    one message per task. Calling it again takes in files that have come since.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    doc_id = F.col("doc_id").cast("long")
    keyed = reader.parquet(exact_glob(path)).select(
        text_digest(F.col("text")).alias("digest"), doc_id.alias("id"),
        F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"),
                 F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block_start")).alias("row"))
    groups = keyed.groupBy("digest").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    with _session_conf(spark, STATE_CONF):
        run = (groups.writeStream.format("noop").outputMode("update")
               .option("checkpointLocation", state).trigger(availableNow=True).start())
        run.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The keyed state as a table: digest, keep_id, locator, group_size."""
    found = spark.read.format("statestore").load(state)
    row, n = found.schema["value"].dataType.names
    return found.select(F.col("key.digest").alias("digest"),
                        F.col(f"value.`{row}`.doc_id").alias("keep_id"),
                        F.struct(F.col(f"value.`{row}`.file").alias("file"),
                                 F.col(f"value.`{row}`.block_start").alias("block_start"))
                        .alias("locator"),
                        F.col(f"value.`{n}`").alias("group_size"))


def dedup_stream(spark: SparkSession, path: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per document: which row of its group of equal texts stays.

    Equal means identical after squeezing white space. The digest state proposes groups; on
    hits (digests with more than one row) the full normalised texts are grouped, and a
    digest that covers several texts is dealt with by text instead of digest, so equal
    digests alone never decide.

    Returns doc_id, keep_id, group_size, kept, text_sha256, locator. Null text is equal to
    empty text. Rows without doc_id are counted but only stay if no row of the group has an
    id (keep_id null, kept true); rows that repeat the kept doc_id and text are all marked
    kept, as no row identity tells them apart. Empty tables give no rows; other columns are
    ignored.
    """
    state = scratch(spark, "dedup-state")
    docs = spark.read.parquet(path).select(F.col("doc_id").cast("long").alias("doc_id"),
                                           F.col("text").alias("text"))
    if docs.isEmpty():
        return docs.select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), F.col("text").alias("text_sha256"),
            F.struct(F.col("text").alias("file"), F.col("doc_id").alias("block_start"))
            .alias("locator"))
    feed_state(spark, path, state, max_files_per_trigger)
    groups = written(read_state(spark, state), "dedup-groups")
    hits = groups.filter(F.col("group_size") > 1).select("digest")
    texts = (docs.select("doc_id", squeezed(F.coalesce("text", F.lit(""))).alias("full"))
             .withColumn("digest", F.unhex(F.sha2("full", 256)))
             .join(hits, "digest", "left_semi")
             .groupBy("digest", "full")
             .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    # digests under which the full bytes differ
    clash = written(texts.groupBy("digest").agg(F.count("*").alias("n"))
                    .filter("n > 1").select("digest"), "dedup-clashes")
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"))
    out = rows.join(groups, "digest").select("doc_id", "digest", "keep_id", "group_size",
                                             "locator")
    if not clash.isEmpty():
        by_text = (docs.select("doc_id", squeezed(F.coalesce("text", F.lit(""))).alias("full"))
                   .withColumn("digest", F.unhex(F.sha2("full", 256)))
                   .join(texts.join(clash, "digest", "left_semi"), ["digest", "full"])
                   .select("doc_id", "digest", "keep_id", "group_size",
                           F.lit(None).cast(groups.schema["locator"].dataType).alias("locator")))
        out = out.join(clash, "digest", "left_anti").unionByName(by_text)
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"), "locator")
