"""Helpers shared by the operators: table access, the shared folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as Spark SQL (Java) regular expressions see it.
SPACE = r"[\x20\x09-\x0D]"
NON_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master may go without the setting (tests): it then gets a private folder.
    On a cluster a missing setting is an error, never a machine-local folder.
    """
    name = "spark.checkpoint.dir"
    found = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name, None)
    if not found:
        master = spark.sparkContext.master
        if not (master.startswith("local") and "cluster" not in master):
            raise ValueError(f"set {name} to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="heliolake-shared-")
        spark.conf.set(name, found)
    return found.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str, compression: str = "lz4") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost
    executors, and fixes values that depend on row order or partition numbers."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def squeezed(text: Column) -> Column:
    """``text`` with every run of ASCII white space replaced by one space.

    Single spaces, most of the white space there is, stay out of the matches."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def stripped(text: Column) -> Column:
    """Without ASCII white space at either end. A pattern such as ``[ ]+$`` would take
    quadratic time on a long run of white space inside a text."""
    return F.trim(text, F.lit(" \t\n\x0b\f\r"))


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-white-space; null counts 0."""
    trimmed = stripped(F.coalesce(text, F.lit("")))
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, f"{SPACE}+"))).cast("long")


#: Rows of a bit filter at most: its size is fixed (16 bytes a row), whatever it is built from.
FILTER_ROWS = 1 << 16


def bit_filter(keys: DataFrame, key: str) -> DataFrame:
    """A filter of fixed size over the long column ``key``: per word of 64 bits, which are set."""
    bit = F.pmod(F.col(key), F.lit(64 * FILTER_ROWS))
    return written(keys.select(F.floor(bit / 64).alias("_word"), F.pmod(bit, F.lit(64)).alias("_bit"))
                   .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, CAST(_bit AS INT))"))
                                         .alias("_mask")), "bits")


def flagged(rows: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """``rows`` with _maybe: false where ``key`` is surely not among the filter's keys.

    Keeps rows out of a shuffle that a join would drop anyway; the join decides. The more keys
    the fixed filter holds, the fewer rows it saves; results do not change."""
    bit = F.pmod(F.col(key), F.lit(64 * FILTER_ROWS))
    return (rows.withColumn("_w", F.floor(bit / 64)).withColumn("_b", F.pmod(bit, F.lit(64)))
            .join(F.broadcast(bits), F.col("_w") == F.col("_word"), "left")  # FILTER_ROWS at most
            .withColumn("_maybe", F.expr(
                "coalesce(shiftright(_mask, CAST(_b AS INT)) & 1L, 0L) = 1L"))
            .drop("_w", "_b", "_word", "_mask"))
