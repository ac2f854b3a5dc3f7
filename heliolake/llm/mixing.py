"""Mixing sources to target weights by repetition rates and hash-seeded Bernoulli copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliolake.llm.shared import word_count, written


def unit_hash(key: Column, seed: Column) -> Column:
    """Uniform value in [0, 1) from the first 52 bits of an MD5 over key and seed."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), seed.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float,
                   max_repeat: float) -> DataFrame:
    """Per source: its size and its target in words.

    Sources take ``weights`` in turn, ordered by code point with null last. Targets share
    ``share`` times all words by weight; one that exceeds ``max_repeat`` times its source
    stops there and the excess is shared again, by weight, among the others. Sources fill up
    in order of max_repeat * size / weight, so the level at which sharing stops follows from
    running sums in that order: no loop. One row per source passes through these windows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(
        turn, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    per = per.withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    per = per.withColumn("level", F.col("cap") / F.col("weight"))
    fill = Window.orderBy("level", F.col("source").isNull(), F.encode("source", "UTF-8"))
    upto, everything = fill.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    # level reached if this source and all before it are full, the rest share what is left
    per = (per.withColumn("budget", budget)
              .withColumn("full", F.sum("cap").over(upto))
              .withColumn("rest", F.sum("weight").over(everything) - F.sum("weight").over(upto)))
    per = per.withColumn("is_full", F.col("full") + F.col("level") * F.col("rest")
                         <= F.col("budget"))
    caps = F.coalesce(F.sum(F.when(F.col("is_full"), F.col("cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(everything)
    target = F.when(F.col("is_full"), F.col("cap")).otherwise(
        F.least(F.col("cap"), (F.col("budget") - caps) * F.col("weight") / open_weight))
    return per.select("source", F.col("source_size").cast("long").alias("source_size"),
                      F.coalesce(target, F.lit(0.0)).alias("target"))


def mixing_rates(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                 max_repeat: float = 2.0, seeds: int = 16) -> tuple[DataFrame, DataFrame]:
    """(sizes, rates): doc_id, source, size of every document, and per source its
    source_size, target, whole (copies of every document), fraction (chance of one more) and seed.

    Of ``seeds`` seeds each source uses the one whose words come nearest its target, which removes
    most of the Bernoulli noise that a few long documents cause in a small source."""
    sizes = written(docs.select(F.col("doc_id").alias("doc_id"),
                                F.col("source").cast("string").alias("source"),
                                word_count(F.col("text")).alias("size")), "mix-sizes")
    rates = source_targets(sizes, weights, share, max_repeat).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(F.lit(0.0)))
    rates = written(rates.withColumn("whole", F.floor("rate"))
                    .withColumn("fraction", F.col("rate") - F.floor("rate")), "mix-rates")
    drawn = with_rates(sizes, rates).filter((F.col("fraction") > 0) & (F.col("size") > 0))
    sums = drawn.groupBy("source").agg(
        F.first("fraction").alias("fraction"), F.first("source_size").alias("source_size"),
        *[F.sum(F.when(unit_hash(F.col("doc_id"), F.lit(k)) < F.col("fraction"), F.col("size"))
                .otherwise(0)).alias(f"s{k}") for k in range(seeds)])
    off = F.array(*[F.struct(F.abs(F.col(f"s{k}") - F.col("fraction") * F.col("source_size"))
                             .alias("off"), F.lit(k).alias("k")) for k in range(seeds)])
    best = sums.select("source", F.array_min(off)["k"].alias("seed"))
    rates = (rates.alias("r").join(best.alias("b"),
                                   F.col("r.source").eqNullSafe(F.col("b.source")), "left")
             .select("r.*", F.coalesce("b.seed", F.lit(0)).alias("seed")))
    return sizes, written(rates, "mix-seeds")


def with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source's rates (one row per source)."""
    named = rates.withColumnRenamed("source", "_source")
    return rows.join(named, F.col("source").cast("string").eqNullSafe(F.col("_source"))) \
        .drop("_source")


def copies() -> Column:
    """floor(rate) copies, one more where the document's hash falls below the fraction."""
    extra = (unit_hash(F.col("doc_id"), F.col("seed")) < F.col("fraction")).cast("long")
    return F.col("whole") + extra


def mix_sources(docs: DataFrame, **plan) -> DataFrame:
    """Copies per document so that each source's words come near its target.

    rate = target / source size; a document gets floor(rate) copies plus one more when its
    hash under the source's seed falls below the fraction, so reruns agree. ``plan``: see
    mixing_rates.

    Returns doc_id, source, size, source_size, target, copies, taken = copies * size, one row
    for each input row. Null text has size 0; a null source is a source of its own; equal
    doc_ids draw alike (ties and repeated rows get the same copies); an empty table gives no
    rows; other columns are ignored.

    Scale: documents are read once for their sizes, which go to a narrow table in the shared
    folder. The sums by source and seed combine before the shuffle, so a source that holds a
    third of all rows costs no more than another. What is joined back has one row per source.
    """
    sizes, rates = mixing_rates(docs, **plan)
    return with_rates(sizes, rates).withColumn("copies", copies()).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **plan) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it has copies, all columns kept."""
    _, rates = mixing_rates(docs, **plan)
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "source")
    return (with_rates(rows, rates).select("_row", F.explode(F.array_repeat(
        F.lit(1), copies().cast("int"))).alias("_copy"))
        .select(*[F.col("_row")[c].alias(c) for c in docs.columns]))
