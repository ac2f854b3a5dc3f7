"""Site addresses (P14) and the geocode lookup join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliolake.functions.address import compose_address
from heliolake.session import scratch_dir

#: A key is hot if it holds more than this share of all rows, so fewer than its inverse are.
HOT_SHARE = 1 / 1000


def with_query_address(sites: DataFrame, address2: str = "location_address2",
                       address: str = "location_address", city: str = "location_city",
                       out: str = "query_address") -> DataFrame:
    return sites.withColumn(out, compose_address(address2, address, city))


def geocode_locate(sites: DataFrame, lookup: DataFrame, key: str = "query_address",
                   ambiguous: str = "first", hot_share: float = HOT_SHARE) -> DataFrame:
    """Every site once with the lookup's columns, ``hit`` and ``reason``.

    The distinct keys of the sites, with their number of rows, meet the lookup once. Keys that
    hold more than ``hot_share`` of all rows (fewer than ``1 / hot_share`` keys) come back to the
    sites by broadcast; the others by one join, in which the rows of hot keys and of a NULL
    key are spread over all tasks by their own hash. So the sites are shuffled once and no
    key gathers in one task.

    A key with several different lookup rows is ambiguous: ``"first"`` takes the row that sorts
    first, ``"reject"`` takes none and gives the reason ``ambiguous``. Without a lookup row the
    reason is ``no hit``; a NULL address has none.
    """
    if ambiguous not in ("first", "reject"):
        raise ValueError(f"ambiguous must be 'first' or 'reject', not {ambiguous!r}")
    spark = sites.sparkSession
    rest = [c for c in lookup.columns if c != key]
    found = lookup.groupBy(key).agg(F.min(F.struct(*rest)).alias("_place"),
                                    (F.min(F.struct(*rest)) != F.max(F.struct(*rest))).alias("_many"))
    path = scratch_dir(spark, "geocode-keys")
    (sites.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).join(found, key, "left")
     .write.parquet(path))
    keys = spark.read.parquet(path)
    total = keys.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = F.col("_n") > total * hot_share
    place = ["_place", "_many"]
    first = keys.filter(hot & F.col(key).isNotNull()).select(
        key, *[F.col(c).alias(f"_h{c}") for c in place], F.lit(True).alias("_hot"))
    cold = keys.filter(~hot & F.col(key).isNotNull() & F.col("_place").isNotNull()).select(
        F.col(key).alias("_cold_key"), F.lit(0).cast("long").alias("_cold_spread"),
        *[F.col(c).alias(f"_c{c}") for c in place])
    apart = F.coalesce("_hot", F.lit(False)) | F.col(key).isNull()
    own = F.xxhash64(*sites.columns, F.monotonically_increasing_id())
    # rows set apart carry a spread that no key has; an empty text keeps them in the join
    placed = (sites.join(F.broadcast(first), key, "left")
              .withColumn("_key", F.when(apart, F.lit("")).otherwise(F.col(key)))
              .withColumn("_spread", F.when(~apart, F.lit(0)).when(own == 0, F.lit(1)).otherwise(own)))
    joined = placed.join(cold, (F.col("_key") == F.col("_cold_key"))
                         & (F.col("_spread") == F.col("_cold_spread")), "left")
    where = F.when(F.col("_hot"), F.col("_h_place")).otherwise(F.col("_c_place"))
    many = F.coalesce(F.when(F.col("_hot"), F.col("_h_many")).otherwise(F.col("_c_many")),
                      F.lit(False))
    none = many if ambiguous == "reject" else F.lit(False)
    hit = where.isNotNull() & ~none
    return joined.select(
        *sites.columns, F.when(hit, where).alias("_at"), hit.alias("hit"),
        F.when(none, F.lit("ambiguous")).when(~hit, F.lit("no hit")).alias("reason")).select(
        *sites.columns, *[F.col("_at")[c].alias(c) for c in rest], "hit", "reason")


def geocode_join(sites: DataFrame, lookup: DataFrame, key: str = "query_address",
                 ambiguous: str = "first") -> tuple[DataFrame, DataFrame]:
    """Attach (address, latitude, longitude) from a supplied lookup table.

    Returns ``(matched, rejected)`` of ``geocode_locate``, whose one result is written and feeds
    both, so a site without a lookup hit is reported instead of silently dropped. A site never
    multiplies. ``rejected`` has the sites' columns; with ``ambiguous="reject"`` also ``reason``.
    """
    path = scratch_dir(sites.sparkSession, "geocode")
    geocode_locate(sites, lookup, key, ambiguous).write.parquet(path)
    located = sites.sparkSession.read.parquet(path)
    rest = [c for c in lookup.columns if c != key]
    others = [c for c in sites.columns if c != key]
    why = ["reason"] if ambiguous == "reject" else []
    return (located.filter("hit").select(key, *others, *rest),
            located.filter("NOT hit").select(*sites.columns, *why))


def sites_csv_frame(matched: DataFrame) -> DataFrame:
    """Columns of the site-location CSV: name, peak power, address, latitude, longitude."""
    return matched.select(F.col("Name").alias("name"), F.col("Peak_Power").alias("peak power"),
                          "address", "latitude", "longitude")
