"""Bronze readers.

One scan per table root, never one job per day: the day (and site / inverter) come from
Hive-style path segments (``dt=``, ``site_id=``, ``inv_id=``) and are declared as string
columns of the explicit schema, so a ``dt`` predicate prunes directories before any file
is opened and ids such as ``0012`` or ``73E4`` stay strings.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from heliolake import schemas
from heliolake.sources.tables import day_filter, day_folders, day_range_filter, path_keys, path_value

if TYPE_CHECKING:
    from heliolake.sinks.day_table import DayTable

#: Columns of Spark's ``binaryFile`` source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def read_json_documents(spark: SparkSession, root: str, dt=None, start=None, end=None,
                        days=None) -> DataFrame:
    """One row per top-level document: ``body``, ``source_file`` and the path columns.

    JSON Lines, indented files and indented documents one after the other are all cut where
    a line begins with ``{``, so files stay splittable and no file is held whole. Indented
    means that inner lines are: with an indent of 0 use a ``multi_line=True`` reader.
    """
    reader = spark.read.option("basePath", root).option("lineSep", "\n{")
    folders = day_folders(spark, root, dt, start, end, days=days)
    if folders == []:
        return spark.createDataFrame([], "body string, source_file string, dt string")
    keys = path_keys(spark, root, folders)
    if "inv_id" in keys:
        read = _flat(spark).option("lineSep", "\n{").schema("value string").text(folders or root)
        df = read.select("value", "_metadata", *[path_value(k) for k in keys])
    else:
        df = reader.text(folders or root)
    df = _days(df, dt, start, end, days)
    cut = F.col("value").rlike(r'^\s*["}]')  # the separator took the opening brace
    whole = F.when(cut, F.concat(F.lit("{"), "value")).otherwise(F.col("value"))
    return (df.select(F.rtrim(whole, F.lit(" \n\r\t")).alias("body"),
                      F.col("_metadata.file_path").alias("source_file"),
                      *[c for c in df.columns if c not in ("value", "_metadata")])
              .filter(F.col("body").rlike(r"\S")))


def _flat(spark: SparkSession):
    """A reader of all files below a folder that leaves the path columns to ``path_value``."""
    return spark.read.option("recursiveFileLookup", "true")


def _split_schema(schema: StructType, path_columns) -> StructType:
    return StructType([f for f in schema.fields if f.name not in path_columns])


def bronze_rejects(spark: SparkSession, root: str, schema: StructType = schemas.INVERTER_BRONZE,
                   field: str = "data.telemetries", dt=None, start=None, end=None,
                   days=None) -> DataFrame:
    """Documents that silver drops, with their path columns, body and ``reason``: ``not JSON``
    (truncated or foreign text) or ``no <field>`` (error bodies, other shapes). A document
    with an empty list is whole and not listed."""
    docs = read_json_documents(spark, root, dt, start, end, days)
    parsed = F.from_json("body", _split_schema(schema, set(docs.columns)))
    return (docs.withColumn("_doc", parsed)
                .filter(F.col(f"_doc.{field}").isNull())
                .withColumn("reason", F.when(F.try_parse_json("body").isNull(), F.lit("not JSON"))
                                       .otherwise(F.lit(f"no {field}")))
                .drop("_doc"))


def compact_landing(spark: SparkSession, root: str, table: "DayTable", dt=None, start=None, end=None,
                    days=None) -> int:
    """Keep the documents of a landing's window as rows of ``table``: dt, the path ids, body and
    source_file, sorted by day, one commit. A window is then read from a few large files pruned
    by their smallest and largest day; no folder of the landing is listed again. Each body
    is kept whole, also if it is no JSON. Returns the table's version."""
    docs = read_json_documents(spark, root, dt, start, end, days)
    for key in ("site_id", "inv_id"):
        if key not in docs.columns:
            docs = docs.withColumn(key, F.lit(None).cast("string"))
    docs = docs.select("dt", *[F.col(k).cast("string").alias(k) for k in ("site_id", "inv_id")],
                       "body", "source_file")
    return table.replace(docs, dt, start, end, days)


def read_compacted(table: "DayTable", schema: StructType = schemas.INVERTER_BRONZE, dt=None,
                   start=None, end=None, days=None) -> DataFrame:
    """Documents of a window in the shape the bronze readers give (S1-S3), from the compacted
    landing: only the declared fields are parsed, path ids come from their columns."""
    docs = table.read(dt, start, end, days)
    inner = _split_schema(schema, set(docs.columns))
    parsed = docs.withColumn("_doc", F.from_json("body", inner))
    return parsed.select(*[F.col(f"_doc.{f.name}") if f in inner.fields else F.col(f.name)
                           for f in schema.fields])


def landed_partitions(spark: SparkSession, root: str,
                      keys: Sequence[str] = ("dt", "site_id", "inv_id")) -> DataFrame:
    """Distinct path keys of the files under ``root`` (C4 against real folders). Only the
    listing is read: no file is opened."""
    files = _flat(spark).format("binaryFile").schema(BINARY_FILE).load(root)
    return files.select(*[path_value(k, "path") for k in keys]).distinct()


def _read_json(spark: SparkSession, root: str, schema: StructType,
               multi_line: bool | None = False, glob: str | None = None, dt=None, start=None,
               end=None, days=None) -> DataFrame:
    """Explicit-schema JSON scan of a ``dt=`` partitioned landing, restricted to the day
    window by folder before any file is listed (see ``tables.day_folders``). ``multi_line``:
    False for JSON Lines, True for one document a file, None for either."""
    if multi_line is None:
        docs = read_json_documents(spark, root, dt, start, end, days)
        inner = _split_schema(schema, set(docs.columns))
        docs = docs.withColumn("_doc", F.from_json("body", inner))
        return docs.select(*[F.col(f"_doc.{f.name}") if f in inner.fields else F.col(f.name)
                             for f in schema.fields])
    reader = (spark.read.schema(schema)
              .option("mode", "PERMISSIVE")
              .option("basePath", root))
    if multi_line:
        reader = reader.option("multiLine", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    folders = day_folders(spark, root, dt, start, end, days=days)
    keys = path_keys(spark, root, folders)
    if "inv_id" in keys:
        inner = _split_schema(schema, keys)
        df = (reader.schema(inner).option("recursiveFileLookup", "true").json(folders or root)
              .select(*inner.names, *[path_value(k) for k in keys]))
    elif folders is None:
        df = reader.json(root)
    elif folders:
        df = reader.json(folders)
    else:
        return spark.createDataFrame([], schema)
    return _days(df, dt, start, end, days)


def _days(df: DataFrame, dt=None, start=None, end=None, days=None) -> DataFrame:
    if days is not None:
        return df.filter(F.col("dt").isin([str(d) for d in days]))
    if dt is not None:
        return df.filter(day_filter(dt))
    if start is not None and end is not None:
        return df.filter(day_range_filter("dt", start, end))
    return df


def read_inverter_bronze(spark: SparkSession, root: str, dt=None, start=None, end=None,
                         multi_line: bool = False, days=None) -> DataFrame:
    """Inverter telemetry documents (S1): ``data.telemetries`` + path ids ``site_id``,
    ``inv_id`` and ``dt``. ``dt`` selects one day; ``start``/``end`` a half-open range."""
    return _read_json(spark, root, schemas.INVERTER_BRONZE, multi_line, None, dt, start, end, days)


def read_inventory_bronze(spark: SparkSession, root: str, dt=None, start=None, end=None,
                          multi_line: bool = False, days=None) -> DataFrame:
    """Site inventory documents (S2): ``Inventory.inverters`` + path ``site_id``, ``dt``."""
    return _read_json(spark, root, schemas.INVENTORY_BRONZE, multi_line, None, dt, start, end, days)


def read_sites_bronze(spark: SparkSession, root: str, dt=None, start=None, end=None,
                      multi_line: bool = False, days=None) -> DataFrame:
    """Site list snapshot pages (S3): ``sites.count`` + ``sites.site`` + path ``dt``."""
    return _read_json(spark, root, schemas.SITES_BRONZE, multi_line, None, dt, start, end, days)


def merge_pages(sites_bronze: DataFrame) -> DataFrame:
    """Site list delivered in pages (S11): explode all pages of each day and report the
    announced ``count`` (first page) against the rows actually received, per day.

    Returns ``(dt, announced, received, complete)``; two-level aggregation, no collect.
    """
    per_day = (sites_bronze
               .select("dt", F.col("sites.count").alias("announced"),
                       F.size(F.coalesce(F.col("sites.site"), F.array())).alias("n"))
               .groupBy("dt")
               .agg(F.max("announced").alias("announced"), F.sum("n").alias("received")))
    return per_day.withColumn("complete", F.col("announced") == F.col("received"))


def read_pretty_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Indented (multi-line) JSON documents, one document per file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_overview(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    r = spark.read.schema(schemas.OVERVIEW_BRONZE)
    return (r.option("multiLine", "true") if multi_line else r).json(path)


def read_energy(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    r = spark.read.schema(schemas.ENERGY_BRONZE)
    return (r.option("multiLine", "true") if multi_line else r).json(path)


def read_power(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    r = spark.read.schema(schemas.POWER_BRONZE)
    return (r.option("multiLine", "true") if multi_line else r).json(path)


def read_data_period(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    r = spark.read.schema(schemas.DATA_PERIOD_BRONZE)
    return (r.option("multiLine", "true") if multi_line else r).json(path)


def read_components(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    r = spark.read.schema(schemas.COMPONENTS_BRONZE)
    return (r.option("multiLine", "true") if multi_line else r).json(path)


def read_site_map(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Second-vendor site map (S9): one row per ``data[].key``."""
    r = spark.read.schema(schemas.SITE_MAP_BRONZE)
    df = (r.option("multiLine", "true") if multi_line else r).json(path)
    return df.select(F.explode("data").alias("d")).select(F.col("d.key").alias("site_key"))


def read_inverter_list(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Second-vendor inverter list (S9): one row per ``data[].id``; the site comes from a
    ``site_id=`` path segment when present."""
    r = spark.read.schema(schemas.INVERTER_LIST_BRONZE)
    df = (r.option("multiLine", "true") if multi_line else r).json(path)
    site = [c for c in df.columns if c == "site_id"]
    return (df.select(*site, F.explode("data").alias("d"))
              .select(*site, F.col("d.id").alias("inverter_id")))


def read_raw_landing(spark: SparkSession, path: str) -> DataFrame:
    """Payloads whose shape is not known (S10): one row per file with the whole text, the
    file path, the ``dt`` / ``site_id`` / ``inv_id`` of the path (NULL when it has none), the
    parsed document as a VARIANT (``try_parse_json``: NULL when the body is not JSON) and a
    validity flag; fields are reached later with ``variant_get`` or ``get_json_object``.

    Each file is one document of one inverter-day, so ``wholetext`` stays bounded by the
    size of one API response.
    """
    df = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return (df.withColumnRenamed("value", "payload")
              .withColumn("source_file", F.input_file_name())
              .withColumns({k: F.url_decode(F.nullif(
                  F.regexp_extract("source_file", f"/{k}=([^/]+)/", 1), F.lit("")))
                  for k in ("dt", "site_id", "inv_id")})
              .withColumn("doc", F.try_parse_json("payload"))
              .withColumn("is_json", F.col("doc").isNotNull()))

