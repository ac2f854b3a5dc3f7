"""Shape of raw landings per vendor and day, and its drift from a declared schema."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from heliolake.operators.quality import CHECK_COLUMNS


def shape_profile(raw: DataFrame, by: Sequence[str] = ("vendor", "dt")) -> DataFrame:
    """One row per vendor and day of a raw landing (``read_raw_landing``): ``n`` documents,
    ``n_not_json`` among them, and ``shape``, the one variant schema that covers the rest. The
    schemas of documents are merged partially in every task."""
    return raw.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc").isNull()).alias("n_not_json"),
        F.schema_of_variant_agg("doc").alias("shape"))


def declared_leaves(schema: StructType, path: str = "$") -> Iterator[tuple[str, DataType]]:
    """(JSON path, type) of the scalar fields; the first element stands for an array."""
    for f in schema.fields:
        at, kind = f"{path}['{f.name}']", f.dataType
        while isinstance(kind, ArrayType):
            at, kind = f"{at}[0]", kind.elementType
        if isinstance(kind, StructType):
            yield from declared_leaves(kind, at)
        else:
            yield at, kind


def shape_drift(raw: DataFrame, schema: StructType, by: Sequence[str] = ("vendor", "dt")
                ) -> DataFrame:
    """Per vendor, day and declared field: in how many documents it is there (``present``), and
    in how many of these it is no value of its declared type (``unfit``). One pass, a row per
    group and field of the declared schema."""
    leaves = list(declared_leaves(schema))
    counts = []
    for k, (path, kind) in enumerate(leaves):
        there = F.try_variant_get("doc", path, "variant")
        given = there.isNotNull() & ~F.is_variant_null(there)
        fits = F.try_variant_get("doc", path, kind.simpleString()).isNotNull()
        counts += [F.count_if(given).alias(f"p{k}"), F.count_if(given & ~fits).alias(f"u{k}")]
    rows = [F.struct(F.lit(path).alias("field"), F.lit(kind.simpleString()).alias("declared"),
                     F.col(f"p{k}").alias("present"), F.col(f"u{k}").alias("unfit"))
            for k, (path, kind) in enumerate(leaves)]
    grouped = raw.groupBy(*by).agg(F.count("doc").alias("documents"), *counts)
    return grouped.select(*by, "documents", F.inline(F.array(*rows)))


def drift_check(drift: DataFrame, by: Sequence[str] = ("vendor", "dt")) -> DataFrame:
    """Check rows (Q9 columns), one per vendor and day: passed if every declared field occurs in
    some document and none holds a value of another type; ``observed`` counts the fields that
    drifted, of ``expected`` = 0. The message names them."""
    bad = (F.col("unfit") > 0) | ((F.col("present") == 0) & (F.col("documents") > 0))
    label = F.concat_ws(" ", F.lit("shape"), *by)
    per = drift.groupBy(*by).agg(
        F.count_if(bad).alias("observed"),
        F.array_join(F.array_sort(F.collect_list(F.when(bad, F.col("field")))), ", ").alias("f"))
    return per.select(
        label.alias("check"), (F.col("observed") == 0).alias("passed"), "observed",
        F.lit(0).cast("bigint").alias("expected"),
        F.concat(F.lit("fields missing or of another type: "), "f").alias("message")
    ).select(*CHECK_COLUMNS)
