"""Line deduplication, exact and within one edit, by a deletion-neighbourhood join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliolake.llm.shared import NON_SPACE, bit_filter, flagged, written

ID = ["h1", "h2"]
#: Characters of the blocks in which single characters are deleted.
SIDE = 64


def normalised_lines(text: Column) -> Column:
    """The lines in lower case, white space squeezed and trimmed."""
    squeezed = F.regexp_replace(
        text, r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(F.lower(squeezed), "\n"), lambda line: F.trim(line))


def _rank(doc_id: Column, line_no: Column) -> Column:
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"),
                    line_no.alias("line_no"))


#: Variants of a line less one half, as hashed keys. Two lines within one edit, m characters in
#: the shorter, agree on all before the half of the edit (counted from the start) or all after
#: it (counted from the end). Places 0 and 1 are for m = n (this line is the shorter or both are
#: equally long) without the first or second half, 2 and 3 for m = n - 1 (this is the longer).
_HALF_KEYS = """array(
    xxhash64(n, 0, right(text, n - (n + 1) div 2)), xxhash64(n, 1, left(text, (n + 1) div 2)),
    xxhash64(n - 1, 0, right(text, n - 1 - n div 2)), xxhash64(n - 1, 1, left(text, n div 2)))"""


def _half(lines: DataFrame) -> DataFrame:
    """Adds block, the half that the key of ``place`` leaves out, its length base in the
    shorter line, and longer, whether this line would be the longer one."""
    return (lines.withColumn("longer", F.expr("place >= 2"))
            .withColumn("m", F.expr("n - CAST(longer AS INT)"))
            .withColumn("s", F.expr("(m + 1) div 2"))
            .withColumn("base", F.expr("CAST(if(place % 2 = 0, s, m - s) AS INT)"))
            .withColumn("block", F.expr("CASE WHEN place % 2 = 0 THEN left(text, "
                                        "CAST(n - (m - s) AS INT)) ELSE substring(text, "
                                        "CAST(s + 1 AS INT)) END")))


def _block_keys() -> Column:
    """The same within the half: variants less one block of SIDE characters, as hashed keys."""
    side, base = F.lit(SIDE), F.col("base")
    count = F.greatest(F.lit(1), F.ceil(base / side).cast("int"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
        F.xxhash64("key", i, F.left("block", side * i),
                   F.right("block", F.greatest(F.lit(0), base - side * (i + 1)))).alias("key"),
        F.substring("block", side * i + 1, F.length("block") - side * i
                    - F.greatest(F.lit(0), base - side * (i + 1))).alias("part")))


def _variants() -> Column:
    """All variants of the part with at most one character deleted, as (hash, role).

    Role 0: equally long lines that agree but for the character at one position; members of
    such a group are all within one substitution. Role 1: the part of a shorter line, role 2: the
    part of a longer line less one character; the two are one insertion apart."""
    def shortened(tag, role: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length("part")), lambda i: F.struct(
            F.xxhash64("key", i if tag is None else tag, F.concat(
                F.left("part", i - 1), F.substring("part", i + 1, F.length("part"))))
            .alias("hash"), F.lit(role).alias("role")))

    whole = F.array(F.struct(F.xxhash64("key", F.lit(0), "part").alias("hash"),
                             F.lit(1).alias("role")))
    none = F.array().cast("array<struct<hash:bigint,role:int>>")
    some = F.length("part") > 0
    return F.when(F.col("longer"), F.when(some, shortened(F.lit(0), 2)).otherwise(none)).otherwise(
        F.concat(F.when(some, shortened(None, 0)).otherwise(none), whole))


def _shared(rows: DataFrame, key: str, line: str) -> DataFrame:
    """The keys that two or more lines have."""
    return (rows.groupBy(key).agg(F.min(line).alias("_low"), F.max(line).alias("_high"))
            .filter("_low <> _high").select(key))


def dedup_lines(docs: DataFrame, min_chars: int = 16) -> DataFrame:
    """Documents without the lines that repeat an earlier line.

    A line goes if an earlier line, ranked by (doc_id, line number), is equal after
    normalisation or, from ``min_chars`` characters on, within one edit (insertion, deletion or
    substitution of a character). Whether the earlier line itself stays does not matter to that.

    1. One pass over the texts gives each line's 128-bit id, place and half keys. Equal lines
       are one id from here on, so a line that a third of all documents share is one row.
    2. Half keys, then block keys within the half, that several lines share narrow down where
       lines may differ; both are variants with a stretch deleted and lose no pair.
    3. For those blocks all variants with a character deleted are emitted, hashed and
       grouped. A group needs only its earliest members by role, since members of a
       role-0 group are all within one edit and so are roles 1 and 2 of a group: no pairs
       are made, however large the group.
    4. The earliest partner of each line is confirmed by edit distance on the full lines.
    5. Removed places are gathered per document and the texts rebuilt.

    Texts that take part in 3 or 5 are picked where they are read by filters of fixed size, so
    the others are not shuffled.

    Returns the columns of ``docs`` with the text replaced, and n_lines (not blank), n_exact and
    n_near (removed lines that repeat an equal or a similar one). Blank lines stay and are not
    counted. Null text stays null. Null doc_ids rank last; rows of equal rank (repeated
    rows) keep their lines alike. An empty table gives no rows. Other columns pass.
    """
    others = [c for c in docs.columns if c != "text"]
    base = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_row"),
                       F.struct(*others).alias("_rest"), F.col("text").alias("_text"))
    lines = (base.select("_doc", "_row", F.posexplode(normalised_lines(F.col("_text")))
                         .alias("line_no", "text")).filter("text <> ''")
             .withColumn("n", F.length("text")))
    places = written(lines.select(
        "_doc", "_row", "line_no", F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), "text").alias("h2"),
        F.when(F.col("n") >= min_chars, F.expr(_HALF_KEYS)).alias("keys")), "line-places")
    firsts = written(places.groupBy(ID).agg(
        F.min(_rank(F.col("_doc"), F.col("line_no"))).alias("first"), F.count("*").alias("n")),
        "line-firsts")

    halves = places.select(*ID, F.posexplode("keys").alias("place", "key"))
    shared = written(_shared(halves, "key", "h1"), "line-halves")
    marked = (flagged(halves, bit_filter(shared, "key"), "key").filter("_maybe")
              .join(shared, "key").groupBy(ID)
              .agg(F.collect_set(F.struct("place", "key")).alias("halves")))  # 4 at most
    marked = written(marked, "line-marked")
    # one place of each marked line, to fetch its text
    at = (flagged(places, bit_filter(marked, "h1"), "h1").filter("_maybe")
          .join(marked.select(*ID), ID, "left_semi")
          .groupBy(ID).agg(F.min(F.struct("_doc", "_row", "line_no")).alias("at")))
    wanted = written(at.groupBy("at._doc", "at._row").agg(F.collect_list(
        F.struct("h1", "h2", "at.line_no")).alias("wanted")), "line-wanted")
    texts = flagged(base.select("_doc", "_row", "_text"), bit_filter(wanted, "_row"), "_row")
    fetched = (texts.filter("_maybe").alias("t").join(
        wanted.hint("merge").alias("w"), (F.col("t._row") == F.col("w._row"))
        & F.col("t._doc").eqNullSafe(F.col("w._doc")))
        .select(normalised_lines(F.col("_text")).alias("all"), F.explode("wanted").alias("w"))
        .select("w.h1", "w.h2", F.get("all", F.col("w.line_no")).alias("text"))
        .groupBy(ID).agg(F.any_value("text").alias("text")))  # repeated rows bring it twice
    marked = (fetched.join(marked, ID).join(firsts.select(*ID, "first"), ID)
              .select(F.struct("first", "h1", "h2").alias("line"), "text",
                      F.length("text").alias("n"), "halves"))
    marked = written(marked, "line-texts")

    blocks = (_half(marked.select("line", "text", "n", F.explode("halves").alias("x"))
                    .select("line", "text", "n", "x.place", "x.key"))
              .select("line", "longer", F.explode(_block_keys()).alias("x"))
              .select("line", "longer", "x.key", "x.part"))
    close = written(_shared(blocks.select("key", F.col("line.h1").alias("h1")), "key", "h1"),
                    "line-blocks")
    variants = written(blocks.join(close, "key").select("line", F.explode(_variants()).alias("v"))
                       .select("line", "v.hash", "v.role"), "line-variants")
    groups = (variants.groupBy("hash").agg(
        *[F.min(F.when(F.col("role") == r, F.col("line"))).alias(f"first{r}") for r in (0, 1, 2)],
        F.min("line.h1").alias("low"), F.max("line.h1").alias("high"))
        .filter("low <> high").drop("low", "high"))
    partner = (F.when(F.col("role") == 0, F.col("first0"))
               .when(F.col("role") == 1, F.col("first2")).otherwise(F.col("first1")))
    found = (variants.join(groups, "hash").withColumn("partner", partner)
             .filter("partner.first < line.first").groupBy("line")
             .agg(F.min("partner").alias("partner")))
    sides = marked.select("line", "text")
    near = (found.join(sides, "line")
            .join(sides.select(F.col("line").alias("partner"), F.col("text").alias("other")), "partner")
            .filter(F.levenshtein("text", "other", 1) >= 0)
            .select("line.h1", "line.h2", F.lit(True).alias("near")))

    several = written(firsts.join(near, ID, "left").filter("n > 1 OR near")
                      .select(*ID, "first", "near"), "line-several")
    gone = (flagged(places.select("_doc", "_row", "line_no", *ID), bit_filter(several, "h1"), "h1")
            .filter("_maybe").join(several, ID)
            .filter(F.col("near").isNotNull()
                    | (_rank(F.col("_doc"), F.col("line_no")) > F.col("first"))))
    gone = written(gone.groupBy("_doc", "_row").agg(
        F.collect_set(F.struct("line_no", F.col("near").isNotNull().alias("near"))).alias("gone")),
        "line-gone")
    told = flagged(base, bit_filter(gone, "_row"), "_row")
    none = F.lit(None).cast(gone.schema["gone"].dataType).alias("gone")
    met = (told.filter("_maybe").alias("b").join(
        gone.hint("merge").alias("g"), (F.col("b._row") == F.col("g._row"))
        & F.col("b._doc").eqNullSafe(F.col("g._doc")), "left").select("_rest", "_text", "gone"))
    out = told.filter("NOT _maybe").select("_rest", "_text", none).unionByName(met)
    split, numbers = F.split("_text", "\n"), F.col("gone.line_no")
    text = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(F.array_join(
        F.filter(split, lambda line, i: ~F.array_contains(numbers, i)), "\n"))
    near_count = F.coalesce(F.size(F.filter("gone", lambda g: g["near"])), F.lit(0))
    return out.select(
        *[F.col("_rest")[c].alias(c) if c != "text" else text.alias("text") for c in docs.columns],
        F.coalesce(F.size(F.filter(split, lambda x: x.rlike(NON_SPACE))), F.lit(0))
        .cast("long").alias("n_lines"),
        (F.coalesce(F.size("gone"), F.lit(0)) - near_count).cast("long").alias("n_exact"),
        near_count.cast("long").alias("n_near"))
