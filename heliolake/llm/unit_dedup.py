"""Substring deduplication by global grouping of unit digests."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliolake.llm.shared import bit_filter, flagged, written

#: Units end at line ends, after a sentence mark, and before a word with a capital, so a passage
#: set into the middle of another text has units of its own. Long units are cut further by content.
#: Runs of spaces are tried from their beginning only and never given back, so that long ones take
#: linear time.
_UNIT_END = re.compile(r"\n+|(?<=[.!?]) +|(?<! ) ++(?=[A-Z\u00c0-\u00de\u0370-\u03ff\u0400-\u042f])")
PAIRS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), *[
    (c, pa.int32()) for c in ("idx", "start", "stop", "before", "words")],
    ("h1", pa.int64()), ("h2", pa.int64())])
UNIT_PAIRS = ("doc_id long, row long, idx int, start int, stop int, before int, words int, "
              "h1 long, h2 long")
#: A pair with more than this part of all repeated rows is joined by broadcast, not by a shuffle.
HOT_PARTS = 1000
#: Odd numbers that weigh the digests of a pair's two units.
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: Longer units are cut further (words); pairs of words of which the least hash is a cut.
LONGEST, WIDTH = 12, 9
#: Scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han): a token is a character,
#: and two of them count as a word.
_DENSE = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
          "\uf900-\ufaff\U00020000-\U0003ffff")
_DENSE_CHAR, _TOKEN = re.compile(f"[{_DENSE}]"), re.compile(rf"[{_DENSE}]|[^\s{_DENSE}]+")


def _n_words(tokens: list[str], dense: bool) -> int:
    return len(tokens) - (sum(_DENSE_CHAR.match(t) is not None for t in tokens) // 2 if dense else 0)


def _digest(tokens: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(tokens).encode("utf-8", "surrogatepass"),
                           digest_size=16).digest()


def _cuts(tokens: list[str], width: int, gap: int) -> list[int]:
    """Where to cut, by content alone: between the two words whose hash is the smallest of
    ``width`` consecutive pairs. Any ``width`` + 1 words have a cut that the words around them do
    not move. Cuts less than ``gap`` words after another, or before the end, are left out."""
    raw = [t.encode("utf-8", "surrogatepass") for t in tokens]
    hashes = [crc32(y, crc32(x)) for x, y in zip(raw, raw[1:], strict=False)]
    out, last, least = [], 0, -1
    for i in range(len(hashes) - width + 1):
        end = i + width - 1
        if least < i:
            window = hashes[i:end + 1]
            least = end - window[::-1].index(min(window))
        elif hashes[end] <= hashes[least]:
            least = end
        if least + 1 - last >= gap and least + 1 <= len(tokens) - gap:
            last = least + 1
            out.append(last)
    return out


def units(text: str, min_words: int = 3) -> list[tuple[int, int, int, bytes]]:
    """(start, stop, words, digest) of the units; every word of the text lies in one.

    Consecutive units with fewer than ``min_words`` words are one; units of more than ``LONGEST``
    words are cut further. Offsets count characters of the original text. The digest is over the
    unit in lower case with white space squeezed."""
    out: list[tuple[int, int, int, bytes]] = []
    dense = not text.isascii() and _DENSE_CHAR.search(text) is not None

    def split(a: int, b: int) -> tuple[list[str], int]:
        tokens = _TOKEN.findall(text[a:b].lower()) if dense else text[a:b].lower().split()
        return tokens, _n_words(tokens, dense)

    def add(a: int, b: int, tokens: list[str], n: int) -> None:
        if n <= LONGEST:
            out.append((a, b, n, _digest(tokens)))
            return
        scale = 2 if 4 * (len(tokens) - n) > len(tokens) else 1  # mostly characters
        cuts = [0, *_cuts(tokens, WIDTH * scale, min_words * scale), len(tokens)]
        spans = [m.span() for m in _TOKEN.finditer(text, a, b)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            part = tokens[i:j]
            out.append((spans[i][0] if i else a, spans[j - 1][1] if j < len(tokens) else b,
                        _n_words(part, dense), _digest(part)))

    spans, start = [], 0
    for m in _UNIT_END.finditer(text):
        spans.append((start, m.start()))
        start = m.end()
    spans.append((start, len(text)))
    short: list[tuple[int, int]] = []
    for a, b in spans:
        tokens, n = split(a, b)
        if 0 < n < min_words:
            short.append((a, b))
        elif n:
            if short:
                add(short[0][0], short[-1][1], *split(short[0][0], short[-1][1]))
                short = []
            add(a, b, tokens, n)
    if short:
        add(short[0][0], short[-1][1], *split(short[0][0], short[-1][1]))
    return out


def _pairs(docs: list, rows: list, sizes: list[int], found: list[tuple]) -> pa.RecordBatch:
    """Pairs of consecutive units of the documents: where they lie, words, weighted digests."""
    start, stop, words, digests = zip(*found, strict=True) if found else ((), (), (), ())
    halves = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    counts = np.array(sizes, np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    idx = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    this = np.flatnonzero(idx > 0)
    last = this - 1
    start, stop, words = (np.array(x, np.int32) for x in (start, stop, words))
    both = (halves[last] * _FIRST + halves[this] * _SECOND).view(np.int64)
    of = pa.array(owner[this])
    return pa.record_batch([
        pa.array(docs, pa.int64()).take(of), pa.array(rows, pa.int64()).take(of),
        *map(pa.array, (idx[this].astype(np.int32), start[last], stop[this], words[last],
                        words[this], both[:, 0], both[:, 1]))], schema=PAIRS)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, rows, sizes, found = [], [], [], []
        for doc, row, text in zip(*(batch.column(c) for c in ("doc_id", "row", "text")),
                                  strict=True):
            here = units(text.as_py() or "")
            docs.append(doc.as_py())
            rows.append(row.as_py())
            sizes.append(len(here))
            found += here
            if len(found) > 50_000:
                yield _pairs(docs, rows, sizes, found)
                docs, rows, sizes, found = [], [], [], []
        yield _pairs(docs, rows, sizes, found)


def dedup_units(docs: DataFrame, min_words: int = 25) -> DataFrame:
    """Documents without the passages that occur earlier, with the offsets of what went.

    Units (lines, sentences, what begins with a capital inside one, and pieces of long ones cut by
    their own words) are digested, each together with the unit before it, and these digests are
    grouped globally; the earliest occurrence of a pair, ranked by (doc_id, position), stays. Of
    the others, runs of consecutive repeated pairs with ``min_words`` words or more are removed,
    so short phrases that any text may share stay. In a removed run every unit follows the one
    before it in some earlier place as well: sentences that stand in different documents do not
    make a passage, and words between two repeated units, however few, are a unit themselves and
    go only if they repeat there. The first occurrence of a unit always stays: a pair that holds
    it has no earlier one. A passage loses up to twelve words at either end to units it shares
    with its surroundings, a few more where the cuts there lie close together.

    Returns doc_id, text (what remains), n_repeated (units of repeated pairs), removed (array of
    start, stop, words in the original text's characters, and keep_doc_id, where the run's first
    pair stays). One row per input row. Null and empty texts, and those of one unit, have no
    pairs. Null doc_ids rank last; rows of equal rank (repeated rows) stay alike. An empty table
    gives no rows; other columns are ignored.

    Scale: digests combine within a task before they are grouped, so a pair that a third of
    the rows share is one row per task. Pairs that hold more than a thousandth of the repeated
    rows, fewer than a thousand, meet their first place by broadcast; for the others only pairs that
    repeat, and the few that a filter of fixed size takes for such, are shuffled. Texts that lose a passage are shuffled once to meet their
    spans; a like filter keeps most others out.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.xxhash64("text").alias("row"))
    found = written(base.mapInArrow(_pair_rows, UNIT_PAIRS), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("idx").alias("idx"))
    digest = ["h1", "h2"]
    # narrow numbers first: which digests repeat at all; then their earliest place
    several = written(found.groupBy(digest).agg(F.count("*").alias("n")).filter("n > 1"),
                      "units-several")
    total = several.agg(F.sum("n")).first()[0] or 0
    # each has more than a thousandth of the repeated rows: fewer than a thousand digests
    hot = F.broadcast(several.filter(F.col("n") * HOT_PARTS > total)
                      .select(*digest, F.lit(True).alias("hot")))
    maybe = (flagged(found, bit_filter(several, "h1"), "h1").filter("_maybe")
             .select(*PAIRS.names).join(hot, digest, "left"))
    rare = maybe.filter("hot IS NULL").join(several.select(digest), digest)
    again = written(maybe.filter("hot").unionByName(rare), "units-repeated")
    firsts = written(again.groupBy("hot", *digest).agg(F.min(rank).alias("first")), "units-firsts")
    met = [again.filter(part).drop("hot").join(side, digest) for part, side in (
        ("hot", F.broadcast(firsts.filter("hot").drop("hot"))),
        ("hot IS NULL", firsts.filter("hot IS NULL").drop("hot")))]
    later = met[0].unionByName(met[1]).filter(rank > F.col("first"))
    per_doc = ["doc_id", "row"]
    later = later.groupBy(*per_doc, "idx").agg(  # repeated rows bring it twice
        *[F.max(c).alias(c) for c in ("start", "stop", "before", "words")],
        F.max("first.doc_id").alias("keep_doc_id"))
    order = Window.partitionBy(per_doc).orderBy("idx")  # no more than a document's units
    runs = (later.withColumn("run", F.col("idx") - F.row_number().over(order))
            .groupBy(*per_doc, "run")
            .agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                 (F.sum("words") + F.min_by("before", "idx")).alias("words"),
                 F.min_by("keep_doc_id", "idx").alias("keep_doc_id"),
                 (F.count("*") + 1).alias("n")))
    spans = runs.groupBy(per_doc).agg(
        F.sum("n").alias("n_repeated"),
        F.sort_array(F.collect_list(F.when(F.col("words") >= min_words, F.struct(
            "start", "stop", "words", "keep_doc_id")))).alias("removed"))
    spans = written(spans, "unit-spans")
    told = flagged(base, bit_filter(spans, "row"), "row")
    met = (told.filter("_maybe").alias("b").join(
        spans.hint("merge").alias("s"), (F.col("b.row") == F.col("s.row"))
        & F.col("b.doc_id").eqNullSafe(F.col("s.doc_id")), "left")
        .select("b.doc_id", "text", "n_repeated", "removed"))
    joined = told.filter("NOT _maybe").select("doc_id", "text", *[
        F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in ("n_repeated", "removed")]
    ).unionByName(met)
    cuts = F.concat(F.array(F.lit(0)),
                    F.transform("removed", lambda r: r["stop"]))
    ends = F.concat(F.transform("removed", lambda r: r["start"]), F.array(F.length("text")))
    text = F.when(F.coalesce(F.size("removed"), F.lit(0)) <= 0, F.col("text")).otherwise(
        F.array_join(F.zip_with(cuts, ends, lambda a, b: F.substring("text", a + 1, b - a)), ""))
    empty = F.array().cast("array<struct<start:int,stop:int,words:bigint,keep_doc_id:bigint>>")
    return joined.select(
        "doc_id", text.alias("text"), F.coalesce("n_repeated", F.lit(0)).cast("long")
        .alias("n_repeated"), F.coalesce("removed", empty).alias("removed"))
