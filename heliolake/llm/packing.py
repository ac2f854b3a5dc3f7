"""Packing token streams into fixed-length sequences by cutting-stock column generation."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliolake.llm.shared import written


# ---------------------------------------------------------------- the plan (lengths only)

@dataclass(frozen=True)
class Slot:
    """Where remainders of ``length`` tokens with rank low..high-1 go.

    In a pattern (``stream`` false) the one of rank r goes whole to sequence ``sequence`` + r - low
    at ``offset``. In the stream they lie end to end from position ``offset`` on, and sequences
    from ``sequence`` on are cut from it."""
    length: int
    low: int
    high: int
    sequence: int
    offset: int
    stream: bool = False


def _price(duals: np.ndarray, lengths: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable pattern at these duals."""
    value, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(int(lengths[0]), room + 1):
        n = np.searchsorted(lengths, w, "right")
        got = value[w - lengths[:n]] + duals[:n]
        k = int(np.argmax(got))
        if got[k] > value[w - 1] + 1e-12:
            value[w], choice[w] = got[k], k
        else:
            value[w] = value[w - 1]
    pattern, w = np.zeros(len(lengths)), room
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[choice[w]] += 1
            w -= int(lengths[choice[w]])
    return float(value[room]), pattern


def _first_basis(lengths: np.ndarray, counts: np.ndarray, room: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Patterns, one column per length, and their use: a feasible start near the optimum.

    The longest length left is filled up with the longest that fit, and the pattern is used until
    one of its lengths runs out; that length owns the column and occurs in no later one, so
    the columns are independent. Lengths that ran out together own a column that is not used."""
    m = len(lengths)
    columns, use, left = np.zeros((m, m)), np.zeros(m), counts.copy()
    owned = np.zeros(m, bool)
    for top in range(m - 1, -1, -1):
        while left[top] > 0:
            pattern, free, i = np.zeros(m), room, top
            while i >= 0 and free > 0:
                if left[i] > 0 and lengths[i] <= free:
                    take = min(free // lengths[i], max(1, left[i] // 1)) if i != top else 1
                    pattern[i] += take
                    free -= int(take * lengths[i])
                i = min(i, int(np.searchsorted(lengths, free, "right"))) - 1
            items = np.flatnonzero(pattern)
            times = left[items] / pattern[items]
            owner = items[int(np.argmin(times))]
            columns[:, owner], use[owner], owned[owner] = pattern, times.min(), True
            left[items] = np.maximum(left[items] - times.min() * pattern[items], 0)
            left[owner] = 0
            left[left < 1e-9] = 0
    for i in np.flatnonzero(~owned):
        columns[i, i] = room // lengths[i]
    return columns, use


def column_generation(lengths: np.ndarray, counts: np.ndarray, room: int, gap: float = 5e-4,
                      max_columns: int = 600) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear relaxation uses them.

    Minimises the number of sequences that hold ``counts`` of each length. Each step prices a
    column by the knapsack at the current duals and pivots it into the basis. Stops when no
    column helps, when the value is within ``gap`` of the area bound, or after
    ``max_columns`` columns: what the patterns leave is packed by plan_packing all the same."""
    columns, x = _first_basis(lengths, counts, room)
    inverse = np.linalg.inv(columns)
    area = float(lengths @ counts) / room
    for _ in range(max_columns):
        if x.sum() <= area * (1 + gap) + 1e-9:
            break
        best, pattern = _price(np.maximum(inverse.sum(axis=0), 0), lengths, room)
        if best <= 1 + 1e-7:
            break
        step = inverse @ pattern
        ratios = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        x = np.maximum(x - ratios[out] * step, 0)
        x[out] = ratios[out]
        columns[:, out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    return [(columns[:, k], float(x[k])) for k in np.flatnonzero(x > 1e-9)]


def plan_packing(counts: dict[int, int], room: int) -> tuple[list[Slot], int]:
    """Slots that place every remainder once, and the number of sequences.

    Patterns that fill a sequence are used floor(x) times. What rounding leaves (a few per length)
    is packed best-fit by falling length. Remainders that no full sequence takes are cut
    freely: they lie end to end in a stream that is cut at ``room``, so one sequence at most
    is padded, and none of them is cut more than once."""
    if not counts:
        return [], 0
    lengths = np.array(sorted(counts), np.int64)
    left = np.array([counts[n] for n in lengths.tolist()], np.int64)
    rank = np.zeros(len(lengths), np.int64)
    slots: list[Slot] = []
    sequence = 0

    def place(items: list[int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for i in items:
            n = int(lengths[i])
            slots.append(Slot(n, int(rank[i]), int(rank[i]) + times, sequence, offset))
            rank[i] += times
            left[i] -= times
            offset += n
        sequence += times

    patterns = column_generation(lengths, left.astype(float), room)
    for pattern, times in sorted(patterns, key=lambda c: -c[1]):
        items = np.flatnonzero(pattern)
        if int(lengths[items] @ pattern[items]) != room:
            continue
        whole = int(min(times + 1e-6, *(left[items] // pattern[items].astype(np.int64))))
        if whole:
            place([i for i in items.tolist() for _ in range(int(pattern[i]))], whole)
    spare = np.minimum(left, 64)  # of a length that is still plentiful the rest goes to the stream
    bins: list[tuple[int, list[int]]] = []
    by_room: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        n = int(lengths[i])
        for _ in range(int(spare[i])):
            fit = n if by_room.get(n) else min((r for r, b in by_room.items() if r > n and b),
                                               default=0)
            if fit:
                at = by_room[fit].pop()
            else:
                bins.append((room, []))
                at, fit = len(bins) - 1, room
            bins[at] = (fit - n, [*bins[at][1], i])
            by_room.setdefault(fit - n, []).append(at)
    for free, items in bins:
        used = room - free
        if not used & (used - 1) or not free:
            place(items, 1)
    position = 0
    for i in np.flatnonzero(left).tolist():
        n, times = int(lengths[i]), int(left[i])
        slots.append(Slot(n, int(rank[i]), int(rank[i]) + times, sequence, position, True))
        position += n * times
    return slots, sequence + -(-position // room)


# ---------------------------------------------------------------- tokens

class FastTokens:
    """Token ids of texts, as the ``tokenizers`` file at ``path`` gives them.

    The byte-level BPE of that file is run by tiktoken on the file's own vocabulary (ids are merge
    ranks), which gives the same ids several times faster and without a cache; added tokens
    in a text become their ids there too. Texts with a word or white space beyond
    ``long_run`` characters, where tiktoken's merging slows down, go to ``tokenizers``."""

    def __init__(self, path: str, pattern: str, long_run: int = 5000):
        import tiktoken
        from tokenizers import Tokenizer
        self.model, self.limit = Tokenizer.from_file(path), long_run
        self.long_run = re.compile(rf"\S{{{long_run}}}|\s{{{long_run}}}")
        added = {t.content: i for i, t in self.model.get_added_tokens_decoder().items()}
        raw = _byte_of_letter()
        ranks = {bytes(raw[c] for c in word): i
                 for word, i in self.model.get_vocab(with_added_tokens=False).items()
                 if word not in added}
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks,
                                      special_tokens=added)

    def encode(self, text: str) -> np.ndarray:
        if len(text) > self.limit and self.long_run.search(text):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def _byte_of_letter() -> dict[str, int]:
    """Byte-level BPE writes bytes as letters: printable Latin-1 as itself, the others in turn
    from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(x for x in range(256) if x not in plain):
        out[chr(0x100 + k)] = b
    return out


TOKENS = ("row_id long, doc_id long, ids binary, n long, rest int, whole int, first_whole long")


def _tokenise(path: str, pattern: str, end_id: int, room: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = FastTokens(path, pattern), np.array([end_id], np.uint32)
        start = TaskContext.get().partitionId() << 33
        row, whole_before = start, start
        for batch in batches:
            texts, at = batch.column("text"), 0
            while at < batch.num_rows:
                ids, size = [], 0
                while at + len(ids) < batch.num_rows and size < 1 << 20:
                    ids.append(np.concatenate((tokens.encode(texts[at + len(ids)].as_py() or ""), end)))
                    size += len(ids[-1])
                n = np.array([len(x) for x in ids], np.int64)
                whole = n // room
                first = whole_before + np.concatenate(([0], np.cumsum(whole)[:-1]))
                yield pa.record_batch([
                    pa.array(np.arange(row, row + len(ids)), pa.int64()),
                    batch.column("doc_id").slice(at, len(ids)),
                    pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    pa.array(n, pa.int64()), pa.array((n % room).astype(np.int32)),
                    pa.array(whole.astype(np.int32)), pa.array(first, pa.int64())],
                    names=["row_id", "doc_id", "ids", "n", "rest", "whole", "first_whole"])
                row, at, whole_before = row + len(ids), at + len(ids), whole_before + int(whole.sum())
    return run


# ---------------------------------------------------------------- the operator

def _slot_frame(spark: SparkSession, slots: list[Slot]) -> DataFrame:
    return spark.createDataFrame(
        [(s.length, s.low, s.high, s.sequence, s.offset, s.stream) for s in slots],
        "s_length int, low long, high long, sequence long, s_offset long, stream boolean")


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, room: int = 1024,
                   end_id: int = 0, salts: int = 64) -> DataFrame:
    """Pieces of tokenised documents, laid into sequences of at most ``room`` tokens.

    ``tokenizer`` is a byte-level BPE file of the ``tokenizers`` library and ``pattern`` the
    expression that splits its pre-tokens. A document's ids end with ``end_id``. Each full ``room`` of ids is a sequence of its own; the
    rest, shorter than ``room``, goes where the cutting-stock plan puts its length and rank.
    Only the histogram of rest lengths (fewer than ``room`` rows) and the plan made from it
    (a few slots per length) pass the driver. Ranks count within (length, one of ``salts``
    hash groups), so a length that a third of all documents share is no hot key.

    Returns doc_id, start (ids of its document before the piece), length, ids (binary,
    little-endian unsigned 32 bits), doc_tokens, sequence_id, offset. Null and empty texts
    have ``end_id`` alone; repeated rows and null ids are packed row by row; an empty table
    gives no rows; other columns are ignored. A document's pieces cover each id once.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    tokens = written(texts.mapInArrow(_tokenise(tokenizer, pattern, end_id, room), TOKENS),
                     "pack-tokens", "zstd")
    rests = tokens.filter("rest > 0").select(
        "row_id", "doc_id", "rest", F.pmod(F.xxhash64("row_id"), F.lit(salts)).alias("salt"))
    counts = written(rests.groupBy("rest", "salt").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["rest"]: r["n"] for r in
                 counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # < room rows
    slots, planned = plan_packing(histogram, room)
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("rest", "salt",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # fewer than room * salts rows
    ranked = (rests.withColumn("k", F.row_number().over(
        Window.partitionBy("rest", "salt").orderBy("doc_id", "row_id")) - 1)
        .join(F.broadcast(starts), ["rest", "salt"])
        .select("row_id", "rest", (F.col("start") + F.col("k")).alias("rank")))
    placed = ranked.join(F.broadcast(_slot_frame(spark, slots)),
                         (F.col("rest") == F.col("s_length")) & (F.col("rank") >= F.col("low"))
                         & (F.col("rank") < F.col("high")))
    nth, n = F.col("rank") - F.col("low"), F.col("rest").cast("long")
    at = F.col("s_offset") + nth * n
    inside = F.when(F.col("stream"), F.least(n, room - F.pmod(at, F.lit(room)))).otherwise(n)
    first = F.struct(
        F.lit(0).cast("long").alias("first"), inside.alias("length"),
        (F.col("sequence") + F.when(F.col("stream"), F.floor(at / room)).otherwise(nth))
        .alias("sequence_id"),
        F.when(F.col("stream"), F.pmod(at, F.lit(room))).otherwise(F.col("s_offset")).alias("offset"))
    second = F.struct(inside.alias("first"), (n - inside).alias("length"),
                      (F.col("sequence") + F.floor(at / room) + 1).alias("sequence_id"),
                      F.lit(0).cast("long").alias("offset"))
    placed = placed.select("row_id", F.filter(F.array(first, second), lambda t: t["length"] > 0)
                           .alias("tail"))
    whole_ids = F.lit(planned).cast("long") + F.col("first_whole")
    whole = F.when(F.col("whole") > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("whole").cast("long") - 1),
        lambda c: F.struct((c * room).alias("start"), F.lit(room).cast("long").alias("length"),
                           (whole_ids + c).alias("sequence_id"),
                           F.lit(0).cast("long").alias("offset"))))
    tail = F.transform("tail", lambda t: F.struct(
        (F.col("whole").cast("long") * room + t["first"]).alias("start"), t["length"].alias("length"),
        t["sequence_id"].alias("sequence_id"), t["offset"].alias("offset")))
    none = F.array().cast("array<struct<start:long,length:long,sequence_id:long,offset:long>>")
    # the token table is sorted by nothing: hash the narrow side instead of sorting the wide one
    pieces = (tokens.join(placed.hint("shuffle_hash"), "row_id", "left")
              .select("doc_id", "ids", "n", F.explode(
                  F.concat(F.coalesce(whole, none), F.coalesce(tail, none))).alias("p")))
    return pieces.select(
        "doc_id", "p.start", "p.length",
        F.expr("substring(ids, CAST(4 * p.start + 1 AS INT), CAST(4 * p.length AS INT))")
        .alias("ids"), F.col("n").alias("doc_tokens"), "p.sequence_id", "p.offset")
