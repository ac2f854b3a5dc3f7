"""Ranked lexical search over posting lists with per-term geometric blocks.

Documents lie in shards. In a shard each term's posting list is clustered by the likeness of its
documents into blocks, and a block keeps the coordinatewise maximum of its documents. A query
opens lists by falling weight and skips a block only if the bound from that summary proves that no
document of it can reach the score needed, so results are exact.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliolake.llm.shared import FILTER_ROWS, bit_filter, written

#: Terms are runs of ASCII letters and digits and of all other characters beyond ASCII.
_FOLD_CASE = bytes(b + 32 if 0x41 <= b <= 0x5A else
                   b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
                   for b in range(256))
#: Documents and postings of a shard at most (one longer document is a shard of its own).
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 21
#: Documents of a block; shorter lists than the second have no summary and are always scored.
BLOCK, LEAST = 256, 8
#: Coordinates of a summary; terms beyond share them, which keeps the bound valid.
WIDTH = 4096
#: Terms of the queries (with repeats between queries) that are searched in one pass.
PASS_TERMS = 20_000
#: Shards that give the first lower bound of each query's last score.
SEED_SHARDS = 64


# ---------------------------------------------------------------- terms

def _terms(bits: np.ndarray | None):
    """doc_id, n and distinct terms with their counts; only terms that the filter may hold."""
    mask = 64 * FILTER_ROWS - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = zlib.crc32
        for batch in batches:
            sizes, cuts, words, counts = [], [0], [], []
            texts = batch.column("text").cast(pa.binary())
            for text in texts:
                found = (text.as_py() or b"").translate(_FOLD_CASE).split()
                sizes.append(len(found))
                for word, times in Counter(found).items():
                    bit = crc(word) & mask
                    if bits is None or bits[bit >> 6] >> (bit & 63) & 1:
                        words.append(word)
                        counts.append(times)
                cuts.append(len(words))
            cuts = pa.array(cuts, pa.int32())
            yield pa.record_batch([
                batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(cuts, pa.array(words, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(cuts, pa.array(counts, pa.int32()))],
                names=["doc_id", "n", "terms", "times"])
    return run


def _vectors(rows: DataFrame, key: str, bits: np.ndarray | None = None) -> DataFrame:
    texts = rows.select(F.col(key).cast("long").alias("doc_id"), F.col("text").alias("text"))
    return texts.mapInArrow(_terms(bits),
                            "doc_id long, n long, terms array<string>, times array<int>")


# ---------------------------------------------------------------- the queries of one pass

@dataclass
class Queries:
    """Queries with numbered terms. ``partners`` of a term: the terms it is asked for with."""
    keys: list[int] = field(default_factory=list)
    names: list[int | None] = field(default_factory=list)
    terms: list[np.ndarray] = field(default_factory=list)
    number: dict[str, int] = field(default_factory=dict)
    weight: list[int] = field(default_factory=list)

    def add(self, key: int, name: int | None, terms: list[tuple[str, int]]) -> None:
        ids = []
        for term, weight in terms:
            if term not in self.number:
                self.number[term] = len(self.weight)
                self.weight.append(weight)
            ids.append(self.number[term])
        self.keys.append(key)
        self.names.append(name)
        self.terms.append(np.array(sorted(ids), np.int64))

    def partners(self) -> list[np.ndarray]:
        asked: list[list[np.ndarray]] = [[] for _ in self.weight]
        for ids in self.terms:
            for t in ids.tolist():
                asked[t].append(ids)
        return [np.unique(np.concatenate(a)) for a in asked]


def _impact(times: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Share of a term's weight that a document earns, in millionths (64-bit, rounding down)."""
    m = 50 + (50 * n * docs) // total
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


# ---------------------------------------------------------------- the index of one shard

SHARD = ("shard_id long, docs array<long>, cut binary, term binary, impact binary, list_term binary, "
         "list_cut binary, list_docs binary, list_top binary, block_cut binary, "
         "list_blocks binary, summary_cut binary, summary binary")
_TYPES = {"cut": np.int64, "term": np.int32, "impact": np.int32, "list_term": np.int32,
          "list_cut": np.int64, "list_docs": np.int32, "list_top": np.int64,
          "block_cut": np.int64, "list_blocks": np.int64, "summary_cut": np.int64,
          "summary": np.uint32}


def _rows_of(cut: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of ``rows`` and the start of each row among them."""
    size = cut[rows + 1] - cut[rows]
    start = np.cumsum(size) - size
    return np.repeat(cut[rows] - start, size) + np.arange(int(size.sum())), start


def _blocks(matrix: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows and block starts in it: rows go to the leader most like them.

    Leaders are evenly spaced rows; likeness is the weighted inner product over the leader's
    norm. Clusters longer than ``BLOCK`` are cut further."""
    n = len(matrix)
    if n <= BLOCK:
        return np.arange(n), np.zeros(1, np.int64)
    leaders = matrix[::BLOCK] * weight
    norm = np.sqrt((leaders * leaders).sum(axis=1)) + 1e-9
    nearest = np.argmax(matrix @ (leaders * weight / norm[:, None]).T, axis=1)
    order = np.argsort(nearest, kind="stable")
    nearest = nearest[order]
    new = np.flatnonzero(np.concatenate(([True], nearest[1:] != nearest[:-1])))
    size = np.diff(np.append(new, n))
    inside = np.arange(n) - np.repeat(new, size)
    return order, np.flatnonzero(inside % BLOCK == 0)


def build_shard(docs: list, cut: np.ndarray, term: np.ndarray, impact: np.ndarray,
                partners: list[np.ndarray], weight: np.ndarray) -> dict[str, np.ndarray]:
    """Posting lists of one shard with their blocks and summaries.

    Rows ``cut[d]:cut[d+1]`` of ``term`` and ``impact`` are document d."""
    owner = np.repeat(np.arange(len(docs)), np.diff(cut))
    by_term = np.argsort(term, kind="stable")
    terms, first = np.unique(term[by_term], return_index=True)
    list_cut = np.append(first, len(by_term))
    list_docs, listed = owner[by_term], impact[by_term]
    top = np.maximum.reduceat(listed, first) if len(first) else np.zeros(0, np.int64)
    place = np.full(len(partners), -1, np.int64)
    block_cut, list_blocks, summaries = [], [0], []
    for k, t in enumerate(terms.tolist()):
        low, high = int(list_cut[k]), int(list_cut[k + 1])
        if high - low >= LEAST:
            asked = partners[t]
            place[asked] = np.arange(len(asked)) % WIDTH
            rows = list_docs[low:high]
            at, _ = _rows_of(cut, rows)
            row = np.repeat(np.arange(len(rows)), cut[rows + 1] - cut[rows])
            column = place[term[at]]
            held = column >= 0
            row, column, value = row[held], column[held], impact[at[held]]
            if len(asked) > WIDTH:  # of terms that share a coordinate the largest is set last
                rising = np.argsort(value, kind="stable")
                row, column, value = row[rising], column[rising], value[rising]
            matrix = np.zeros((len(rows), min(len(asked), WIDTH)), np.float32)  # exact below 2^24
            matrix[row, column] = value
            scale = np.zeros(matrix.shape[1], np.float32)
            scale[place[asked]] = weight[asked]
            order, starts = _blocks(matrix, scale)
            list_docs[low:high] = rows[order]
            summaries.append(np.maximum.reduceat(matrix[order], starts, axis=0).astype(np.uint32))
            block_cut.append(starts)
            place[asked] = -1
        else:
            block_cut.append(np.zeros(0, np.int64))
            summaries.append(np.zeros((0, 0), np.uint32))
        list_blocks.append(list_blocks[-1] + len(block_cut[-1]))
    sizes = [s.size for s in summaries]
    return {"cut": cut, "term": term, "impact": impact, "list_term": terms, "list_cut": list_cut,
            "list_docs": list_docs, "list_top": top,
            "block_cut": np.concatenate(block_cut) if block_cut else np.zeros(0),
            "list_blocks": np.array(list_blocks), "summary_cut": np.cumsum([0, *sizes]),
            "summary": np.concatenate([s.ravel() for s in summaries]) if sizes else np.zeros(0)}


def _index(queries: Queries, docs_total: int, terms_total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partners, weight = queries.partners(), np.array(queries.weight, np.int64)
        number, shard_id = queries.number, TaskContext.get().partitionId() << 33
        docs: list = []
        n, terms, times, cut = [], [], [], [0]

        def close() -> pa.RecordBatch:
            nonlocal shard_id, docs, n, terms, times, cut
            size = np.diff(cut)
            impact = _impact(np.array(times, np.int64), np.repeat(np.array(n, np.int64), size),
                             docs_total, max(terms_total, 1))
            parts = build_shard(docs, np.array(cut, np.int64), np.array(terms, np.int64), impact,
                                partners, weight)
            out = pa.record_batch([
                pa.array([shard_id], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                *[pa.array([parts[c].astype(kind).tobytes()], pa.binary())
                  for c, kind in _TYPES.items()]], names=["shard_id", "docs", *_TYPES])
            shard_id += 1
            docs, n, terms, times, cut = [], [], [], [], [0]
            return out

        for batch in batches:
            for doc_id, size, words, counts in zip(*map(batch.column, range(4)), strict=True):
                found = [(number[w], c) for w, c in
                         zip(words.as_py(), counts.as_py(), strict=True) if w in number]
                if not found:
                    continue
                if docs and (len(docs) == SHARD_DOCS or len(terms) + len(found) > SHARD_POSTINGS):
                    yield close()
                docs.append(doc_id.as_py())
                n.append(size.as_py())
                terms += [t for t, _ in found]
                times += [c for _, c in found]
                cut.append(len(terms))
        if docs:
            yield close()
    return run


# ---------------------------------------------------------------- search in one shard

class Shard:
    """An indexed shard as the search reads it."""

    def __init__(self, row: dict, queries: Queries):
        for name, kind in _TYPES.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.docs = row["docs"]
        self.rank = np.argsort(np.argsort(np.array(
            [np.iinfo(np.int64).max if d is None else d for d in self.docs], np.int64),
            kind="stable"))
        self.list_of = np.full(len(queries.weight), -1, np.int64)
        self.list_of[self.list_term] = np.arange(len(self.list_term))
        self.dense = np.zeros(len(queries.weight), np.int64)

    def list(self, k: int) -> np.ndarray:
        return self.list_docs[self.list_cut[k]:self.list_cut[k + 1]]

    def open(self, k: int, columns: np.ndarray, weight: np.ndarray, needed: int) -> np.ndarray:
        """Documents of list ``k`` in blocks whose summary allows a score of ``needed`` from the
        terms at ``columns``."""
        docs, low, high = self.list(k), int(self.list_blocks[k]), int(self.list_blocks[k + 1])
        if high == low:
            return docs
        summary = self.summary[self.summary_cut[k]:self.summary_cut[k + 1]].reshape(high - low, -1)
        reach = summary[:, columns].astype(np.int64) @ weight >= needed
        if reach.all():
            return docs
        starts = self.block_cut[low:high]
        return docs[np.repeat(reach, np.diff(np.append(starts, len(docs))))]

    def scores(self, docs: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        self.dense[terms] = weight
        at, start = _rows_of(self.cut, docs)
        out = np.add.reduceat(self.impact[at] * self.dense[self.term[at]], start) \
            if len(at) else np.zeros(0, np.int64)
        self.dense[terms] = 0
        return out

    def best(self, terms: np.ndarray, weight: np.ndarray, partners: list[np.ndarray], k: int,
             needed: int, seeds: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best documents with a score of ``needed`` or more.

        Lists are opened by falling share of the score they can give. A document that no opened
        list holds gets its score from the lists left, so their sum, and block by block
        their summaries, bound it. With ``seeds`` only the first lists are opened, until
        they hold that many documents: some good scores, not all."""
        lists = self.list_of[terms]
        here = lists >= 0
        asked, given, lists = terms[here], weight[here], lists[here]
        share = given * self.list_top[lists]
        order = np.argsort(-share, kind="stable")
        left = np.cumsum(share[order][::-1])[::-1]
        found: list[np.ndarray] = []
        for step, i in enumerate(order.tolist()):
            if left[step] < needed or (seeds and sum(map(len, found)) >= seeds):
                break
            rest = order[step:]
            columns = np.searchsorted(partners[asked[i]], asked[rest]) % WIDTH
            found.append(self.open(int(lists[i]), columns, given[rest], needed))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs = np.unique(np.concatenate(found)).astype(np.int64)
        score = self.scores(docs, asked, given)
        enough = score >= max(needed, 1)
        docs, score = docs[enough], score[enough]
        first = np.lexsort((self.rank[docs], -score))[:k]
        return docs[first], score[first]


def _search(queries: Queries, needed: list[int], k: int, seeds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partners, weight = queries.partners(), np.array(queries.weight, np.int64)
        # the k-th best score seen by this task raises what later shards must reach
        seen = [np.zeros(0, np.int64) for _ in queries.keys]
        bound = list(needed)
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.slice(row, 1).to_pylist()[0], queries)
                keys, names, docs, scores = [], [], [], []
                for q, terms in enumerate(queries.terms):
                    place, score = shard.best(terms, weight[terms], partners, k, bound[q], seeds)
                    if len(score):
                        seen[q] = -np.sort(-np.concatenate((seen[q], score)))[:k]
                        if len(seen[q]) == k:
                            bound[q] = max(bound[q], int(seen[q][-1]))
                    keys += [queries.keys[q]] * len(place)
                    names += [queries.names[q]] * len(place)
                    docs += [shard.docs[d] for d in place.tolist()]
                    scores += score.tolist()
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(names, pa.int64()),
                                       pa.array(docs, pa.int64()), pa.array(scores, pa.int64())],
                                      names=["item_key", "item_id", "doc_id", "score"])
    return run


FOUND = "item_key long, item_id long, doc_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query; Spark cuts each partition to k before the shuffle."""
    by = Window.partitionBy("item_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def search_pass(vectors: DataFrame, queries: Queries, docs_total: int, terms_total: int,
                k: int) -> DataFrame:
    """Index for the terms of ``queries``, written, and the search in it."""
    index = written(vectors.mapInArrow(_index(queries, docs_total, terms_total), SHARD),
                    "search-index", "zstd")
    none = [0] * len(queries.keys)
    few = index.select("shard_id").orderBy(F.xxhash64("shard_id")).limit(SEED_SHARDS)
    seeds = index.join(F.broadcast(few), "shard_id").mapInArrow(
        _search(queries, none, k, 4 * k), FOUND)
    last = _ranked(seeds, k).filter(F.col("rank") == k).select("item_key", "score").collect()
    bound = {r["item_key"]: r["score"] for r in last}  # one row per query of the pass at most
    return index.mapInArrow(
        _search(queries, [bound.get(q, 0) for q in queries.keys], k, 0), FOUND)


def search_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents for each row of ``items`` (item_id, text).

    Term weights and length norms count over all rows of ``docs``. Each text is read once and
    kept as its length and its terms that some query may hold (a filter of fixed size picks
    them). Queries pass the driver in passes of about ``PASS_TERMS`` terms; per pass the kept
    terms are indexed in shards of at most ``SHARD_DOCS`` documents, some shards give a first lower
    bound for each query's last place, and all shards are searched with it. A shard returns
    at most k documents per query, none below the bound.

    Returns item_id, rank, doc_id, score: scores above 0, equal ones by rising doc_id (nulls
    last). Null and empty texts have no terms: such queries give no rows, such documents
    are never found and do not count. Repeated rows, of either table, are rows of their own. Other
    columns are ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = written(_vectors(items, "item_id").withColumn(
        "item_key", F.monotonically_increasing_id()), "search-items")
    terms = asked.select("item_key", F.col("doc_id").alias("item_id"), F.explode("terms").alias("term"))
    bits = np.zeros(FILTER_ROWS, np.uint64)
    for row in bit_filter(terms.select(F.crc32(F.encode("term", "UTF-8")).alias("key")),
                          "key").collect():  # FILTER_ROWS at most
        bits[row["_word"]] = np.uint64(row["_mask"] & 0xFFFF_FFFF_FFFF_FFFF)
    vectors = written(_vectors(docs, "doc_id", bits), "search-vectors", "zstd")
    total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df"))
    ratio = F.lit(float(2 * total["docs"] + 2)) / (2 * F.col("df") + 1).cast("double")
    weighed = terms.join(held, "term").withColumn(
        "weight", F.floor(1000 * F.log(ratio)).cast("long"))
    questions = written(weighed.groupBy("item_key", "item_id").agg(
        F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("terms")), "search-queries")
    found, queries, size = [], Queries(), 0
    for row in questions.orderBy("item_key").toLocalIterator():  # one pass's queries at a time
        if size and size + len(row["terms"]) > PASS_TERMS:
            found.append(search_pass(vectors, queries, total["docs"], total["terms"], k))
            queries, size = Queries(), 0
        queries.add(row["item_key"], row["item_id"], [(t["term"], t["weight"]) for t in row["terms"]])
        size += len(row["terms"])
    if size:
        found.append(search_pass(vectors, queries, total["docs"], total["terms"], k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return _ranked(rows, k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
