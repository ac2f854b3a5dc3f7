"""Near-duplicate detection by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliolake.llm.shared import written

_U = np.uint64


@dataclass(frozen=True)
class Banding:
    """``bands`` bands of ``rows`` signature coordinates over ``width``-word shingles.

    A pair of Jaccard similarity s shares no band with probability (1 - s**rows)**bands."""
    width: int = 5
    bands: int = 35
    rows: int = 5
    seed: int = 20240

    @classmethod
    def catching(cls, percent: int, miss: float = 1e-6, rows: int = 5) -> Banding:
        """Bands enough that a pair of just that similarity is missed less often than ``miss``."""
        return cls(bands=math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows)), rows=rows)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (in place)."""
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


class Shingler:
    """64-bit hashes of the word shingles of many texts at once.

    Words are runs of non-white-space (ASCII) after lower-casing A-Z. The hash of a word is a
    polynomial over its bytes modulo 2**64, read off prefix sums, then mixed."""

    def __init__(self, width: int, seed: int):
        rng = np.random.default_rng(seed)
        self.width = width
        self.byte = rng.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.base, self.inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
        self.at = rng.integers(1, 2**63, width, dtype=np.uint64) | _U(1)
        self.powers = self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, step in (("powers", self.base), ("back", self.inverse)):
                factors = np.full(n, step, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text; shorter texts have one shingle of
        all their words, texts without words none."""
        joined = np.frombuffer(b" " + b" ".join(t.lower() for t in texts) + b" ", np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        first = np.concatenate(([0], np.cumsum(sizes)))
        space = self.space[joined]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, end = edge[0::2], edge[1::2]
        self._grow(len(joined) + 1)
        prefix = np.cumsum(self.byte[joined] * self.powers[:len(joined)])
        words = _mix((prefix[end - 1] - prefix[start - 1]) * self.back[start]
                     ^ (end - start).astype(np.uint64))
        bounds = np.searchsorted(start, first)
        w = self.width
        n = max(len(words) - w + 1, 0)
        shingles = np.zeros(n, np.uint64)
        for k in range(w):
            shingles += words[k:k + n] * self.at[k]
        shingles = _mix(shingles)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= w:
                out.append(np.unique(shingles[a:b - w + 1]))
            elif b > a:
                part = (words[a:b] * self.at[:b - a]).sum(dtype=np.uint64, keepdims=True)
                out.append(_mix(part + _U(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
        return out


def circulant_bands(sets: list[np.ndarray], spec: Banding) -> np.ndarray:
    """One 64-bit key per set (none empty) and band.

    Circulant MinHash: sigma permutes the 64-bit universe once; coordinate k is the minimum over
    the set of pi(sigma(x) + k), the second permutation shifted circularly by k. Elements are taken in
    blocks that stay in the processor's cache; a long set is split and its minima joined."""
    s = _U(np.random.default_rng(spec.seed + 1).integers(1, 2**63))
    c1, c2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
    k = spec.bands * spec.rows
    low = np.full((len(sets), k), np.iinfo(np.uint64).max, np.uint64)
    step, i = 1 << 15, 0
    while i < len(sets):
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= step):
            total += len(sets[j])
            j += 1
        values = np.concatenate(sets[i:j])
        starts = np.concatenate(([0], np.cumsum([len(x) for x in sets[i:j - 1]]))).astype(np.int64) \
            if j - i > 1 else np.zeros(1, np.int64)
        for at in range(0, len(values), step) if j - i == 1 else (0,):
            part = values[at:at + step] if j - i == 1 else values
            sigma = _mix(part ^ s) * c1
            z, t = np.empty_like(sigma), np.empty_like(sigma)
            with np.errstate(over="ignore"):
                for c in range(k):
                    np.add(sigma, _U(c) * c1, out=z)
                    np.right_shift(z, _U(31), out=t)
                    np.bitwise_xor(z, t, out=z)
                    np.multiply(z, c2, out=z)
                    low[i:j, c] = np.minimum(low[i:j, c], np.minimum.reduceat(z, starts))
        i = j
    keys = np.zeros((len(sets), spec.bands), np.uint64)
    for b in range(spec.bands):
        keys[:, b] = _U(b + 1)
        for c in range(b * spec.rows, (b + 1) * spec.rows):
            keys[:, b] = _mix(keys[:, b] * _U(0x9E3779B97F4A7C15) + low[:, c])
    return keys.view(np.int64)


def _slices(texts: pa.Array, limit: int = 1 << 21) -> Iterator[list[bytes]]:
    """The texts as UTF-8 in runs of about ``limit`` bytes (a longer text comes alone)."""
    run, size = [], 0
    for value in texts.cast(pa.large_binary()):
        raw = value.as_py() or b""
        if run and size + len(raw) > limit:
            yield run
            run, size = [], 0
        run.append(raw)
        size += len(raw)
    if run:
        yield run


FEATURES = "doc_id long, n_shingles long, digest binary, bands array<long>"
SETS = "digest binary, shingles binary"


def _features(spec: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(spec.width, spec.seed)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column("text")):
                sets = shingler.sets(texts)
                keys = np.empty((len(sets), spec.bands), np.int64)
                full = [i for i, x in enumerate(sets) if len(x)]
                if full:
                    keys[full] = circulant_bands([sets[i] for i in full], spec)
                yield pa.record_batch([
                    batch.column("doc_id").slice(at, len(sets)),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([_digest(x) if len(x) else None for x in sets], pa.binary()),
                    pa.array([k.tolist() if len(x) else None for k, x in zip(keys, sets, strict=True)],
                             pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "digest", "bands"])
                at += len(sets)
    return run


def _set_rows(spec: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(spec.width, spec.seed)
        for batch in batches:
            for texts in _slices(batch.column("text")):
                sets = [x for x in shingler.sets(texts) if len(x)]
                yield pa.record_batch([pa.array([_digest(x) for x in sets], pa.binary()),
                                       pa.array([x.tobytes() for x in sets], pa.binary())],
                                      names=["digest", "shingles"])
    return run


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def similar(sets: list[np.ndarray], other: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets have 100 * |intersection| >= percent * |union|, exactly.

    Shingles of one set only are dropped; frequent ones are counted by matrix products in
    blocks of columns, rare ones pair by pair."""
    everything = sets + other if other is not sets else sets
    sizes = np.array([len(x) for x in everything], np.int64)
    owner = np.repeat(np.arange(len(everything), dtype=np.int32), sizes)
    values = np.concatenate(everything)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    count = np.bincount(column)
    begin = np.flatnonzero(new)
    inter = np.zeros((len(everything), len(everything)), np.float32)
    for f in range(2, 17):  # rare: f owners each
        at = begin[count == f]
        for a in range(f):
            for b in range(a + 1, f):
                np.add.at(inter, (owner[at + a], owner[at + b]), 1)
    inter += inter.T
    frequent = np.flatnonzero(count > 16)
    rank = np.full(len(count), -1, np.int64)
    rank[frequent] = np.arange(len(frequent))
    rank = rank[column]
    for low in range(0, len(frequent), 2048):
        mine = (rank >= low) & (rank < low + 2048)
        dense = np.zeros((len(everything), min(2048, len(frequent) - low)), np.float32)
        dense[owner[mine], rank[mine] - low] = 1
        inter += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - inter
    linked = 100 * inter.astype(np.float64) >= percent * union
    return linked[:len(sets), len(sets):] if other is not sets else linked


def _forest(linked: np.ndarray, ids: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``linked`` connects, at most one per member: a member and the
    smallest id it reaches."""
    nodes, where = np.unique(np.concatenate((ids, other)), return_inverse=True)
    a, b = np.nonzero(linked)
    a, b = where[:len(ids)][a], where[len(ids):][b]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if np.array_equal(after, label):
            return [(int(nodes[i]), int(nodes[x])) for i, x in enumerate(label) if x != i]
        label = after


def _links(percent: int):
    """Edges of every (bucket, block pair), whose rows come sorted together."""
    def of(rows: list[tuple[int, int, bytes]], left: int, right: int) -> list[tuple[int, int]]:
        sides = {left: ([], []), right: ([], [])}
        for side, node, raw in rows:
            sides[side][0].append(node)
            sides[side][1].append(np.frombuffer(raw, np.uint64))
        (ids, sets), (ids2, sets2) = sides[left], sides[right]
        if not ids or not ids2:
            return []
        if left == right and len(ids) == 2:
            x, y = sets
            n = len(np.intersect1d(x, y, assume_unique=True))
            hit = 100 * n >= percent * (len(x) + len(y) - n) and ids[0] != ids[1]
            return [(max(ids), min(ids))] if hit else []
        linked = similar(sets, sets if left == right else sets2, percent)
        return _forest(linked, np.array(ids), np.array(ids2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def close():
            found = of(rows, key[1], key[2]) if key else []
            return pa.record_batch([pa.array([x for x, _ in found], pa.int64()),
                                    pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            bucket, left, right, side, node = (batch.column(c).to_numpy() for c in
                                               ("bucket", "left", "right", "side", "node"))
            shingles = batch.column("shingles")
            for i in range(batch.num_rows):
                now = (bucket[i], left[i], right[i])
                if now != key:
                    yield close()
                    key, rows = now, []
                rows.append((side[i], node[i], shingles[i].as_py()))
        yield close()
    return run


def _to_roots(hooks: DataFrame) -> DataFrame:
    """Pointer doubling: (a, to) with ``to`` the root of a's tree, in log2(depth) joins."""
    while True:
        up = hooks.select(F.col("a").alias("x"), F.col("to").alias("up"))
        hooks = written(hooks.join(up, hooks["to"] == up["x"]).select(
            "a", F.col("up").alias("to"), (F.col("up") < F.col("to")).alias("moved")), "cc-jumps")
        if hooks.filter("moved").isEmpty():
            return hooks.select("a", "to")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over ``edges`` (a, b), for nodes on edges.

    Every round hooks each node to its smallest neighbour, follows the hooks to the roots of the
    trees they form, and contracts the edges to those roots. At least half of the nodes that have
    edges go in a round, so rounds and jumps are logarithmic, also on long paths. All steps
    are written to the shared folder; aggregation by node combines before the shuffle."""
    edges = written(edges.filter("a <> b").distinct(), "cc-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        hooks = _to_roots(written(both.groupBy("a").agg(F.min("b").alias("b"))
                                  .select("a", F.least("a", "b").alias("to")), "cc-hooks"))
        if labels is None:
            labels = hooks.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            labels = (labels.join(hooks, labels["root"] == hooks["a"], "left")
                      .select("node", F.coalesce("to", "root").alias("root")))
        labels = written(labels, "cc-labels")
        ends = hooks.select(F.col("a").alias("x"), F.col("to").alias("y"))
        edges = edges.join(ends, edges["a"] == ends["x"]).select(F.col("y").alias("a"), "b")
        edges = edges.join(ends, edges["b"] == ends["x"]).select("a", F.col("y").alias("b"))
        edges = written(edges.filter("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def near_duplicates(docs: DataFrame, percent: int = 80, spec: Banding | None = None,
                    block: int = 512, block_bytes: int = 32 << 20) -> DataFrame:
    """One row per document: n_shingles, component_id (smallest doc_id reachable over links), kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets,
    confirmed on the full sets (64-bit shingle hashes).

    1. One pass over the texts gives each document's set size, set digest and band keys.
    2. Equal sets become one class, whose node is its smallest doc_id: a group of copies is
       one node however large, combined before the shuffle.
    3. Classes that share a band key form a bucket; buckets of the same members count once.
    4. Members meet with their sets. A large bucket is split into blocks of at most ``block``
       members or ``block_bytes`` of sets, and every pair of blocks is compared in a task of its
       own, which returns a spanning forest of the links it confirmed, never the pairs. No
       bucket or partner is capped.
    5. Components over the forests.

    Rows of one doc_id are one node (repeated rows, or different texts of an id). Null, empty
    and wordless texts have no shingles and are linked with nothing. A row without doc_id
    joins the component of an equal set, else its component_id is null; kept is true where doc_id
    and component_id are the same, null included. An empty table gives no rows; other
    columns are ignored.
    """
    spec = spec or Banding.catching(percent)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    features = written(texts.mapInArrow(_features(spec), FEATURES), "near-features")
    classes = (features.filter("digest IS NOT NULL").groupBy("digest")
               .agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"),
                    F.any_value("bands").alias("bands")))
    classes = written(classes, "near-classes")
    named = classes.filter("node IS NOT NULL")
    banded = named.select("node", "n", F.explode("bands").alias("key"))
    buckets = (banded.groupBy("key")
               .agg(F.count("*").alias("size"), F.min("node").alias("low"),
                    F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"),
                    F.sum("n").alias("shingles"))
               .filter("size > 1")
               .groupBy("size", "low", "who").agg(F.min("key").alias("key"),
                                                  F.max("shingles").alias("shingles"))
               .select("key", F.greatest(F.ceil(F.col("size") / block),
                                         F.ceil(F.col("shingles") * 8 / block_bytes))
                       .cast("int").alias("blocks")))
    members = written(banded.select("node", "key").join(buckets, "key"), "near-members")
    wanted = members.select("node").distinct()
    # merged, never broadcast: the wanted ids grow with the documents
    found = (texts.join(wanted.hint("merge"), texts["doc_id"] == wanted["node"], "left_semi")
             .select("text").mapInArrow(_set_rows(spec), SETS))
    sets = (named.select("node", "digest").join(wanted, "node", "left_semi")
            .join(found.dropDuplicates(["digest"]), "digest").select("node", "shingles"))
    dealt = members.select(
        F.col("key").alias("bucket"), "node", "blocks",
        F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int").alias("side"))
    dealt = dealt.select("bucket", "node", "side", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("peer"))
    dealt = dealt.select("bucket", "node", "side", F.least("side", "peer").alias("left"),
                         F.greatest("side", "peer").alias("right"))
    pairs = (dealt.join(sets, "node").select("bucket", "left", "right", "side", "node", "shingles")
             .repartition("bucket", "left", "right")
             .sortWithinPartitions("bucket", "left", "right"))
    links = pairs.mapInArrow(_links(percent), "a long, b long")
    roots = components(links)
    joined = (classes.join(roots, classes["node"] == roots["node"], "left")
              .select("digest", F.coalesce("root", classes["node"]).alias("root")))
    # an id whose rows have different texts is one node
    out = (features.select("doc_id", "n_shingles", "digest")
           .join(joined, "digest", "left")
           .withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id"))
                       .otherwise(F.col("root"))))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
