"""Alignment of two tokenizers' tokens over the same bytes by diagonal run skipping.

Both token sequences are arrays of byte ends. While the tokens pair off one to one, the arrays
agree at a constant index shift; exponentially growing blocks are compared at that shift to jump
such stretches. Where they part, the irregular group is closed by a local walk to the next common
end, which gives the new shift.
"""

from __future__ import annotations

import contextlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliolake.llm.packing import FastTokens
from heliolake.llm.piece_encoder import SPACE_MARK, text_chunks
from heliolake.llm.shared import written

#: A pair of ids as one long: first id times this, plus second id.
PAIR = 1 << 24
#: Units of text whose ids a worker remembers, in two generations of this many at most.
MEMO = 1 << 18
#: Ids of a unit that the tokenizers do not spell alike.
UNLIKE = b""
#: Tokens of a one-to-one stretch that are compared one by one before and after whole blocks.
STEP = 16
#: Links of the documents that are counted together, about (a longer document is one block).
BLOCK_LINKS = 1 << 19

ALIGNED = ("block_id long, row_no int, doc_id long, n_a long, n_b long, n_groups long, "
           "n_links long, groups string, pair_at binary, times binary, pairs array<long>, "
           "pair_docs array<int>")
SCORED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


# ---------------------------------------------------------------- one document

def align(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Stretches and groups (a, a_stop, b, b_stop) that cover both arrays, in order.

    Both rise strictly and have the same last end. A result with as many tokens on either side is
    a stretch of one-to-one groups if its first ends agree; any other is one irregular group."""
    i, j, n = 0, 0, len(ends_a)
    while i < n:
        a, b, x, y = i, j, ends_a[i], ends_b[j]
        if x == y:
            shift, stop, width = j - i, min(i + STEP, n), STEP
            i += 1
            while i < stop and ends_a[i] == ends_b[i + shift]:
                i += 1
            if i == stop:  # grow while whole blocks agree at this shift, then halve to the edge
                while (block := ends_a[i:i + width]) and block == ends_b[i + shift:
                                                                         i + shift + width]:
                    i, width = i + len(block), 2 * width
                while width > STEP:
                    width //= 2
                    block = ends_a[i:i + width]
                    if block == ends_b[i + shift:i + shift + width]:
                        i += len(block)
                while i < n and ends_a[i] == ends_b[i + shift]:
                    i += 1
            j = i + shift
        else:
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            i, j = i + 1, j + 1
        yield a, i, b, j


class TokenPair:
    """Tokenizer A (byte-level BPE file, run on a space and the text) and tokenizer B
    (sentencepiece file, which adds the space itself) with the bytes of their tokens. The pattern
    that splits A's text must not join a space to the character before it."""

    def __init__(self, byte_bpe: str, pattern: str, pieces: str):
        from sentencepiece import SentencePieceProcessor
        self.a = FastTokens(byte_bpe, pattern)
        self.a.model.encode_special_tokens = True  # their strings are plain text
        n = self.a.limit  # tried at the starts of runs only: linear time
        self.long_run = re.compile(rf"(?<!\S)\S{{{n}}}|(?<!\s)\s{{{n}}}")
        self.b = SentencePieceProcessor(model_file=pieces)
        self.bytes_a = np.full(self.a.fast.n_vocab, b"", object)
        for i in range(self.a.fast.n_vocab):
            with contextlib.suppress(KeyError):  # ids may have gaps
                self.bytes_a[i] = self.a.fast.decode_single_token_bytes(i)
        self.bytes_b = np.array([self._piece_bytes(i) for i in range(self.b.vocab_size())], object)
        if max(len(self.bytes_a), len(self.bytes_b)) >= PAIR:
            raise ValueError(f"token ids must stay below {PAIR}")
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64)
                                    for t in (self.bytes_a, self.bytes_b))
        self.n_ids = n = max(len(self.bytes_a), len(self.bytes_b))
        #: Ids as text: inside a group, last of A's in it, last of B's in it.
        self.marked = np.array([f"{i}{mark}" for mark in ",|;" for i in range(n)], object)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.mark = self.b.piece_to_id(SPACE_MARK)
        self.by_unit = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.wide, self.border = re.compile(r"\s "), re.compile(r"(?<=\S)(?= )")
        #: Ids of A, then those of B inverted (below 0), as 32-bit integers.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def _units(self, text: str) -> list[str]:
        """The text cut before each space that follows a character that is no white space, without
        those spaces. Neither tokenizer joins a space to such a character, so units are encoded
        alike alone and in their text."""
        if not self.by_unit:
            return [text]
        units = text.split(" ")
        if "" in units or self.wide.search(text):
            units = [u[1:] for u in self.border.split(" " + text)]
        return units

    def _learn(self, units: set[str]) -> dict[str, bytes]:
        """Ids of both tokenizers for units that are not remembered: encoded as one text, whose
        ids are cut at the units' ends, or one by one if a unit ends with white space (the last
        of its text) or is not spelt alike."""
        order = [u for u in units if u and not u[-1].isspace()]
        new = self._spelt(order) if order else {}
        if UNLIKE in new.values():
            new = {}
        for unit in units - new.keys():
            new |= self._spelt([unit])
        for unit, entry in new.items():
            if len(unit) <= 64:
                if len(self.memo) >= MEMO:
                    self.older, self.memo = self.memo, {}
                self.memo[unit] = entry
        return new

    def _spelt(self, units: list[str]) -> dict[str, bytes]:
        text = " ".join(units)
        raw = (" " + text).encode()
        a = self._ids_a(" " + text)
        b = np.array(array("i", self.b.encode(text) if text else [self.mark]), np.int32)
        if (b"".join(self.bytes_a[a].tolist()) != raw
                or b"".join(self.bytes_b[b].tolist()) != raw):
            return dict.fromkeys(units, UNLIKE)
        ends = np.cumsum(list(map(len, units if text.isascii() else map(str.encode, units)))) \
            + np.arange(1, len(units) + 1)
        cut_a, cut_b = (np.searchsorted(size[ids].cumsum(), ends) + 1
                        for size, ids in ((self.size_a, a), (self.size_b, b)))
        raw_a, raw_b = a.tobytes(), (~b).tobytes()
        new, x, y = {}, 0, 0
        for unit, p, q in zip(units, (4 * cut_a).tolist(), (4 * cut_b).tolist(), strict=True):
            new[unit] = raw_a[x:p] + raw_b[y:q]
            x, y = p, q
        return new

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and byte ends of both; empty where either does not spell space and text."""
        none = (np.empty(0, np.int32),) * 2 + (np.empty(0, np.int64),) * 2
        if not text:
            return none
        units = self._units(text)
        found = list(map(self.memo.get, units))
        missed = [k for k, e in enumerate(found) if e is None]
        if missed:
            memo, older, left = self.memo, self.older, []
            for k in missed:
                unit = units[k]
                found[k] = e = older.get(unit)
                if e is None:
                    left.append(k)
                elif len(memo) < MEMO:  # still in use: outlives the next generation
                    memo[unit] = e
            new = self._learn({units[k] for k in left})
            for k in left:
                found[k] = new[units[k]]
        if not all(found):  # some unit is not spelt alike
            return none
        ids = np.frombuffer(b"".join(found), np.int32)
        of_a = ids >= 0
        a, b = ids[of_a], ~ids[~of_a]
        return a, b, self.size_a[a].cumsum(), self.size_b[b].cumsum()

    def _ids_a(self, text: str) -> np.ndarray:
        if len(text) > self.a.limit and self.long_run.search(text):
            return np.array(self.a.model.encode(text, add_special_tokens=False).ids, np.int32)
        return self.a.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()
                                           ).astype(np.int32)

    def aligned(self, text: str) -> tuple[int, int, int, str, np.ndarray]:
        """Tokens of A and of B, groups, the groups as text, and the pair of each link."""
        a, b, ends_a, ends_b = self.tokens(text)
        spans = np.fromiter(chain.from_iterable(align(ends_a.tolist(), ends_b.tolist())),
                            np.int64).reshape(-1, 4)
        i, i_stop, j, j_stop = spans[ends_a[spans[:, 0]] != ends_b[spans[:, 2]]].T
        odd_a, inner_a = _covered(len(a), i, i_stop)
        odd_b, inner_b = _covered(len(b), j, j_stop)
        n_groups = len(a) - np.count_nonzero(inner_a)

        sizes = np.empty(2 * n_groups, np.int64)  # tokens of A and of B, group by group
        sizes[::2] = np.diff(np.flatnonzero(~inner_a), prepend=-1)
        sizes[1::2] = np.diff(np.flatnonzero(~inner_b), prepend=-1)
        of_a = np.repeat(np.arange(2 * n_groups) % 2 == 0, sizes)
        marked = np.empty(len(of_a), np.int64)
        marked[of_a] = a + np.where(inner_a, 0, self.n_ids)
        marked[~of_a] = b + np.where(inner_b, 0, 2 * self.n_ids)
        groups = "".join(self.marked[marked].tolist())[:-1]

        # A link ends where either of its tokens ends: in an irregular group at each end of A and
        # at each of B but the last, which is A's last as well.
        of_a = np.repeat([True, False], (np.count_nonzero(odd_a), np.count_nonzero(inner_b)))
        order = np.concatenate([ends_a[odd_a], ends_b[inner_b]]).argsort(kind="stable")
        past_b = np.concatenate([~inner_a[odd_a], np.ones(len(of_a) - len(ends_a[odd_a]), bool)])
        of_a, past_b = of_a[order], past_b[order]
        left = np.concatenate([a[~odd_a], a[odd_a][of_a.cumsum() - of_a]])
        right = np.concatenate([b[~odd_b], b[odd_b][past_b.cumsum() - past_b]])
        return len(a), len(b), n_groups, groups, left.astype(np.int64) * PAIR + right


def _covered(n: int, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of n tokens lie in one of the groups start..stop-1, and which of them not last."""
    step = np.zeros(n + 1, np.int8)
    step[start] += 1
    step[stop] -= 1
    held = step[:-1].cumsum(dtype=np.int8).astype(bool)
    inner = held.copy()
    inner[stop - 1] = False
    return held, inner


@lru_cache(maxsize=2)
def token_pair(byte_bpe: str, pattern: str, pieces: str) -> TokenPair:
    """One pair of tokenizers per worker."""
    return TokenPair(byte_bpe, pattern, pieces)


# ---------------------------------------------------------------- blocks of documents

def _block(block_id: int, rows: list[tuple]) -> pa.RecordBatch:
    """One row per document; the first row carries the pairs of the whole block and how many of
    its documents hold each. Documents name their distinct pairs by place in that list."""
    links = np.concatenate([r[5] for r in rows])
    size = np.array([len(r[5]) for r in rows])
    owner = np.repeat(np.arange(len(rows)), size)
    found = pa.array(links).dictionary_encode()  # hashed: only the distinct pairs are sorted
    pairs = found.dictionary.to_numpy()
    order = pairs.argsort()
    pairs, place = pairs[order], np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = place[found.indices.to_numpy()]
    held, times = np.unique(owner * max(len(pairs), 1) + at, return_counts=True)
    owner, at = np.divmod(held, max(len(pairs), 1))
    docs = np.bincount(at, minlength=len(pairs)).astype(np.int32)
    cut = np.searchsorted(owner, np.arange(len(rows) + 1))
    at, times = at.astype("<u4"), times.astype("<u4")
    parts = list(zip(cut[:-1], cut[1:], strict=True))
    empty = [None] * (len(rows) - 1)
    return pa.record_batch([
        pa.array([block_id] * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int32()),
        *[pa.array([r[k] for r in rows], pa.int64()) for k in range(4)],
        pa.array(size, pa.int64()), pa.array([r[4] for r in rows], pa.string()),
        pa.array([at[x:y].tobytes() for x, y in parts], pa.binary()),
        pa.array([times[x:y].tobytes() for x, y in parts], pa.binary()),
        pa.array([pairs, *empty], pa.list_(pa.int64())),
        pa.array([docs, *empty], pa.list_(pa.int32()))], names=[
            "block_id", "row_no", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups",
            "pair_at", "times", "pairs", "pair_docs"])


def _aligned(byte_bpe: str, pattern: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(byte_bpe, pattern, pieces)
        block_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column("doc_id")
            for at, texts in text_chunks(batch):
                rows, links = [], 0
                for k, text in enumerate(texts):
                    n_a, n_b, n_groups, groups, found = pair.aligned(text)
                    rows.append((ids[at + k].as_py(), n_a, n_b, n_groups, groups, found))
                    links += len(found)
                    if links >= BLOCK_LINKS:
                        yield _block(block_id, rows)
                        block_id, rows, links = block_id + 1, [], 0
                if rows:
                    yield _block(block_id, rows)
                    block_id += 1
    return run


def align_documents(docs: DataFrame, byte_bpe: str, pattern: str, pieces: str) -> DataFrame:
    """Token groups and links of every whole text, one row per row of ``docs``.

    Returns doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2`` in ids) and, for
    ``link_counts``, the row's block, its distinct linked pairs by place in the block's list, how
    often each is linked, and on the block's first row that list and the number of documents
    that hold each pair. A block holds about ``BLOCK_LINKS`` links, or one longer document.
    Texts that are null, empty, or not spelt alike by both have no tokens: zeros and no groups.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return texts.mapInArrow(_aligned(byte_bpe, pattern, pieces), ALIGNED)


# ---------------------------------------------------------------- counts over all documents

def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums per document of one block from the corpus-wide counts of the block's pairs."""
    count = np.zeros(max(answers.num_rows, 1), np.int64)
    best = np.zeros(max(answers.num_rows, 1), bool)
    place = answers.column("place").to_numpy()
    count[place] = answers.column("docs").to_numpy()
    best[place] = answers.column("best").to_numpy(zero_copy_only=False)
    n_best, total = [], []
    for at, times in zip(docs.column("pair_at"), docs.column("times"), strict=True):
        at, times = np.frombuffer(at.as_py(), "<u4"), np.frombuffer(times.as_py(), "<u4")
        n_best.append(int(times[best[at]].sum()))
        total.append(int((count[at] * times).sum()))
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*[docs.column(c) for c in keep], pa.array(n_best, pa.int64()),
                     pa.array(total, pa.int64()), docs.column("groups_sha256")],
                    names=[*keep, "n_best", "count_sum", "groups_sha256"])


def link_counts(aligned: DataFrame) -> DataFrame:
    """Links of each document measured by how many documents hold the same pair linked.

    ``aligned`` is what ``align_documents`` returns with ``groups`` replaced by ``groups_sha256``;
    it is written once. Counting and asking go by block, not by document: a block adds each of its
    pairs once with its number of documents, and gets each pair's total back once. So a pair that
    every document holds is one row per block. The best count per first id is a table of one
    row per token of the first tokenizer's vocabulary, broadcast as such.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest count of
    its first id, ties included), count_sum (counts summed over links), groups_sha256. Rows with
    null or repeated doc_ids count as documents of their own; an empty table gives no rows.
    """
    aligned = written(aligned, "aligned", "zstd")
    blocks = aligned.filter("row_no = 0")
    totals = written(
        blocks.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_docs").alias("docs")), "pairs")
    first = F.floor(F.col("pair") / PAIR)
    top = totals.groupBy(first.alias("first")).agg(F.max("docs").alias("most"))  # <= vocabulary
    judged = (totals.withColumn("first", first).join(F.broadcast(top), "first")
              .select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")))
    asked = blocks.select("block_id", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(judged, "pair").select(
        F.col("block_id").alias("answered"), "place", "docs", "best")
    rows = aligned.drop("pairs", "pair_docs", "row_no")
    return (rows.groupBy("block_id").cogroup(answers.groupBy("answered"))
            .applyInArrow(_score, SCORED))
