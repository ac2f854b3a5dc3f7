"""SentencePiece BPE encoding by each prefix's last token, and decoding.

The encoding of every prefix of a text ends in exactly one token, and tokens of which each is
compatible with the next are the encoding of their text. A left-to-right pass asks a trie for the
longest piece that starts at the end of a prefix and takes the longest of its prefixes that is
compatible with the prefix's last token; a prefix that none continues is left and not met again.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
#: Encodings of short segments are remembered per worker, in two generations of this many at most.
MEMO = 1 << 18
#: Characters of the longest segment remembered.
SHORT = 32


class Memo(dict):
    """Packed ids of segments as ``encode`` finds them, in two generations of ``MEMO`` at most."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        found = self.older.get(segment)
        if found is None:
            found = array("i", self.encode(segment)).tobytes()
        if len(segment) <= SHORT:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[segment] = found
        return found


class PieceTable:
    """The pieces, merges and trie of the sentencepiece BPE model at ``path``.

    A merge joins two neighbours whose text is a piece; better-scored pieces go first, leftmost
    among equals. Models must have byte pieces for characters without a piece. Pieces of equal
    score must be runs of the space mark with the worst score of all (they are merged last);
    any other model raises ValueError.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        model, size = self.model, self.model.vocab_size()
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not supported")
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(model.is_byte, self.bytes)):
            raise ValueError("the model has no byte pieces")
        plain = {model.id_to_piece(i): i for i in range(size)
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        long = [p for p in plain if len(p) > 1]
        uses = Counter(model.get_score(plain[p]) for p in long)
        runs = [p for p in long if p.strip(SPACE_MARK) == ""]
        late = {p for p in long if uses[model.get_score(plain[p])] > 1} or set()
        if late:
            worst = min(uses)
            if late != set(runs) or any(model.get_score(plain[p]) != worst for p in late):
                raise ValueError("pieces other than runs of the space mark share a score")
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) or p.startswith(SPACE_MARK * 2)
               for p in long if p not in late):
            raise ValueError("a piece holds a space mark after another character")
        self.run_ids = {len(p): plain[p] for p in late}
        self.mark = plain[SPACE_MARK]
        self.reach = max(map(len, plain))
        self.length = [0] * size
        for p, i in plain.items():
            self.length[i] = len(p)
        # rank: order of merging; single characters are there from the start
        self.rank = [-1] * size
        self.parts: list[tuple[int, int]] = [(0, 0)] * size
        self.whole: dict[tuple[int, int], int] = {}
        self._seen: dict[int, bool] = {}
        early = sorted((p for p in long if p not in late),
                       key=lambda p: (-model.get_score(plain[p]), plain[p]))
        for k, p in enumerate(early):
            self.rank[plain[p]] = k
        for p in early:
            for cut in range(1, len(p)):
                left, right = plain.get(p[:cut]), plain.get(p[cut:])
                if left is not None and right is not None and p[:cut] not in late:
                    self.whole[left, right] = plain[p]
        for k, p in enumerate(early):
            self.parts[plain[p]] = self._last_merge(p, k, plain)
        # per prefix of a piece the longest piece it starts with, per piece the next shorter one
        self.trie = ahocorasick.Automaton()
        self.longest: dict[str, int] = {}
        self.shorter = [0] * size
        merged = {p: i for p, i in plain.items() if p not in late}
        for p, i in merged.items():
            self.trie.add_word(p, i)
            found = 0
            for end in range(1, len(p)):
                found = self.longest[p[:end]] = merged.get(p[:end], found)
            self.longest[p], self.shorter[i] = i, found
        # no piece spans the start of a run of marks, nor a line break unless a piece holds one
        ends = "" if any("\n" in p for p in plain) else "\n"
        self.segments = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}{ends}]*|[^{SPACE_MARK}{ends}]+"
                                   + (f"|{ends}+" if ends else ""))
        # the same cuts by splitting, for texts without runs of marks
        self.cuts = [SPACE_MARK, *ends]
        self.memo = Memo(self._encode_segment)

    @property
    def older(self) -> dict[str, bytes]:
        return self.memo.older

    def _last_merge(self, piece: str, rank: int, plain: dict[str, int]) -> tuple[int, int]:
        """The two tokens whose merge makes ``piece``: the pair of earlier tokens that stand side
        by side when all earlier merges of its text are done."""
        for cut in range(1, len(piece)):
            left, right = plain.get(piece[:cut]), plain.get(piece[cut:])
            if left is None or right is None or max(self.rank[left], self.rank[right]) >= rank:
                continue
            if self._apart(left, right, rank):
                return left, right
        raise ValueError(f"piece {piece!r} is not made by merges of better-scored pieces")

    def _apart(self, left: int, right: int, limit: float = float("inf")) -> bool:
        """Whether neighbours ``left`` and ``right`` stay apart until merge ``limit``.

        Their making is undone, latest merge first. At each step the tokens that meet at the border
        exist until the merge just undone; a better-ranked merge across it would have come first.
        """
        while True:
            across = self.whole.get((left, right))
            if across is not None and self.rank[across] < limit:
                return False
            a, b = self.rank[left], self.rank[right]
            if a > b:
                limit, left = a, self.parts[left][1]
            elif b >= 0:  # of equal pieces the left one was made first and would lose the tie
                limit, right = b + 1, self.parts[right][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        """Whether the texts of two tokens, joined, are encoded as just these two tokens."""
        key = left << 32 | right
        found = self._seen.get(key)
        if found is None:
            if len(self._seen) >= 1 << 20:
                self._seen.clear()
            found = self._seen[key] = self._apart(left, right)
        return found

    def _encode_segment(self, text: str) -> list[int]:
        length, shorter, seen = self.length, self.shorter, self._seen
        ids: list[int] = []
        at, n, last = 0, len(text), 0  # 0 and bytes: compatible with every token after them
        left: set[int] = set()  # prefixes whose last token no piece continues
        while at < n:
            known = self.trie.longest_prefix(text[at:at + self.reach])
            if not known:  # no piece holds this character
                ids += [self.bytes[b] for b in text[at].encode()]
                at, last = at + 1, 0
                continue
            piece = self.longest[text[at:at + known]]
            while True:
                end = at + length[piece]
                if end not in left:
                    fits = seen.get(last << 32 | piece)
                    if fits or fits is None and self.compatible(last, piece):
                        ids.append(piece)
                        at, last = end, piece
                        break
                piece = shorter[piece]
                while not piece:  # back to the prefix before, with a shorter token
                    left.add(at)
                    at -= length[last]
                    piece = shorter[ids.pop()]
                    last = ids[-1] if ids else 0
        if self.run_ids and text.startswith(SPACE_MARK * 2):
            k = next((k for k, i in enumerate(ids) if i != self.mark), len(ids))
            ids[:k] = self._merge_run(k)
        return ids

    @lru_cache(maxsize=1024)  # noqa: B019 - one table per model lives as long as its worker
    def _merge_run(self, k: int) -> list[int]:
        """Ids of ``k`` single marks after the merges of equal score, leftmost first."""
        size, after = [1] * k, list(range(1, k + 1))
        before = list(range(-1, k - 1))
        agenda = [(i, 1, 1) for i in range(k - 1)] if 2 in self.run_ids else []
        while agenda:
            i, a, b = heapq.heappop(agenda)
            j = after[i] if size[i] else k
            if size[i] != a or j >= k or size[j] != b:
                continue
            size[i], size[j] = a + b, 0
            after[i] = after[j]
            if after[j] < k:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < k and size[x] + size[y] in self.run_ids:
                    heapq.heappush(agenda, (x, size[x], size[y]))
        return [self.run_ids[s] if s > 1 else self.mark for s in size if s]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without begin or end ids; the model's own normaliser runs first."""
        return array("i", self.encode_packed(text)).tolist()

    def encode_packed(self, text: str) -> bytes:
        """The ids of ``encode`` as 32-bit integers of this machine's byte order."""
        text = self.model.normalize(text)
        if SPACE_MARK * 2 in text or "\0" in text:
            segments = self.segments.findall(text)
        else:
            for cut in self.cuts:
                text = text.replace(cut, f"\0{cut}")
            segments = text.split("\0")
        return b"".join(map(self.memo.__getitem__, segments))

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    """One table per worker and model."""
    return PieceTable(path)


def text_chunks(batch: pa.RecordBatch, size: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in chunks of about ``size`` characters, with the first row of each."""
    column, at, texts, total = batch.column("text"), 0, [], 0
    for row in range(batch.num_rows):
        text = column[row].as_py() or ""
        texts.append(text)
        total += len(text)
        if total >= size:
            yield at, texts
            at, texts, total = row + 1, [], 0
    if texts:
        yield at, texts


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(path)
        for batch in batches:
            for at, texts in text_chunks(batch):
                packed = [table.encode_packed(t) for t in texts]
                ends = list(accumulate((len(p) // 4 for p in packed), initial=0))
                ids = pa.Array.from_buffers(pa.int32(), ends[-1],
                                            [None, pa.py_buffer(b"".join(packed))])
                decoded = [table.decode(array("i", p).tolist()) for p in packed]
                yield pa.record_batch([
                    batch.column("doc_id").slice(at, len(packed)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
                    pa.array(decoded, pa.string())],
                    names=["doc_id", "ids", "decoded"])
    return run


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """Ids of every whole text under the sentencepiece BPE ``model`` file, and their decoding.

    Returns doc_id, ids (array of int), decoded (string), one row per row of ``docs``. One narrow
    stage: no shuffle, a lost task is run again. Time is linear in a text's length; memory is a
    chunk of texts, the memo of ``MEMO`` short segments and 2^20 tested pairs. Null and empty texts
    have no ids and decode to the empty string; null and repeated doc_ids are kept row by row; an
    empty table gives no rows; other columns are ignored. Literal space marks in a text become
    spaces, as the library has it.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return texts.mapInArrow(_encode(model), "doc_id long, ids array<int>, decoded string")
