"""Toxicity by compression distance: zstandard dictionaries trained on toxic and on ordinary
windows, distances per window and calibrated thresholds."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliolake.llm.shared import written

#: Two bytes a character: a match then saves more than the few bytes it costs in a short window.
ENCODING = "utf-16-le"
#: Opens every window and ends both dictionaries, so that each window has a match and the cost
#: of a block's first sequence is the same under both.
_OPENING = (" begin window: the quick brown fox jumps over the lazy dog near the river bank; "
            .encode(ENCODING))
#: A window's distance counts if it reaches these numbers of bytes; their weights are calibrated.
CUTS = (2, 4, 6, 8, 10, 12)
#: Dictionary bytes, segment lengths of the trainer and powers of a window's number of contexts
#: among which the calibration documents choose.
CHOICES = [(size, k, power) for size in (2048, 4096, 8192) for k in (56, 96) for power in (1.0, 0.6)]
#: Distances that a task remembers, in two generations of this many words.
MEMO = 1 << 17
_SPLIT = re.compile(r"\W+")


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries of toxic and ordinary text, and the logistic calibration of a document's
    features (see ``features``): their means, spreads and weights, the constant first."""
    toxic: bytes
    ordinary: bytes
    mean: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()


def trained(windows: list[bytes], size: int, k: int) -> bytes:
    """Content of a zstandard dictionary trained on ``windows`` (three to a sample), or the
    windows themselves where they are too few to train on."""
    samples = [b"".join(windows[i:i + 3]) for i in range(0, len(windows), 3)]
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=8).as_bytes()[8:] + _OPENING
    except zstandard.ZstdError:
        return b"".join(windows)[-size:] + _OPENING


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        9, strategy=zstandard.STRATEGY_GREEDY, min_match=6, search_log=6, hash_log=14,
        chain_log=14, window_log=17, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT),
        compression_params=parameters)


def window(word: str) -> bytes:
    return f" {word} ".encode(ENCODING, "surrogatepass")


class Distances:
    """Per word of a text (lower case): its bytes under the ordinary dictionary less its bytes
    under the toxic one."""

    def __init__(self, model: ToxicityModel):
        self.toxic, self.ordinary = _compressor(model.toxic), _compressor(model.ordinary)
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words, memo = _SPLIT.split(text.lower()), self.memo
        found = list(map(memo.get, words))
        for i, d in enumerate(found):
            if d is None:
                found[i] = self._learn(words[i])
        return np.array([d for w, d in zip(words, found, strict=True) if w], np.int64)

    def _learn(self, word: str) -> int:
        d = self.memo.get(word, self.older.get(word))
        if d is None:
            x = _OPENING + window(word)
            d = len(self.ordinary.compress(x)) - len(self.toxic.compress(x))
        if len(word) <= 64:
            if len(self.memo) >= MEMO:
                self.older, self.memo = self.memo, {}
            self.memo[word] = d
        return d


def features(found: np.ndarray) -> list[float]:
    """Largest distance, the next, mean of the largest in 33, mean of all, how many reach each cut
    (log), their share (log), number of windows (log). Without windows as for one of distance 0."""
    n = max(len(found), 1)
    top = np.sort(found)[::-1] if len(found) else np.zeros(1)
    reach = [int((found >= c).sum()) for c in CUTS]
    return [float(top[0]), float(top[1]) if n > 1 else 0.0, float(top[:max(1, n // 33)].mean()),
            float(top.mean()), *[math.log1p(r) for r in reach],
            *[math.log((r + 0.3) / (n + 10)) for r in reach], math.log1p(n)]


N_FEATURES = 5 + 2 * len(CUTS)


def _logistic(x: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps with a ridge; the constant first."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (toxic - p) - w)
    return w


def score(model: ToxicityModel, x: np.ndarray) -> np.ndarray:
    if not model.weights:
        return np.full(len(x), 0.5)
    x = (x - np.array(model.mean)) / np.array(model.spread)
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights[1:]) + model.weights[0], -30, 30)))


def _calibrated(model: ToxicityModel, x: np.ndarray, toxic: np.ndarray) -> tuple[float, ToxicityModel]:
    """Log loss on thirds left out in turn, and the model calibrated on all."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z, fold, loss = (x - mean) / spread, np.arange(len(toxic)) % 3, 0.0
    for k in range(3):
        out = fold == k
        w = _logistic(z[~out], toxic[~out])
        p = 1 / (1 + np.exp(-np.clip(z[out] @ w[1:] + w[0], -30, 30)))
        loss -= float((toxic[out] * np.log(p + 1e-9) + (1 - toxic[out]) * np.log(1 - p + 1e-9)).sum())
    return loss, ToxicityModel(model.toxic, model.ordinary, tuple(mean.tolist()),
                               tuple(spread.tolist()), tuple(_logistic(z, toxic).tolist()))


def _surprise(a: int, b: int, n1: int, n0: int) -> float:
    """Root of the log-likelihood ratio of a and b occurrences in classes of n1 and n0."""
    share = (a + b) / (n1 + n0)
    parts = [x * math.log(x / (n * share)) for x, n in ((a, n1), (b, n0)) if x]
    return math.sqrt(max(2 * sum(parts), 0.0))


def _pieces(word: Column) -> Column:
    """' word ' and, of longer words, ' prefix' of 4 to 8 characters."""
    whole = F.array(F.concat(F.lit(" "), word, F.lit(" ")))
    starts = F.transform(F.sequence(F.lit(4), F.least(F.lit(8), F.length(word) - 1)),
                         lambda n: F.concat(F.lit(" "), F.left(word, n)))
    return F.when(F.length(word) > 4, F.concat(whole, starts)).otherwise(whole)


def _training_windows(words: DataFrame, min_share: float, min_count: int, odds: float,
                      min_surprise: float, most: int) -> tuple[list, list]:
    """Words with their numbers of contexts to train either dictionary on, at most ``most`` each.

    Most of a toxic document is ordinary text. Toxic windows to learn from are the words
    with a piece (the word or a prefix) that is ``odds`` times as frequent in toxic contexts
    as in ordinary ones, and so beyond chance; ordinary windows are drawn from the other words
    of ordinary documents, each by its number of contexts."""
    sums = words.agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")).first()
    n1, n0 = max(sums["t"] or 0, 1), max(sums["o"] or 0, 1)
    pieces = (words.select(F.explode(_pieces(F.col("word"))).alias("piece"), "toxic", "ordinary")
              .groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
              .filter(F.col("toxic") >= F.lit(max(min_count, min_share * n1)))
              .filter(F.col("toxic") / n1 > odds * (F.col("ordinary") + 0.5) / n0))
    # fewer than 6 / min_share pieces: each has that share of the contexts, a word has 6 pieces
    marks = [(r["piece"],) for r in pieces.collect()
             if _surprise(r["toxic"], r["ordinary"], n1, n0) >= min_surprise]
    marked = words.select("*", F.explode(_pieces(F.col("word"))).alias("piece")).join(
        F.broadcast(words.sparkSession.createDataFrame(marks, "piece string")), "piece").select(
        "word").distinct()
    order = F.xxhash64("word", F.lit(3))
    toxic = (words.filter("toxic > 0").join(marked, "word").orderBy(F.desc("toxic"), order)
             .select("word", F.col("toxic").alias("n")).limit(most).collect())
    wanted = sum(r["n"] for r in toxic)
    # weighted draw without replacement: smallest of -log(u) / weight
    u = (F.pmod(F.xxhash64("word", F.lit(5)), F.lit(1 << 30)) + 1) / float((1 << 30) + 1)
    ordinary = (words.filter("ordinary > 0").join(marked, "word", "left_anti")
                .orderBy(-F.log(u) / F.col("ordinary"), "word")
                .select("word", F.col("ordinary").alias("n")).limit(min(most, max(wanted, 1))).collect())
    return toxic, ordinary


def _dictionary_pair(toxic: list, ordinary: list, size: int, k: int, power: float) -> ToxicityModel:
    def listing(rows, repeat):
        times = [(r["word"], max(1, round(r["n"] ** power)) if repeat else 1) for r in rows]
        out = [(window(w), i) for w, n in times for i in range(n)]
        # the trainer sees windows in an order that depends on their bytes alone
        return [x for x, _ in sorted(out, key=lambda x: (hash_of(x[0], x[1]), x[0]))]
    bad, plain = listing(toxic, True), listing(ordinary, False)
    n = max(1, min(len(bad), len(plain)))
    return ToxicityModel(trained(bad[:n], size, k), trained(plain[:n], size, k))


def hash_of(raw: bytes, turn: int) -> int:
    return zlib.crc32(raw + bytes([turn % 256, turn // 256 % 256]))


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000, min_share: float = 1e-4,
          min_count: int = 6, odds: float = 3.0, min_surprise: float = 3.5,
          most: int = 50_000) -> ToxicityModel:
    """Dictionaries and calibration from labelled documents.

    Of each class at most ``sample`` labelled documents are used, those with the smallest hash
    of doc_id; two thirds train the dictionaries, one third calibrates. Words are counted by
    distinct contexts (the word with its neighbours), so copies of a text count once. Spark
    does the counting; the driver gets at most ``most`` words a class to train on and the features
    of the calibration third. Several trainer settings (``CHOICES``) are tried; the one with the
    least log loss on calibration documents left out in turn stays. Conflicting labels of a
    doc_id count as toxic; null labels do not count. With one class alone nothing is learnt: every
    score is 0.5."""
    marks = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .withColumn("order", F.xxhash64("doc_id", F.lit(11))))
    picked = marks.filter("toxic = 1").orderBy("order", "doc_id").limit(sample).unionAll(
        marks.filter("toxic = 0").orderBy("order", "doc_id").limit(sample))
    rows = written(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # 2 * sample
                   .select("toxic", "order", F.pmod(F.col("order"), F.lit(3)).alias("part"),
                           F.lower(F.coalesce("text", F.lit(""))).alias("text")), "toxic-sample")
    fit = rows.filter("part > 0").select("toxic", F.filter(
        F.split("text", r"[^\p{L}\p{M}\p{N}_]+"), lambda w: w != "").alias("w"))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("i")
    found = fit.filter(F.size("w") > 0).select("toxic", "w", at).select(
        "toxic", F.get("w", "i").alias("word"),
        F.xxhash64(F.get("w", F.col("i") - 1), F.get("w", "i"), F.get("w", F.col("i") + 1))
        .alias("context"))
    words = written(found.distinct().groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary")), "toxic-words")
    toxic, ordinary = _training_windows(words, min_share, min_count, odds, min_surprise, most)
    models = [_dictionary_pair(toxic, ordinary, *choice) for choice in CHOICES]
    held = rows.filter("part = 0").select("toxic", "order", "text").mapInArrow(
        _scorer(models, ("toxic", "order")), "toxic int, order long, f array<double>")
    got = held.orderBy("order").collect()  # 2 * sample / 3 rows, about
    y = np.array([r["toxic"] for r in got], float)
    if min(y.sum(), len(y) - y.sum()) < 3:
        return models[0]
    x = np.array([r["f"] for r in got]).reshape(len(got), len(models), N_FEATURES)
    return min((_calibrated(m, x[:, k], y) for k, m in enumerate(models)), key=lambda c: c[0])[1]


def _scorer(models: list[ToxicityModel], keep: tuple[str, ...]):
    """Columns ``keep`` and the features of each text under each model, as f."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = [Distances(m) for m in models]
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                text = t.as_py() or ""
                rows.append([x for d in distances for x in features(d(text))])
            yield pa.record_batch([*[batch.column(c) for c in keep],
                                   pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "f"])
    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1), max_distance, n_windows for every whole text.

    Each word is a window that is compressed under both dictionaries; a map over rows without a
    shuffle. Null, empty and blank texts have no windows and get the calibrated score of no
    evidence. Repeated rows score alike, null ids pass, an empty table gives no rows; other
    columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _scorer([model], ("doc_id",))(batches):
            f = np.array(out.column("f").to_pylist(), float).reshape(out.num_rows, N_FEATURES)
            yield pa.record_batch(
                [out.column("doc_id"), pa.array(score(model, f), pa.float64()),
                 pa.array(f[:, 0].astype(np.int64)),
                 pa.array(np.rint(np.expm1(f[:, -1])).astype(np.int64))],
                names=["doc_id", "score", "max_distance", "n_windows"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, max_distance long, n_windows long")
