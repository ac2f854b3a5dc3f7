"""Quality rules: text statistics and a decision list learned by sequential covering."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliolake.llm.shared import NON_SPACE, SPACE, stripped, written

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_lines", "n_upper", "n_marks")
#: What rules may test, as SQL over the statistics; all are ratios or sizes.
FEATURES = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated(words: Column) -> Column:
    """How many words lie in a 3-word window that the text has twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(ordered: Column) -> Column:
        same = F.filter(F.transform(
            ordered, lambda e, j: F.when(
                (F.get(ordered, j - 1)["h"] == e["h"]) | (F.get(ordered, j + 1)["h"] == e["h"]),
                e["i"])), lambda i: i.isNotNull())
        return F.size(F.array_distinct(F.flatten(
            F.transform(same, lambda i: F.array(i, i + 1, i + 2)))))

    def count(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _let(ordered, covered))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(_let(windows, count))


def statistics(text: Column) -> Column:
    """A struct of STATISTICS (long) over the whole text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    trimmed = stripped(text)
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{SPACE}+"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NON_SPACE))

    def n_of(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    word_part = _let(words, lambda w: F.struct(
        F.size(w).alias("n"), _repeated(w).alias("r"),
        F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("c")))
    line_part = _let(lines, lambda a: F.struct(
        F.size(a).alias("n"), (F.size(a) - F.size(F.array_distinct(a))).alias("d")))
    return _let(F.struct(word_part.alias("w"), line_part.alias("l")), lambda s: F.struct(
        s["w"]["n"].cast("long").alias("n_words"), s["w"]["c"].cast("long").alias("word_chars"),
        n_of("#*$%&|<>").cast("long").alias("n_symbols"),
        s["l"]["d"].cast("long").alias("n_dup_lines"),
        s["w"]["r"].cast("long").alias("n_repeat_words"),
        s["l"]["n"].cast("long").alias("n_lines"),
        n_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        n_of("!?;:").cast("long").alias("n_marks")))


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATISTICS, one row per document."""
    return (docs.select(F.col("doc_id").alias("doc_id"), statistics(F.col("text")).alias("s"))
            .select("doc_id", *[f"s.{c}" for c in STATISTICS]))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>=' if self.at_least else '<'} {self.threshold!r}D"


@dataclass
class Rule:
    conditions: list[Condition] = field(default_factory=list)
    rejected: int = 0
    mistaken: int = 0

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions) or "true"


def verdict_sql(rules: list[Rule]) -> str:
    """The ordered list as one Spark conditional expression: number of the rule that rejects
    a row, 0 if none does."""
    whens = "".join(f" WHEN {r.sql()} THEN {k}" for k, r in enumerate(rules, 1))
    return f"CASE{whens} ELSE 0 END" if rules else "0"


def learn_rules(stats: DataFrame, labels: DataFrame, max_rules: int = 8, max_conditions: int = 4,
                bins: int = 64, min_precision: float = 0.9, min_support: int = 3) -> list[Rule]:
    """Sequential covering over all labelled rows (labels.quality = 0 is rejected).

    Each rule grows on two thirds of the rows by the condition of the highest information
    gain, among ``bins`` quantiles of each feature, and is pruned on the other third to the
    prefix of conditions with the best precision there. It is taken if that precision is
    at least ``min_precision`` on at least ``min_support`` rejected rows; the rows it covers are
    set aside and the next rule is grown. Each step is one aggregation by (feature, bin)
    that combines before its shuffle; only its sums, at most features x bins, reach the driver.
    Conflicting labels of a doc_id count as good (max); unlabelled documents do not count.
    """
    marks = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg(F.max("quality").alias("quality")))
    rows = (stats.join(marks, "doc_id")
            .selectExpr("doc_id", "quality = 0 AS bad",
                        "pmod(crc32(CAST(doc_id AS STRING)), 3) = 0 AS held",
                        *[f"CAST({sql} AS DOUBLE) AS `f_{name}`" for name, sql in FEATURES.items()]))
    rows = written(rows, "rule-rows")
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(f"f_{f}", shares, 10000).alias(f) for f in FEATURES]
                     ).first()
    edges = {f: sorted(set(found[f] or [])) for f in FEATURES}

    def met(conditions: list[Condition]) -> Column:
        out = F.lit(True)
        for c in conditions:
            x = F.col(f"f_{c.feature}")
            out = out & ((x >= c.threshold) if c.at_least else (x < c.threshold))
        return out

    def counts(part: DataFrame) -> dict[str, list[tuple[int, int]]]:
        """Per feature and bin: rows to reject, rows to keep."""
        cells = F.array(*[
            F.struct(F.lit(f).alias("f"), _bin(F.col(f"f_{f}"), edges[f]).alias("b"))
            for f in FEATURES])
        sums = (part.select("bad", F.explode(cells).alias("c")).groupBy("c.f", "c.b")
                .agg(F.sum(F.col("bad").cast("long")).alias("p"), F.count("*").alias("n")).collect())
        out = {f: [(0, 0)] * (len(edges[f]) + 1) for f in FEATURES}
        for f, b, p, n in sums:
            out[f][b] = (p, n - p)
        return out

    def best(part: DataFrame) -> tuple[float, Condition | None, int, int]:
        top: tuple[float, Condition | None, int, int] = (0.0, None, 0, 0)
        for f, cells in counts(part).items():
            all_p, all_n = sum(p for p, _ in cells), sum(n for _, n in cells)
            if not all_p:
                continue
            prior = math.log2(all_p / (all_p + all_n))
            p = n = 0
            for edge, (cp, cn) in zip(edges[f], cells, strict=False):
                p, n = p + cp, n + cn  # rows below the edge
                for at_least, (a, b) in ((False, (p, n)), (True, (all_p - p, all_n - n))):
                    if a and (gain := a * (math.log2(a / (a + b)) - prior)) > top[0] + 1e-9:
                        top = (gain, Condition(f, at_least, float(edge)), a, b)
        return top

    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule, part = Rule(), left.filter("NOT held")
        while len(rule.conditions) < max_conditions:
            gain, condition, _, wrong = best(part.filter(met(rule.conditions)))
            if condition is None:
                break
            rule.conditions.append(condition)
            if not wrong:
                break
        if not rule.conditions:
            break
        prefixes = [rule.conditions[:k] for k in range(1, len(rule.conditions) + 1)]
        sums = left.filter("held").agg(*[
            F.sum(F.when(met(c) & (F.col("bad") == F.lit(bad)), 1).otherwise(0)).alias(f"n{k}{bad}")
            for k, c in enumerate(prefixes) for bad in (True, False)]).first()
        scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n)
                  for k in range(len(prefixes))
                  for p, n in [(sums[f"n{k}True"] or 0, sums[f"n{k}False"] or 0)]]
        _, k, p, n = max(scored)
        if p < min_support or p < min_precision * (p + n):
            break
        rules.append(Rule(prefixes[-k], p, n))
        left = left.filter(~met(rules[-1].conditions))
    return rules


def _bin(value: Column, edges: list[float]) -> Column:
    """Number of edges that are not above the value."""
    if not edges:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= value))


def judge_quality(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """Statistics, base rules and the learned verdict of every document.

    Base: fewer than 50 words, or more than half of the words in repeated 3-word windows.
    Returns doc_id, STATISTICS, base_failed, rule (number of the learned rule that rejects,
    0 if none), kept. Null and empty texts have no words and fail; null doc_ids are judged
    but teach nothing; repeated rows are judged alike; an empty table gives no rows; without
    labels no rule is learned. The texts are read once, for their statistics, without a
    shuffle; learning runs over the narrow table of statistics.
    """
    stats = written(document_statistics(docs), "rule-stats")
    rules = learn_rules(stats, labels, **learning)
    judged = stats.withColumn("base_failed", F.expr(
        "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    judged = judged.withColumn("rule", F.expr(verdict_sql(rules)).cast("int"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def quality_filter(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """The rows of ``docs`` that judge_quality keeps, all columns unchanged.

    Rules are learned from the labelled documents; the verdict is an expression over each
    row's own text, so the texts are filtered where they are read, without a shuffle."""
    marked = labels.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    stats = written(document_statistics(docs.join(marked, "doc_id", "left_semi")), "rule-stats")
    rules = learn_rules(stats, labels, **learning)
    judged = docs.select(F.struct("*").alias("_row"), statistics(F.col("text")).alias("_s"))
    judged = judged.select("_row", *[F.col("_s")[c].alias(c) for c in STATISTICS])
    return judged.filter(F.expr(
        f"NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ({verdict_sql(rules)}) = 0"
    )).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
