"""Quality rules: a learned decision list over text statistics.

One Arrow pass computes the statistics of a text. Sequential covering on a bounded labelled sample grows conjunctions
of thresholds, prunes each on held-back rows and takes the rows it covers away; the list becomes one ordered Spark
conditional expression over the statistics, evaluated in the same job as the statistics themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.keys import shielded
from sievewright.llm.labelled import sample
from sievewright.llm.text import add_columns, widened

SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?.,;:"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_bytes", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_same_as_last")
PREFIX = "__q_"
FEATURES = {
    "n_words": "{n_words}",
    "mean_word": "{word_chars} / {n_words}",
    "symbol_rate": "{n_symbols} / {n_words}",
    "dup_line_rate": "{n_dup_lines} / {n_lines}",
    "repeat_rate": "{n_repeat_words} / {n_words}",
    "distinct_rate": "{n_distinct} / {n_words}",
    "same_rate": "{n_same_as_last} / {n_words}",
    "upper_rate": "{n_upper} / {n_bytes}",
    "digit_rate": "{n_digits} / {n_bytes}",
    "mark_rate": "{n_marks} / {n_words}",
    "line_words": "{n_words} / {n_lines}",
}


def text_counts(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``COUNTS`` and ``MORE`` for one text. Null and empty: all zero, but no line."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    number = lambda kind: len(raw) - len(raw.translate(None, kind))
    chars = len(text or "") - number(_BLANKS)
    lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
    repeated = 0
    distinct = len(set(words))
    if n > 5 and distinct < n - 4:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            often = Counter(windows)
            covered = np.zeros(n + 1, dtype=np.int32)
            at = np.fromiter((i for i, x in enumerate(windows) if often[x] > 1), dtype=np.int64)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + 5, -1)
            repeated = int((np.cumsum(covered)[:n] > 0).sum())
    same = sum(map(bytes.__eq__, words, words[1:])) if distinct < n else 0
    return (
        n, chars, number(SYMBOLS), len(lines) - len(set(lines)), repeated,
        len(raw), len(lines), distinct, number(_UPPER), number(_DIGITS), number(_MARKS), same,
    )


def _count_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([text_counts(x.as_py()) for x in batch.column(text)], dtype=np.int64).reshape(-1, len(COUNTS + MORE))
        yield add_columns(batch, {PREFIX + k: pa.array(found[:, i]) for i, k in enumerate(COUNTS + MORE)})


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the statistics, whose names start with ``__q_``."""
    fields = ", ".join(f"`{PREFIX}{k}` bigint" for k in COUNTS + MORE)
    return docs.mapInArrow(partial(_count_batches, text=text), widened(docs, fields))


def feature(name: str) -> Column:
    """A statistic as a Spark expression over the counts; divisions by zero give zero."""
    top, _, low = FEATURES[name].partition(" / ")
    column = lambda x: F.col(PREFIX + x.strip("{}")).cast("double")
    return column(top) if not low else F.coalesce(F.try_divide(column(top), column(low)), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def expression(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(lambda a, c: a & c.holds(x), rule, np.ones(n, dtype=bool))


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], longest: int) -> Rule:
    """Add the condition with the highest information gain until only bad rows are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < longest and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        base, best = np.log2(p / (p + n)), (1e-9, None)
        for name, thresholds in cuts.items():
            order = np.sort(x[name][inside & bad]), np.sort(x[name][inside & ~bad])
            low = [np.searchsorted(o, thresholds, side="right") for o in order]
            for above in (False, True):
                pp, nn = (p - low[0], n - low[1]) if above else low
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - base), -1.0)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), Condition(name, above, float(thresholds[gain.argmax()])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return tuple(rule)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, longest: int = 4, most: int = 24, least: float = 0.75) -> list[Rule]:
    """Rules that reject, in order. Every third row is held back for pruning; a rule whose share of bad rows among the
    held-back rows it covers is below ``least`` ends the list. No rows or one class: no rules."""
    held = np.arange(len(bad)) % 3 == 0
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < most:
        part = [left & ~held, left & held]
        if bad[part[0]].sum() < 2 or not (~bad[part[0]]).any():
            break
        grow, prune = ({k: v[m] for k, v in x.items()} for m in part)
        cuts = {k: np.unique(np.quantile(v[bad[part[0]]], np.linspace(0, 1, 33))) for k, v in grow.items()}
        cuts |= {k: np.unique(np.concatenate([v, np.quantile(grow[k], np.linspace(0.01, 0.99, 33))])) for k, v in cuts.items()}
        rule = _grow(grow, bad[part[0]], cuts, longest)
        worth = []
        for k in range(1, len(rule) + 1):
            hit = _covers(rule[:k], prune, int(part[1].sum()))
            p, n = int((hit & bad[part[1]]).sum()), int((hit & ~bad[part[1]]).sum())
            worth.append(((p + 1) / (p + n + 2), p, n, k))
        if not worth:
            break
        share, p, n, k = max(worth, key=lambda w: (w[0], -w[3]))
        if p + n == 0 or p / (p + n) < least:
            break
        rules.append(rule[:k])
        left &= ~_covers(rule[:k], x, len(bad))
    return rules


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> list[Rule]:
    """Learn from at most ``max_rows`` labelled documents (``labels.quality``: 1 is good)."""
    counted = with_counts(sample(docs, labels, "quality", max_rows))
    table = counted.select("doc_id", "label", *(feature(k).alias(k) for k in FEATURES)).toPandas()
    table = table.sort_values(["doc_id", *FEATURES], kind="stable")
    return learn({k: table[k].to_numpy(dtype=float) for k in FEATURES}, table["label"].to_numpy() == 0)


def rule_number(rules: list[Rule]) -> Column:
    """The first rule that holds (from 1), 0 if none: one ordered conditional expression."""
    out = F
    for i, rule in enumerate(rules, 1):
        out = out.when(reduce(Column.__and__, (c.expression() for c in rule)), F.lit(i))
    return out.otherwise(F.lit(0)) if rules else F.lit(0)


def base_failed() -> Column:
    """Fewer than ten words, or more than a fifth of the words in repeated five-word windows."""
    words, repeated = F.col(PREFIX + "n_words"), F.col(PREFIX + "n_repeat_words")
    return (words < 10) | (100 * repeated > 20 * words)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """All columns of ``docs``, the statistics, ``__q_base_failed``, ``__q_rule`` and ``__q_kept``; one row per row.

    Null text has no words and fails. Repeated rows are judged alike; columns of any name but ``__q_*`` pass through, and those
    are refused.
    """
    taken = [c for c in docs.columns if c.startswith(PREFIX)]
    if taken:
        raise ValueError(f"columns named {PREFIX}* are the operator's own: {', '.join(taken)}")
    return (
        with_counts(docs, text)
        .withColumn(PREFIX + "base_failed", base_failed())
        .withColumn(PREFIX + "rule", rule_number(rules))
        .withColumn(PREFIX + "kept", ~F.col(PREFIX + "base_failed") & (F.col(PREFIX + "rule") == 0))
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as they came, whatever their names."""
    own, named = shielded(docs, "doc_id", "text")
    return named(judge(own, fit(own, labels)).where(PREFIX + "kept"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: its statistics, the base verdict, the number of the rule that rejects it, the verdict."""
    names = [*COUNTS, "base_failed", "kept", "rule"]
    return judge(docs.select("doc_id", "text"), fit(docs, labels)).select(
        "doc_id", *(F.col(PREFIX + k).alias(k) for k in names)
    )
