"""Quality rules: a learned decision list over text statistics.

Statistics of each text are made once.  Sequential covering then learns, from a bounded
sample of labelled documents, an ordered list of threshold conjunctions that tell bad
documents: a rule grows by the condition with the highest information gain, is pruned from
its end on data it has not seen, and the rows it covers are taken out before the next rule
grows.  The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample

#: Labelled documents that learning may use at most.
MAX_ROWS = 20_000
#: Share of bad documents that a rule must reach on the rows it is pruned on.
PRECISION = 0.9
MIN_COVER = 5
CUTS = 32

_BLANKS, _SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits")
#: What rules may test: a count, or one count in relation to another.
ATTRIBUTES = {
    "n_words": ("n_words", None),
    "mean_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "words_per_line": ("n_words", "n_lines"),
}


def _repeated(words: list[bytes], window: int = 3) -> int:
    """Words inside windows that occur at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    key = ids[:n]
    for k in range(1, window):
        # Pairs of numbers below 2^31 fit into one; they are numbered anew for the next word.
        key = key * len(number) + ids[k : n + k]
        if k < window - 1 and len(number) > 1 << 20:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:n] += twice
    edge[window : n + window] -= twice
    return int((np.cumsum(edge) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The :data:`COUNTS` of a text; all are 0 for null."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = Counter(line for line in raw.split(b"\n") if line.strip())
    total = sum(lines.values())
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    return (
        len(words),
        len(text) - without(_BLANKS),
        without(_SYMBOLS),
        total - len(lines),
        _repeated(words),
        total,
        without(_UPPER),
        without(_DIGITS),
    )


def counts(text: Column) -> Column:
    """Statistics of a text column as a struct of longs."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def statistics(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([text_counts(t) for t in batch], columns=list(COUNTS), dtype="int64")

    return statistics(text)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def attribute(name: str) -> Column:
    """An attribute of a rule from the counts; a ratio to nothing is 0."""
    top, bottom = ATTRIBUTES[name]
    if bottom is None:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.name] > self.cut if self.above else table[self.name] <= self.cut

    def expression(self) -> Column:
        return attribute(self.name) > self.cut if self.above else attribute(self.name) <= self.cut


Rule = tuple[Condition, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, dtype=bool)
    for condition in rule:
        held &= condition.holds(table)
    return held


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition of highest gain until only bad rows are covered."""
    rule: Rule = ()
    while True:
        held = _covers(rule, table, len(bad))
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        if not n or not p:
            return rule
        best, found = 1e-9, None
        for name in ATTRIBUTES:
            x = table[name]
            values, order = x[held], np.argsort(x[held], kind="stable")
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 1)[:-1], method="lower"))
            below = np.searchsorted(values[order], cuts, side="right")
            bad_below = np.r_[0, np.cumsum(bad[held][order])][below]
            for above in (False, True):
                pp = p - bad_below if above else bad_below
                all_ = len(values) - below if above else below
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / all_) - np.log2(p / (p + n))), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, found = gain[k], Condition(name, above, float(cuts[k]))
        if found is None:
            return rule
        rule += (found,)


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The shortest beginning of a rule with the best share of bad rows; its share and cover."""
    best: tuple[Rule, float, int] = ((), 0.0, 0)
    for k in range(1, len(rule) + 1):
        held = _covers(rule[:k], table, len(bad))
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        share = p / (p + n) if p + n else 0.0
        if share > best[1]:
            best = rule[:k], share, p + n
    return best


def learn(table: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray, precision: float, min_cover: int) -> list[Rule]:
    """Ordered rules for bad rows; ``prune`` marks the rows kept for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while True:
        part = lambda mask: ({k: v[mask] for k, v in table.items()}, bad[mask])
        grown = _grow(*part(left & ~prune))
        rule, share, cover = _prune(grown, *part(left & prune))
        if not rule or share < precision or cover < min_cover:
            return rules
        rules.append(rule)
        left &= ~_covers(rule, table, len(bad))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
    precision: float = PRECISION,
    min_cover: int = MIN_COVER,
) -> list[Rule]:
    """Rules learned from at most ``max_rows`` labelled documents (label 0: bad).

    Null ids, null labels and contradicting labels teach nothing; without labels of both
    kinds the list is empty.  The sample is that of the smallest hashes of the ids.
    """
    one_label = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min(label_col).alias("y"), F.max(label_col).alias("y_max"))
        .filter("y = y_max")
    )
    sample = (
        hash_sample(one_label, ["label_id"], max_rows)
        .orderBy("place", "label_id")
        .limit(max_rows)
        .select("label_id", "y", "place")
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), counts(F.col(text_col)).alias("x"))
    known = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("place", "y", "x.*")
    rows = (
        known.filter(~base_failed())
        .groupBy("place")
        .agg(F.min(F.struct("y", *(attribute(a).alias(a) for a in ATTRIBUTES))).alias("r"))
        .select("place", "r.*")
        .orderBy("place")
        .limit(max_rows)
        .toPandas()
    )
    table = {a: rows[a].to_numpy(dtype=float) for a in ATTRIBUTES}
    return learn(table, (rows["y"] == 0).to_numpy(), (rows["place"] % 3 == 0).to_numpy(), precision, min_cover)


def decision(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1, or 0."""
    if not rules:
        return F.lit(0)
    chain = F
    for i, rule in enumerate(rules):
        held = rule[0].expression()
        for condition in rule[1:]:
            held = held & condition.expression()
        chain = chain.when(held, F.lit(i + 1))
    return chain.otherwise(F.lit(0))


def judged(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, the counts, ``base_failed``, ``rule`` and ``kept``.

    Null and empty texts have no words and fail the base.  Repeated rows and null ids stay
    as they are; other columns are not read.  An empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), counts(F.col(text_col)).alias("x")).select("doc_id", "x.*")
    return rows.select(
        "*", base_failed().alias("base_failed"), decision(rules).alias("rule")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
