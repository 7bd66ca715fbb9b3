"""Toxicity scores: FTRL-proximal logistic regression on hashed word n-grams.

The features of a text are whether it contains a word, the first letters of a word, a pair
of neighbouring words, or a pair with one word between (skip-gram), each hashed into
``2^bits`` numbers.  FTRL-proximal keeps a learning rate per feature and an L1 penalty
that leaves all but the telling features at exactly zero, so the model is a short table
of weights that is sent to the tasks.

Training takes a bounded sample of labelled rows (``max_rows``, the smallest hashes of the
ids): features are made by all tasks, the updates run in one, row by row.  Scoring covers
all rows and whole texts and shuffles nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, values

#: Labelled rows that training may use at most.
MAX_ROWS = 20_000
BITS = 20
STEM_LETTERS = 4

_WORD = re.compile(r"\w+")
_STEM, _PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class _WordHashes(dict):
    """Hash of a word, and of its first letters below; forgets all when it grows too large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        whole, stem = (zlib.crc32(x.encode("utf-8", "replace")) for x in (word, word[:STEM_LETTERS]))
        found = self[word] = whole << 32 | stem
        return found


def features(text: str | None, hashes: dict, bits: int) -> np.ndarray:
    """Feature numbers of a text, repeats included."""
    words = _WORD.findall((text or "").lower())
    both = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    word, stem = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    mixed = np.concatenate(
        [
            word * _PAIR,
            stem * _STEM + _SKIP,
            (word[:-1] * _STEM + word[1:]) * _PAIR,
            (word[:-2] * _PAIR + word[2:]) * _SKIP,
        ]
    )
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _STEM) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class ToxicityModel:
    """Weights other than zero; all texts have ``bias``."""

    bits: int
    bias: float
    index: np.ndarray
    weight: np.ndarray


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def ftrl(
    rows: list[tuple[np.ndarray, int]],
    bits: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
    epochs: int,
) -> ToxicityModel:
    """Weights after ``epochs`` passes over (distinct feature numbers, label) in this order.

    A feature's weight is zero until its summed gradients exceed ``l1``; its step shrinks
    with the gradients it has met itself.
    """
    bias_at = 1 << bits
    z, n = np.zeros(bias_at + 1), np.zeros(bias_at + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(z[at]) <= l1] = 0
        if len(at) and at[-1] == bias_at:  # the bias is not penalised
            w[-1] = -z[bias_at] / ((beta + math.sqrt(n[bias_at])) / alpha + l2)
        return w

    for _ in range(epochs):
        for index, label in rows:
            at = np.append(index, bias_at)
            w = weights(at)
            gradient = _sigmoid(float(w.sum())) - label
            rate = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / alpha
            z[at] += gradient - rate * w
            n[at] += gradient * gradient
    every = weights(np.arange(bias_at + 1))
    index = np.flatnonzero(every[:-1])
    return ToxicityModel(bits, float(every[-1]), index, every[index])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = MAX_ROWS,
    bits: int = BITS,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 5.0,
    l2: float = 1.0,
    epochs: int = 3,
) -> ToxicityModel:
    """Model of a 0/1 label, trained on at most ``max_rows`` labelled documents.

    Rows with a null id, a null label or contradicting labels of an id teach nothing; of
    several documents with one id the one with the smallest text counts.  Without any
    usable row, or with one class only, all weights are zero and every score is the share
    of ones (0 without rows).
    """
    one_label = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min(label_col).alias("y"), F.max(label_col).alias("y_max"))
        .filter("y = y_max")
    )
    sample = hash_sample(one_label, ["label_id"], max_rows).orderBy("place", "label_id").limit(max_rows).select("label_id", "y", "place")
    seen: dict = _WordHashes()

    @F.pandas_udf("binary")
    def feature_bytes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([np.unique(features(t, seen, bits)).astype("<u4").tobytes() for t in batch])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = (
        texts.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
        .groupBy("place", "label_id")
        .agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "y")).alias("x"))
        .select("place", "label_id", F.col("x.y").cast("int").alias("y"), feature_bytes("x.text").alias("f"))
    )

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = [
            (np.frombuffer(f, dtype="<u4"), int(y))
            for batch in batches
            for f, y in zip(batch["f"], batch["y"])
        ]
        share = sum(y for _, y in known) / len(known) if known else 0.0
        if share in (0, 1):
            bias = math.copysign(35.0, share - 0.5)
            yield pd.DataFrame({"index": [-1], "weight": [bias]})
            return
        model = ftrl(known, bits, alpha, beta, l1, l2, epochs)
        yield pd.DataFrame(
            {"index": np.append(model.index, -1), "weight": np.append(model.weight, model.bias)}
        )

    table = (
        rows.repartition(1)
        .sortWithinPartitions("place", "label_id")
        .select("y", "f")
        .mapInPandas(train, "index long, weight double")
        .toPandas()
        .sort_values("index")
    )
    bias = float(table["weight"].iloc[0]) if len(table) else -35.0
    return ToxicityModel(
        bits, bias, table["index"].to_numpy()[1:].astype(np.int64), table["weight"].to_numpy()[1:]
    )


def score(text: Column, model: ToxicityModel) -> Column:
    """Probability of label 1 for a text column; null and empty texts have that of the bias."""

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = np.zeros(1 << model.bits)
        weights[model.index] = model.weight
        seen = _WordHashes()
        for batch in batches:
            out = []
            for t in values(batch):
                at = features(t, seen, model.bits)
                at = np.unique(at[weights[at] != 0])
                out.append(_sigmoid(model.bias + float(weights[at].sum())))
            yield pa.array(out, pa.float64())

    return toxicity(text)


def held_out(doc_id: Column) -> Column:
    """Documents that training never sees: a fifth by CRC-32 of the id as text; null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from a score of 0.5) per row.

    Repeated rows stay repeated; other columns are not read.  An empty table gives an
    empty table.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        score(F.col(text_col), model).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more, all columns kept."""
    return docs.filter(score(F.col(text_col), model) < 0.5)
