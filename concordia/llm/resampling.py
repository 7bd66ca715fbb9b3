"""Importance resampling of documents towards a target distribution.

Documents and target texts are bags of hashed word runs.  Bucket counts of both sides are
summed by Spark; the log ratio of the smoothed shares of a bucket is its gain, an array of
``buckets`` numbers that travels to the tasks, and a document's weight is the sum of the
gains of its runs.  Adding Gumbel noise and taking the k highest scores draws k documents
without replacement in proportion to their weights.

The k-th highest is found by distributed quickselect: random pivot keys are drawn from the
candidates that are left, one aggregation counts exactly how many keys lie below and at
each pivot, and the candidates shrink to the stretch that holds the k-th.  Keys are unique,
so the winners are exactly those up to it; they alone are sorted, and their ranks are the
places in their sorted partition plus the sizes of the partitions before.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, values
from .decontaminate import words

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Pivots of a round of the quickselect.
PIVOTS = 16
#: Words that are hashed at a time.
_SLICE = 1 << 16
#: Bytes that a checksum is moved over by one look-up.
_REACH = 64


def _moves() -> np.ndarray:
    """What n zero bytes after it make of each byte of a CRC-32: [n, place of the byte, byte]."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> np.uint32(1) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    moves = np.zeros((_REACH + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        moves[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, _REACH + 1):
        moves[n] = (moves[n - 1] >> np.uint32(8)) ^ step[moves[n - 1] & np.uint32(255)]
    return moves


class RunBuckets:
    """Buckets of all runs of one to ``longest`` words, the CRC-32 of the run modulo ``buckets``.

    A checksum of joined texts is that of the first, moved on by the length of the second,
    xor that of the second; so each word is read once and runs are put together from the
    checksums of their words.
    """

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST_RUN):
        self.buckets, self.longest = buckets, longest
        self.moves = _moves()

    def _moved(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Checksums moved on by ``n`` bytes."""
        now = np.minimum(n, _REACH)
        out = np.zeros_like(crc)
        for k in range(4):
            out ^= self.moves[now, k, crc >> np.uint32(8 * k) & np.uint32(255)]
        left = np.flatnonzero(n > _REACH)
        if len(left):
            crc, n = out[left], n[left] - _REACH
            while len(left):
                short = np.minimum(n, _REACH)
                crc = np.bitwise_xor.reduce(
                    [self.moves[short, k, crc >> np.uint32(8 * k) & np.uint32(255)] for k in range(4)]
                )
                n = n - short
                out[left] = crc
                more = n > 0
                left, crc, n = left[more], crc[more], n[more]
        return out

    def _of_pool(self, pool: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        found = [w for _, part, _ in pool for w in part]
        plain = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
        length = np.fromiter(map(len, found), np.int64, len(found))
        spaced_word = self._moved(plain, np.ones_like(length)) ^ np.uint32(zlib.crc32(b" "))
        sizes = np.array([len(part) for _, part, _ in pool])
        text = np.repeat([i for i, *_ in pool], sizes)
        place = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        size, own = np.repeat(sizes, sizes), np.repeat([n for *_, n in pool], sizes)
        begins = np.flatnonzero(place < own)
        # Checksums of the run with a space behind it, for the next word to follow.
        spaced = np.zeros(len(begins), np.uint32)
        for k in range(self.longest):
            stays = place[begins] + k < size[begins]
            begins, spaced = begins[stays], spaced[stays]
            word = begins + k
            crc = self._moved(spaced, length[word]) ^ plain[word] if k else plain[word]
            yield text[begins], crc % np.uint32(self.buckets)
            if k + 1 < self.longest:
                spaced = self._moved(spaced, length[word] + 1) ^ spaced_word[word] if k else spaced_word[word]

    def of(self, texts: Iterable[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of the texts and buckets of their runs, in slices."""
        pool, held = [], 0
        for i, found in enumerate(texts):
            for s in range(0, len(found), _SLICE):
                part = found[s : s + _SLICE + self.longest - 1]
                pool.append((i, part, min(_SLICE, len(found) - s)))
                held += len(part)
                if held >= _SLICE:
                    yield from self._of_pool(pool)
                    pool, held = [], 0
        if pool:
            yield from self._of_pool(pool)


def bucket_counts(
    texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN
) -> np.ndarray:
    """How many runs of all texts fall in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total = RunBuckets(buckets, longest), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, at in hashed.of(words(t) for t in values(batch.column(0))):
                total += np.bincount(at, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = texts.select(text_col).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares of target and raw runs."""
    size, s, t = len(raw), float(raw.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((float(b) + 1) * (s + size) / ((float(a) + 1) * (t + size))))
            for a, b in zip(raw.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def weights(text: Column, gain: np.ndarray, longest: int = LONGEST_RUN) -> Column:
    """``n_words``, ``n_features`` and ``weight`` of a text column."""

    @F.arrow_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashed = RunBuckets(len(gain), longest)
        for batch in batches:
            total, sizes = np.zeros(len(batch), dtype=np.int64), []

            def cut() -> Iterator[list[bytes]]:
                for t in values(batch):
                    found = words(t)
                    sizes.append(len(found))
                    yield found

            for i, at in hashed.of(cut()):
                # Whole numbers below 2^53 stay exact in the sums of floats.
                total += np.bincount(i, weights=gain[at], minlength=len(batch)).astype(np.int64)
            n = np.array(sizes, dtype=np.int64)
            runs = sum(np.maximum(n - k, 0) for k in range(longest))
            yield pa.StructArray.from_arrays(
                [pa.array(n), pa.array(runs), pa.array(total)], ["n_words", "n_features", "weight"]
            )

    return weigh(text)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from a hash of the id; that of a null id is of an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def kth_smallest(rows: DataFrame, key: list[str], k: int, pivots: int = PIVOTS, seed: int = SEED) -> Column | None:
    """The k-th smallest of unique keys as a literal, by distributed quickselect.

    None if there are fewer than k rows, or k is not positive.  Every round reads the
    rows between the bounds once to draw pivots and once to count; ``pivots`` keys reach
    the driver.
    """
    if k < 1:
        return None
    types = [rows.schema[c].dataType for c in key]
    own = F.struct(*key)

    def literal(row) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row, types, key)])

    left, turn = rows.select(*key), 0
    while True:
        turn += 1
        drawn = left.orderBy(F.xxhash64(*key, F.lit(seed + turn)), *key).limit(pivots).orderBy(*key).collect()
        if not drawn:
            return None
        points = [literal(r) for r in drawn]
        counted = left.agg(
            *[F.count_if(own < p).alias(f"below{i}") for i, p in enumerate(points)],
            *[F.count_if(own == p).alias(f"at{i}") for i, p in enumerate(points)],
        ).first()
        below = [counted[f"below{i}"] for i in range(len(points))]
        upto = [b + counted[f"at{i}"] for i, b in enumerate(below)]
        for p, b, u in zip(points, below, upto):
            if b < k <= u:
                return p
        lower = [i for i, u in enumerate(upto) if u < k]
        higher = [i for i, b in enumerate(below) if b >= k]
        if higher:
            left = left.filter(own < points[higher[0]])
        if lower:
            left = left.filter(own > points[lower[-1]])
            k -= upto[lower[-1]]


def ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 1) by unique keys; no task sees more than its share."""
    place = F.monotonically_increasing_id()
    kept = stored(rows.orderBy(*key).withColumn("sorted_place", place), "winners")
    part, within = F.shiftright("sorted_place", 33), F.col("sorted_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(tuple(r) for r in kept.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    # One row for each sorted partition.
    starts = kept.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before)], "sorted_part long, before long"
    )
    return (
        kept.join(F.broadcast(starts), part == F.col("sorted_part"))
        .withColumn("rank", F.col("before") + within + 1)
        .drop("sorted_place", "sorted_part", "before")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` per document.

    Of the N documents of at least ``least_words`` words, floor(percent * N / 100) are
    drawn: those of the highest scores, ties to smaller ids, null ids last; rows that
    still tie are drawn in any one order.  ``rank`` is null for the others.  Null and
    empty texts have no runs and a weight of zero.  Repeated rows stay repeated and each
    counts; an empty target leaves the raw counts to decide.  Other columns are not read;
    an empty table gives an empty table.
    """
    gain = gains(
        bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_text_col, buckets, longest)
    )
    weighed = docs.select(F.col(id_col).alias("doc_id"), weights(F.col(text_col), gain, longest).alias("w"))
    scored = stored(
        weighed.select(
            "doc_id",
            "w.n_words",
            "w.n_features",
            "w.weight",
            (F.col("w.weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "scored",
    )
    keyed = scored.withColumn("falling", -F.col("score")).withColumn("no_id", F.col("doc_id").isNull())
    key = ["falling", "no_id", "doc_id", "place"]
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = keyed.filter(F.col("n_words") >= least_words)
    last = kth_smallest(eligible, key, percent * eligible.count() // 100, seed=seed)
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= least_words) & (F.struct(*key) <= last)
    winners = ranked(keyed.filter(drawn).select(*key, *columns[1:]), key)
    rest = keyed.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return winners.select(*columns, "rank").union(rest)
