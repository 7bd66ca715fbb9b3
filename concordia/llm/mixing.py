"""Mixing sources to target weights with exact block quotas.

Every source is cut into pieces of at most ``PIECE_WORDS`` words, and the pieces are dealt
by hash to the source's blocks, a power of two of about ``BLOCK_WORDS`` words each.  A pass
visits all blocks in a permuted order; a target of 1.5 times a source's size is one whole
pass and the first blocks of the next one.  The last block is taken in part, piece by piece
in hash order, and the last piece up to the word at which the target is met.

Which output shard gets which blocks is decided by a splitting tree: at every node the
blocks left of each source are divided between the two halves of the shards by a
multivariate hypergeometric draw, so every shard has its exact number of blocks, and its
composition is that of a random sample without replacement.  A shard's draw is a run of
positions in each source's order, disjoint from all others, and every task finds it from
the seed alone.  Rows are shuffled locally, by hash within their shard.

The number of shards follows from the words to be taken.  Only one row per source passes
through the driver, with one number per shard: sources and shards are catalogues of the
mix, not data.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, n_words, stored, values

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_PASSES = 2
PIECE_WORDS = 4096
BLOCK_WORDS = 16_384
#: Blocks of a source, and of all sources, at most; beyond that blocks have more words.
MOST_BLOCKS = 1 << 20
ALL_BLOCKS = 1 << 28
#: Words of an output shard, and parts of a shard that tasks may shuffle apart.
SHARD_WORDS = 1 << 25
SHARD_PARTS = 16
SEED = 20_240_229


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST_PASSES) -> list[float]:
    """Words to take from each source: ``share`` of all words, dealt by weight.

    No target exceeds ``most`` times its source's size; what is over goes to the others
    by weight, until none is above.
    """
    total, target = share * sum(sizes), [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0 and weights[i] > 0]
    while free:
        unit = total / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > most * sizes[i]]
        for i in over or free:
            target[i] = float(most * sizes[i]) if over else weights[i] * unit
        if not over:
            break
        total -= sum(target[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return target


@dataclass
class SourceShare:
    """What the mix takes of a source, in words, and where it stops."""

    source: str | None
    size: int
    target: float
    blocks: int
    passes: int
    rest: int
    last: int = -1  # position of the block taken in part
    key: int = 0  # hash of the piece taken in part, its words, and how many of them
    words: int = 0
    part: int = 0

    @property
    def drawn(self) -> int:
        """Blocks drawn, repeats and the last one included."""
        return self.passes * self.blocks + self.last + 1


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words and ``key`` of each document."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"),
        _row_key(id_col, text_col).alias("key"),
    )


def _piece_hash(key: Column, number: Column, blocks: Column, seed: int) -> tuple[Column, Column]:
    """Block of a piece and its place in the block."""
    return F.pmod(F.xxhash64(key, number, F.lit(seed)), blocks), F.xxhash64(key, number, F.lit(seed + 1))


def _position(block: Column, blocks: Column, number: Column) -> Column:
    """Place of a block in the permuted order of a pass (an odd factor permutes 2^k blocks)."""
    return F.pmod(block * (F.lit(40_503) + number * 2) + F.lit(12_289) * (number + 1), blocks)


def _piece_words(size: Column, number: Column) -> Column:
    return F.least(F.lit(PIECE_WORDS).cast("long"), size - number * PIECE_WORDS)


def _null_safe(left: Column, right: str) -> Column:
    return left.eqNullSafe(F.col(right))


def plan_mix(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_PASSES,
    seed: int = SEED,
) -> list[SourceShare]:
    """Shares of all sources; ``sizes`` is the table that :func:`sized` makes.

    Sources stand in order of their code points, null last, and have the weights in
    turn.  Sources without a word have a target of zero.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("size")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    words = [int(r["size"]) for r in totals]
    wanted = targets(words, [weights[i % len(weights)] for i in range(len(words))], share, most)
    plan, most_blocks = [], MOST_BLOCKS
    own = [1 << max(0, math.ceil(math.log2(max(1.0, size / BLOCK_WORDS)))) for size in words]
    while most_blocks > 1 and sum(min(most_blocks, b) for b in own) > ALL_BLOCKS:
        most_blocks //= 2
    for row, size, target, blocks in zip(totals, words, wanted, own):
        blocks = min(most_blocks, blocks)
        quota = min(round(target), most * size)
        plan.append(SourceShare(row["source"], size, target, blocks, *(divmod(quota, size) if size else (0, 0))))
    parted = [p for p in plan if p.rest]
    if not parted:
        return plan
    params = F.broadcast(
        spark.createDataFrame(
            [(p.source, p.blocks, p.passes, p.rest) for p in parted],
            "s string, blocks long, passes long, rest long",
        )
    )
    pieces = (
        sizes.filter("size > 0")
        .join(params, _null_safe(F.col("source"), "s"))
        .withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / PIECE_WORDS))))
    )
    block, place = _piece_hash(F.col("key"), F.col("number"), F.col("blocks"), seed)
    pieces = pieces.select(
        "s", "rest",
        _position(block, F.col("blocks"), F.col("passes")).alias("position"),
        place.alias("place"),
        _piece_words(F.col("size"), F.col("number")).alias("words"),
    )
    by_block = pieces.groupBy("s", "rest", "position").agg(F.sum("words").alias("words"))
    order = Window.partitionBy("s").orderBy("position")
    ends = by_block.withColumn("end", F.sum("words").over(order)).filter("end > rest and end - words <= rest")
    last = [(r["s"], r["position"], r["rest"] - (r["end"] - r["words"])) for r in ends.collect()]
    lasts = F.broadcast(spark.createDataFrame(last, "l string, last long, left long"))
    inside = (
        pieces.join(lasts, _null_safe(F.col("s"), "l") & (F.col("position") == F.col("last")))
        .groupBy("s", "left", "place", "words")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("s").orderBy("place", "words")
    cut = (
        inside.withColumn("end", F.sum(F.col("words") * F.col("n")).over(order))
        .withColumn("before", F.col("end") - F.col("words") * F.col("n"))
        .filter("end > left and before <= left")
        .collect()
    )
    at = {s: position for s, position, _ in last}
    pieces_at = {r["s"]: r for r in cut}
    for p in parted:
        r = pieces_at[p.source]
        p.last, p.key, p.words = at[p.source], r["place"], r["words"]
        # Rows that agree in id and text are cut alike, so that their order never matters.
        p.part = (r["left"] - r["before"]) // r["n"]
    return plan


def _taken_of_piece(number: Column, seed: int) -> Column:
    """Words of a piece that the pass in part takes."""
    block, place = _piece_hash(F.col("key"), number, F.col("blocks"), seed)
    position = _position(block, F.col("blocks"), F.col("passes"))
    words = _piece_words(F.col("size"), number)
    cut = F.col("cut")
    before = (place < cut["key"]) | ((place == cut["key"]) & (words < cut["words"]))
    return (
        F.when(position < F.col("last"), words)
        .when((position > F.col("last")) | F.col("cut").isNull(), F.lit(0).cast("long"))
        .when(before, words)
        .when((place == cut["key"]) & (words == cut["words"]), cut["part"])
        .otherwise(F.lit(0).cast("long"))
    )


def _numbers() -> Column:
    last = F.floor((F.col("size") - 1) / PIECE_WORDS)
    empty = F.array().cast("array<bigint>")
    return F.when(F.col("size") > 0, F.sequence(F.lit(0).cast("long"), last)).otherwise(empty)


def with_shares(sizes: DataFrame, plan: list[SourceShare]) -> DataFrame:
    """Documents beside the share of their source (one small row per source, broadcast)."""
    rows = [
        (i, p.source, p.size, p.target, p.blocks, p.passes, p.last, (p.key, p.words, p.part) if p.rest else None)
        for i, p in enumerate(plan)
    ]
    params = sizes.sparkSession.createDataFrame(
        rows,
        "place_of_source int, s string, source_size long, target double, blocks long, passes long, "
        "last long, cut struct<key:bigint,words:bigint,part:bigint>",
    )
    return sizes.join(F.broadcast(params), _null_safe(F.col("source"), "s")).drop("s")


def shard_draw(shard: int, drawn: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """First position of each source that a shard draws, found along its path in the tree.

    The draw ends where that of the next shard begins; that of number ``shards`` is the
    end of all.
    """
    first, counts, low, high = np.zeros(len(drawn), np.int64), drawn.astype(np.int64), 0, shards
    if shard >= shards:
        return counts
    total = int(counts.sum())
    while high - low > 1:
        middle = (low + high) // 2
        left = total * middle // shards - total * low // shards
        rng = np.random.default_rng([seed, low, high])
        draw = rng.multivariate_hypergeometric(counts, left, method="marginals")
        if shard < middle:
            counts, high = draw, middle
        else:
            first, counts, low = first + draw, counts - draw, middle
    return first


def shard_starts(plan: list[SourceShare], shards: int, seed: int, spark) -> np.ndarray:
    """One column per source: where the draw of each shard begins, and where that of the last ends."""
    drawn = np.array([p.drawn for p in plan], dtype=np.int64)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            starts = [shard_draw(int(s), drawn, shards, seed).tolist() for s in batch["id"]]
            yield pd.DataFrame({"shard": batch["id"], "starts": starts})

    rows = spark.range(shards).mapInPandas(draw, "shard long, starts array<long>").collect()
    begins = np.array([r["starts"] for r in sorted(rows)], dtype=np.int64).reshape(shards, len(plan))
    return np.concatenate([begins, drawn[None, :]])


def shard_count(plan: list[SourceShare]) -> int:
    """Shards of about ``SHARD_WORDS`` words each."""
    return max(1, math.ceil(sum(p.target for p in plan) / SHARD_WORDS))


def drawn_pieces(seed: int = SEED) -> Column:
    """The pieces that a mix draws of a document: number, words and position in its source.

    A document that is drawn several times has a piece for each turn.
    """

    def piece(number: Column, turn: Column, words: Column) -> Column:
        block = _piece_hash(F.col("key"), number, F.col("blocks"), seed)[0]
        return F.struct(
            number.alias("number"),
            words.alias("words"),
            (turn * F.col("blocks") + _position(block, F.col("blocks"), turn)).alias("position"),
        )

    turns = F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    full = F.flatten(
        F.transform(
            turns, lambda turn: F.transform(_numbers(), lambda n: piece(n, turn, _piece_words(F.col("size"), n)))
        )
    )
    part = F.transform(_numbers(), lambda n: piece(n, F.col("passes"), _taken_of_piece(n, seed)))
    return F.filter(F.concat(full, part), lambda p: p["words"] > 0)


def shards_of(starts: np.ndarray, source: Column, positions: Column) -> Column:
    """Shard that draws each of the positions of a source; -1 beyond what the tree gave out."""

    @F.arrow_udf("array<int>")
    def find(places: pa.Array, position: pa.Array) -> pa.Array:
        values_, offsets = position.values.to_numpy(), position.offsets.to_numpy()
        source_of = np.repeat(places.to_numpy(zero_copy_only=False), np.diff(offsets))
        values_ = values_[offsets[0] : offsets[-1]]
        found = np.full(len(values_), -1, dtype=np.int32)
        for s in np.unique(source_of):
            mine = source_of == s
            at = np.searchsorted(starts[:, s], values_[mine], side="right") - 1
            found[mine] = np.where(at < len(starts) - 1, at, -1)
        return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(found))

    return find(source, positions)


def shard_quotas(plan: list[SourceShare], starts: np.ndarray, spark) -> DataFrame:
    """``shard``, ``source`` and ``blocks``: how many blocks of a source the tree gives a shard."""
    counts = np.diff(starts, axis=0)
    rows = [(int(i), p.source, int(counts[i, s])) for i in range(len(counts)) for s, p in enumerate(plan)]
    return spark.createDataFrame(rows, "shard int, source string, blocks long")


def mix_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int | None = None,
    seed: int = SEED,
    **settings,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``shards`` per document.

    ``taken`` counts the words of the pieces that the splitting tree gives to some shard,
    ``shards`` are these shards.  Null texts have size 0, and so nothing is taken of them;
    a null source is a source of its own.  Rows that agree in id and text are taken alike,
    which may leave the last words of a target untaken, fewer than there are such rows.
    Other columns are not read; an empty table gives an empty table.
    """
    sizes = stored(sized(docs, id_col, text_col, source_col), "sizes")
    plan = plan_mix(sizes, seed=seed, **settings)
    starts = shard_starts(plan, shards or shard_count(plan), seed, docs.sparkSession)
    pieces = with_shares(sizes, plan).withColumn("pieces", drawn_pieces(seed))
    found = pieces.withColumn("found", shards_of(starts, F.col("place_of_source"), F.col("pieces.position")))
    given = F.filter(F.arrays_zip("pieces", "found"), lambda x: x["found"] >= 0)
    total = F.aggregate(given, F.lit(0).cast("long"), lambda n, x: n + x["pieces"]["words"])
    return found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        total.alias("taken"),
        F.array_sort(F.array_distinct(F.transform(given, lambda x: x["found"]))).alias("shards"),
    )


_WORDS = re.compile(WORD)


def cut_texts(text: str, numbers: list[int], words: list[int], size: int) -> list[str]:
    """The first words of some pieces, with the white space after them that a longer piece has.

    A piece begins at a multiple of ``PIECE_WORDS``; the first one and the last one have
    what stands before the first word and after the last.
    """
    starts = [m.start() for m in _WORDS.finditer(text)]
    out = []
    for number, n in zip(numbers, words):
        first = number * PIECE_WORDS
        begin = 0 if first == 0 else starts[first]
        end = len(text) if first + n == size else starts[first + n]
        out.append(text[begin:end])
    return out


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int | None = None,
    seed: int = SEED,
    **settings,
) -> DataFrame:
    """The mixed rows: ``doc`` (the columns of ``docs``), ``shard`` and ``place``.

    A row is a piece of a document: all of it, unless it has more than ``PIECE_WORDS``
    words or is the one with which a target is met; the pieces of a whole pass joined are
    the text.  A text is cut into all of its pieces at once, so one of any length is read
    through once.  Rows of a shard are in order of their place, which is random; a shard is
    shuffled in ``SHARD_PARTS`` parts that may lie in different tasks, one after the other.
    Texts without a word, null ones among them, are never drawn; an empty table gives an
    empty table.
    """
    spark, names = docs.sparkSession, docs.columns
    plan = plan_mix(stored(sized(docs, id_col, text_col, source_col), "sizes"), seed=seed, **settings)
    starts = shard_starts(plan, shards or shard_count(plan), seed, spark)

    @F.arrow_udf("array<string>")
    def cut(text: pa.Array, numbers: pa.Array, words: pa.Array, size: pa.Array) -> pa.Array:
        rows = zip(*(values(a) for a in (text, numbers, words, size)))
        return pa.array([None if t is None else cut_texts(t, n, w, s) for t, n, w, s in rows], pa.list_(pa.string()))

    others = [c for c in names if c != text_col]
    rows = with_shares(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0)]).alias("rest"),
            F.col(text_col).alias("whole"),
            F.col(source_col).cast("string").alias("source"),
            n_words(F.col(text_col)).alias("size"),
            _row_key(id_col, text_col).alias("key"),
        ),
        plan,
    ).select("rest", "whole", "size", "key", "place_of_source", drawn_pieces(seed).alias("pieces"))
    is_cut = F.exists("pieces", lambda p: p["words"] != F.col("size"))
    pieces = F.col("pieces")
    texts = cut(F.when(is_cut, F.col("whole")), pieces["number"], pieces["words"], F.col("size"))
    # Only texts that stay whole travel through the explode.
    drawn = rows.select(
        "rest",
        "key",
        F.when(~is_cut, F.col("whole")).alias("whole"),
        F.explode(
            F.arrays_zip(
                pieces.alias("piece"),
                shards_of(starts, F.col("place_of_source"), pieces["position"]).alias("shard"),
                F.coalesce(texts, F.transform(pieces, lambda _: F.lit(None).cast("string"))).alias("text"),
            )
        ).alias("x"),
    )
    fields = [
        F.coalesce("x.text", "whole").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in names
    ]
    place = F.xxhash64(F.lit(seed), F.col("x.piece.position"), "key", F.col("x.piece.number"))
    return (
        drawn.select(F.struct(*fields).alias("doc"), F.col("x.shard").alias("shard"), place.alias("place"))
        .repartition("shard", F.pmod("place", F.lit(SHARD_PARTS)))
        .sortWithinPartitions("shard", F.pmod("place", F.lit(SHARD_PARTS)), "place")
    )
