"""Hard negatives for contrastive training by a secondary-sort shuffle.

Every anchor is scored against all vectors.  Scores leave the tasks as rows with the key
(anchor, descending score, id); the shuffle brings an anchor's rows together in that order,
so an iterator that remembers a handful of open windows can go through them: a positive
opens a window of scores below its own, and the negatives that follow are emitted into the
windows they fall in.  No anchor's rows are ever held, whatever their number.

Scores are made in cells: anchors are dealt to blocks of bounded size, vectors to groups,
and a cell is one block against one group.  A cell sorts its anchors to the front, keeps
them as a matrix and streams the vectors past it.  Two passes keep the shuffle small: the
first sends the best positives of each cell, and once an anchor's positives are known, the
second sends the best negatives of each cell for each of their windows.  Nothing is lost
by this, as the best of all are among the best of their cells.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Components of an anchor block (8 bytes each in a task).
BLOCK_VALUES = 1 << 20
#: Vectors of a group at most; small tables have smaller groups so that all cores work.
GROUP_ROWS = 1 << 16
#: Scores that a task holds at a time.
TILE_SCORES = 1 << 21
#: Scores beyond this size count as this size, so that a hundred of them fit in a long.
MOST_SCORE = 1 << 56
_NONE = -(1 << 62)
_MOST_VALUE = 2.0**62
_KEY = ["anchor", "anchor_variant"]


def valid_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column
) -> DataFrame:
    """``id``, ``label``, ``vec``, ``variant`` and ``is_anchor`` of the rows that take part."""
    kind = vectors.schema[vector_col].dataType.elementType.typeName()
    vec = F.col(vector_col) if kind in ("float", "double") else F.col(vector_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("long").alias("label"),
            vec.alias("vec"),
            anchor.alias("is_anchor"),
        )
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
        .filter(finite)
        .distinct()
        .withColumn("variant", F.xxhash64("label", "vec"))
    )


def whole_numbers(vectors: list[np.ndarray], scale: float) -> np.ndarray:
    """Matrix of floor(scale * component)."""
    return np.floor(np.clip(scale * np.stack(vectors).astype(np.float64), -_MOST_VALUE, _MOST_VALUE))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices of whole numbers.

    Products of floats are exact while their sums stay below 2^53; beyond that Python's
    integers are used.
    """
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return np.clip((a @ b.T).astype(np.int64), -MOST_SCORE, MOST_SCORE)
    exact = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (a, b)]
    return np.clip(exact[0] @ exact[1].T, -MOST_SCORE, MOST_SCORE).astype(np.int64)


@dataclass
class Best:
    """The ``k`` highest scores of each anchor so far; earlier rows win ties."""

    score: np.ndarray
    id: np.ndarray
    variant: np.ndarray

    @classmethod
    def none(cls, anchors: int, k: int) -> Best:
        return cls(*(np.full((anchors, k), fill, dtype=np.int64) for fill in (_NONE, 0, 0)))

    def meet(self, scores: np.ndarray, ids: np.ndarray, variants: np.ndarray) -> None:
        """Take up a tile of scores, which is used up by it; ids ascend within and over tiles."""
        anchors, k = self.score.shape
        every = np.arange(anchors)
        for _ in range(min(k, scores.shape[1])):
            at = scores.argmax(axis=1)
            best = scores[every, at]
            better = np.flatnonzero(best > self.score[:, -1])
            if not len(better):
                return
            at = at[better]
            # Behind all scores that are as high, before those that are lower.
            place = (self.score[better] >= best[better, None]).sum(axis=1)
            for held, new in ((self.score, best[better]), (self.id, ids[at]), (self.variant, variants[at])):
                rows = held[better]
                for j in range(k - 1, 0, -1):
                    move = place < j
                    rows[move, j] = rows[move, j - 1]
                rows[np.arange(len(better)), place] = new
                held[better] = rows
            scores[better, at] = _NONE


@dataclass
class Cell:
    """The anchors of a cell, and what has been found for them."""

    number: int
    ids: list = field(default_factory=list)
    variants: list = field(default_factory=list)
    labels: list = field(default_factory=list)
    vectors: list = field(default_factory=list)
    known: list = field(default_factory=list)
    matrix: np.ndarray | None = None
    found: list[Best] = field(default_factory=list)


def _cells(
    batches: Iterator[pd.DataFrame],
    scale: float,
    begin: Callable[[Cell], list[Best]],
    meet: Callable[[Cell, np.ndarray, np.ndarray, np.ndarray, np.ndarray], None],
    end: Callable[[Cell], pd.DataFrame | None],
) -> Iterator[pd.DataFrame]:
    """Go through rows sorted by cell, anchors first, then by id."""
    cell: Cell | None = None

    def close() -> Iterator[pd.DataFrame]:
        out = end(cell) if cell is not None and cell.matrix is not None else None
        if out is not None and len(out):
            yield out

    for batch in batches:
        numbers = batch["cell"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)] if len(numbers) else [0]
        for s, e in zip(cuts, cuts[1:]):
            if cell is None or cell.number != numbers[s]:
                yield from close()
                cell = Cell(int(numbers[s]))
            rows = batch.iloc[s:e]
            front = int((rows["kind"] == 0).sum())
            if front:
                cell.ids += rows["id"].tolist()[:front]
                cell.variants += rows["variant"].tolist()[:front]
                cell.labels += rows["label"].tolist()[:front]
                cell.vectors += rows["vec"].tolist()[:front]
                cell.known += rows["scores"].tolist()[:front]
            if front == len(rows) or not len(cell.ids):
                continue
            if cell.matrix is None:
                cell.matrix = whole_numbers(cell.vectors, scale)
                cell.vectors = []
                cell.ids, cell.variants, cell.labels = (
                    np.array(x, dtype=np.int64) for x in (cell.ids, cell.variants, cell.labels)
                )
                cell.found = begin(cell)
            tile = max(1, TILE_SCORES // len(cell.ids))
            for t in range(front, len(rows), tile):
                part = rows.iloc[t : min(t + tile, len(rows))]
                scores = inner_products(cell.matrix, whole_numbers(part["vec"].tolist(), scale))
                same = cell.labels[:, None] == part["label"].to_numpy()[None, :]
                meet(cell, scores, same, part["id"].to_numpy(), part["variant"].to_numpy())
    yield from close()


def _rows_of(cell: Cell, best: Best) -> pd.DataFrame:
    anchor, place = np.nonzero(best.score > _NONE)
    return pd.DataFrame(
        {
            "anchor": cell.ids[anchor],
            "anchor_variant": cell.variants[anchor],
            "score": best.score[anchor, place],
            "id": best.id[anchor, place],
            "variant": best.variant[anchor, place],
        }
    )


def _positive_pass(scale: float, positives: int):
    def begin(cell: Cell) -> list[Best]:
        return [Best.none(len(cell.ids), positives)]

    def meet(cell, scores, same, ids, variants) -> None:
        itself = (cell.ids[:, None] == ids[None, :]) & (cell.variants[:, None] == variants[None, :])
        scores[~same | itself] = _NONE
        cell.found[0].meet(scores, ids, variants)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _cells(batches, scale, begin, meet, lambda cell: _rows_of(cell, cell.found[0]))

    return run


def window(positive_scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest negative score with low * p <= 100 * n <= high * p."""
    return -((-low * positive_scores) // 100), (high * positive_scores) // 100


def _negative_pass(scale: float, positives: int, negatives: int, low: int, high: int):
    def begin(cell: Cell) -> list[Best]:
        scores = np.full((len(cell.ids), positives), -1, dtype=np.int64)
        for i, known in enumerate(cell.known):
            scores[i, : len(known)] = known
        # A positive below zero has no window: low * p is above high * p.
        cell.known = [window(scores[:, j], low, high) for j in range(positives)]
        return [Best.none(len(cell.ids), negatives) for _ in range(positives)]

    def meet(cell, scores, same, ids, variants) -> None:
        scores[same] = _NONE
        for (least, most), best in zip(cell.known, cell.found):
            inside = (scores >= least[:, None]) & (scores <= most[:, None])
            if inside.any():
                best.meet(np.where(inside, scores, _NONE), ids, variants)

    def end(cell: Cell) -> pd.DataFrame:
        return pd.concat([_rows_of(cell, best) for best in cell.found]).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _cells(batches, scale, begin, meet, end)

    return run


def _first_positives(positives: int):
    """The first rows of each anchor; rows come in order of the key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, seen = None, 0
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for i, key in enumerate(zip(batch["anchor"].tolist(), batch["anchor_variant"].tolist())):
                seen = seen + 1 if key == at else 1
                at, keep[i] = key, seen <= positives
            yield batch.loc[keep, [*_KEY, "score", "id", "variant"]]

    return run


def open_windows(rows: Iterator[tuple], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) from rows in order.

    Rows are (anchor key, score, is positive, id), by anchor, then descending score, then
    positives before others, then id.  Only the windows of one anchor that are not full
    yet are remembered.
    """
    at, windows = None, []
    for anchor, score, positive, number in rows:
        if anchor != at:
            at, windows = anchor, []
        if positive:
            windows.append([number, score, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
        for w in windows:
            if 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor[0], w[0], w[2], number, w[1], score


def _emit(negatives: int, low: int, high: int):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                keys = zip(batch["anchor"].tolist(), batch["anchor_variant"].tolist())
                yield from zip(keys, batch["score"].tolist(), (batch["kind"] == 0).tolist(), batch["id"].tolist())

        out: list[tuple] = []
        for row in open_windows(rows(), negatives, low, high):
            out.append(row)
            if len(out) == 8192:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return run


_FOUND = "anchor long, anchor_variant long, score long, id long, variant long"


def _in_cells(anchors: DataFrame, rows: DataFrame, layout: DataFrame) -> DataFrame:
    """Anchors and vectors of every cell, ``kind`` 0 and 1, in the order of :func:`_cells`."""
    place = F.xxhash64("id", "variant", F.lit(7))
    columns = ["cell", "kind", "id", "variant", "label", "vec", "scores"]

    def dealt(table: DataFrame, copies: str, own: str, kind: int) -> DataFrame:
        copy, mine = F.explode(F.sequence(F.lit(0), F.col(copies) - 1)), F.pmod(place, F.col(own))
        table = table.join(F.broadcast(layout), F.size("vec") == F.col("dim")).withColumn("copy", copy)
        block, group = (mine, F.col("copy")) if kind == 0 else (F.col("copy"), mine)
        cell = F.col("first_cell") + block * F.col("groups") + group
        return table.select(cell.cast("long").alias("cell"), F.lit(kind).alias("kind"), *columns[2:])

    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("scores", none)
    anchors = anchors if "scores" in anchors.columns else anchors.withColumn("scores", none)
    both = dealt(anchors, "groups", "blocks", 0).union(dealt(rows, "blocks", "groups", 1))
    return both.repartition("cell").sortWithinPartitions("cell", "kind", "id", "variant")


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
) -> DataFrame:
    """Hard negatives of each positive of each anchor (the rows for which ``anchor`` holds).

    Components become floor(scale * x); a score is the integer inner product with the
    anchor, and higher scores come first, ties by smaller id.  An anchor's positives are
    its first ``positives`` other rows of the same label.  For each of them come the first
    ``negatives`` rows of other labels whose score is between ``low`` and ``high`` per cent
    of the positive's, as ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score``.  Positives of a score below zero have none.

    Rows with a null id, label or vector, or a null or non-finite component take no part.
    Rows that agree in id, label and vector count once; rows of one id that differ are rows
    of their own.  Vectors of different lengths are not compared; those without components
    score zero.  Components beyond 2^62 and scores beyond 2^56 count as these.  Other
    columns are not read; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    rows = stored(valid_vectors(vectors, id_col, vector_col, label_col, anchor), "vectors")
    sizes = (
        rows.groupBy(F.size("vec").alias("dim"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors"))
        .orderBy("dim")
        .collect()
    )
    shapes, first = [], 0
    for r in sizes:  # one row for each length of vectors
        blocks = math.ceil(r["anchors"] * max(1, r["dim"]) / BLOCK_VALUES)
        wanted = min(2 * spark.sparkContext.defaultParallelism, math.ceil(r["n"] / 1024))
        groups = max(wanted, math.ceil(r["n"] / GROUP_ROWS))
        if blocks:
            shapes.append((r["dim"], blocks, groups, first))
            first += blocks * groups
    layout = spark.createDataFrame(shapes, "dim int, blocks int, groups int, first_cell long")
    anchors = rows.filter("is_anchor")

    scored = _in_cells(anchors, rows, layout).mapInPandas(_positive_pass(scale, positives), _FOUND)
    order = [*_KEY, F.col("score").desc(), "id", "variant"]
    known = stored(
        scored.repartition(*_KEY)
        .sortWithinPartitions(*order)
        .mapInPandas(_first_positives(positives), _FOUND),
        "positives",
    )
    listed = known.groupBy(*_KEY).agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
    searching = anchors.join(
        listed, (F.col("id") == F.col("anchor")) & (F.col("variant") == F.col("anchor_variant"))
    )
    near = _in_cells(searching, rows, layout).mapInPandas(
        _negative_pass(scale, positives, negatives, low, high), _FOUND
    )
    both = known.withColumn("kind", F.lit(0)).union(near.withColumn("kind", F.lit(1)))
    order = [*_KEY, F.col("score").desc(), "kind", "id", "variant"]
    return (
        both.repartition(*_KEY)
        .sortWithinPartitions(*order)
        .mapInPandas(
            _emit(negatives, low, high),
            "anchor_id long, positive_id long, rank int, negative_id long, "
            "positive_score long, negative_score long",
        )
    )
