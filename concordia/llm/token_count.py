"""Token counts without token ids.

Texts are cut into pre-tokens.  The pieces of a pre-token are counted once for the whole
corpus, the counts are joined to each document's pre-token frequencies, and their products
are summed.

Frequencies are kept by blocks of documents: a block has its distinct pre-tokens once and,
for each document, their numbers in the block and how often they occur, so what is shuffled
is one row for each pre-token of a block instead of one for each pre-token of a document.
A pre-token that every document contains is one row of each block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_bytes, stored
from .pieces import load_model, pretoken_ids, pretokens

#: Characters of a block; the block of one very long document may have more.
BLOCK_CHARS = 32 << 20
OVER = 4096


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte of equal weight, which compresses small ones well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


_BLOCK = (
    "block long, terms array<string>, ids array<string>, bytes array<long>, "
    "ends array<long>, term_gaps binary, freqs binary"
)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of documents: each one's distinct pre-tokens, ascending, and their frequencies."""
    part, serial = TaskContext.get().partitionId(), 0
    number: dict[str, int] = {}
    ids, sizes, ends, gaps, freqs, chars = [], [], [], [], [], 0

    def block() -> pd.DataFrame:
        row = {
            "block": (part << 24) + serial,
            "terms": list(number),
            "ids": list(ids),
            "bytes": list(sizes),
            "ends": np.cumsum(ends).tolist(),
            "term_gaps": _planes(np.concatenate(gaps)),
            "freqs": _planes(np.concatenate(freqs)),
        }
        for held in (number, ids, sizes, ends, gaps, freqs):
            held.clear()
        return pd.DataFrame({k: [v] for k, v in row.items()})

    for batch in batches:
        for i, size, text in zip(batch["id"], batch["n_bytes"], batch["text"]):
            found = Counter(pretokens(text))
            at = np.fromiter((number.setdefault(t, len(number)) for t in found), np.int64, len(found))
            order = np.argsort(at)
            ids.append(None if pd.isna(i) else i)
            sizes.append(int(size))
            ends.append(len(found))
            gaps.append(np.diff(at[order], prepend=0))
            freqs.append(np.fromiter(found.values(), np.int64, len(found))[order])
            chars += len(text or "")
            if chars >= BLOCK_CHARS or len(ids) == 1 << 17:
                yield block()
                serial, chars = serial + 1, 0
    if ids:
        yield block()


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            ends = np.array(row.ends, dtype=np.int64)
            gaps, freqs = _numbers(row.term_gaps).astype(np.int64), _numbers(row.freqs).astype(np.int64)
            starts = ends - np.diff(ends, prepend=0)
            # Numbers restart with each document: take off what the running sum had before it.
            at = np.cumsum(gaps)
            before = np.r_[0, at][starts]
            at -= np.repeat(before, ends - starts)
            counts = np.zeros(int(at.max(initial=0)) + 1, dtype=np.int64)
            for piece in () if row.counts is None else row.counts:
                numbers, n = (_numbers(half) for half in (piece[: len(piece) // 2], piece[len(piece) // 2 :]))
                counts[np.cumsum(numbers.astype(np.int64))] = n
            total = np.r_[0, np.cumsum(counts[at] * freqs)] if len(at) else np.zeros(1, np.int64)
            yield pd.DataFrame(
                {"id": list(row.ids), "n_bytes": list(row.bytes), "n_tokens": total[ends] - total[starts]}
            )


def token_counts(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", over: int = OVER
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``over``) per row.

    Counts are those of the model on the whole text without begin or end tokens; special
    strings in a text are ordinary text to it.  Null and empty texts have no bytes and no
    tokens.  Repeated rows and null ids stay as they are; other columns are not read.  An
    empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType
    plain = docs.select(
        F.col(id_col).cast("string").alias("id"),
        n_bytes(F.col(text_col)).alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    blocks = stored(plain.mapInPandas(_frequencies, _BLOCK), "frequencies")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by term, so each is cut once, wherever it occurs.

        The counts go back to the blocks many in a row: numbers and counts, byte by byte.
        """
        model, last, known = load_model(model_path), None, 0
        for batch in batches:
            terms = batch["term"]
            if not len(terms):
                continue
            new = terms != terms.shift()
            new.iloc[0] = terms.iloc[0] != last
            fresh = terms[new].tolist()
            counts = [known, *map(len, pretoken_ids(model, fresh))]
            n = np.array(counts, dtype=np.int64)[np.cumsum(new.to_numpy())]
            last, known = terms.iloc[-1], int(n[-1])
            block, number = batch["block"].to_numpy(), batch["number"].to_numpy()
            order = np.lexsort((number, block))
            block, number, n = block[order], number[order], n[order]
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
            pieces = [
                _planes(np.diff(number[s:e], prepend=0)) + _planes(n[s:e]) for s, e in zip(cuts, cuts[1:])
            ]
            yield pd.DataFrame({"block": block[cuts[:-1]], "piece": pieces})

    counted = (
        blocks.select("block", F.posexplode("terms").alias("number", "term"))
        .repartition("term")
        .sortWithinPartitions("term")
        .mapInPandas(count, "block long, piece binary")
    )
    by_block = counted.groupBy(F.col("block").alias("counted")).agg(F.collect_list("piece").alias("counts"))
    joined = blocks.drop("terms").join(by_block, F.col("block") == F.col("counted"), "left")
    return joined.drop("counted").mapInPandas(_sums, "id string, n_bytes long, n_tokens long").select(
        F.col("id").cast(kind).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit")
    )
