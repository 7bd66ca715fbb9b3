"""Language-model scores of texts: a hashed maximum-entropy model with class-factored softmax.

The probability of a token after its history has three factors: that of its class, that of
its slot within the class, and that of the token within its slot.  Classes and slots are
softmaxes over sums of hashed features of the history (the word before, the pair before,
the words two and three back), so one token costs two short softmaxes whatever the size of the
vocabulary.  The most frequent tokens have slots of their own; all others share slots by
hash, where corpus counts tell them apart.  Biases start at the corpus shares, so without
any feature the model is the unigram model.

Documents are tokenised once into blocks, each with its own list of terms and its documents
as term numbers.  Spark sums the counts of a term over all blocks in one shuffle and sends them
back to the blocks with the term's hash, so no task holds a vocabulary larger than that of its
block, and the terms themselves do not travel with the texts.

Training takes every training document.  In each round the tasks start from the weights
they are sent, take gradient steps through their documents of that round, and send back how
far every feature's weights moved and how many tokens moved them; Spark sums these by
slices of the weights, and the next weights are the average movement, each task weighted
by its tokens of the feature.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Classes, and as many slots in each.
CLASSES = WIDTH = 32
#: Slots of single tokens; the others are shared by hash.
OWN = CLASSES * WIDTH * 3 // 4
#: Rows of hashed feature weights for classes, and for slots; powers of two.
CLASS_ROWS, SLOT_ROWS = 1 << 13, 1 << 15
ROUNDS = 2
RATE = 0.3
SMOOTHING = 0.1
#: Words of a block; the block of one very long document may have more.
BLOCK_WORDS = 1 << 21
#: Documents whose words are cut at a time, and counts that go back to the blocks at a time.
CUT_ROWS, PACK_ROWS = 128, 1 << 20
#: Tokens of a gradient step, and tokens whose features are made at a time.
STEP, BATCH = 1 << 12, 1 << 14
#: Rows of weights in a slice that is summed in one piece.
SLICE = 1 << 10
SALTS = 4
FEATURES = 4
#: Uses of a row in a gradient step that are added row by row of tokens.
_TURNS = 8
#: The end of a text, which no word can be.
END = b" "

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of some texts with A-Z lower-cased, and how many each text has."""
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    cut = pc.ascii_split_whitespace(plain)
    # A text without words is cut into one that is empty.
    some = pc.binary_length(plain).to_numpy(zero_copy_only=False) > 0
    found = cut.flatten()
    if not some.all():
        found = found.filter(pc.greater(pc.binary_length(found), 0))
    return found, np.where(some, pc.list_value_length(cut).to_numpy(zero_copy_only=False), 0)


def held_out(doc_id: Column, folds: int = 10) -> Column:
    """Documents that training never sees; null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


_BLOCK = (
    "block long, terms array<binary>, ids array<string>, held array<boolean>, turns array<int>, "
    "sizes array<long>, numbers binary"
)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: distinct terms, and each document as numbers of terms."""
    part, serial = TaskContext.get().partitionId(), 0
    ids, held, turns, sizes, parts, total = [], [], [], [], [], 0

    def block() -> pa.RecordBatch:
        found = pa.concat_arrays(parts).dictionary_encode()
        # Term 0 is the end, which stands behind the words of each document.
        terms = pa.concat_arrays([pa.array([END], pa.binary()), found.dictionary.cast(pa.binary())])
        numbers = np.zeros(total, dtype=np.uint32)
        is_word = np.ones(total, dtype=bool)
        is_word[np.cumsum(sizes) - 1] = False
        numbers[is_word] = found.indices.to_numpy() + 1
        row = [[(part << 24) + serial], None, [list(ids)], [list(held)], [list(turns)], [list(sizes)], [_planes(numbers)]]
        types = [
            pa.int64(), None, pa.list_(pa.string()), pa.list_(pa.bool_()),
            pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(),
        ]
        for kept in (ids, held, turns, sizes, parts):
            kept.clear()
        arrays = [t and pa.array(v, t) for v, t in zip(row, types)]
        arrays[1] = pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms)
        return pa.RecordBatch.from_arrays(arrays, names)

    names = [c.split()[0] for c in _BLOCK.split(", ")]
    for batch in batches:
        for first in range(0, batch.num_rows, CUT_ROWS):
            rows = batch.slice(first, CUT_ROWS)
            found, n = words(rows.column(3))
            ends = np.cumsum(n)
            plain = [rows.column(c).to_pylist() for c in range(3)]
            at = 0
            while at < len(n):
                # Up to the document that fills the block.
                before = ends[at] - n[at]
                sums = total + np.cumsum(n[at:] + 1)
                end = at + min(int(np.searchsorted(sums, BLOCK_WORDS)) + 1, (1 << 16) - len(ids), len(n) - at)
                for kept, column in zip((ids, held, turns), plain):
                    kept.extend(column[at:end])
                sizes.extend((n[at:end] + 1).tolist())
                parts.append(found.slice(before, ends[end - 1] - before))
                total = int(sums[end - at - 1])
                if total >= BLOCK_WORDS or len(ids) == 1 << 16:
                    yield block()
                    serial, total = serial + 1, 0
                at = end
    if ids:
        yield block()


def _planes(numbers: np.ndarray, kind: str = "<u4") -> bytes:
    """The lowest bytes of all numbers, then the next; the high ones, mostly zeros, compress well."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, size).T).tobytes()


def _of_planes(planes, kind: str = "<u4") -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _numbers(row) -> np.ndarray:
    return _of_planes(row.numbers).astype(np.int64)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[SimpleNamespace]:
    """Blocks one by one; terms stay an Arrow array."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = SimpleNamespace()
            for name in batch.schema.names:
                value = batch.column(name)[i]
                if name == "terms":
                    row.terms = value.values
                elif name == "numbers":
                    row.numbers = value.as_buffer()
                elif pa.types.is_list(value.type):
                    setattr(row, name, value.values.to_numpy(zero_copy_only=False))
                else:
                    setattr(row, name, value.as_py())
            yield row


_COUNTS = pa.schema([("block", pa.int64()), ("number", pa.int32()), ("term", pa.binary()), ("n", pa.int64())])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term of a block in its training documents."""
    for row in _each(batches):
        learn = np.repeat(~row.held.astype(bool), row.sizes)
        n = np.bincount(_numbers(row)[learn], minlength=len(row.terms))
        for s in range(0, len(n), 1 << 16):
            e = min(s + (1 << 16), len(n))
            columns = [np.full(e - s, row.block), np.arange(s, e, dtype=np.int32), row.terms.slice(s, e - s), n[s:e]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _COUNTS.types)], schema=_COUNTS)


def _crcs(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms), np.int64, len(terms))


def _slots_of(own: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """Slots of terms by their own one, or -1, and their hash."""
    return np.where(own < 0, OWN + crc % (CLASSES * WIDTH - OWN), own)


@dataclass
class Vocabulary:
    """Where terms stand in the classes, and what the corpus says of each slot."""

    total: int  # training tokens
    distinct: int  # distinct training tokens
    own: dict[bytes, int]  # terms with a slot of their own
    slot_tokens: np.ndarray  # training tokens of each slot
    slot_terms: np.ndarray  # distinct training terms of each slot

    def slots(self, terms: list[bytes]) -> np.ndarray:
        """Slot of each term; classes are consecutive runs of slots."""
        return _slots_of(np.fromiter((self.own.get(t, -1) for t in terms), np.int64, len(terms)), _crcs(terms))

    def slot_mass(self) -> np.ndarray:
        """Smoothed tokens of a slot: one unseen term more in those that are shared."""
        unseen = np.arange(CLASSES * WIDTH) >= OWN
        return self.slot_tokens + SMOOTHING * (self.slot_terms + unseen)

    def within_slot(self, terms: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Probability of terms of these counts in their slots."""
        return (terms + SMOOTHING) / self.slot_mass()[slots]


@dataclass
class Weights:
    """Rows of class and slot weights, and the summed squared gradients of each row."""

    class_bias: np.ndarray
    slot_bias: np.ndarray
    rows: np.ndarray
    squares: np.ndarray

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Weights:
        mass = np.maximum(vocabulary.slot_mass(), 1e-9).reshape(CLASSES, WIDTH)
        slot = np.log(mass / mass.sum(axis=1, keepdims=True))
        rows = np.zeros((CLASS_ROWS + SLOT_ROWS, WIDTH), dtype=np.float32)
        class_bias = np.log(mass.sum(axis=1) / mass.sum()).astype(np.float32)
        return cls(class_bias, slot.astype(np.float32), rows, np.zeros(len(rows), dtype=np.float32))

    def copy(self) -> Weights:
        return Weights(self.class_bias, self.slot_bias, self.rows.copy(), self.squares.copy())


def _exp_sums(x: np.ndarray) -> np.ndarray:
    """Put exponentials, but for a factor of each row, in place of ``x``; their sums."""
    # Exponentials of these and their sums are ordinary floats; others are shifted first.
    if not -60 < x.min() <= x.max() < 60:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], dtype=x.dtype)


def _softmax(x: np.ndarray) -> np.ndarray:
    """Softmax of each row."""
    x *= (1 / _exp_sums(x))[:, None]
    return x


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each row, at one place of it."""
    if not -60 < x.min() <= x.max() < 60:
        x -= x.max(axis=1, keepdims=True)
    chosen = x[np.arange(len(at)), at].astype(np.float64)
    return chosen - np.log(_exp_sums(x).astype(np.float64))


def features(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the features of each token's history, one row of ``FEATURES`` per token.

    ``hashes`` are those of the tokens of some documents in a row, ``starts`` tells the
    first token of each; what lies before a document is zero.
    """
    n = len(hashes)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    back = []
    for k in (1, 2, 3):
        h = np.zeros(n, dtype=np.uint64)
        h[k:] = hashes[: n - k]
        h[place < k] = 0
        back.append(h)
    one, two, three = back
    found = np.empty((n, FEATURES), dtype=np.uint64)
    found[:, 0] = one * _MIX[0] + _MIX[1]
    found[:, 1] = (one * _MIX[1] + two) * _MIX[2] + _MIX[0]
    found[:, 2] = two * _MIX[2] + _MIX[3]
    found[:, 3] = three * _MIX[3] + _MIX[2]
    return found


def _fold(x: np.ndarray) -> np.ndarray:
    return (x ^ (x >> np.uint64(31))) * _MIX[3] >> np.uint64(33)


def _class_rows(found: np.ndarray) -> np.ndarray:
    return (_fold(found) & np.uint64(CLASS_ROWS - 1)).astype(np.int64)


def _slot_rows(found: np.ndarray, classes: np.ndarray) -> np.ndarray:
    mixed = found * _MIX[2] + (classes.astype(np.uint64)[:, None] + np.uint64(1)) * _MIX[0]
    return CLASS_ROWS + (_fold(mixed) & np.uint64(SLOT_ROWS - 1)).astype(np.int64)


def _activations(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Summed weights of each token's features."""
    total = rows.take(at[:, 0], axis=0)
    for k in range(1, at.shape[1]):
        total += rows.take(at[:, k], axis=0)
    return total


def _gradient_step(weights: Weights, moved: np.ndarray, at: np.ndarray, error: np.ndarray) -> None:
    """One step against the summed gradient of every row that the tokens use."""
    flat = at.ravel()
    # Numbers of 16 bits are sorted by their digits.
    order = flat.astype(np.uint16 if len(weights.rows) <= 1 << 16 else np.int64).argsort(kind="stable")
    ordered, token = flat.take(order), order // at.shape[1]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    times = np.diff(starts, append=len(flat))
    # Rows from the most used down: the first tokens of all rows are added, then the second
    # ones of those rows that have one, and so on; what is left of the few others in runs.
    by_times = np.argsort(-np.minimum(times, _TURNS + 1).astype(np.int8), kind="stable")
    starts, times = starts.take(by_times), times.take(by_times)
    gradient = error.take(token.take(starts), axis=0)
    with_more = np.searchsorted(-np.minimum(times, _TURNS + 1), -np.arange(1, _TURNS + 1))
    for turn, n in enumerate(with_more[:-1].tolist(), 1):
        if not n:
            break
        gradient[:n] += error.take(token.take(starts[:n] + turn), axis=0)
    if many := with_more[-1]:
        left = times[:many] - _TURNS
        ends = np.cumsum(left)
        at_left = np.arange(ends[-1]) + np.repeat(starts[:many] + _TURNS - (ends - left), left)
        gradient[:many] += np.add.reduceat(error.take(token.take(at_left), axis=0), ends - left, axis=0)
    used = ordered.take(starts)
    squares = weights.squares.take(used) + np.einsum("ij,ij->i", gradient, gradient)
    weights.squares[used] = squares
    gradient *= (RATE / np.sqrt(squares + 1))[:, None]
    weights.rows[used] = weights.rows.take(used, axis=0) - gradient
    moved[used] += times


def learn(weights: Weights, moved: np.ndarray, found: np.ndarray, slots: np.ndarray) -> None:
    """Gradient steps through some tokens, given the features of their histories."""
    for s in range(0, len(slots), STEP):
        part, slot = found[s : s + STEP], slots[s : s + STEP]
        every, cls = np.arange(len(slot)), slot // WIDTH
        at = _class_rows(part)
        error = _softmax(_activations(weights.rows, at) + weights.class_bias)
        error[every, cls] -= 1
        _gradient_step(weights, moved, at, error)
        at = _slot_rows(part, cls)
        error = _softmax(_activations(weights.rows, at) + weights.slot_bias.take(cls, axis=0))
        error[every, slot % WIDTH] -= 1
        _gradient_step(weights, moved, at, error)


def log_probabilities(weights: Weights, found: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each token's slot after its history."""
    out = np.empty(len(slots))
    # As many at a time as stay in the processor's cache.
    for s in range(0, len(slots), STEP):
        part, slot = found[s : s + STEP], slots[s : s + STEP]
        cls = slot // WIDTH
        of_class = _activations(weights.rows, _class_rows(part)) + weights.class_bias
        of_slot = _activations(weights.rows, _slot_rows(part, cls)) + weights.slot_bias.take(cls, axis=0)
        out[s : s + STEP] = _log_softmax_at(of_class, cls) + _log_softmax_at(of_slot, slot % WIDTH)
    return out


def _term_hashes(terms: list[bytes]) -> np.ndarray:
    return _mixed(_crcs(terms))


def _mixed(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint64)
    return (crc + np.uint64(1)) * _MIX[1] ^ crc


def _slices(before: Weights, after: Weights, moved: np.ndarray, salt: int) -> Iterator[pa.RecordBatch]:
    """Movements of all rows, in slices: weights and squares times tokens, and tokens."""
    changes = [after.rows - before.rows, (after.squares - before.squares)[:, None]]
    both = np.concatenate([c * moved[:, None] for c in changes] + [moved[:, None]], axis=1).astype("<f4")
    for s in range(0, len(both), SLICE):
        if moved[s : s + SLICE].any():
            columns = [pa.array([s // SLICE], pa.int32()), pa.array([salt], pa.int32()), pa.array([both[s : s + SLICE].tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "salt", "moved"])


def _train_pass(start: Weights, vocabulary: Vocabulary, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = start.copy()
        moved = np.zeros(len(weights.rows))
        for row in _each(batches):
            numbers, terms = _numbers(row), row.terms.to_pylist()
            mine = ~row.held.astype(bool) & (row.turns == turn)
            starts = np.cumsum(row.sizes) - row.sizes
            hashes, slots = _term_hashes(terms), vocabulary.slots(terms)
            pool, held = [], 0
            for d in np.flatnonzero(mine).tolist():
                pool.append(numbers[starts[d] : starts[d] + row.sizes[d]])
                held += len(pool[-1])
                if held >= BATCH:
                    _learn_pool(weights, moved, pool, hashes, slots)
                    pool, held = [], 0
            if pool:
                _learn_pool(weights, moved, pool, hashes, slots)
        yield from _slices(start, weights, moved, TaskContext.get().partitionId() % SALTS)

    return run


def _learn_pool(weights, moved, pool, hashes, slots) -> None:
    at = np.concatenate(pool)
    sizes = np.array([len(p) for p in pool])
    learn(weights, moved, features(hashes[at], np.cumsum(sizes) - sizes), slots[at])


def _sum_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the slices of a partition; rows come sorted by slice and salt."""
    at, total = None, None

    def done() -> pd.DataFrame:
        return pd.DataFrame({"slice": [at[0]], "salt": [at[1]], "moved": [total.astype("<f4").tobytes()]})

    for batch in batches:
        for row in batch.itertuples(index=False):
            more = np.frombuffer(row.moved, dtype="<f4").astype(np.float64)
            if at == (row.slice, row.salt):
                total += more
                continue
            if at is not None:
                yield done()
            at, total = (row.slice, row.salt), more
    if at is not None:
        yield done()


_MOVED = "slice int, salt int, moved binary"


def train(blocks: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Weights after ``rounds`` rounds; a document takes part in the round of its turn.

    The weights have a fixed size; they alone pass through the driver.
    """
    weights = Weights.of(vocabulary)
    columns = ["block", "terms", "held", "turns", "sizes", "numbers"]
    for turn in range(rounds):
        moved = blocks.select(*columns).mapInArrow(_train_pass(weights, vocabulary, turn), _MOVED)
        salted = (
            moved.repartition("slice", "salt").sortWithinPartitions("slice", "salt").mapInPandas(_sum_slices, _MOVED)
        )
        summed = (
            salted.withColumn("salt", F.lit(0))
            .repartition("slice")
            .sortWithinPartitions("slice", "salt")
            .mapInPandas(_sum_slices, _MOVED)
        )
        weights = weights.copy()
        for r in summed.collect():
            s = slice(r["slice"] * SLICE, (r["slice"] + 1) * SLICE)
            both = np.frombuffer(bytes(r["moved"]), dtype="<f4").reshape(len(weights.squares[s]), -1)
            mean = both[:, :-1] / np.maximum(both[:, -1:], 1)
            weights.rows[s] += mean[:, :-1]
            weights.squares[s] += mean[:, -1]
    return weights


def _score_pass(weights: Weights, vocabulary: Vocabulary):
    scale = vocabulary.total + SMOOTHING * (vocabulary.distinct + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                sizes, at = np.array(row.sizes, dtype=np.int64), _numbers(row)
                # Every term of the block comes back once.
                n = sum(len(piece["numbers"]) for piece in row.counts) // 4
                counts, crc, own = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for piece in row.counts:
                    number = _of_planes(piece["numbers"])
                    counts[number] = _of_planes(piece["counts"], "<i8")
                    crc[number] = _of_planes(piece["crcs"])
                    own[number] = _of_planes(piece["own"], "<i2")
                slots = _slots_of(own, crc)
                base = np.log10((counts + SMOOTHING) / scale)
                within = np.log10(vocabulary.within_slot(counts, slots))
                hashes, starts = _mixed(crc), np.cumsum(sizes) - sizes
                score = np.empty(len(at))
                # Whole documents, about a batch of tokens at a time.
                cuts = np.flatnonzero(np.diff(starts // BATCH, prepend=-1))
                for s, e in zip(cuts, np.r_[cuts[1:], len(starts)]):
                    a, b = starts[s], starts[e] if e < len(starts) else len(at)
                    part = at[a:b]
                    found = features(hashes[part], starts[s:e] - a)
                    score[a:b] = log_probabilities(weights, found, slots[part]) / np.log(10) + within[part]
                yield pd.DataFrame(
                    {
                        "doc_id": list(row.ids),
                        "held_out": list(row.held),
                        "n_tokens": sizes,
                        "n_known": np.add.reduceat((counts[at] > 0).astype(np.int64), starts),
                        "base_score": np.add.reduceat(base[at], starts),
                        "score": np.add.reduceat(score, starts),
                    }
                )

    return run


_PACKED = "block long, numbers binary, counts binary, crcs binary, own binary"


def _pack_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, hashes and own slots on their way back to the blocks, many in a row."""
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        held.clear()
        columns = [rows.column(c).to_numpy() for c in ("block", "number", "c", "crc", "own")]
        order = np.lexsort(columns[1::-1])
        block, *rest = (c[order] for c in columns)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
        out = [pa.array(block[cuts[:-1]])]
        for column, kind in zip(rest, ("<u4", "<i8", "<u4", "<i2")):
            out.append(pa.array([_planes(column[s:e], kind) for s, e in zip(cuts, cuts[1:])], pa.binary()))
        return pa.RecordBatch.from_arrays(out, [c.split()[0] for c in _PACKED.split(", ")])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= PACK_ROWS:
            yield packed()
    if held:
        yield packed()


def corpus_vocabulary(counts: DataFrame) -> Vocabulary:
    """Slots from the table of terms ``term`` and their training counts ``c``.

    The driver receives the ``OWN`` most frequent terms and one row for each slot.
    """
    known = counts.filter("c > 0")
    top = known.orderBy(F.col("c").desc(), "term").limit(OWN).collect()
    own = {bytes(r["term"]): i for i, r in enumerate(top)}
    shared = CLASSES * WIDTH - OWN
    slot_tokens, slot_terms = (np.zeros(CLASSES * WIDTH, dtype=np.int64) for _ in range(2))
    by_slot = known.groupBy((F.crc32("term") % shared).alias("slot")).agg(
        F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("terms")
    )
    for r in by_slot.collect():
        slot_tokens[OWN + r["slot"]], slot_terms[OWN + r["slot"]] = r["tokens"], r["terms"]
    total, distinct = int(slot_tokens.sum()), int(slot_terms.sum())
    for r in top:
        term = bytes(r["term"])
        slot = OWN + zlib.crc32(term) % shared
        slot_tokens[slot] -= r["c"]
        slot_terms[slot] -= 1
        slot_tokens[own[term]], slot_terms[own[term]] = r["c"], 1
    return Vocabulary(total, distinct, own, slot_tokens, slot_terms)


def scored(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    held: Column | None = None,
) -> DataFrame:
    """Scores of all documents by a model of those that are not held out.

    ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens that
    occur in training documents), ``train_tokens``, ``base_score`` (unigram log10
    probability) and ``score`` (the model's log10 probability of the text).

    Null and empty texts are an end only.  Null ids are held out.  Repeated rows stay
    repeated, and each teaches.  Without any training document all scores rest on the
    smoothing alone.  Other columns are not read; an empty table gives an empty table.
    Hot terms are one row of each block; a document is never divided, so the task of a
    very long one holds its numbers (4 bytes a token).
    """
    kind = docs.schema[id_col].dataType
    out = held_out(F.col(id_col)) if held is None else F.coalesce(held, F.lit(True))
    plain = docs.select(
        F.col(id_col).cast("string").alias("id"),
        out.alias("held"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(rounds)).cast("int").alias("turn"),
        F.col(text_col).alias("text"),
    )
    blocks = stored(plain.mapInArrow(_encode, _BLOCK), "tokens")
    # Each term of each block with its count in the corpus: one shuffle, in which a term has a
    # row for each of its blocks at most.
    of_term = Window.partitionBy("term").orderBy("block")
    whole = of_term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_term = stored(
        blocks.select("block", "terms", "held", "sizes", "numbers")
        .mapInArrow(_term_counts, "block long, number int, term binary, n long")
        .select(
            "block", "number", "term", F.sum("n").over(whole).alias("c"), (F.row_number().over(of_term) == 1).alias("first")
        ),
        "terms",
    )
    vocabulary = corpus_vocabulary(by_term.filter("first").select("term", "c"))
    weights = train(blocks, vocabulary, rounds)
    own = docs.sparkSession.createDataFrame(
        [(bytearray(term), slot) for term, slot in vocabulary.own.items()], "term binary, own int"
    )
    packed = (
        by_term.join(F.broadcast(own), "term", "left")
        .select("block", "number", "c", F.crc32("term").alias("crc"), F.coalesce("own", F.lit(-1)).alias("own"))
        .mapInArrow(_pack_counts, _PACKED)
    )
    returned = packed.groupBy(F.col("block").alias("counted")).agg(
        F.collect_list(F.struct("numbers", "counts", "crcs", "own")).alias("counts")
    )
    scores = (
        blocks.drop("terms", "turns")
        .join(returned, F.col("block") == F.col("counted"))
        .drop("counted")
        .mapInPandas(
            _score_pass(weights, vocabulary),
            "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scores.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
