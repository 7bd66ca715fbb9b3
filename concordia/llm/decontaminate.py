"""Benchmark decontamination on a positional inverted index.

The training texts are indexed in blocks of documents.  A block is one row of a stored
table: its terms and, for each term, the ascending list of positions at which it occurs.
The index is built once and searched for any number of benchmarks, block by block, so no
posting is ever shuffled and a term that occurs in every document is spread over all
blocks.

A phrase is found from its rarest term in the block: the term's positions, less its offset
in the phrase, are the candidate starts, and the lists of the other terms, each less its
own offset, are intersected with them from rare to frequent.  A proximity match asks that
every term occurs within ``near`` words of the window's rarest term of all documents (of
equals, the first in byte order), in any order.

Windows of the benchmark are cut and packed by Spark and travel to the tasks in chunks of
about ``CHUNK``; a benchmark of more windows takes one more reading of the index for each
chunk, whose matches are put together block by block at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, values

WINDOW = 10
#: Words on either side of a window's rarest term within which op8 looks for its others:
#: a window and half as many inserted words.
NEAR = 15
#: Words of a block; the block of one very long document may have more.
BLOCK_WORDS = 1_000_000
#: Words of a block that a filter keeps only while it is searched.
FILTER_WORDS = 400_000
#: Windows of the benchmark sent to the tasks at a time (about 50 bytes each).
CHUNK = 400_000
#: Unused positions between documents: matches never reach over them.
GAP = 64
#: Candidate starts that are intersected at a time.
_SLICE = 2_000_000

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """ASCII letters (lower-cased), digits and everything beyond ASCII make words."""
    return (text or "").encode("utf-8", "replace").translate(_LETTERS).split()


@dataclass
class Block:
    """Positional index of some documents; document ``i`` starts at ``starts[i]``."""

    sizes: np.ndarray
    terms: dict[bytes, int]
    counts: np.ndarray
    positions: np.ndarray  # of term 0, of term 1, ...

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes + GAP) - (self.sizes + GAP)

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> Block:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        terms = dict.fromkeys(w for t in texts for w in t)
        terms = {w: i for i, w in enumerate(terms)}
        total = int(sizes.sum())
        ids = np.fromiter((terms[w] for t in texts for w in t), dtype=np.int32, count=total)
        position = np.arange(total) + np.repeat(np.arange(len(texts)) * GAP, sizes)
        order = np.argsort(ids, kind="stable")
        return cls(sizes, terms, np.bincount(ids, minlength=len(terms)), position[order])


@dataclass
class Windows:
    """A chunk of the benchmark: term numbers of each window, padded by -1.

    Windows name their item by its row, so items of one id or of none stay apart.
    """

    rows: np.ndarray
    ids: list[str]
    vocabulary: list[bytes]
    item: np.ndarray
    terms: np.ndarray
    anchor: np.ndarray | None = None  # rarest term of each window in the corpus

    def known(self, counts: np.ndarray) -> Windows:
        """The windows all of whose terms occur, with their rarest; ``counts`` by term."""
        order = sorted(range(len(counts)), key=lambda i: (counts[i], self.vocabulary[i]))
        rank = np.empty(len(counts) + 1, dtype=np.int64)
        rank[order], rank[-1] = np.arange(len(counts)), len(counts)
        first = self.terms[np.arange(len(self.terms)), rank[self.terms].argmin(axis=1)]
        keep = np.asarray(counts)[first] > 0
        return Windows(self.rows, self.ids, self.vocabulary, self.item[keep], self.terms[keep], first[keep])


def _windows(item_words: list[bytes], window: int) -> list[list[bytes]]:
    if len(item_words) <= window:
        return [item_words] if item_words else []
    return [item_words[i : i + window] for i in range(len(item_words) - window + 1)]


def _cut_items(window: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, name, text in zip(batch["row"].tolist(), batch["name"].tolist(), batch["text"].tolist()):
                found = [b" ".join(ws) for ws in _windows(words(text), window)]
                for s in range(0, len(found), 1 << 14):
                    yield pd.DataFrame({"row": row, "name": name, "window": found[s : s + (1 << 14)]})

    return cut


def _pack_windows(window: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row for each chunk; rows come sorted by chunk."""
        chunk, held = None, []

        def packed() -> pd.DataFrame:
            items = {r: name for r, name, _ in held}
            place = {r: i for i, r in enumerate(items)}
            vocabulary: dict[bytes, int] = {}
            terms = np.full((len(held), window), -1, dtype="<i4")
            for i, (*_, text) in enumerate(held):
                ws = text.split(b" ")
                terms[i, : len(ws)] = [vocabulary.setdefault(w, len(vocabulary)) for w in ws]
            item = np.array([place[r] for r, *_ in held], dtype="<i4")
            row = {
                "rows": np.array(list(items), dtype="<i8").tobytes(),
                "ids": list(items.values()),
                "vocabulary": b" ".join(vocabulary),
                "item": item.tobytes(),
                "terms": terms.tobytes(),
            }
            held.clear()
            return pd.DataFrame({k: [v] for k, v in row.items()})

        for batch in batches:
            for c, *row in zip(*(batch[k].tolist() for k in ("chunk", "row", "name", "window"))):
                if c != chunk and held:
                    yield packed()
                chunk = c
                held.append(row)
        if held:
            yield packed()

    return pack


def benchmark_chunks(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> Iterator[Windows]:
    """The windows of all items, about ``CHUNK`` at a time; equal rows are one item.

    The driver holds one packed chunk, which is also what the tasks are sent.
    """
    items = (
        benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).alias("text"))
        .filter("text IS NOT NULL")
        .distinct()
        .withColumn("row", F.monotonically_increasing_id())
    )
    cut = stored(items.mapInPandas(_cut_items(window), "row long, name string, window binary"), "windows")
    chunks = math.ceil(cut.count() / CHUNK)
    if not chunks:
        return
    packed = stored(
        cut.withColumn("chunk", F.pmod(F.xxhash64("window", "row"), F.lit(chunks)))
        .repartition("chunk")
        .sortWithinPartitions("chunk", "row", "window")
        .mapInPandas(_pack_windows(window), "rows binary, ids array<string>, vocabulary binary, item binary, terms binary"),
        "chunks",
    )
    for r in packed.toLocalIterator():
        yield Windows(
            np.frombuffer(r["rows"], dtype="<i8"),
            list(r["ids"]),
            bytes(r["vocabulary"]).split(b" "),
            np.frombuffer(r["item"], dtype="<i4").astype(np.int32),
            np.frombuffer(r["terms"], dtype="<i4").reshape(-1, window),
        )


def _candidates(block: Block, chunk: Windows, anchored: bool) -> Iterator[tuple]:
    """Slices of (windows, their terms from rare to frequent, offsets, which are used, places).

    Places are those of the rarest term in the block, or of the rarest one in the corpus.
    """
    local = np.array([block.terms.get(w, -1) for w in chunk.vocabulary] + [-1], dtype=np.int64)
    terms = local[chunk.terms]
    used = chunk.terms >= 0
    often = np.where(used, np.append(block.counts, 0)[terms], np.iinfo(np.int64).max)
    alive = np.flatnonzero(often.min(axis=1) > 0)
    if not len(alive):
        return
    order = np.argsort(often[alive], axis=1, kind="stable")
    terms = np.take_along_axis(terms[alive], order, axis=1)
    used = np.take_along_axis(used[alive], order, axis=1)
    lead = local[chunk.anchor[alive]] if anchored else terms[:, 0]
    first = np.cumsum(block.counts) - block.counts
    begin, n = first[lead], block.counts[lead]
    cuts = np.flatnonzero(np.diff(np.cumsum(n) // _SLICE)) + 1
    for s, e in zip(np.r_[0, cuts], np.r_[cuts, len(alive)]):
        row = np.repeat(np.arange(s, e), n[s:e])
        within = np.arange(len(row)) - np.repeat(np.cumsum(n[s:e]) - n[s:e], n[s:e])
        yield alive, terms, order, used, row, block.positions[begin[row] + within]


def _keys(block: Block) -> np.ndarray:
    """Term and position in one number, ascending as the postings are."""
    return (np.repeat(np.arange(len(block.counts)), block.counts) << 40) | block.positions


def phrase_matches(block: Block, chunk: Windows, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the chunk and the positions at which they start."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for alive, terms, order, used, row, place in _candidates(block, chunk, anchored=False):
        start = place - order[row, 0]
        for k in range(1, terms.shape[1]):
            if not len(row):
                break
            wanted = (terms[row, k] << 40) | (start + order[row, k])
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            keep = ~used[row, k] | ((start + order[row, k] >= 0) & (keys[at] == wanted))
            row, start = row[keep], start[keep]
        found.append((alive[row], start))
    return tuple(np.concatenate(x) for x in zip(*found))


def near_matches(
    block: Block, chunk: Windows, keys: np.ndarray, near: int
) -> tuple[np.ndarray, np.ndarray]:
    """Windows and positions of their rarest term with all other terms within ``near`` words."""
    if near >= GAP:
        raise ValueError(f"near must be below {GAP}")
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for alive, terms, _, used, row, place in _candidates(block, chunk, anchored=True):
        for k in range(terms.shape[1]):
            if not len(row):
                break
            low = (terms[row, k] << 40) | np.maximum(place - near, 0)
            at = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
            high = (terms[row, k] << 40) | (place + near)
            keep = ~used[row, k] | ((keys[at] >= low) & (keys[at] <= high))
            row, place = row[keep], place[keep]
        found.append((alive[row], place))
    return tuple(np.concatenate(x) for x in zip(*found))


def _spans(block: Block, chunk: Windows) -> dict[str, list]:
    """Passages of a block that occur in an item: document, item, first word, words."""
    keys = _keys(block)
    window, start = phrase_matches(block, chunk, keys)
    doc = np.searchsorted(block.starts, start, side="right") - 1
    item, length = chunk.item[window], (chunk.terms[window] >= 0).sum(axis=1)
    order = np.lexsort((start, item, doc))
    doc, item, start, end = doc[order], item[order], start[order], (start + length)[order]
    own = np.ones(len(doc), dtype=bool)
    own[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    # How far the windows of an item reach so far; a long one may cover later short ones.
    shift = (np.cumsum(own) - 1) * (int(end.max(initial=0)) + 1)
    reach = np.maximum.accumulate(end + shift) - shift
    new = own.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(doc)] - 1 if len(first) else first
    return {
        "doc": doc[first].tolist(),
        "item": chunk.rows[item[first]].tolist(),
        "name": [chunk.ids[i] for i in item[first]],
        "start": (start[first] - block.starts[doc[first]]).tolist(),
        "words": (reach[last] - start[first]).tolist(),
    }


def _near_pairs(block: Block, chunk: Windows, near: int) -> dict[str, list]:
    window, place = near_matches(block, chunk, _keys(block), near)
    doc = np.searchsorted(block.starts, place, side="right") - 1
    pairs = sorted({(int(d), int(i)) for d, i in zip(doc, chunk.item[window])})
    return {
        "near_doc": [d for d, _ in pairs],
        "near_item": [int(chunk.rows[i]) for _, i in pairs],
        "near_name": [chunk.ids[i] for _, i in pairs],
    }


def _hits(sizes: np.ndarray, spans: dict[str, list]) -> np.ndarray:
    """Words of each document that lie in some span."""
    starts = np.cumsum(sizes + GAP) - (sizes + GAP)
    edge = np.zeros(int((sizes + GAP).sum()) + 1, dtype=np.int64)
    at = starts[np.array(spans["doc"], dtype=np.int64)] + np.array(spans["start"], dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + np.array(spans["words"], dtype=np.int64), -1)
    covered = np.r_[0, np.cumsum(np.cumsum(edge) > 0)]
    return covered[starts + sizes] - covered[starts]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional index of all texts: one row for each block of documents.

    ``ids`` and ``sizes`` hold each document's id and number of words, ``terms`` the terms
    separated by spaces, ``counts`` and ``postings`` their position lists, as differences
    of 32 bits.  Nothing is shuffled.
    """

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, serial = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def block() -> pd.DataFrame:
            b = Block.of(texts)
            row = {
                "block": (part << 24) + serial,
                "ids": list(ids),
                "sizes": b.sizes.tolist(),
                "terms": b" ".join(b.terms),
                "counts": b.counts.astype("<u4").tobytes(),
                "postings": np.diff(b.positions, prepend=0).astype("<i8").astype("<u4").tobytes(),
            }
            ids.clear()
            texts.clear()
            return pd.DataFrame({k: [v] for k, v in row.items()})

        for batch in batches:
            for i, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                ids.append(None if pd.isna(i) else i)
                texts.append(words(text))
                size += len(texts[-1])
                if size >= BLOCK_WORDS or len(ids) == 1 << 16:
                    yield block()
                    serial, size = serial + 1, 0
        if ids:
            yield block()

    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(T.StringType())),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("terms", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("postings", T.BinaryType()),
        ]
    )
    # A null id must not turn whole numbers into floats on the way.
    plain = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    rows = plain.mapInPandas(index, schema)
    return stored(rows.withColumn("ids", F.col("ids").cast(T.ArrayType(kind))), "index")


def _block(row) -> Block:
    counts = np.frombuffer(row.counts, dtype="<u4").astype(np.int64)
    # Sums modulo 2^32 undo the differences; positions of a block stay far below that.
    positions = np.cumsum(np.frombuffer(row.postings, dtype="<u4"), dtype=np.uint32).astype(np.int64)
    terms = {w: i for i, w in enumerate(row.terms.split())}
    return Block(np.array(row.sizes, dtype=np.int64), terms, counts, positions)


_FIELDS = ("doc", "item", "name", "start", "words", "near_doc", "near_item", "near_name")
_FOUND = (
    "block long, doc array<int>, item array<long>, name array<string>, start array<int>, words array<int>, "
    "near_doc array<int>, near_item array<long>, near_name array<string>"
)


def _chunk_pass(index: DataFrame, chunk: Windows, near: int | None) -> DataFrame:
    """Matches of one chunk of the benchmark: one row for each block that has any."""

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if not len(row.counts):
                    continue
                block = _block(row)
                found = _spans(block, chunk)
                found |= _near_pairs(block, chunk, near) if near is not None else {f: [] for f in _FIELDS[5:]}
                if found["doc"] or found["near_doc"]:
                    yield pd.DataFrame({"block": [row.block]} | {f: [found[f]] for f in _FIELDS})

    return index.drop("ids").mapInPandas(match, _FOUND)


def _corpus_counts(index: DataFrame, chunk: Windows) -> np.ndarray:
    """How often each term of a chunk occurs in all indexed texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {w: i for i, w in enumerate(chunk.vocabulary)}
        total = np.zeros(len(place), dtype=np.int64)
        for batch in batches:
            for terms, counts in zip(batch["terms"], batch["counts"]):
                counts = np.frombuffer(counts, dtype="<u4")
                for i, w in enumerate(terms.split()):
                    if (at := place.get(w)) is not None:
                        total[at] += counts[i]
        used = np.flatnonzero(total)
        yield pd.DataFrame({"term": used, "n": total[used]})

    out = np.zeros(len(chunk.vocabulary), dtype=np.int64)
    rows = index.select("terms", "counts").mapInPandas(count, "term long, n long")
    for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per document of each block, from the matches of all chunks."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            chunks = [] if row.found is None else list(row.found)
            found = {f: [x for c in chunks for x in c[f]] for f in _FIELDS}
            by_doc: dict[int, list] = {}
            for d, *span in zip(*(found[f] for f in ("doc", "item", "name", "start", "words"))):
                by_doc.setdefault(d, []).append(span)
            close: dict[int, set] = {}
            for d, *item in zip(*(found[f] for f in ("near_doc", "near_item", "near_name"))):
                close.setdefault(d, set()).add(tuple(item))
            sizes = np.array(row.sizes, dtype=np.int64)
            docs = range(len(sizes))
            yield pd.DataFrame(
                {
                    "doc_id": list(row.ids),
                    "n_words": sizes,
                    "n_hit": _hits(sizes, found),
                    "items": [sorted(n for _, n in {(i, n) for i, n, *_ in by_doc.get(d, ())}) for d in docs],
                    "near_items": [sorted(n for _, n in close.get(d, ())) for d in docs],
                    "passages": [
                        [{"item_id": n, "start": s, "words": w} for _, n, s, w in by_doc.get(d, ())] for d in docs
                    ],
                }
            )


def search(
    index: DataFrame,
    benchmark: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    window: int = WINDOW,
    near: int | None = None,
) -> DataFrame:
    """One row per indexed document with what it shares with the benchmark.

    ``n_words``; ``n_hit``, its words inside exact occurrences of a window; ``items``, the
    sorted ids of items with such windows; ``passages``, each occurrence as item, first
    word and words, overlapping windows of an item in one (a passage may come in parts if
    the benchmark has several chunks); ``near_items``, items with a window all of whose
    terms lie within ``near`` words of its rarest (empty if ``near`` is not given).

    A window is ``window`` consecutive words of an item, or all of a shorter one.  Null
    and empty texts have no words.  Items are rows: those that agree in id and text are
    one, others of the same id count one by one, and a null id is named as an empty text.
    Repeated rows of the index stay repeated.  An empty benchmark gives zeros.
    """
    kind = index.schema["ids"].dataType.elementType
    passes = [
        stored(_chunk_pass(index, chunk.known(_corpus_counts(index, chunk)), near), "found")
        for chunk in benchmark_chunks(benchmark, id_col, text_col, window)
    ]
    blocks = index.select("block", F.col("ids").cast("array<string>").alias("ids"), "sizes")
    if passes:
        found = reduce(DataFrame.union, passes)
        by_block = found.groupBy(F.col("block").alias("at")).agg(F.collect_list(F.struct(*_FIELDS)).alias("found"))
        blocks = blocks.join(by_block, F.col("block") == F.col("at"), "left").drop("at")
    else:
        blocks = blocks.withColumn("found", F.lit(None).cast(f"array<struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>>"))
    result = blocks.mapInPandas(
        _digests,
        "doc_id string, n_words long, n_hit long, items array<string>, near_items array<string>, "
        "passages array<struct<item_id:string,start:int,words:int>>",
    )
    return result.withColumn("doc_id", F.col("doc_id").cast(kind))


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` without the rows that contain a window of the benchmark, all columns kept.

    The index of each batch of rows lives only while the batch is searched: a filter
    needs no stored postings, and rows need no key.  Null and empty texts have no words and
    stay, repeated rows stay or go together, and an empty benchmark keeps all rows.  A
    batch ends after ``FILTER_WORDS`` words, so a very long text is a batch of its own.
    """
    for chunk in benchmark_chunks(benchmark, item_col, item_text_col, window):
        docs = docs.filter(~_contaminated(chunk)(F.col(text_col)))
    return docs


def _contaminated(chunk: Windows):
    def block_hits(texts: list[list[bytes]]) -> np.ndarray:
        hit = np.zeros(len(texts), dtype=bool)
        block = Block.of(texts)
        if len(block.counts):
            _, start = phrase_matches(block, chunk, _keys(block))
            hit[np.searchsorted(block.starts, start, side="right") - 1] = True
        return hit

    @F.arrow_udf("boolean")
    def contaminated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            hits, texts, size = [np.zeros(0, dtype=bool)], [], 0
            for text in values(batch):
                texts.append(words(text))
                size += len(texts[-1])
                if size >= FILTER_WORDS:
                    hits.append(block_hits(texts))
                    texts, size = [], 0
            if texts:
                hits.append(block_hits(texts))
            yield pa.array(np.concatenate(hits), pa.bool_())

    return contaminated


def digest(found: DataFrame, proximity: bool = False) -> DataFrame:
    """The columns by which two searches are compared; the hashes are of the item ids.

    With ``proximity``, ``n_near_items`` and ``near_items_sha256`` follow; proximity matches
    do not count for ``contaminated``.
    """
    near = [
        F.size("near_items").cast("long").alias("n_near_items"),
        F.sha2(F.array_join("near_items", ","), 256).alias("near_items_sha256"),
    ]
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        *(near if proximity else []),
    )
