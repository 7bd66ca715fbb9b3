"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most three bits are found without comparing all
of them.  The 64 bits are cut into ``parts`` runs.  Of three differing bits at least one
lies in some run, so with that run left out the rest differs in at most two bits, and two
values at distance two meet in the middle: every fingerprint emits, for each run left out,
the rest itself and all of its variants at distance one.  The variants are shuffled; the
fingerprints that meet on one are verified on all 64 bits.

With four runs that is 196 variants of a fingerprint on keys of 48 bits, against 2,081
variants of the full width if the whole radius of two had to be emitted.

Only distinct fingerprints take part, so a group of copies counts as one.  The members of
one variant are at most two bits apart outside the left-out run, which makes all pairs
within a group needless: members that agree on the run hang on their smallest member, and
runs are compared by their neighbours at distance one, two and three.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, values
from .components import components

RADIUS = 3
SEED = 42
#: Shingles whose bits are unpacked at a time; bounds the memory of very long texts.
_SLICE = 1 << 14


def text_fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles of a text, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=">u8")
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle_words + 1]
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [
                digest(line[a:b], SEED)
                for a, b in zip(starts.tolist(), ends[shingle_words - 1 :].tolist())
            ],
            dtype=">u8",
        )
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _SLICE):
        bits = np.unpackbits(hashes[i : i + _SLICE].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle_words: int = 3) -> Column:
    """SimHash of a text column as a signed long; empty and null texts have zero.

    A-Z are lower-cased, words are separated by ASCII white space, shingles are hashed by
    XXH64 with seed 42 over UTF-8; a bit is set if it is in more than half of the shingles.
    """

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([text_fingerprint(t, shingle_words) for t in values(batch)], pa.int64())

    return simhash(text)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _runs(parts: int) -> list[tuple[int, int]]:
    """First bit and width of each run."""
    edges = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def ball_variants(nodes: DataFrame, parts: int = 4) -> DataFrame:
    """``part``, ``variant``, ``fp``: the ball of radius one around each rest of ``fp``."""
    variants = []
    for part, (start, width) in enumerate(_runs(parts)):
        rest = ((1 << 64) - 1) ^ (((1 << width) - 1) << start)
        flips = [0] + [1 << b for b in range(64) if not start <= b < start + width]
        variants += [
            F.struct(
                F.lit(part).cast("byte").alias("part"),
                F.lit(_signed(rest)).alias("rest"),
                F.lit(_signed(flip)).alias("flip"),
            )
            for flip in flips
        ]
    return nodes.select("fp", F.explode(F.array(*variants)).alias("x")).select(
        "x.part", F.col("fp").bitwiseAND(F.col("x.rest")).bitwiseXOR(F.col("x.flip")).alias("variant"), "fp"
    )


def _neighbours(values: np.ndarray, width: int, distance: int) -> Iterator[tuple]:
    """Index pairs of sorted values that differ in exactly ``distance`` bits.

    Short lists are compared directly, long ones by looking up the values that
    ``distance`` flipped bits lead to; the pairs are the same.
    """
    n = len(values)
    if n * n <= 1 << 20:
        i, j = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) == distance)
        yield i[i < j], j[i < j]
        return
    flips = [0]
    for _ in range(distance):
        flips = sorted({f | 1 << b for f in flips for b in range(width) if not f >> b & 1})
    for flip in flips:
        other = values ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(values, other), n - 1)
        hit = np.flatnonzero((values[at] == other) & (values < other))
        yield hit, at[hit]


def _group_links(fps: np.ndarray, key: int, start: int, width: int) -> Iterator[tuple]:
    """Links that connect what belongs together among the fingerprints of one variant."""
    mask = np.uint64(((1 << width) - 1) << start)
    fps = np.unique(fps)
    run = (fps & mask) >> np.uint64(start)
    runs, first = np.unique(run, return_index=True)
    lead = fps[first]
    where = np.searchsorted(runs, run)
    yield lead[where], fps
    exact = (fps & ~mask) == np.uint64(key)
    # At most one member of a run equals the variant itself outside the run.
    middle = np.zeros(len(runs), dtype=bool)
    middle[where[exact]] = True
    centre = lead.copy()
    centre[where[exact]] = fps[exact]
    for i, j in _neighbours(runs, width, 1):
        yield lead[i], lead[j]
    for i, j in _neighbours(runs, width, 2):
        for a, b in ((i, j), (j, i)):
            yield centre[a][middle[a]], lead[b][middle[a]]
    runs, centre = runs[middle], centre[middle]
    for i, j in _neighbours(runs, width, 3):
        yield centre[i], centre[j]


def ball_links(nodes: DataFrame, parts: int = 4) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` at most three bits apart.

    Repeated and redundant links of a group are left out, so the table has the same
    connected components as all links, not all links themselves.
    """
    shapes = _runs(parts)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by part and variant; a group may span batches."""
        held: list[tuple] = []

        def links(part, key, fps):
            found = [
                (np.minimum(a, b), np.maximum(a, b))
                for a, b in _group_links(fps.view(np.uint64), key & (1 << 64) - 1, *shapes[part])
            ]
            a, b = (np.concatenate(x) for x in zip(*found))
            keep = (a != b) & (np.bitwise_count(a ^ b) <= RADIUS)
            return a[keep].view(np.int64), b[keep].view(np.int64)

        def done():
            (part, key, _), fps = held[0], np.concatenate([x for *_, x in held])
            held.clear()
            return [links(part, key, fps)] if len(fps) > 1 else []

        for batch in batches:
            if not len(batch):
                continue
            part, key, fps = (batch[c].to_numpy() for c in ("part", "variant", "fp"))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(key)]
            out = []
            if held and (part[0], key[0]) != held[0][:2]:
                out += done()
            if held or len(starts) == 1:
                held.append((int(part[0]), int(key[0]), fps[: ends[0]].copy()))
                starts, ends = starts[1:], ends[1:]
                if len(starts):
                    out += done()
            if len(starts):
                for s, e in zip(starts[:-1], ends[:-1]):
                    if e - s > 1:
                        out.append(links(int(part[s]), int(key[s]), fps[s:e].copy()))
                held.append((int(part[starts[-1]]), int(key[starts[-1]]), fps[starts[-1] :].copy()))
            if out:
                a, b = (np.concatenate(x) for x in zip(*out))
                yield pd.DataFrame({"a": a, "b": b}).drop_duplicates()
        if held and (out := done()):
            yield pd.DataFrame(dict(zip("ab", out[0]))).drop_duplicates()

    return (
        ball_variants(nodes, parts)
        .repartition("part", "variant")
        .sortWithinPartitions("part", "variant")
        .mapInPandas(meet, "a long, b long")
        .distinct()
    )


def _grouped(docs: DataFrame, id_col: str, text: Column, shingle_words: int, parts: int) -> DataFrame:
    """``docs`` (narrow columns) with ``fp``, ``root`` and ``component_id``.

    ``root`` is the smallest fingerprint of the linked ones and tells groups apart, which
    ids cannot do where they are null or repeated.
    """
    narrow = [c for c in docs.columns if c != "text_"]
    prints = stored(docs.select(*narrow, fingerprint(text, shingle_words).alias("fp")), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min(id_col).alias("first")), "nodes")
    roots = components(ball_links(nodes.select("fp"), parts), "a", "b")
    linked = roots.join(nodes, roots["node"] == nodes["fp"]).select("fp", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = linked.join(least, "root").select("fp", "root", "component_id")
    labels = stored(
        nodes.join(moved, "fp", "left").select(
            F.col("fp").alias("label_fp"),
            F.coalesce("root", "fp").alias("root"),
            F.coalesce("component_id", "first").alias("component_id"),
        ),
        "labels",
    )
    return prints.join(labels, prints["fp"] == labels["label_fp"]).select(*narrow, "fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    parts: int = 4,
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``.

    ``component_id`` is the smallest id among all documents reachable by links of at most
    three differing bits, the document itself included.  Null and empty texts have the
    fingerprint zero and are linked like any other.  Repeated rows stay repeated.  Null
    ids never name a component; one of null ids only has a null ``component_id``.  Extra
    columns are not read; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text_"))
    return _grouped(rows, "doc_id", F.col("text_"), shingle_words, parts).drop("root")


def row_key(id_: Column, text: Column) -> Column:
    """Hash of id and text, by which the rows that stay are found again."""
    return F.md5(
        F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("-")), text.isNull().cast("string"), text)
    )


def leaders_of(docs: DataFrame, key: Column, marked: DataFrame) -> DataFrame:
    """Rows of ``docs`` that lead a group: ``marked`` has ``doc_id``, ``key_`` and ``root`` of all."""
    leaders = marked.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key_"))["key_"].alias("leader_key_")
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_"), key.alias("key_"))
    return (
        whole.join(stored(leaders.select("leader_key_"), "leaders"), F.col("key_") == F.col("leader_key_"))
        .dropDuplicates(["key_"])
        .select("row_.*")
    )


def keep_representatives(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    parts: int = 4,
) -> DataFrame:
    """All columns of one document of each group: the one with the smallest id.

    A group is what fingerprints link, whatever its ids: null or repeated ids neither join
    texts nor part them.  Rows that share the smallest id are told apart by a hash of id
    and text; rows that agree in both count as one.  A group of null ids keeps one row.
    """
    id_, text = F.col(id_col), F.col(text_col)
    key = row_key(id_, text)
    rows = docs.select(id_.alias("doc_id"), key.alias("key_"), text.alias("text_"))
    return leaders_of(docs, key, _grouped(rows, "doc_id", F.col("text_"), shingle_words, parts))
