"""The mix against a plain one made document by document."""

import struct
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from concordia.llm import mixing


def spark_hash(*parts):
    """Spark's xxhash64 of longs, ints (given as one-tuples) and texts; nulls are passed over."""
    h = 42
    for p in parts:
        if p is None:
            continue
        data = p.encode() if isinstance(p, str) else struct.pack("<i", p[0]) if isinstance(p, tuple) else struct.pack("<q", p)
        h = xxhash.xxh64_intdigest(data, seed=h)
        h -= (1 << 64) * (h >> 63)
    return h


def plain_mix(rows, seed, piece_words, block_words):
    """Words taken of each row, by going through all pieces of a source in drawing order."""
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(len(t.split()) for _, x, t in rows if x == s) for s in sources}
    targets = mixing.targets([size[s] for s in sources], [(3.0, 1.0, 2.0)[i % 3] for i in range(len(sources))])
    taken = dict.fromkeys(range(len(rows)), 0)
    for s, target in zip(sources, targets):
        blocks = 1
        while blocks * block_words < size[s]:
            blocks *= 2
        left = min(round(target), 2 * size[s])
        for turn in range(2):
            order = []
            for r, (i, source, text) in enumerate(rows):
                if source != s:
                    continue
                n = len(text.split())
                for number in range(-(-n // piece_words)):
                    key = spark_hash(i, text)
                    block = spark_hash(key, number, (seed,)) % blocks
                    position = (block * (40_503 + 2 * turn) + 12_289 * (turn + 1)) % blocks
                    place = spark_hash(key, number, (seed + 1,))
                    order.append((position, place, min(piece_words, n - number * piece_words), r))
            for _, _, n, r in sorted(order):
                used = min(n, left)
                taken[r] += used
                left -= used
    return taken


def test_every_document_against_a_plain_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE_WORDS", 7)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 40)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 100)
    rng = np.random.default_rng(4)
    rows = [
        (i, ("a", "b", None, "c")[min(3, int(rng.integers(0, 6)))], " ".join(f"w{i}x{k}" for k in range(rng.integers(1, 60))))
        for i in range(150)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    report = mixing.mix_report(docs, seed=11).collect()
    expected = plain_mix(rows, 11, 7, 40)
    assert {r.doc_id: r.taken for r in report} == expected
    mixed = mixing.mix(docs, seed=11).select("doc.*", "shard").collect()
    by_doc, shards = {}, {}
    for r in mixed:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + len(r.text.split())
        shards.setdefault(r.doc_id, set()).add(r.shard)
    assert by_doc == {i: n for i, n in expected.items() if n}
    assert {r.doc_id: r.shards for r in report if r.taken} == {i: sorted(s) for i, s in shards.items()}


def test_quotas_of_the_tree_are_what_shards_hold(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 16)
    rows = [(i, f"s{i % 3}", " ".join(["w"] * (1 + i % 20))) for i in range(400)]
    sizes = mixing.sized(spark.createDataFrame(rows, "doc_id long, source string, text string"), "doc_id", "text", "source")
    plan = mixing.plan_mix(sizes)
    starts = mixing.shard_starts(plan, 5, 3, spark)
    quotas = mixing.shard_quotas(plan, starts, spark).collect()
    for p in plan:
        assert sum(r.blocks for r in quotas if r.source == p.source) == p.drawn
    per_shard = [sum(r.blocks for r in quotas if r.shard == s) for s in range(5)]
    assert max(per_shard) - min(per_shard) <= 1


def test_blocks_of_very_many_large_sources_stay_countable():
    counts = np.full(8_000, mixing.ALL_BLOCKS // 8_000, dtype=np.int64)
    first, second = (mixing.shard_draw(s, counts * 2, 4, 1) for s in (1, 2))
    assert (first <= second).all() and abs(int(first.sum()) - int(counts.sum()) * 2 // 4) <= 1


def test_a_text_of_800_000_words_is_cut_once(spark):
    long = " ".join(f"w{i % 100}" for i in range(800_000))
    docs = spark.createDataFrame([(1, "a", long), (2, "b", "x y")], "doc_id long, source string, text string")
    begin = time.monotonic()
    words = mixing.mix(docs).select(F.sum(F.size(F.split("doc.text", " +")))).first()[0]
    assert words >= 800_000 and time.monotonic() - begin < 60


@pytest.mark.parametrize("columns", [["text", "source", "doc_id"], ["place", "shard", "x", "text", "source", "doc_id"]])
def test_columns_that_clash(spark, columns):
    docs = spark.createDataFrame([(1, "a", "x y z")], "doc_id long, source string, text string")
    for c in set(columns) - set(docs.columns):
        docs = docs.withColumn(c, F.lit(1))
    assert mixing.mix(docs.select(*columns)).select("doc.*").columns == columns
