"""Language model, hard negatives and resampling against plain versions, on untidy tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from concordia.llm import hard_negatives, language_model, queries, resampling
from tests.oracle import assert_same_rows

SCHEMA = (
    "doc_id long, text string, n_words long, score double, rank long, place long, weight double, "
    "block long, turn int, held boolean, terms string"
)
CLASH = (9, 0.5, 1, 2, 3.0, 4, 5, True, "t")


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, *CLASH) for i, t in texts], SCHEMA)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# Resampling -----------------------------------------------------------------------


def plain_features(text):
    ws = plain_words(text)
    return [zlib.crc32(" ".join(ws[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(ws) - k + 1)]


def plain_resample(docs, target):
    raw, wanted = Counter(), Counter()
    for _, t in docs:
        raw.update(plain_features(t))
    for t in target:
        wanted.update(plain_features(t))
    s, t = sum(raw.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, text in docs:
        f = plain_features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(f), weight, weight + noise, len(plain_words(text)) >= 20))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = [r[:4] + (n + 1,) for n, r in enumerate(able[: 5 * len(able) // 100])]
    left = Counter(r[:4] for r in rows) - Counter(r[:4] for r in ranks)
    return sorted(map(str, ranks + [r + (None,) for r in left.elements()]))


@pytest.mark.parametrize("pivots", [1, 16])
def test_resampling_of_untidy_rows(spark, monkeypatch, pivots):
    monkeypatch.setattr(resampling.kth_smallest, "__defaults__", (pivots, 42))
    monkeypatch.setattr(resampling, "_SLICE", 50)
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 90)))) for i in range(300)]
    long = " ".join(f"Wört{i % 50} x{'y' * (i % 90)}" for i in range(400)) + " " + "z" * 500 + " end"
    texts += [(None, None), (1000, ""), (1001, " -- "), (None, long), (1002, long), (1002, long), (1003, "a b " * 30)]
    texts += [texts[5]] * 40
    target = [None, "", "aa bb cc " * 30, long]
    docs = docs_of(spark, texts).repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(docs, bench).collect()
    assert sorted(str(tuple(r)) for r in found) == plain_resample(texts, target)


def test_resampling_of_empty_tables(spark):
    none = docs_of(spark, [])
    bench = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(none, bench).count() == 0
    few = docs_of(spark, [(1, "a"), (2, None)])
    assert [r["rank"] for r in resampling.resample(few, bench.limit(0)).collect()] == [None, None]


def test_ranks_span_partitions(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    found = resampling.ranked(rows.repartition(7), ["k"]).orderBy("k").collect()
    assert [r["rank"] for r in found] == list(range(1, 5001))
    assert resampling.kth_smallest(rows, ["k"], 0) is None and resampling.kth_smallest(rows, ["k"], 5001) is None


# Hard negatives -------------------------------------------------------------------


def plain_negatives(rows, positives=5, negatives=3):
    kept = {
        (i, label, tuple(v)) for i, v, label in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    }
    whole = [(i, label, v, [math.floor(256 * x) for x in v]) for i, label, v in kept]
    out = []
    for a in (r for r in whole if r[0] % 50 == 0):
        scored = sorted(
            (-sum(x * y for x, y in zip(a[3], b[3])), b[0], b[1]) for b in whole if b is not a and len(b[2]) == len(a[2])
        )
        same = [s for s in scored if s[2] == a[1]][:positives]
        for p, pid, _ in same:
            near = [s for s in scored if s[2] != a[1] and -50 * p <= -100 * s[0] <= -95 * p][:negatives]
            out += [(a[0], pid, n + 1, s[1], -p, -s[0]) for n, s in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("tile, block, group", [(1 << 21, 1 << 20, 1 << 16), (64, 8, 40)])
def test_negatives_of_untidy_rows(spark, monkeypatch, tile, block, group):
    monkeypatch.setattr(hard_negatives, "TILE_SCORES", tile)
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", block)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", group)
    rng = random.Random(2)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(4)], rng.randint(0, 2)) for i in range(0, 500, 2)]
    hot = [0.5, 0.5, -0.5, 0.25]
    rows += [(1000 + i, hot, i % 3) for i in range(150)]
    rows += [(100, hot, 1), (50, hot, 0), (50, [1.0, 1.0, 1.0, 1.0], 0), (2001, [1.0, 2.0], 0), (2050, [1.0, 1.0], 0)]
    rows += [(2002, [1.1, 1.0], 1), (2100, [], 1), (2101, [], 1), (2102, [], 2), (-50, hot, 2)]
    rows += [(3000, None, 1), (3050, hot, None), (None, hot, 1), (3100, [float("nan"), 1.0, 1.0, 1.0], 1)]
    rows += [(3150, [float("inf"), 1.0, 1.0, 1.0], 1), (3200, [None, 1.0, 1.0, 1.0], 1)] + rows[:30]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    table = table.withColumns({"scores": F.lit(1), "cell": F.lit(2), "anchor": F.lit("x")}).repartition(6)
    # Cells and anchors that span many Arrow batches.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 7 if tile == 64 else 100)
    try:
        found = hard_negatives.mine(table, F.col("vec_id") % 50 == 0)
        assert sorted(map(tuple, found.collect())) == plain_negatives(rows)
    finally:
        spark.conf.set(key, before)
    assert len(plain_negatives(rows)) > 50
    assert hard_negatives.mine(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_scores_beyond_floats_are_exact(spark):
    big = float(1 << 40)
    rows = [(0, [big, 1.0], 1), (1, [1.0, big], 1), (2, [0.75, 0.0], 2), (3, [0.5, 2.0 ** 39], 2), (4, [1e300, 0.0], 3)]
    a, b = (hard_negatives.whole_numbers([np.array(r[1]) for r in rows], 256.0) for _ in range(2))
    got = hard_negatives.inner_products(a, b)
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    most = hard_negatives.MOST_SCORE
    assert got.tolist() == [[max(-most, min(most, x)) for x in row] for row in exact]


# Language model -------------------------------------------------------------------


def plain_base(rows):
    """Held out, tokens, known tokens, training tokens and base score of each row."""
    cut = [(i, [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w)
                for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None]) for i, t in rows]
    out = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for (_, ws), held in zip(cut, out) if not held for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (str(i), held, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for (i, ws), held in zip(cut, out)
    ]


def english(n, seed):
    """Texts in which a word depends on the one before."""
    rng, words = random.Random(seed), [f"w{k}" for k in range(40)]
    out = []
    for i in range(n):
        at, text = rng.randrange(40), []
        for _ in range(rng.randint(5, 60)):
            at = (at * 7 + 3 + rng.choice([0, 0, 0, 1])) % 40
            text.append(words[at])
        out.append((i, " ".join(text)))
    return out


def test_base_scores_of_untidy_rows(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_WORDS", 500)
    texts = english(60, 1) + [
        (None, "w1 w2"), (61, None), (62, ""), (63, " \n"), (64, "Ä é x A\x00B �"), (65, "x " * 3000), (2, "W1 w2"), (2, "W1 w2"),
    ]
    rows = language_model.scored(docs_of(spark, texts).repartition(4)).collect()
    expected = plain_base(texts)
    key = lambda r: (r[0], r[2], round(r[5], 6))
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=key)
    for a, b in zip(got, sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert language_model.scored(docs_of(spark, [])).count() == 0
    lost = language_model.scored(docs_of(spark, [(None, "a b"), (None, "")])).collect()
    assert {(r.train_tokens, r.n_known) for r in lost} == {(0, 0)} and all(math.isfinite(r.score) for r in lost)


def test_the_model_learns_from_context(spark):
    docs = docs_of(spark, english(1500, 2)).repartition(3)
    rows = [r for r in language_model.scored(docs).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    assert len(rows) > 50
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 0.3
    again = {r.doc_id: r.score for r in language_model.scored(docs).collect()}
    assert all(again[r.doc_id] == r.score for r in rows)


def test_the_model_tells_hundreds_of_words_apart(spark):
    """Of 600 words of equal frequency each is followed by one of two."""
    rng, texts = random.Random(3), []
    for i in range(3000):
        at, words = rng.randrange(600), []
        for _ in range(60):
            at = (at * 7 + 3 + rng.choice([0, 1])) % 600
            words.append(f"w{at}")
        texts.append((i, " ".join(words)))
    rows = [r for r in language_model.scored(docs_of(spark, texts).repartition(2)).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 1.8


def test_features_reach_three_words_back():
    hashes = language_model._term_hashes([b"a", b"b", b"c", b"d", b"x"])
    one, other = (language_model.features(hashes[np.array(t)], np.array([0])) for t in ([0, 1, 2, 3], [4, 1, 2, 3]))
    assert (one[3] != other[3]).sum() == 1 and one.shape == (4, 4)


def test_numbers_of_terms_come_back():
    numbers = np.random.default_rng(5).integers(0, 1 << 32, 1000).astype(np.uint32)
    for some in (numbers, numbers[:1], numbers % 7):
        row = pd.DataFrame({"numbers": [language_model._planes(some)]}).iloc[0]
        assert (language_model._numbers(row) == some).all()


def test_terms_do_not_travel_with_the_texts(spark):
    """What is shuffled with the texts has hashes and counts of terms, not the terms."""
    plan = language_model.scored(docs_of(spark, english(20, 4)))._jdf.queryExecution().executedPlan().toString()
    assert "numbers#" in plan and "terms#" not in plan


def test_words_of_untidy_texts():
    texts = [None, "", " \n", "a", " A  b\t\x0bc\x0c\r", "Ä\xa0É\u2003z \x1cÿ\x85q", "x\x00Y", "  ", "İZ é"]
    for some in (texts, texts[3:4], texts[:3], texts[5:]):
        found, n = language_model.words(pa.array(some, pa.string()))
        expected = [(t or "").encode().lower().split() for t in some]
        assert n.tolist() == [len(w) for w in expected]
        assert [w.encode() for w in found.to_pylist()] == [w for ws in expected for w in ws]


def test_blocks_keep_documents_whole(spark, monkeypatch):
    """Blocks end with the document that fills them, also amid the rows that are cut together."""
    monkeypatch.setattr(language_model, "BLOCK_WORDS", 100)
    texts = [(i, " ".join(f"w{i * k % 17}" for k in range(i % 7 * 20))) for i in range(300)]
    docs = docs_of(spark, texts).coalesce(1).selectExpr("cast(doc_id as string)", "false", "0", "text")
    at = 0
    for r in docs.mapInArrow(language_model._encode, language_model._BLOCK).collect():
        assert sum(r.sizes[:-1]) < 100 and (sum(r.sizes) >= 100 or r.ids[-1] == "299")
        words = iter(bytes(r.terms[k]).decode() for k in language_model._numbers(r))
        for i, size in zip(r.ids, r.sizes):
            assert int(i) == at and [next(words) for _ in range(size)] == [*texts[at][1].split(), " "]
            at += 1
    assert at == 300


def test_probabilities_of_all_tokens_add_up_to_one():
    rng = np.random.default_rng(0)
    counts = {f"t{i}".encode(): int(rng.integers(1, 50)) for i in range(3000)} | {language_model.END: 90}
    top = sorted(counts, key=lambda t: (-counts[t], t))[: language_model.OWN]
    slots_n = language_model.CLASSES * language_model.WIDTH
    vocabulary = language_model.Vocabulary(
        sum(counts.values()), len(counts), {t: i for i, t in enumerate(top)}, np.zeros(slots_n, int), np.zeros(slots_n, int)
    )
    terms = list(counts)
    slots = vocabulary.slots(terms)
    np.add.at(vocabulary.slot_tokens, slots, list(counts.values()))
    np.add.at(vocabulary.slot_terms, slots, 1)
    weights, moved = language_model.Weights.of(vocabulary), np.zeros(language_model.CLASS_ROWS + language_model.SLOT_ROWS)
    hashes = language_model._term_hashes(terms)
    order = rng.integers(0, len(terms), 4000)
    found = language_model.features(hashes[order], np.arange(0, 4000, 100))
    language_model.learn(weights, moved, found, slots[order])
    assert np.abs(weights.rows).max() > 0 and moved.sum() == 2 * language_model.FEATURES * 4000
    # One history, every token that can follow it, and one unseen token of each shared slot.
    history = np.repeat(found[50:51], len(terms), axis=0)
    p = np.exp(language_model.log_probabilities(weights, history, slots))
    seen = p * vocabulary.within_slot(np.array(list(counts.values())), slots)
    shared = np.arange(language_model.OWN, slots_n)
    q = np.exp(language_model.log_probabilities(weights, np.repeat(found[50:51], len(shared), axis=0), shared))
    unseen = q * vocabulary.within_slot(np.zeros(len(shared)), shared)
    assert seen.sum() + unseen.sum() == pytest.approx(1, abs=1e-5)


def test_a_gradient_step_is_that_of_every_token():
    """Rows used by several tokens move by their summed gradient."""
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(6, language_model.WIDTH)).astype(np.float32)
    at, error = rng.integers(0, 6, (20, language_model.FEATURES)), rng.normal(size=(20, language_model.WIDTH)).astype(np.float32)
    weights = language_model.Weights(np.zeros(1), np.zeros(1), rows.copy(), np.zeros(6, dtype=np.float32))
    moved = np.zeros(6)
    language_model._gradient_step(weights, moved, at, error)
    for r in range(6):
        g = sum((error[t].astype(float) for t in range(20) for k in range(language_model.FEATURES) if at[t, k] == r), np.zeros(language_model.WIDTH))
        step = language_model.RATE * g / math.sqrt((g * g).sum() + 1)
        assert np.allclose(weights.rows[r], rows[r] - step, atol=1e-4)
        assert moved[r] == (at == r).sum()


# Registered queries ---------------------------------------------------------------


@pytest.mark.parametrize("name", ["op8_decontamination", "op12_hard_negatives", "op13_resampling"])
def test_queries_against_sql(spark, sf_dir, duck, name):
    assert_same_rows(queries.queries()[name](spark, sf_dir), duck, queries.oracle_sql()[name])


def test_contract_of_the_language_model(spark, sf_dir):
    found = queries.op11_language_model(spark, sf_dir)
    assert [f"{f.name}:{f.dataType.simpleString()}" for f in found.schema] == [
        "doc_id:bigint", "held_out:boolean", "n_tokens:bigint", "n_known:bigint", "train_tokens:bigint",
        "base_score:double", "score:double",
    ]
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = {r[0]: r for r in plain_base(texts)}
    for r in found.collect():
        e = expected[str(r.doc_id)]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[1:5] and r.base_score == pytest.approx(e[5])
