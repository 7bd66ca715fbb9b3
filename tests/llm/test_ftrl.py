"""The toxicity learner against FTRL-proximal updates written out one feature at a time."""

import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from concordia.llm import toxicity

MASK = (1 << 64) - 1
STEM, PAIR, SKIP = (int(x) for x in (toxicity._STEM, toxicity._PAIR, toxicity._SKIP))


def plain_features(text, bits):
    words = re.findall(r"\w+", text.lower())
    crc = lambda w: zlib.crc32(w.encode())
    mixed = [crc(w) * PAIR for w in words]
    mixed += [crc(w[: toxicity.STEM_LETTERS]) * STEM + SKIP for w in words]
    mixed += [(crc(a) * STEM + crc(b)) * PAIR for a, b in zip(words, words[1:])]
    mixed += [(crc(a) * PAIR + crc(b)) * SKIP for a, b in zip(words, words[2:])]
    out = set()
    for m in mixed:
        m &= MASK
        out.add((((m ^ (m >> 29)) * STEM) & MASK) >> (64 - bits))
    return out


def plain_ftrl(rows, alpha, beta, l1, l2, epochs):
    z, n = {}, {}

    def weight(i):
        penalty = 0.0 if i == "bias" else l1
        zi = z.get(i, 0.0)
        if abs(zi) <= penalty:
            return 0.0
        return -(zi - math.copysign(penalty, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for found, label in rows:
            used = {i: weight(i) for i in [*found, "bias"]}
            g = 1 / (1 + math.exp(-sum(used.values()))) - label
            for i, w in used.items():
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / alpha * w
    return {i: weight(i) for i in z if weight(i) != 0}


@pytest.mark.parametrize("l1, epochs", [(0.5, 3), (2.0, 1)])
def test_weights_and_scores(spark, l1, epochs):
    rng = random.Random(3)
    words = ["bad", "worse", "Good", "fine", "calm", "éclair", "42", "plain", "story", "river"]
    texts = {i: " ".join(rng.choices(words, k=rng.randrange(0, 12))) for i in range(60)}
    toxic = {i: int("bad" in t or "worse good" in t.lower()) for i, t in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, y in toxic.items() if i % 4], "doc_id long, toxic int")
    bits = 14
    model = toxicity.fit(docs, labels, bits=bits, l1=l1, epochs=epochs)

    place = F.xxhash64(F.col("doc_id").cast("string"), F.lit(1))
    order = [r.doc_id for r in labels.orderBy(place, "doc_id").collect()]
    rows = [(plain_features(texts[i], bits), toxic[i]) for i in order]
    wanted = plain_ftrl(rows, 1.0, 1.0, l1, 1.0, epochs)
    bias = wanted.pop("bias")
    found = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert 0 < len(wanted) < len(set().union(*(f for f, _ in rows)))
    assert found.keys() == wanted.keys() and model.bias == pytest.approx(bias)
    assert all(found[i] == pytest.approx(wanted[i]) for i in wanted)

    for r in toxicity.scored(docs, model).collect():
        total = bias + sum(wanted.get(i, 0.0) for i in plain_features(texts[r.doc_id], bits))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)))
        assert r.predicted == int(r.score >= 0.5)
