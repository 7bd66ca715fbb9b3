"""The training-data operators against brute force, on untidy tables."""

import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from concordia.llm import (
    chat,
    decontaminate,
    mixing,
    packing,
    pieces,
    pii,
    quality_list,
    queries,
    simhash,
    token_count,
    toxicity,
    url_rules,
)

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(9000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, "
    "component_id long, place long, key string, row string, shard int, piece int, size long, target double"
)
TEXTS = [
    (1, "The cat, the dog\nand  the bird"), (1, "The cat, the dog\nand  the bird"),
    (2, "the CAT, the dog and the bird"), (None, "one two"), (None, "one two"), (3, None), (4, ""),
    (5, " \n\t "), (6, LONG), (7, LONG + " end"), (8, "é ü ▁ <s> ☃\u2003x 中文字\x00"), (9, "a b a b a b a b"),
]


@pytest.fixture(scope="module")
def untidy(spark):
    rows = [
        (i, t, "en", None if k % 4 == 3 else f"s{k % 3}", 1, 0.5, 7, 9, 3, "k", "r", 1, 1, 1, 1.0)
        for k, (i, t) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_simhash(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Smallest member of the component of each value, by comparing all pairs."""
    values, root = sorted(values), {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in values}


def test_simhash_of_untidy_rows(untidy):
    rows = simhash.near_duplicates(untidy).collect()
    assert len(rows) == len(TEXTS)
    fps = [(i, plain_simhash(t)) for i, t in TEXTS]
    roots = plain_components({fp for _, fp in fps})
    least = {}
    for i, fp in fps:
        least[roots[fp]] = min((x for x in (i, least.get(roots[fp])) if x is not None), default=None)
    expected = sorted(((str(i), fp, str(least[roots[fp]])) for i, fp in fps))
    assert sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id)) for r in rows) == expected


@pytest.mark.parametrize("parts", [2, 4])
def test_ball_links_of_dense_groups(spark, parts):
    """Crowded balls, chains and pairs that differ in one run only keep their components."""
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(40)}
    for centre in list(values)[:6]:
        values |= {centre ^ (1 << a) ^ (1 << b) for a, b in (rng.sample(range(64), 2) for _ in range(60))}
        values |= {centre ^ (0b111 << s) for s in (0, 20, 30, 61)}
        step = centre
        for _ in range(12):
            step ^= sum(1 << b for b in rng.sample(range(64), 3))
            values.add(step)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.ball_links(spark.createDataFrame(signed, "fp long"), parts).collect()
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        a, b = (x & (1 << 64) - 1 for x in (a, b))
        assert (a ^ b).bit_count() <= 3
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {v: find(v) for v in values} == plain_components(values)
    assert len(links) < 40 * len(values)


def test_one_row_of_each_group_stays(untidy):
    kept = simhash.keep_representatives(untidy)
    assert kept.columns == untidy.columns
    assert len(kept.collect()) == len({r.component_id for r in simhash.near_duplicates(untidy).collect()})


def test_texts_of_null_and_repeated_ids_stay(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(30))
    rows = [(i, text()) for i in (None, None, None, None, 7, 7, 8, 8, 1, 2)]
    rows += [(None, rows[4][1].upper()), (None, rows[0][1]), (0, rows[8][1]), (None, None), (None, " ")]
    roots = plain_components({plain_simhash(t) for _, t in rows})
    groups = {}
    for i, t in rows:
        groups.setdefault(roots[plain_simhash(t)], []).append((i is None, i or 0))
    kept = simhash.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == len(groups) == 11
    assert {roots[plain_simhash(r.text)]: (r.doc_id is None, r.doc_id or 0) for r in kept} == {
        g: min(members) for g, members in groups.items()
    }


def test_toxicity_on_held_out_rows(spark, table):
    docs, labels = (table(n, "/root/testdata/sf0.1") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    assert 0 < len(model.index) < 5000
    rows = toxicity.scored(docs, model).join(labels, "doc_id").filter("held_out").collect()
    clean, toxic = ([r.predicted for r in rows if r.toxic == y] for y in (0, 1))
    assert sum(clean) <= 0.01 * len(clean) and sum(toxic) >= 0.7 * len(toxic)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_of_untidy_rows(spark, untidy, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (6, 0), (6, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.fit(untidy, labels)
    rows = toxicity.scored(untidy, model).collect()
    assert len(rows) == len(TEXTS) and len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    assert toxicity.without_toxic(untidy, model).columns == untidy.columns
    assert toxicity.scored(empty, toxicity.fit(empty, labels)).count() == 0


URLS = {
    "http://A.example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
    "http://example.net": ("example.net", "", None, None),
    "x://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
    "http://b.example.com/de/#": ("b.example.com", "/de/", "example.com/de/", "block"),
    "http://notexample.com/de/": ("notexample.com", "/de/", None, None),
    "https://x.org/fr/é://?q": ("x.org", "/fr/é://", "org/fr/", "allow"),
    "no scheme": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
}


def test_url_parts_and_listed_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    rows = sorted(url_rules.judged(pages, []).collect())
    for row, (host, path, rule, verdict) in zip(rows, URLS.values()):
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict or "allow")


def test_mined_rules_match_by_all_their_tokens(spark):
    urls = [f"http://{h}.net/{p}/{i}" for i in range(60) for h, p in (("a", "x"), ("b", "y"))]
    urls += [f"http://c.example.net/en/{i}" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    mined = url_rules.mine(pages)
    assert mined and all(r.confidence >= 0.95 and r.support >= 0.005 for r in mined)
    assert not any(set(a.tokens) < set(b.tokens) and a.verdict == b.verdict for a in mined for b in mined)
    other = spark.createDataFrame([(1, "http://a.com/x/1"), (2, "http://q.com/z")], "page_id long, url string")
    assert [r.verdict for r in sorted(url_rules.judged(other, mined).collect())] == ["block", "allow"]
    assert url_rules.mine(pages.limit(0)) == []


def plain_rules(urls, support, confidence):
    """All sets of tokens counted one by one, without those a subset makes needless."""
    known = []
    for url in urls:
        host, _, path = url.split("://")[1].partition("/")
        labels, parts = host.split("."), path.split("/")
        verdict = "allow" if host.endswith("example.net") and parts[0] == "en" else "block"
        known.append(({f"h:{x}" for x in labels} | {f"p:{x}" for x in parts if x}, verdict))
    least = support * len(known)
    every = {t for have, _ in known for t in have}
    often = sorted(t for t in every if sum(t in have for have, _ in known) >= least)
    sure = {}
    for size in range(1, len(often) + 1):
        for chosen in itertools.combinations(often, size):
            verdicts = [v for have, v in known if have.issuperset(chosen)]
            for v in ("allow", "block"):
                n = verdicts.count(v)
                if not n or n < least or n / len(verdicts) < confidence:
                    continue
                shorter = (sure.get((s, v)) for k in range(1, size) for s in itertools.combinations(chosen, k))
                if not any(c is not None and c[0] >= n / len(verdicts) for c in shorter):
                    sure[chosen, v] = (n / len(verdicts), n / len(known))
    return sure


def test_mined_rules_count_all_tokens_of_long_urls(spark):
    rng = random.Random(5)
    urls = set()
    while len(urls) < 90:
        # Five parts that always come together, seven that come and go, and a rare one.
        parts = [f"part{c}" for c in "abcdefg" if rng.random() < 0.6]
        start = rng.choice(["en/one/two/three/four/", "de/"])
        urls.add(f"http://{rng.choice('xy')}.example.net/{start}" + "/".join(parts))
    urls = sorted(urls) + ["http://rare.net/only/" + "/".join(f"part{c}" for c in "abcdefg")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 2)], "page_id long, url string")
    mined = url_rules.mine(pages, min_support=0.1, min_confidence=0.6)
    wanted = plain_rules(urls, 0.1, 0.6)
    found = {(tuple(sorted(r.tokens)), r.verdict): (r.confidence, r.support) for r in mined}
    assert max(len(u.split("/")) for u in urls) > 12 and len(found) == len(mined) > 8
    assert found.keys() == wanted.keys()
    assert all(found[k] == pytest.approx(wanted[k]) for k in wanted)
    assert [r.order for r in mined] == sorted(r.order for r in mined)


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(inside),
    )


def test_quality_counts():
    cases = [t for _, t in TEXTS if t != LONG] + ["a\na \na\n\n b #|#", "a b c a b c x", "x " * 60, "a a a a"]
    for text in cases:
        if len(text or "") < 5000:
            assert quality_list.text_counts(text)[:5] == plain_counts(text), text


def test_quality_list_is_learned_and_applied(spark, untidy, empty):
    rng = np.random.default_rng(1)
    table = {a: rng.random(600) for a in quality_list.ATTRIBUTES}
    bad = ((table["symbols_per_word"] > 0.7) & (table["mean_word"] > 0.4)) | (table["dup_line_share"] > 0.9)
    rules = quality_list.learn(table, bad, np.arange(600) % 3 == 0, 0.9, 5)
    covered = np.zeros(600, bool)
    for rule in rules:
        covered |= quality_list._covers(rule, table, 600)
    assert 2 <= len(rules) and (covered == bad).mean() > 0.97
    rows = {r.doc_id: r for r in quality_list.judged(untidy, rules).collect()}
    assert rows[3].base_failed and not rows[3].kept and rows[9].n_repeat_words == 8
    assert quality_list.judged(empty, rules).count() == 0


def test_token_counts_are_those_of_the_library(spark, untidy, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    letters = list("ab  \n\n▁.,²_-中é'\t\r\x00<s>0")
    rng = random.Random(2)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.n_tokens for r in token_count.token_counts(docs, MODEL).collect()}
    assert found == {i: len(ids) for i, ids in enumerate(model.encode(texts))}
    rows = token_count.token_counts(untidy, MODEL).collect()
    expected = sorted((str(i), len((t or "").encode()), len(model.encode(t or ""))) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == expected
    assert {r.doc_id for r in rows if r.over_limit} == {6, 7}
    assert token_count.token_counts(empty, MODEL).count() == 0


def test_targets():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.targets([10, 0, 1000], [3, 1, 2]) == [20.0, 0.0, pytest.approx(1495.0)]
    assert mixing.targets([], []) == []


def test_mix_meets_its_targets(spark, untidy, empty, table):
    for docs in (untidy, table("documents")):
        source = {(r.doc_id, r.text): r.source for r in docs.collect()}
        rows = mixing.mix_report(docs).collect()
        assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_report(docs.repartition(5)).collect()))
        assert all(0 <= r.taken <= 2 * r.size for r in rows) and len(rows) == docs.count()
        mixed = mixing.mix(docs).select("doc.*", "shard").collect()
        assert mixing.mix(docs).select("doc.*").columns == docs.columns
        assert sum(len(WORDS.findall(r.text)) for r in mixed) == sum(r.taken for r in rows)
    totals = {}
    for r in rows:
        of = totals.setdefault(r.target, [0, r.target])
        of[0] += r.taken
    by_source = {}
    for r in table("documents").select("doc_id", "source").collect():
        by_source[r.doc_id] = r.source
    taken, target = {}, {}
    for r in rows:
        s = by_source[r.doc_id]
        taken[s], target[s] = taken.get(s, 0) + r.taken, r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_shards_draw_disjoint_runs():
    drawn = np.array([7, 0, 100, 31])
    starts = np.array([mixing.shard_draw(s, drawn, 6, 1) for s in range(7)])
    sizes = np.diff(starts, axis=0)
    assert (sizes >= 0).all() and (sizes.sum(axis=0) == drawn).all()
    assert sizes.sum(axis=1).max() - sizes.sum(axis=1).min() <= 1


def test_cut_pieces_restore_a_text():
    size = len(WORDS.findall(LONG))
    numbers = list(range(-(-size // 4096)))
    pieces = mixing.cut_texts(LONG, numbers, [min(4096, size - 4096 * n) for n in numbers], size)
    assert len(pieces) > 1 and "".join(pieces) == LONG


def test_best_fit_decreasing():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 500)
    rows, free = [], []
    for piece in np.argsort(-lengths, kind="stable"):
        fits = [f for f in free if f >= lengths[piece]]
        if fits:
            free[free.index(min(fits))] -= lengths[piece]
        else:
            free.append(64 - lengths[piece])
    rows = packing.best_fit_decreasing(lengths, 64)
    assert sorted(64 - int(lengths[r].sum()) for r in rows) == sorted(int(f) for f in free)
    assert sorted(p for r in rows for p in r) == list(range(500))


def test_packed_rows_restore_all_ids(spark, untidy, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = {}
    for r in packing.pack(untidy, MODEL, width=512, group_tokens=4000).collect():
        ids, position = (np.frombuffer(b, "<u2") for b in (r.ids, r.position_ids))
        assert len(ids) == 512 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        for k, (doc, offset) in enumerate(zip(r.doc_ids, r.doc_offsets)):
            s, e = r.cu_seqlens[k : k + 2]
            assert position[s:e].tolist() == list(range(e - s))
            found.setdefault((doc, offset), []).append(ids[s:e].tolist())
    expected = {}
    for doc, text in TEXTS:
        ids = model.encode(text or "")
        for s in range(0, len(ids), 512):
            expected.setdefault((doc, s), []).append(ids[s : s + 512])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    assert packing.pack(empty, MODEL).count() == 0


def test_cuts_of_whole_columns_are_those_of_each_text():
    rng = np.random.default_rng(11)
    texts = [t for _, t in TEXTS] + ["▁a ▁ ▁b", " ▁", "\n", "\n\n x\ny", "x\n", "ÿ▂▀ é", "a\r\tb", None, ""]
    texts += ["".join(rng.choice(list("aé ▁\n☃."), rng.integers(0, 30))) for _ in range(500)]
    for some in (texts, texts[5:9], [None, ""], []):
        column = pa.array([*some, "left out"], pa.string()).slice(0, len(some))
        found, ends = pieces.cuts(column)
        expected = [pieces.pretokens(t) for t in some]
        assert found.to_pylist() == [c for cut in expected for c in cut]
        assert ends.tolist() == np.cumsum([len(cut) for cut in expected]).tolist()


def test_ids_do_not_depend_on_slices_and_memory(monkeypatch):
    """Words in use are cut once, however many others come and go."""
    texts = [f"the cat and\nthe dog w{i} x{i * 7}" for i in range(400)] + [None, "", "▁ é  ▁x"]
    expected = [pieces.load_model(MODEL).encode(t or "") for t in texts]
    monkeypatch.setattr(pieces, "SLICE_BYTES", 100)
    monkeypatch.setattr(pieces, "CACHE", 40)
    fresh, cut = [], pieces.pretoken_ids
    monkeypatch.setattr(pieces, "pretoken_ids", lambda model, terms: fresh.extend(terms) or cut(model, terms))
    encoder = pieces.PieceIds(MODEL)
    assert [ids.tolist() for ids in encoder.encode(pa.array(texts, pa.string()))] == expected
    assert fresh.count(" cat") == fresh.count("\nthe") == 1
    assert list(encoder.encode(pa.array([], pa.string()))) == []


def test_decontamination_against_brute_force(spark, untidy, empty, table, monkeypatch):
    # Small blocks and chunks: several passes over several blocks.
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 3000)
    monkeypatch.setattr(decontaminate, "CHUNK", 700)
    # Items are rows: windows of several lengths under one id, and under none.
    extra = [
        ("s", "a b a"), ("n", None), ("e", "- -"), (None, "w5 x5"),
        ("x", "w1 x1 w2 x2 w3 x3 w4 x4 w5 x5"), ("x", "w2 x2 w3"), ("x", "w2 x2 w3"),
        (None, "w9 x9 w10 x10 w11 x11 w12 x12 w13 x0"), (None, "w10 x10 w11"), (None, None),
    ]
    bench = table("benchmark").select(F.col("item_id").cast("string"), "text").union(
        spark.createDataFrame(extra, "item_id string, text string")
    )
    docs = untidy.select("doc_id", "text").union(table("documents").select("doc_id", "text"))
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in bench.select(F.col("item_id").cast("string"), "text").collect():
        ws = words(text)
        for i in range(max(1, len(ws) - 9) if ws else 0):
            windows.setdefault(tuple(ws[i : i + 10]), set()).add((item, text))
    lengths, expected = {len(w) for w in windows}, []
    for i, text in docs.collect():
        ws, items, hit = words(text), set(), set()
        for n in lengths:
            for at in range(len(ws) - n + 1):
                if (found := windows.get(tuple(ws[at : at + n]))) is not None:
                    items |= found
                    hit |= set(range(at, at + n))
        names = sorted(x or "" for x, _ in items)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        expected.append((str(i), len(ws), len(hit), len(names), digest, bool(hit)))
    index = decontaminate.build_index(docs)
    rows = decontaminate.digest(decontaminate.search(index, bench)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted(expected)
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not e[-1] for e in expected)
    assert decontaminate.decontaminated(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.search(decontaminate.build_index(empty), bench).count() == 0
    assert decontaminate.search(index, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "c x a x b"), (2, "a x x x x x b c"), (3, "a b"), (4, "b c")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "a b c")], "item_id string, text string")
    found = decontaminate.search(decontaminate.build_index(docs), bench, near=4).collect()
    assert {r.doc_id: r.near_items for r in found} == {1: ["i"], 2: [], 3: [], 4: []}


def test_registered_search_has_proximity_matches(spark, tmp_path):
    """Reordered and inserted words, neither of which is an exact window."""
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliet"
    other = " ".join(reversed(item.split()))
    texts = ["x " + item + " y", other, item.replace("echo", "echo x y z"), item.replace("golf", "gulf"), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("i", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = sorted(queries.op8_decontamination(spark, str(tmp_path)).collect())
    assert [r.n_items for r in rows] == [1, 0, 0, 0, 0]
    assert [r.n_near_items for r in rows] == [1, 1, 1, 0, 0]
    assert rows[1].near_items_sha256 == hashlib.sha256(b"i").hexdigest()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                yield kind, *m.span()


def test_base_spans():
    rng = random.Random(7)
    letters = list("ab.@@-+ 0123() é\n") + ["@b.c", "1.2.3.4", "4111111111111111", "+1 (980) 555-6268", "256."]
    for _ in range(20000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == list(plain_spans(text)), text
    pii.base_spans("1" * 200_000 + "a" * 200_000 + "@" + "." * 1000)


def test_personal_data_of_a_corpus(spark, untidy, empty):
    rng = random.Random(1)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = []
    for i in range(400):
        texts += [
            f"call +1 ({number(3)}) 555-{number(4)} now", f"mail a{i}@mail{i % 7}.example.com ok",
            f"from 10.{i % 255}.3.{i % 99} to", f"build 300.{i}.1.{i} done", f"id {number(16)} x", f"sum {number(8)} y",
        ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.fit(docs)
    rows = {r.doc_id: r for r in pii.personal_data(docs, model).collect()}
    for i, text in enumerate(texts):
        assert set(rows[i].base.split(",")) <= set(rows[i].spans.split(","))
        assert rows[i].base == ",".join(f"{k}:{s}:{e}" for k, s, e in plain_spans(text))
    other = spark.createDataFrame([(1, "call (212) 555-1234 now"), (2, "nothing 12 here")], "doc_id long, text string")
    assert rows[0].spans and pii.personal_data(other, model).filter("doc_id = 2").first().spans == ""
    assert pii.redacted(F.col("text"), model) is not None
    shown = docs.limit(2).select(pii.redacted(F.col("text"), model).alias("t")).collect()
    assert "555" not in shown[0].t and "[PHONE]" in shown[0].t
    assert pii.personal_data(untidy, pii.fit(untidy)).count() == len(TEXTS)
    assert pii.personal_data(empty, pii.fit(empty)).count() == 0


def plain_cost(roles, costs=chat.Costs()):
    """Cheapest repair by trying everything, turn by turn."""
    best = {0: 0}

    def inserted(states):
        queue = dict(states)
        for _ in range(4):
            for s, c in list(queue.items()):
                for n in chat._LEGAL[s]:
                    queue[n] = min(queue.get(n, 1 << 40), c + costs.insert)
        return queue

    for role in roles:
        new = {}
        for s, c in best.items():
            for x in (1, 2, 3):
                label = 0 if x == role else costs.relabel if role else costs.name
                if x == s:
                    new[x] = min(new.get(x, 1 << 40), c + costs.merge + label)
        for s, c in inserted(best).items():
            for x in chat._LEGAL[s]:
                label = 0 if x == role else costs.relabel if role else costs.name
                new[x] = min(new.get(x, 1 << 40), c + label)
        best = new
    return min(c for s, c in inserted(best).items() if s == chat.ASSISTANT)


def test_role_repair_is_cheapest_and_legal(spark):
    names = [None, "system", "user", "Assistant ", "tool"]
    number = {None: 0, "system": 1, "user": 2, "Assistant ": 3, "tool": 0}
    convs = [list(c) for n in (1, 2, 3) for c in itertools.product(names, repeat=n)]
    rows = [(i, t, r, f"{i}.{t}", "x") for i, c in enumerate(convs) for t, r in enumerate(c)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string")
    out = {}
    for r in sorted(chat.repair(turns).collect(), key=lambda r: (r.conv_id, r.place, r.part)):
        out.setdefault(r.conv_id, []).append(r)
    assert len(out) == len(convs)
    for i, conv in enumerate(convs):
        assert sum(r.cost for r in out[i]) == plain_cost([number[x] for x in conv]), conv
        shown = "".join(r.rendered for r in out[i])
        assert re.fullmatch(
            r"(?s)(<\|im_start\|>system\n[^<]*<\|im_end\|>\n)?"
            r"(<\|im_start\|>user\n[^<]*<\|im_end\|>\n<\|im_start\|>assistant\n[^<]*<\|im_end\|>\n)+", shown
        ), shown
        assert [r.turn for r in out[i] if r.action != "insert"] == list(range(len(conv)))


def test_one_conversation_in_many_runs(spark):
    rows = [(None, None, "user", "same") for _ in range(300)] + [(7, t, "user" if t % 3 else "assistant", f"t{t}") for t in range(900)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = chat.repair(turns).collect()
    assert sum(r.cost for r in found if r.conv_id is None) == plain_cost([2] * 300)
    assert sum(r.cost for r in found if r.conv_id == 7) == plain_cost([2 if t % 3 else 3 for t in range(900)])
    assert sorted(r.turn for r in found if r.turn is not None) == list(range(900))
    assert chat.repair(turns.limit(0)).count() == 0


def test_queries_return_their_contract(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    found = queries.queries()
    assert [n.split("_")[0] for n in found] == [f"op{i}" for i in range(1, 14)]
    for name in ("op3_quality_rules", "op8_decontamination", "op9_personal_data"):
        assert found[name](spark, sf_dir).count() == documents
    assert found["op10_chat"](spark, sf_dir).count() > 0
