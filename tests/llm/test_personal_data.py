"""What the method adds to the fixed patterns, on texts labelled by hand."""

import pytest

from concordia.llm import pii

#: Text, and what is personal or secret in it beside the spans of the base.
LABELLED = [
    ("pay 7536784127813050 4845168114407329 now", ["7536784127813050", "4845168114407329"]),
    ("reach +1 (826) 555-4081 190.137.223.204 today", ["(826) 555-4081"]),
    ("call (212) 555-1234 now", ["(212) 555-1234"]),
    ("my number is (415) 555-0134, ask", ["(415) 555-0134"]),
    ("dial 1 (646) 555-0188 soon", ["(646) 555-0188"]),
    ("ssn 123-45-6789 ok", ["123-45-6789"]),
    ("the card says 321-54-9876 here", ["321-54-9876"]),
    ("mail bob [at] example.com please", ["bob [at] example.com"]),
    ("write to jane(at)mail.example.org", ["jane(at)mail.example.org"]),
    ("id 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b end", ["9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"]),
    ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" t', ["04dbebab91ab85687d33eeaaf9ac699e1188f962"]),
    ("the password: hunter2 was", ["hunter2"]),
    ("db pwd=winter99 there", ["winter99"]),
    ("on 2019-05-17 12:30 we met", []),
    ("from 1990-2010 it was", []),
    ("amount 12 345 678.00 paid", []),
    ("isbn 978-3-16-148410-0 in print", []),
    ("see my_long_variable_name_2 now", []),
    ("open src/main/module/file2/name", []),
    ("order 20210345 shipped", []),
    ("pin 666-12-3456 is none", []),
    ("code 000-12-3456 is none", []),
    ("the key: value of it", []),
    ("version 300.1.2.3 is out", []),
    ("from 2001-02-03 to 2004-05-06", []),
    ("ConvertStringToNumber2 is called", []),
    ("nothing at all", []),
    ("", []),
]


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def overlaps(a, b):
    return a[0] < b[1] and b[0] < a[1]


def test_added_spans_of_a_labelled_set(model):
    right = wrong = missed = 0
    for text, expected in LABELLED:
        base = pii.base_spans(text)
        added = [(s, e) for _, s, e in pii._chosen(text, base, model)]
        wanted = [(text.index(x), text.index(x) + len(x)) for x in expected]
        hits = [w for w in wanted if any(overlaps(w, a) for a in added)]
        right, missed = right + len(hits), missed + len(wanted) - len(hits)
        wrong += sum(not any(overlaps(w, a) for w in wanted) for a in added)
        assert not any(overlaps((s, e), a) for _, s, e in base for a in added)
    print(f"precision {right / max(1, right + wrong):.2f}, recall {right / (right + missed):.2f}")
    assert right / (right + wrong) >= 0.8 and right / (right + missed) >= 0.8


def test_the_method_adds_spans_to_a_corpus(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = pii.personal_data(docs, model).filter("spans <> base").collect()
    assert len(found) > 100
    texts = {r.doc_id: r.text for r in docs.collect()}
    tokens = [i for i, t in texts.items() if t and pii.named_values(t)]
    kinds = {r.doc_id: r.spans for r in found}
    caught = sum("secret:" in kinds.get(i, "") for i in tokens)
    assert caught >= 0.9 * len(tokens)


def test_every_neighbour_is_proposed():
    text = "1234567 7654321 1111111"
    found = {text[s:e] for s, e in pii._numbers_within(text, 0, len(text))}
    assert found == {"1234567", "7654321", "1111111", "1234567 7654321", "7654321 1111111"}
    assert not list(pii._numbers_within("11 22", 0, 5))
    long = "1 " * 50_000 + "1"
    assert len(list(pii._numbers_within(long, 0, len(long)))) < 14 * 50_001
