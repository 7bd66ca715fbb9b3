"""Personal data: candidate spans, boosted trees and calibrated thresholds.

The base finds e-mail addresses, IP addresses, payment cards and phone numbers by fixed
patterns with checks.  High-recall generators propose further, overlapping spans: every run
of consecutive digit groups within a longer number, so neighbours that run into each other
are told apart; groups joined by dots or colons; words around an at sign or its spelling;
values given to a name such as ``token``, and long strings of letters and digits; numbers
in the form of national ones.  Boosted trees judge each by its format and its context;
spans that reach the threshold of their kind are redacted, too, the best first, and never
over a base span.

There is no labelled personal data.  What the trees learn from is:

- candidates that the base accepts, with copies in other formats (no plus sign, other
  separators, a spelled at sign), as ones, and those its checks reject as zeros;
- values that a text itself calls a password, token, key or secret as ones, with copies
  that have lost the name;
- made-up national numbers by their published rules, passwords behind a name and addresses
  as ones, and as zeros look-alikes, all put between the words of real texts: dates, times,
  amounts, catalogue numbers, identifiers, paths, words after a colon or an at sign, and
  national numbers that break the rules.

All others teach nothing.  The training table is bounded: of about ``MAX_DOCS`` documents,
chosen by hash, it has the ``MAX_ROWS`` candidates of smallest hash.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, boost
from .common import hash_sample

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the method finds, after those of the base.
ADDED = ("secret", "national")
ALL_KINDS = KINDS + ADDED
#: Documents whose candidates are used for training (about), and candidates at most.
MAX_DOCS = 50_000
MAX_ROWS = 20_000
#: Share of true spans that a threshold must reach on held-out candidates.
PRECISION = 0.99

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digits are matched possessively from the start of their run: the same matches as without,
# but in linear time on very long runs.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_MAYBE_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]++ ?(?:@|\[at\]|\(at\)|\{at\}) ?[\w-]+(?:(?: ?\[dot\] ?|\.)[\w-]+)*")
_MAYBE_IP = re.compile(r"(?<![0-9A-Fa-f.:])[0-9A-Fa-f]++(?:[.:]+[0-9A-Fa-f]++){3,}")
_MAYBE_NUMBER = re.compile(r"[+(]?[0-9][0-9 ().\-/]*[0-9]")
_MAYBE_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])")
_MAYBE_SECRET = re.compile(r"(?<![\w+/=-])[A-Za-z0-9_+/-]{16,}+={0,2}(?![\w+/=-])")
_NAMED = re.compile(
    r"(?i)(?<![a-z])(?:pass(?:word|wd)?|pwd|secret|token|api[_ -]?key|key|auth)[\"']? {0,3}[:=] {0,3}[\"']?([^\s\"',;]{6,})"
)
_GROUP = re.compile("[0-9]+")
_AT = re.compile(r"@|[\[({]at[\])}]")
_ANY = re.compile(r"[0-9@]|[\[({]at[\])}]|(?i:pass|pwd|secret|token|key|auth)")
#: Digits of a number that is proposed.
_FEWEST, _MOST = 7, 19

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of letters, an at sign and a domain, without trying starts in vain."""
    end = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield "email", start, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns that pass their checks, by kind and start."""
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def _numbers_within(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive digit groups with 7 to 19 digits: at most 19 for each group."""
    groups = [m.span() for m in _GROUP.finditer(text, start, end)]
    for i, (s, _) in enumerate(groups):
        while s > start and text[s - 1] in "+(":
            s -= 1
        digits = 0
        for a, b in groups[i:]:
            digits += b - a
            if digits > _MOST:
                break
            if digits >= _FEWEST:
                yield s, b


def named_values(text: str) -> set[tuple[int, int]]:
    """Spans of values that the text itself calls a secret."""
    return {m.span(1) for m in _NAMED.finditer(text)}


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of all kinds."""
    found = [("email", *m.span()) for m in _MAYBE_EMAIL.finditer(text)] if _AT.search(text) else []
    found += [("ip", *m.span()) for m in _MAYBE_IP.finditer(text)]
    for m in _MAYBE_NUMBER.finditer(text):
        for span in dict.fromkeys([*_numbers_within(text, *m.span())]):
            found += [("card", *span), ("phone", *span)]
    long = {m.span() for m in _MAYBE_SECRET.finditer(text) if _mixed(m[0])}
    found += [("secret", *span) for span in sorted(long | named_values(text))]
    found += [("national", *m.span()) for m in _MAYBE_NATIONAL.finditer(text)]
    return found


def _mixed(span: str) -> bool:
    return any(c.isdigit() for c in span) and any(c.isalpha() for c in span)


_CONTEXT = 16
_NAME_BEFORE = re.compile(r"(?i)(?:pass(?:word|wd)?|pwd|secret|token|key|auth)[\"']? {0,3}[:=] {0,3}[\"']?$")


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span; the checks of the base are among the formats."""
    span, before, after = text[start:end], text[max(0, start - _CONTEXT) : start], text[end : end + _CONTEXT]
    digits = _digits(span)
    groups = [len(g) for g in re.findall("[0-9]+", span)] or [0]
    parts = re.split(r"[.:]+", span)
    word = before.split()[-1] if before.split() else ""
    beside = [0.0 if not c or c.isspace() else 1.0 if c.isalnum() else 2.0 for c in (before[-1:], after[:1])]
    share = [sum(c.isdigit() for c in x) / max(1, len(x)) for x in (before, after)]
    return [
        float(ALL_KINDS.index(kind)),
        float(len(span)),
        float(len(digits)),
        float(sum(c.isalpha() for c in span)),
        *(float(span.count(c)) for c in ".- ():/"),
        float(len(groups)),
        float(max(groups)),
        float(min(groups)),
        float(groups[-1]),
        float("@" in span),
        float(bool(re.search(r"[\[({]at[\])}]", span))),
        float(len(re.search(r"[A-Za-z]*$", span)[0])),
        float(luhn(digits)) if digits else 0.0,
        float(len(parts)),
        float(max((int(p[:9]) for p in parts if p.isascii() and p.isdigit()), default=-1)),
        *beside,
        *share,
        float(len(word)),
        float(word.endswith((":", "=", "#"))),
        float(bool(_NAME_BEFORE.search(before))),
        float(len(set(span)) / len(span)),
        float(sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:])) / len(span)),
        float(max(map(len, re.findall("[A-Za-z]+", span)), default=0)),
        float(max((int(g) for g in re.findall("[0-9]+", span[:3])), default=-1)),
        float(bool(re.search("[a-z]", span)) + 2 * bool(re.search("[A-Z]", span))),
        float(bool(re.search(r"(?:^|[^0-9])(?:19|20)[0-9]{2}[-/. ](?:0[1-9]|1[0-2])", span))),
    ]


_OTHER_FORMS = {
    "email": (lambda s: s.replace("@", " [at] "), lambda s: s.replace("@", "(at)")),
    "ip": (),
    "card": (lambda s: " ".join(re.findall(".{1,4}", _digits(s))), lambda s: "-".join(re.findall(".{1,4}", _digits(s)))),
    "phone": (
        lambda s: s.lstrip("+"),
        lambda s: re.sub(r"[ ().-]+", "-", s.lstrip("+")),
        lambda s: re.sub(r"[ ().-]+", ".", s.lstrip("+")),
        lambda s: re.sub(r"^\+[0-9]{1,2} ", "", s),
    ),
}


def _rejected(kind: str, span: str) -> bool:
    """Whether the checks of a kind say that the span is none of it."""
    digits = _digits(span)
    if kind == "email":
        return "@" in span and not re.search(r"@.*\.", span)
    if kind == "ip":
        parts = span.split(".")
        return ":" not in span and (len(parts) != 4 or not all(p.isdigit() and int(p[:9]) <= 255 for p in parts))
    if kind == "card":
        return not 13 <= len(digits) <= 19 or not luhn(digits)
    return not 9 <= len(digits) <= 15


def made_up(text: str) -> Iterator[tuple[str, str, str, str, int]]:
    """Kind, head, span, tail and label of examples set between words of a text.

    The same text always gives the same ones.  National numbers follow the published rules
    of one country: three digits, not 000, 666 or from 900; two, not 00; four, not 0000.
    """
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    words = re.findall(r"[A-Za-z]{2,12}", text[:2000]) or ["no"]
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: rng.choice(words)
    date = f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    area = rng.choice([rng.randint(1, 665), rng.randint(667, 899)])
    good = f"{area:03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"
    bad = rng.choice([f"{rng.choice([0, 666, rng.randint(900, 999)]):03d}-{digits(2)}-{digits(4)}", f"{area:03d}-00-{digits(4)}"])
    lookalikes = [
        ("national", bad),
        ("phone", rng.choice([date + " " + digits(2), date.replace("-", "/"), f"{rng.randint(1900, 2000)}-{rng.randint(2001, 2030)}"])),
        ("phone", rng.choice([f"{rng.randint(1, 99)} {digits(3)} {digits(3)}.00", f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", digits(8)])),
        ("card", rng.choice([f"{date} {digits(6)}", digits(8), digits(10)])),
        ("secret", rng.choice(["_".join([word(), word(), word(), word(), digits(2)]), "/".join([word(), word(), word(), word() + digits(1), word()])])),
        ("secret", rng.choice([word().title() + word().title() + word().title() + word().title() + digits(1), f"{word()}-{word()}-{word()}-{date}"])),
    ]
    yield "national", f"{word()} {word()} ", good, f" {word()}", 1
    name, sign = rng.choice(["password", "passwd", "pwd", "secret"]), rng.choice([": ", "=", " = ", ' = "'])
    yield "secret", f"{word()} {name}{sign}", word() + digits(rng.randint(1, 4)) + rng.choice(["", "x", "!"]), f" {word()}", 1
    yield "secret", f"{word()} key: ", word(), f" {word()}", 0
    host = f"{word()}{rng.choice(['', '.' + word()])}.{rng.choice(['com', 'org', 'net'])}".lower()
    yield "email", f"{word()} {word()} ", word() + rng.choice(["@", " [at] ", "(at)"]) + host, f" {word()}", 1
    yield "email", f"{word()} {word()} ", word() + rng.choice(["@", " @ "]) + word(), f" {word()}", 0
    for kind, span in lookalikes:
        yield kind, f"{word()} {word()} ", span, f" {word()}", 0


def training_rows(text: str) -> Iterator[tuple[int, int, list[float]]]:
    """Hash, label and features of the candidates of a text that something can judge."""

    def row(kind: str, head: str, span: str, tail: str, label: int) -> tuple[int, int, list[float]]:
        whole = head + span + tail
        found = features(whole, kind, len(head), len(head) + len(span))
        return zlib.crc32(f"{kind}:{whole}".encode("utf-8", "replace")), label, found

    base, named = set(base_spans(text)), named_values(text)
    for kind, start, end in candidates(text):
        span = text[start:end]
        head, tail = text[max(0, start - _CONTEXT) : start], text[end : end + _CONTEXT]
        if (kind, start, end) in base:
            forms, label = [span, *(form(span) for form in _OTHER_FORMS[kind])], 1
        elif kind == "secret":
            if (start, end) in named:
                yield row(kind, head, span, tail, 1)
                if len(span) >= 16 and _mixed(span):
                    yield row(kind, " ".join(re.findall("[a-z]+", text[:200])[:2]) + " ", span, " ", 1)
            continue
        elif kind == "national":
            continue
        elif _rejected(kind, span) and not any(s < end and start < e for k, s, e in base if k == kind):
            forms, label = [span], 0
        else:
            continue
        for form in dict.fromkeys(forms):
            yield row(kind, head, form, tail, label)
        if label and kind in ("card", "phone"):
            # The same number beside another one.
            other = re.sub("[0-9]", "7", span.lstrip("+")) + " "
            yield row(kind, head + other[-_CONTEXT:], span, tail, 1)
            yield row(kind, head, span, " " + other + tail, 1)
    if zlib.crc32(text.encode("utf-8", "replace")) % 4 == 0:
        for example in made_up(text):
            yield row(*example)


@dataclass
class SpanModel:
    trees: Boosted | None
    thresholds: dict[str, float]


def _threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Score at or above which held-out candidates are true often enough.

    It lies half way between the last candidate that may be let in and the first that may
    not, and never below one half.
    """
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last_of_score = np.r_[p[order][1:] != p[order][:-1], True] if len(y) else np.empty(0, bool)
    good = np.flatnonzero(last_of_score & (right >= precision))
    if not len(good):
        return 2.0
    below = p[order][good[-1] + 1] if good[-1] + 1 < len(p) else 0.0
    return max(0.5, float(p[order][good[-1]] + below) / 2)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_docs: int = MAX_DOCS,
    max_rows: int = MAX_ROWS,
    precision: float = PRECISION,
) -> SpanModel:
    """Trees and thresholds from the candidates of a corpus.

    Where candidates of only one label occur, nothing can be learnt and the model adds no
    span; a kind without true held-out candidates is never added either.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [r for t in batch["text"] if t for r in training_rows(t)]
            yield pd.DataFrame(found, columns=["hash", "label", "features"]).drop_duplicates("hash")

    table = (
        hash_sample(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], max_docs)
        .select("text")
        .mapInPandas(rows, "hash long, label int, features array<double>")
        .orderBy("hash", "label", "features")
        .limit(max_rows)
        .toPandas()
        .drop_duplicates("hash")
    )
    y = table["label"].to_numpy()
    if not 0 < y.sum() < len(y):
        return SpanModel(None, {})
    x = np.array(table["features"].tolist())
    held = (table["hash"] % 5 == 0).to_numpy()
    if not 0 < y[~held].sum() < (~held).sum():
        return SpanModel(None, {})
    trees = boost(x[~held], y[~held].astype(float), rounds=80, depth=4)
    p = trees.probability(x)
    thresholds = {
        kind: _threshold(p[of], y[of], precision)
        for i, kind in enumerate(ALL_KINDS)
        if y[of := held & (x[:, 0] == i)].sum()
    }
    return SpanModel(trees, thresholds)


def _chosen(text: str, base: list[Span], model: SpanModel) -> list[Span]:
    """Added spans: of overlapping ones the best score, then the first, then the longest."""
    proposed = [c for c in candidates(text) if not any(s < c[2] and c[1] < e for _, s, e in base)]
    if not proposed or model.trees is None:
        return []
    p = model.trees.probability(np.array([features(text, *c) for c in proposed]))
    taken: list[Span] = []
    for i in sorted(range(len(proposed)), key=lambda i: (-p[i], proposed[i][1], -proposed[i][2])):
        kind, start, end = proposed[i]
        if p[i] >= model.thresholds.get(kind, 2.0) and not any(s < end and start < e for _, s, e in taken):
            taken.append(proposed[i])
    return taken


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (ALL_KINDS.index(x[0]), x[1], x[2])))


def find(text: Column, model: SpanModel) -> Column:
    """``base`` and ``spans`` of a text column, both as ``kind:start:end`` joined by commas.

    Offsets count code points, the end is exclusive.  Null and empty texts have none.
    """

    @F.pandas_udf("base string, spans string")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                if not t or not _ANY.search(t):
                    rows.append(("", ""))
                    continue
                base = base_spans(t)
                rows.append((_joined(base), _joined(base + _chosen(t, base, model))))
            yield pd.DataFrame(rows, columns=["base", "spans"])

    return spans(text)


def personal_data(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, the counts of base spans by kind, ``base`` and all ``spans``.

    Repeated rows and null ids stay as they are; other columns are not read.  An empty
    table gives an empty table.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), find(F.col(text_col), model).alias("x"))
    count = lambda kind: F.regexp_count("x.base", F.lit(f"\\b{kind}:")).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.col("x.base").alias("base"),
        F.col("x.spans").alias("spans"),
    )


def redacted(text: Column, model: SpanModel) -> Column:
    """A text column with every span replaced by its kind in brackets; null stays null."""

    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for t in batch:
                if t and _ANY.search(t):
                    base = base_spans(t)
                    spans = sorted(base + _chosen(t, base, model), key=lambda x: (x[1], -x[2]))
                    cut, end = [], 0
                    for kind, s, e in spans:
                        if s >= end:
                            cut += [t[end:s], f"[{kind.upper()}]"]
                        end = max(end, e)
                    t = "".join([*cut, t[end:]])
                out.append(t)
            yield pd.Series(out, dtype="object")

    return redact(text)
