"""URL verdicts by listed rules and by mined association rules.

A URL is judged by the longest listed rule that fits it.  The listed rules are also the
labels from which further ones are learned: Spark's FP-growth mines the combinations of
URL tokens (host labels, path parts, file type, query keys) that occur with a verdict.
Rules of enough support and confidence are kept unless a shorter one says the same at
least as surely; they are matched through an inverted index from a rule's rarest token.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Listed rules: verdict, host with its subdomains, beginning of the path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.95
#: Mined rules sent to the tasks at a time.
CHUNK = 100_000
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _text(rule: tuple[str, str, str]) -> str:
    return rule[1] + rule[2]


def listed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Text of the longest rule that fits, or null; of equally long ones the first."""
    chain = F
    for rule in sorted(rules, key=lambda r: -len(_text(r))):
        of_host = (host == rule[1]) | host.endswith(f".{rule[1]}")
        chain = chain.when(of_host & path.startswith(rule[2]), F.lit(_text(rule)))
    return chain.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def listed_verdict(rule: Column, rules=RULES) -> Column:
    if not rules:
        return F.lit(None).cast("string")
    chain = F
    for r in rules:
        chain = chain.when(rule == _text(r), F.lit(r[0]))
    return chain


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; runs of digits count as one sign."""
    plain = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    marked = lambda mark, array: F.transform(
        F.filter(array, lambda x: x != ""), lambda x: F.concat(F.lit(mark), plain(x))
    )
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return F.array_distinct(
        F.concat(
            marked("h:", F.split(host, "[.]")),
            marked("p:", F.split(path, "/")),
            marked("t:", F.array(F.regexp_extract(path, r"[.]([A-Za-z0-9]+)$", 1))),
            marked("q:", F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))),
        )
    )


@dataclass(frozen=True)
class MinedRule:
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float

    @property
    def order(self) -> tuple:
        """The surest rule wins, then the most frequent, the longest, the first by name."""
        return -self.confidence, -self.support, -len(self.tokens), self.tokens, self.verdict


def _pruned(rules: list[MinedRule]) -> list[MinedRule]:
    """Rules without those that a rule of fewer of their tokens makes needless."""
    kept: list[MinedRule] = []
    index: dict[str, list[MinedRule]] = {}
    for rule in sorted(rules, key=lambda r: (len(r.tokens), r.order)):
        shorter = (k for t in rule.tokens for k in index.get(t, ()))
        if not any(
            k.verdict == rule.verdict and k.confidence >= rule.confidence and set(k.tokens) <= set(rule.tokens)
            for k in shorter
        ):
            kept.append(rule)
            index.setdefault(rule.tokens[0], []).append(rule)
    return sorted(kept, key=lambda r: r.order)


def _parsed(pages: DataFrame, url_col: str) -> DataFrame:
    """``url``, ``host``, ``path`` and ``tokens`` of distinct URLs."""
    urls = pages.select(F.col(url_col).alias("url")).filter("url is not null").distinct()
    parts = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))


def mine(
    pages: DataFrame,
    url_col: str = "url",
    rules=RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> list[MinedRule]:
    """Association rules from tokens to verdicts, of all distinct URLs that a listed rule fits.

    All frequent tokens of a URL take part.  Tokens that occur in exactly the same URLs, as
    the parts of one address do, are mined as one: a combination of several of them has
    the support and confidence of any one, so pruning would drop it, and the others stand
    in for that one in the rules found.  This keeps long URLs from yielding all subsets of
    their parts.  Support alone bounds the combinations of tokens that differ.
    Without URLs of a listed rule there are no mined rules.
    """
    known = _parsed(pages, url_col).withColumn(
        "verdict", listed_verdict(listed_rule(F.col("host"), F.col("path"), rules), rules)
    )
    known = known.filter("verdict is not null")
    total = known.count()
    if not total:
        return []
    frequent = (
        known.select(F.explode("tokens").alias("token"), F.xxhash64("url").alias("place"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("place").alias("places"))
        .filter(F.col("n") >= min_support * total)
    )
    # At most (tokens of a URL) / min_support tokens are frequent.
    often: dict[str, int] = {}
    alike: dict[tuple[int, int], list[str]] = {}
    for r in frequent.orderBy("token").collect():
        often[r["token"]] = r["n"]
        alike.setdefault((r["n"], r["places"]), []).append(r["token"])
    if not often:
        return []
    members = {group[0]: group for group in alike.values()}
    first = F.create_map(*(F.lit(x) for name, group in members.items() for t in group for x in (t, name)))
    mined = F.array_distinct(F.filter(F.transform("tokens", lambda x: first[x]), lambda x: x.isNotNull()))
    items = known.select(F.concat(mined, F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = (
        model.associationRules.filter(F.col("consequent")[0].startswith("="))
        .filter(~F.exists("antecedent", lambda x: x.startswith("=")))
        .collect()
    )
    by_count = lambda names: tuple(sorted(names, key=lambda t: (often[t], t)))
    kept = _pruned(
        [MinedRule(by_count(r["antecedent"]), r["consequent"][0][1:], r["confidence"], r["support"]) for r in found]
    )
    spelled = (
        replace(rule, tokens=by_count(names))
        for rule in kept
        for names in itertools.product(*(members[t] for t in rule.tokens))
    )
    return sorted(spelled, key=lambda r: r.order)


def _best_rule(chunk: list[MinedRule]):
    """Place in ``chunk`` of the first rule whose tokens a URL all has, or -1."""
    index: dict[str, list[tuple[int, frozenset]]] = {}
    for place, rule in enumerate(chunk):
        index.setdefault(rule.tokens[0], []).append((place, frozenset(rule.tokens)))

    @F.pandas_udf("int")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for found in batch:
                have = set() if found is None else set(found)
                hits = (p for t in have for p, needed in index.get(t, ()) if needed <= have)
                out.append(min(hits, default=-1))
            yield pd.Series(out, dtype="int32")

    return best


def mined_verdict(url_tokens: Column, mined: list[MinedRule]) -> Column:
    """Verdict of the best mined rule that fits, or null.

    Rules stand in order, so a later chunk only counts where no earlier one has a rule.
    """
    verdicts = []
    for i in range(0, len(mined), CHUNK):
        chunk = mined[i : i + CHUNK]
        place = _best_rule(chunk)(url_tokens)
        names = F.array(*(F.lit(v) for v in ("allow", "block")))
        blocked = [p for p, rule in enumerate(chunk) if rule.verdict == "block"]
        verdicts.append(F.when(place >= 0, names[place.isin(blocked).cast("int")]))
    return F.coalesce(*verdicts) if verdicts else F.lit(None).cast("string")


def judged(
    pages: DataFrame, mined: list[MinedRule], id_col: str = "page_id", url_col: str = "url", rules=RULES
) -> DataFrame:
    """Per row ``page_id``, ``host``, ``path``, the listed ``rule`` and the ``verdict``.

    A null URL, or one without ``://``, has an empty host and path, fits no listed rule and
    is allowed unless a mined rule fits.  Rows stay as they are; other columns are not
    read.  An empty table gives an empty table.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("rule", listed_rule(F.col("host"), F.col("path"), rules))
    learned = mined_verdict(tokens(url, F.col("host"), F.col("path")), mined)
    verdict = F.coalesce(listed_verdict(F.col("rule"), rules), learned, F.lit(DEFAULT))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
