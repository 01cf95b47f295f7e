"""URL filters: fixed rules by host and path, then association rules mined from labelled URLs.

Fixed rules name a host and the start of a path. A rule fits its host and every subdomain when the URL's path starts
with the rule's; the longest that fits decides.

URLs without a fixed rule are judged by mined rules. A URL's tokens are its scheme, host labels by place, the words of
host labels, path segments (numbers as one token) and query names. Spark's FP-growth finds token combinations that
are frequent together with the label ``block`` among labelled URLs, of any number of tokens; rules need a least support
(``MIN_SUPPORT``, a share of all labelled URLs, blocked or not, and ``MIN_ROWS`` blocked URLs at least) and confidence, and a rule goes if one with a subset of
its tokens is as confident. Every frequent combination is judged, where it was mined, by the row numbers of its tokens
(their size is bound by ``MAX_LABELLED``). Tokens of the very same rows are mined as one, and tokens of blocked rows
only are rules by themselves; neither changes the rules. Only then are the rules cut to ``MAX_RULES``, the most
confident and then the most frequent. They are held in an inverted index under their rarest token, so a URL looks up
its own tokens only and checks the few rules they lead to. A URL that a rule matches is blocked, others allowed.

Labels are given by the caller. For a table without any, ``list_labels`` takes them from lists: URLs that the fixed rules
block, or whose host has a word of ``CATEGORIES`` (a general list, not drawn from any table), are marked, all others
count as not blocked. What states the lists (tokens of fixed rules, and tokens with a listed word) is withheld from
mining, so that rules can't repeat them: what is mined are combinations of other tokens nearly all of whose URLs the lists
block, and they block the URLs that the lists don't reach. At most about ``MAX_LABELLED`` labelled URLs are mined, chosen
by hash (the documented bound).
The index is fixed in size and broadcast; judging is one map over the pages, so no key can be hot.

Edge cases: a URL that is null or has no ``://`` has an empty host and path, no tokens, no rule, and is allowed. Only
A-Z is lower-cased in hosts. Without labelled URLs, or without any blocked one, nothing is mined. Repeated pages each
get a row. An empty table gives an empty result. Only page_id and url are read.
"""

from __future__ import annotations

import math
import re
from itertools import islice, product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
MAX_LABELLED = 50_000
MAX_RULES = 5_000
MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.9
MIN_ROWS = 10
CATEGORIES = {
    "gambling": "bet bets betting bingo casino gamble gambling jackpot lottery poker roulette slots wager",
    "adult": "adult cams escort erotic hentai nude porn sex xxx",
    "pharmacy": "cialis drugs pharma pharmacy pills steroids viagra",
    "advertising": "ad ads adserver affiliate banner banners clicks doubleclick popup promo sponsor tracker",
    "fraud and malware": "crack cracks hacked keygen malware phishing prize ransomware scam spam spyware virus warez",
    "lending": "debt loan loans payday",
}
_BLOCKED = "=block"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 2), *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 3), F.lit(""))


def tokens_of(url: str | None, host: str, path: str) -> list[str]:
    """The distinct tokens of a URL."""
    if not url or "://" not in url:
        return []
    labels = host.split(".")
    out = {"s:" + url.partition("://")[0].lower()} | {f"h{len(labels) - i}:{label}" for i, label in enumerate(labels)}
    out |= {"w:" + w for label in labels for w in re.split(r"[-_0-9]+", label) if w}
    out |= {"p:" + ("#" if s.isdigit() else s) for s in re.split(r"[/.]", path) if s}
    query = url.partition("?")[2].partition("#")[0]
    return sorted(out | {"q:" + x.partition("=")[0] for x in query.split("&") if x})


def _tokeniser(withheld: frozenset[str]):
    def tokenise(batches):
        for batch in batches:
            rows = [[t for t in tokens_of(*r) if not (withheld and _stated(t, withheld))] + ([_BLOCKED] if blocked else []) for *r, blocked in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["items"])

    return tokenise


def list_tokens(fixed=RULES) -> frozenset[str]:
    """The tokens that state fixed rules; those with a listed word are found by ``_stated``."""
    return frozenset(t for host, path, _ in fixed for t in tokens_of(f"://{host}{path}", host, path) if t != "s:")


_LISTED = frozenset(w for words in CATEGORIES.values() for w in words.split())


def _stated(token: str, withheld: frozenset[str]) -> bool:
    return token in withheld or (token[0] in "hw" and not _LISTED.isdisjoint(re.split(r"[-_0-9]+", token.partition(":")[2])))


def list_labels(pages: DataFrame, fixed=RULES) -> DataFrame:
    """url and blocked: whether a fixed rule blocks it, or its host has a listed word."""
    listed = F.arrays_overlap(F.split("host", "[^a-z]+"), F.array(*map(F.lit, sorted(_LISTED))))
    return judge(pages, [], fixed).where(F.col("url").contains("://")).select("url", ((F.col("rule").isNotNull() & (F.col("verdict") == "block")) | listed).alias("blocked"))


def _rules(shared, n: int, min_support: float, min_confidence: float):
    """Keeps the itemsets that are rules and that no rule with one token less makes needless; ``shared`` has the places."""

    def judged(items) -> tuple[float, float]:
        allowed, blocked = (_common([places[t] for t in items]) for places in shared.value)
        return blocked / (allowed + blocked), blocked / n

    def keep(batches):
        for batch in batches:
            out = []
            for items in batch.column(0).to_pylist():
                confidence, support = judged(items)
                if confidence < min_confidence or support < min_support:
                    continue
                if len(items) > 1 and any(judged(items[:i] + items[i + 1 :])[0] >= confidence for i in range(len(items))):
                    continue
                out.append((items, confidence, support))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.list_(pa.string())), *(pa.array([x[i] for x in out], pa.float64()) for i in (1, 2))], names=["items", "confidence", "support"])

    return keep


def _common(places: list[np.ndarray]) -> int:
    """How many numbers are in all of the sorted arrays."""
    first, *others = sorted(places, key=len)
    for other in others:
        if not len(first):
            break
        first = first[other[np.minimum(np.searchsorted(other, first), len(other) - 1)] == first]
    return len(first)


def _placer(tokens):
    """Per partition, token and label: the numbers of the rows that hold the token."""

    def place(batches):
        part, row, found = TaskContext.get().partitionId() << 32, 0, {}
        for batch in batches:
            for items in batch.column(0).to_pylist():
                blocked = _BLOCKED in items
                for token in items:
                    if token in tokens.value:
                        found.setdefault((token, blocked), []).append(part + row)
                row += 1
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([b for _, b in found], pa.bool_()), pa.array([np.array(x, "<i8").tobytes() for x in found.values()], pa.binary())], names=["token", "blocked", "places"])

    return place


def mine(labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_labelled: int = MAX_LABELLED, max_rules: int = MAX_RULES, min_rows: int = MIN_ROWS, withheld: frozenset[str] = frozenset()) -> list[tuple[frozenset, float, float]]:
    """Rules (tokens, confidence, support) for ``block`` from (url, blocked); support is the share of all labelled rows.

    With ``withheld`` tokens, these and tokens with a listed word are in no rule.
    """
    labelled = labelled.where(F.col("url").isNotNull() & F.col("blocked").isNotNull())
    spark, total = labelled.sparkSession, labelled.count()
    draw = F.pmod(F.xxhash64(F.lit(5), "url", F.col("blocked")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # equal URLs are drawn together, so they are thinned by hash of the URL and counted whole
    sample = labelled.where(draw < max_labelled / max(1, total)).select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "blocked")
    items, _ = stored(sample.mapInArrow(_tokeniser(withheld), "items array<string>"), "items")
    n = items.count()
    blocked = items.where(F.array_contains("items", _BLOCKED)).select(F.array_remove("items", _BLOCKED).alias("items"))
    n_blocked = blocked.count()
    need = max(1, min_rows, math.ceil(min_support * n - 1e-9))
    if n_blocked < need:
        return []
    often = {r["token"] for r in blocked.select(F.explode("items").alias("token")).groupBy("token").count().where(F.col("count") >= need).collect()}
    places: tuple[dict, dict] = ({}, {})
    for r in items.mapInArrow(_placer(spark.sparkContext.broadcast(often)), "token string, blocked boolean, places binary").collect():
        places[r["blocked"]].setdefault(r["token"], []).append(np.frombuffer(r["places"], "<i8"))
    allowed_at, blocked_at = ({t: np.sort(np.concatenate(x)) if (x := at.get(t)) else np.empty(0, "<i8") for t in often} for at in places)
    # tokens of the very same rows stand for each other: one is mined
    alike: dict[tuple, list[str]] = {}
    for token in sorted(often):
        alike.setdefault((allowed_at[token].tobytes(), blocked_at[token].tobytes()), []).append(token)
    classes = {x[0]: x for x in alike.values()}
    # a token of blocked rows only is a rule that no larger one betters, and a token of all rows adds nothing to others
    alone = lambda t: len(blocked_at[t]) / (len(allowed_at[t]) + len(blocked_at[t]))
    mined = {t for t in classes if len(allowed_at[t]) and len(allowed_at[t]) + len(blocked_at[t]) < n}
    found = [(frozenset([t]), alone(t), len(blocked_at[t]) / n) for t in classes if t not in mined and alone(t) >= min_confidence]
    if mined:
        shared = spark.sparkContext.broadcast(({t: allowed_at[t] for t in mined}, {t: blocked_at[t] for t in mined}))
        # mining the blocked rows gives every combination frequent together with the label; half a row less keeps rounding out of the bound
        model = FPGrowth(itemsCol="items", minSupport=(need - 0.5) / n_blocked, minConfidence=min_confidence).fit(blocked.select(F.array_intersect("items", F.lit(sorted(mined))).alias("items")))
        sets = model.freqItemsets.select("items").mapInArrow(_rules(shared, n, need / n, min_confidence), "items array<string>, confidence double, support double")
        found += [(frozenset(r["items"]), r["confidence"], r["support"]) for r in sets.collect()]
    kept: list[tuple[frozenset, float, float]] = []
    under: dict[str, list[tuple[frozenset, float]]] = {}
    for rule in sorted(found, key=lambda r: (len(r[0]), -r[1], -r[2], sorted(r[0]))):
        if not any(tokens <= rule[0] and confidence >= rule[1] for t in rule[0] for tokens, confidence in under.get(t, ())):
            kept.append(rule)
            under.setdefault(min(rule[0]), []).append(rule[:2])
    kept.sort(key=lambda r: (-r[1], -r[2], len(r[0]), sorted(r[0])))
    return list(islice(((frozenset(x), c, s) for tokens, c, s in kept for x in product(*(classes[t] for t in sorted(tokens)))), max_rules))


def _index(rules, frequency: dict[str, int]) -> dict[str, list[frozenset]]:
    out: dict[str, list[frozenset]] = {}
    for rule in rules:
        out.setdefault(min(rule, key=lambda t: (frequency.get(t, 0), t)), []).append(rule)
    return out


def _judge(shared):
    def judge(batches):
        fixed, index = shared.value
        for batch in batches:
            rules, verdicts = [], []
            for url, host, path in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                best = None
                labels = host.split(".") if host else []
                for i in range(len(labels)):
                    suffix = ".".join(labels[i:])
                    for start, verdict in fixed.get(suffix, ()):
                        if path.startswith(start) and (best is None or len(suffix) + len(start) > len(best[0])):
                            best = (suffix + start, verdict)
                if best is None:
                    tokens = tokens_of(url, host, path)
                    have = set(tokens)
                    best = (None, "block" if any(rule <= have for t in tokens for rule in index.get(t, ())) else "allow")
                rules.append(best[0])
                verdicts.append(best[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(rules, pa.string()), pa.array(verdicts, pa.string()), batch.column(1)], names=["page_id", "host", "path", "rule", "verdict", "url"])

    return judge


def judge(pages: DataFrame, mined: list[tuple[frozenset, float, float]], fixed=RULES) -> DataFrame:
    """Per page row: page_id, host, path, rule, verdict, url."""
    by_host: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in fixed:
        by_host.setdefault(host, []).append((path, verdict))
    frequency: dict[str, int] = {}
    for rule, _, _ in mined:
        for token in rule:
            frequency[token] = frequency.get(token, 0) + 1
    shared = pages.sparkSession.sparkContext.broadcast((by_host, _index([r[0] for r in mined], frequency)))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return rows.mapInArrow(_judge(shared), "page_id long, host string, path string, rule string, verdict string, url string")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, mine(list_labels(pages), withheld=list_tokens())).drop("url")
