"""Ranked text search against scoring every document."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import text_search


def brute(docs, query, k, keep=None):
    words = {i: re.findall("[a-z0-9]+", (t or "").lower()) for i, t in docs}
    mean = sum(map(len, words.values())) / len(words)
    out = []
    terms = set(re.findall("[a-z0-9]+", query.lower()))
    df = {t: sum(t in w for w in words.values()) for t in terms}
    for i, w in words.items():
        if terms & set(w) and (keep is None or i in keep):
            score = sum(math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in terms if t in w)
            out.append((-round(score, 6), i))
    return [(i, -s) for s, i in sorted(out)[:k]]


@pytest.mark.parametrize("block_docs", [5, 512])
def test_ranked_search(block_docs, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_search, "BLOCK_DOCS", block_docs)
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(60)], k=rng.randint(1, 60)))) for i in range(200)]
    docs += [(300, None), (301, ""), (302, "W1, w1; W2!"), (303, docs[0][1])]
    rows = spark.createDataFrame(docs, "id long, text string").withColumn("term", F.lit("clash"))
    index = f"file://{tmp_path}/index{block_docs}"
    text_search.build(rows, index)
    asked = {1: "w0 w7 w7", 2: "W50, w3 w59", 3: "nowhere", 4: "", 5: "w1 w2", 6: "w59"}
    queries = spark.createDataFrame(list(asked.items()), "query_id long, query string")
    keep = {i for i, _ in docs if i % 3 == 0}
    for kept in (None, keep):
        found = text_search.search(index, queries, 7, None if kept is None else spark.createDataFrame([(i,) for i in kept], "id long")).collect()
        for q, text in asked.items():
            got = [(r["id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
            expected = brute(docs, text, 7, kept)
            assert [i for i, _ in got] == [i for i, _ in expected] and [s for _, s in got] == pytest.approx([s for _, s in expected], abs=2e-6)
    lists = {r["id"] for r in text_search.phrase(index, "w1 w1 w2", spark).collect()}
    assert lists == {i for i, t in docs if re.search(r"\bw1 w1 w2\b", " ".join(re.findall("[a-z0-9]+", (t or "").lower())))} and 302 in lists


def test_no_documents(spark, tmp_path):
    text_search.build(spark.createDataFrame([], "id long, text string"), f"file://{tmp_path}/none")
    assert text_search.search(f"file://{tmp_path}/none", spark.createDataFrame([(1, "a")], "query_id long, query string")).count() == 0


def _shuffled(spark):
    """Rows written to shuffles so far."""
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_words_do_not_move_one_by_one(spark, tmp_path):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices([f"w{j}" for j in range(300)], k=400))) for i in range(1500)]
    rows = spark.createDataFrame(docs, "id long, text string").repartition(2).cache()
    rows.count()
    queries = spark.createDataFrame([(1, "w1 w2"), (2, " ".join(f"w{j}" for j in range(300)))], "query_id long, query string")
    index = f"file://{tmp_path}/index"
    before = _shuffled(spark)
    text_search.build(rows, index)
    built = _shuffled(spark)
    lists = spark.read.parquet(f"{index}/postings")
    n, entries = lists.count(), lists.selectExpr("sum(size(entries))").first()[0]
    assert entries > 100 * n
    assert built - before <= len(docs) + 100  # the documents, not their 600,000 words or the index's entries
    built = _shuffled(spark)
    found = text_search.search(index, queries, 5).where("query_id = 1").collect()
    assert _shuffled(spark) - built < 4 * (n + len(docs))  # a term's lists aren't sent to one task; scores are
    assert [r["id"] for r in sorted(found, key=lambda r: r["rank"])] == [i for i, _ in brute(docs, "w1 w2", 5)]


def test_blocks_hold_documents_once_and_filters_change_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_search, "BLOCK_DOCS", 7)
    docs = [(f"d{i:03d}", f"all t{i % 10} T{i % 3} all") for i in range(100)] + [("none", "?!"), ("null", None)]
    index = f"file://{tmp_path}/index"
    text_search.build(spark.createDataFrame(docs, "id string, text string").repartition(3), index)
    lists = [r for r in spark.read.parquet(f"{index}/postings").where("term = 'all'").collect()]
    assert sorted(e["id"] for r in lists for e in r["entries"]) == [i for i, _ in docs[:100]]
    assert all(r["n"] == len(r["entries"]) <= 7 and r["largest"] == max(e["weight"] for e in r["entries"]) for r in lists) and len({r["block"] for r in lists}) == len(lists)
    assert {(e["length"], *e["places"]) for r in lists for e in r["entries"]} == {(4, 0, 3)}
    queries = spark.createDataFrame([(1, "t1 t5"), (2, "all")], "query_id long, query string")
    results = []
    for terms in (1000, 1):
        monkeypatch.setattr(text_search, "FILTER_TERMS", terms)
        results.append(sorted(map(tuple, text_search.search(index, queries, 4).collect()), key=lambda r: (r[0], r[3])))
    assert results[0] == results[1] and [r[1] for r in results[0] if r[0] == 1] == [i for i, _ in brute(docs, "t1 t5", 4)]
