"""Packing, exact search and the vector index against sequential and brute-force versions."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tessera.operators import packing, search, vector_index
from tessera.queries import all_queries

QUERIES, _ = all_queries()


# -- packing ---------------------------------------------------------------------


def greedy(sizes, most, largest, least):
    jobs, held = [], 0
    for i, size in enumerate(sizes):
        if not jobs or len(jobs[-1]) == most or held + size > largest:
            jobs.append([])
            held = 0
        jobs[-1].append(i)
        held += size
    if len(jobs) > 1 and len(jobs[-1]) < least:
        both = jobs[-2] + jobs[-1]
        jobs[-2:] = [both[: len(both) // 2], both[len(both) // 2 :]]
    return [(i, k + 1) for k, job in enumerate(jobs) for i in job]


CASES = [([], 3, 100, 1), ([164] * 5, 100, 200, 1), ([1] * 320, 100, 10**9, 50), ([500, 1, 1, 500, 1], 10, 100, 1), ([0, 0, 0, 7, 0], 2, 7, 1)]


@pytest.mark.parametrize("sizes,most,largest,least", CASES)
def test_packing(sizes, most, largest, least, spark):
    rows = spark.createDataFrame(list(enumerate(sizes)), "id long, bytes long")
    got = packing.pack_jobs(rows, ["id"], "bytes", most, largest, least)
    assert sorted((r["place"], r["job"]) for r in got.collect()) == greedy(sizes, most, largest, least)


def test_packing_as_the_sequential_pass(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 16)
    rng = random.Random(11)
    sizes = [rng.choice([1, 20, 64, 90, 400, 3000]) for _ in range(700)]
    rows = spark.createDataFrame([(3 * i, s) for i, s in enumerate(sizes)], "id long, bytes long").repartition(5)
    for most, largest, least in ((25, 2500, 10), (1000, 2500, 5), (7, 10**9, 4)):
        got = packing.pack_jobs(rows, ["id"], "bytes", most, largest, least).collect()
        assert sorted((r["place"], r["job"]) for r in got) == greedy(sizes, most, largest, least)
        assert all(r["id"] == 3 * r["place"] for r in got)


# -- exact search ----------------------------------------------------------------


def test_search_of_all_queries(spark, sf, duck, monkeypatch):
    monkeypatch.setattr(search.search_all, "__defaults__", (10, "label", 2000))  # pass after pass
    monkeypatch.setattr(search, "ROWS", 37)
    rows = duck.execute("SELECT vec_id, label, embedding FROM embeddings").fetchall()
    unit = {i: np.array(e, float) / np.linalg.norm(np.array(e, float)) for i, _, e in rows}
    got = defaultdict(list)
    for r in QUERIES["kb_search_all"](spark, sf).collect():
        got[r["query_id"], r["label"]].append((r["rank"], r["vec_id"], r["score"]))
    asked = [i for i, _, _ in rows if i % 20 == 0]
    assert len(asked) > 4 and got.keys() == {(q, label) for q in asked for _, label, _ in rows}
    for (q, label), found in got.items():
        best = sorted((-round(float(unit[q] @ unit[i]), 6), i) for i, x, _ in rows if x == label)[:10]
        assert [x[0] for x in sorted(found)] == list(range(1, len(best) + 1))
        assert [x[2] for x in sorted(found)] == pytest.approx([-s for s, _ in best], abs=2e-6)


def test_search_edges(spark):
    rows = [(i, i % 2 or None, [1.0, float(i % 3)]) for i in range(40)] + [(50, 1, None), (51, 1, [0.0, 0.0]), (52, 1, [1.0]), (53, 1, [float("nan"), 1.0]), (54, 1, []), (None, 1, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    queries = spark.createDataFrame([(1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [3.0])], "query_id long, query array<double>")
    got = [(r["query_id"], r["label"], r["rank"], r["vec_id"], r["score"]) for r in search.search_all(vectors, queries, 3).collect()]
    evens, odds = [i for i in range(0, 40, 2) if i % 3 == 0][:3], [i for i in range(1, 40, 2) if i % 3 == 0][:3]
    expected = [(1, None, k + 1, i, 1.0) for k, i in enumerate(evens)] + [(1, 1, k + 1, i, 1.0) for k, i in enumerate(odds)] + [(5, 1, 1, 52, 1.0)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert search.search_all(vectors, queries.limit(0)).count() == 0 and search.search_all(vectors.limit(0), queries).count() == 0


# -- index -----------------------------------------------------------------------


def recall_of(found, unit, k=10):
    got, ids = defaultdict(set), np.array(sorted(unit))
    for r in found:
        got[r["query_id"]].add(r["vec_id"])
    x, hits = np.stack([unit[i] for i in ids]), []
    for q in got:
        score = x @ unit[q]
        worst = np.sort(score)[-k]
        hits.append(sum(unit[i] @ unit[q] >= worst - 1e-9 for i in got[q]) / k)
    return float(np.mean(hits)), len(got)


def test_index_of_all_vectors(spark, sf, tmp_path):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    unit = {r["vec_id"]: np.array(r["embedding"], float) / np.linalg.norm(r["embedding"]) for r in vectors.collect()}
    found = QUERIES["vector_index_search"](spark, "/root/testdata/sf0.1").collect()
    recall, asked = recall_of(found, unit)
    assert asked == sum(i % 20 == 0 for i in unit) and recall >= 0.9
    assert all(abs(r["score"] - unit[r["query_id"]] @ unit[r["vec_id"]]) < 2e-6 for r in found)


def test_index_prunes_lists_and_keeps_all_rows(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(30, 16))[rng.integers(0, 30, 3000)] + 0.2 * rng.normal(size=(3000, 16))).tolist()
    rows = [(i, e) for i, e in enumerate(x)] + [(5000 + i, x[0]) for i in range(1500)] + [(9000, None), (9001, [1.0]), (9002, [0.0] * 16)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    path = f"file://{tmp_path}/index"
    model = vector_index.fit(vectors, sample=1000, lists=24, parts=8)
    vector_index.build(vectors, model, path)
    index = spark.read.parquet(path)
    assert index.count() == 4500 and index.select("vec_id").distinct().count() == 4500
    queries = vectors.where("vec_id < 3000 AND vec_id % 50 = 7").selectExpr("vec_id AS query_id", "embedding AS query")
    found = vector_index.search(spark, path, model, queries, 10, probes=4, query_bytes=16 * 8 * 7)
    unit = {i: np.array(e) / np.linalg.norm(e) for i, e in rows if e is not None and len(e) == 16 and any(e)}
    recall, asked = recall_of(found.collect(), unit)
    assert asked == 60 and recall >= 0.9
    assert vector_index.search(spark, path, model, queries.limit(0)).count() == 0
