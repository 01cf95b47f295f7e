"""Many LIKE patterns, neighbour lists, chunking settings and dates in names, against plain forms."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import corpus as C
from tessera.operators import graph as G
from tessera.operators import patterns as PT
from tessera.operators import presets as PR
from tessera.store import scratch


@pytest.mark.parametrize("block_bytes", [40, 4_000_000])
def test_patterns_equal_like(spark, block_bytes):
    draw = random.Random(5)
    words = ["ab", "abc", "b", "", "a%b", "a_b", "ä.b", "x\ny", "aab*"]
    texts = [(i, "".join(draw.choice(words) for _ in range(3))) for i in range(60)] + [(97, None), (98, ""), (98, ""), (99, "ab" * 5000)]
    forms = ["%ab%", "ab%", "%b", "abc", "a_b", "%a_b%c%", "%", "_%", "", r"%a\%b%", r"a\_b%", "%*", "x%y", "%ä.%", "__"]
    patterns = [(f"n{i % 4}", p) for i, p in enumerate(forms)] + [("n9", None), ("n0", "%ab%")]
    rows = spark.createDataFrame(texts, "id long, text string")
    frame = spark.createDataFrame(patterns, "name string, pattern string")
    found = PT.like_any(rows, "id", "text", frame, "name", "pattern", block_bytes)
    plain = rows.join(frame, F.expr("text LIKE pattern")).select("id", "name").distinct()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_no_patterns_or_texts(spark):
    rows, none = spark.createDataFrame([(1, "a")], "id long, text string"), spark.createDataFrame([], "name string, pattern string")
    assert PT.like_any(rows, "id", "text", none, "name", "pattern").count() == 0
    some = spark.createDataFrame([("n", "%a%")], "name string, pattern string")
    assert PT.like_any(rows.where("id = 2"), "id", "text", some, "name", "pattern").count() == 0


def _plain_expand(pairs, start, ends, cap):
    near = {}
    for a, b in pairs:
        if a is not None and b is not None:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    paths = [(start, m) for m in near.get(start, ())] + [(start, m, e) for m in near.get(start, ()) for e in near[m] if e != start]
    ids = sorted({n for p in paths if ends is None or p[-1] in ends for n in p})
    return ids[:cap]


@pytest.mark.parametrize("cap", [None, 3, 40])
@pytest.mark.parametrize("ends", [None, [2, 5, 900], [1, 777]])
def test_expansion_over_hubs(spark, ends, cap):
    draw = random.Random(3)
    pairs = [(1, i) for i in range(2, 200)] + [(draw.randrange(2, 60), draw.randrange(2, 400)) for _ in range(200)] + [(1, 2), (2, 1), (7, 7), (1, 1), (None, 4), (900, 5)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    lists = G.Adjacency.build(edges, scratch(spark, "lists"), 8)
    for start in (1, 7, 900, 12345):
        expected = _plain_expand(pairs, start, ends, cap)
        assert sorted(r.id for r in G.expand(edges, start, ends, cap).collect()) == expected
        assert sorted(r.id for r in lists.expand(start, ends, cap).collect()) == expected
    assert lists.degrees().where("node = 1").first()["degree"] == 199


def test_lists_of_other_nodes_are_pruned(spark):
    edges = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") * 7 % 2000).alias("b"))
    lists = G.Adjacency.build(edges, scratch(spark, "lists"), 8)
    plan = lists.around([5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(node,5)" in plan


def test_presets(spark):
    assert PR.preset({"strategy": "SEMANTIC"}) == PR.ByMeaning(512, 1, 91)
    assert PR.preset({"strategy": "FIXED_SIZE", "max_tokens": 10}) == PR.BySize(10, 20)
    for bad in ({}, {"strategy": "OTHER"}, {"strategy": "NONE", "max_tokens": 1}, {"strategy": "SEMANTIC", "buffer_size": 2}, {"strategy": "SEMANTIC", "breakpoint_percentile_threshold": 49},
                {"strategy": "FIXED_SIZE", "overlap_percentage": 0}, {"strategy": "FIXED_SIZE", "max_tokens": 0}, {"strategy": "FIXED_SIZE", "max_tokens": True}):
        with pytest.raises(ValueError):
            PR.preset(bad)
    docs = spark.createDataFrame([(1, "One two. Three four. Five six! Seven?"), (2, ""), (3, None), (4, " ".join(f"w{i}" for i in range(25)))], "doc_id long, text string")
    cut = lambda **s: sorted(map(tuple, PR.cut_documents(docs, s).collect()))
    assert [r[:3] for r in cut(strategy="NONE")] == [(1, 0, 0), (4, 0, 0)]
    assert [r[3].split()[0] for r in cut(strategy="FIXED_SIZE", max_tokens=10, overlap_percentage=20) if r[0] == 4] == ["w0", "w8", "w16"]
    meaning = cut(strategy="SEMANTIC", max_tokens=10)
    assert " ".join(r[3] for r in meaning if r[0] == 1) == "One two. Three four. Five six! Seven?"
    assert [len(r[3].split()) for r in meaning if r[0] == 4] == [10, 10, 5]


def test_names_state_dates(spark):
    names = ["20260901 Letter to Home Office - Review 010926.docx", "llm_dbr_report_home_office_062026.pdf", "report_132026", "202609 x", "20261301 x", "x 20260901", "123456789 y", None, ""]
    found = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", S.named_date(F.col("n")).cast("string").alias("d"))
    assert [r.d for r in found.orderBy("i").collect()] == ["2026-09-01", "2026-06-01", None, None, None, None, None, None, None]


def test_latest_by_name(spark):
    keys = ["a/20250101 Letter to The Treasury - X.docx", "b/20260101 Letter to treasury - X.docx", "b/20269901 Letter to treasury - X.docx", "llm_dbr_report_the_treasury_012024", "llm_dbr_report_treasury_122023.pdf", "note.txt", None]
    found = {r.key: r for r in C.named_documents(spark.createDataFrame([(k,) for k in keys], "key string"), "key").collect()}
    assert len(found) == len(keys)
    assert {k for k, r in found.items() if r.is_latest} == {keys[1], keys[3]}
    assert found[keys[3]].department == "the treasury" and found[keys[3]].document_type == "dbr_report" and found["note.txt"].department is None
