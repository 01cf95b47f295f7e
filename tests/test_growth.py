"""Results and plans that only large tables tell apart, on tables made small for the purpose."""

from __future__ import annotations

import numpy as np
from tessera.llm.registry import QUERIES as QUERIES_OF_OPERATORS
from tessera.queries import all_queries

QUERIES, SQL = all_queries()


def test_approximate_count_stays_near_at_any_size(spark, tmp_path):
    # the default sketch is off by more than a tenth on these keys
    spark.range(1, 1_200_001).selectExpr("id AS l_partkey", "'R' AS l_returnflag").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in QUERIES["passthru_sample_approx"](spark, str(tmp_path)).collect()] == [("R", 1_200_000, True)]


def test_pattern_names_leave_the_mapper_once(spark):
    from tessera.operators import patterns as PT

    class Block:
        value = [("%a%", [1, 2]), ("a%", [2]), ("%", [3])]

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"key": pa.array([7, 8]), "text": pa.array(["abc", "x"])})
    found = [tuple(r.values()) for b in PT._matcher(Block)([batch]) for r in b.to_pylist()]
    assert sorted(found) == [(7, 1), (7, 2), (7, 3), (8, 3)]


def test_probing_holds_little_however_many_queries(monkeypatch):
    import tracemalloc

    import pandas as pd

    from tessera.operators import vector_index as V

    rng = np.random.default_rng(0)
    x = rng.normal(size=(2048, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = V.Model(x[:400], 4, 8, 32)
    lists, codes = model.encode(x)
    frame = pd.DataFrame({"vec_id": np.arange(len(x)), "code": [c.tobytes() for c in codes], "unit": list(x), "list": lists})
    n, made = 3000, 0
    asked = rng.normal(size=(n, 32))

    class Queries:
        value = (np.arange(n), asked, {i: np.arange(n) for i in range(4)})

    class Sent:
        value = model

    tracemalloc.start()
    for part in V._probe(Queries, Sent, 20)(iter([frame])):
        made += len(part)
        assert part.groupby("query_id").size().max() == 20
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made == 20 * n and peak < 16_000_000  # one row for each of a task's best, not for each piece; a products' table for all queries alone is 200 MB


def test_semantic_nodes_do_not_shuffle(spark, sf):
    plan = QUERIES["semantic_nodes"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_ranks_and_percentiles_of_few_groups_are_dealt_by_ranges(spark, tmp_path):
    rows = [(i, status, None if i % 50 == 0 else float(i * 37 % 1000), ["1-A", "2-B", None][i % 3]) for i, status in enumerate("FFFFO" * 80)] + [(1000, "P", 5.0, "1-A")]
    frame = spark.createDataFrame(rows, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    frame.write.parquet(f"{tmp_path}/orders.parquet")
    frame.selectExpr("o_orderstatus AS l_returnflag", "o_totalprice AS l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    import duckdb

    duck = duckdb.connect()
    for name in ("orders", "lineitem"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    from .compare import check

    for name in ("passthru_window_rank", "passthru_percentile"):
        check(spark, str(tmp_path), duck, QUERIES[name], SQL[name])
        plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert "ntile(" not in plan and "percentile(" not in plan


def test_pairs_of_a_large_bucket_that_later_tiers_part_are_compared(spark, monkeypatch):
    import random

    from tessera.llm import near_dup
    from tessera.llm.common import ship

    monkeypatch.setattr(near_dup, "LIMIT", 8)
    ship(spark)
    deal = random.Random(3)
    word = lambda: f"w{deal.randrange(10**9)}"
    passage, docs = [word() for _ in range(60)], []
    for i in range(20):
        rest = [word() for _ in range(240 - 40 * (i % 3))]
        # every fifth word differs, so that the pair shares no shingle but the passage's, as all texts do
        docs += [(2 * i, " ".join(passage + rest)), (2 * i + 1, " ".join(passage + [word() if j % 5 == 4 else w for j, w in enumerate(rest)]))]
    rows = near_dup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {r["doc_id"]: r["class_id"] for r in rows}
    codes = {i: near_dup.word_codes(t) for i, t in docs}
    sketches = {i: set(enumerate(near_dup.sketches_of(c))) for i, c in codes.items()}
    meant = [i for i in range(0, 40, 2) if sketches[i] & sketches[i + 1]]
    assert len(meant) >= 15 and all(near_dup.similarity(codes[i].tolist(), codes[i + 1].tolist()) >= 0.8 for i in meant)
    assert [found[i + 1] for i in meant] == meant and all(found[i] == i for i in range(0, 40, 2))


def test_line_dedup_broadcasts_no_table(spark, sf):
    # rows of numbers are small in files and large in the driver
    plan = QUERIES_OF_OPERATORS["op2_line_dedup"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_dangling_ends_are_found_in_one_pass(spark, sf):
    from tessera.operators import topics as T

    texts = [
        (1, "entities:\nA|x\nentity-entity relationships:\nA|r|B\nB|r|A\ntopic: t\nentities:\nB|x\nentity-entity relationships:\nB|r|C\nC|r|C\nA|r|B\ntopic: t\nentities:\nC|x"),
        (2, "topic: t\nentity-entity relationships:\nA|r|B"),
        (3, None),
        (None, "topic: t\nentities:\nA|x\nentity-entity relationships:\nA|r|B"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    expected = {(1, None, "A"), (1, None, "B"), (1, "t", "A"), (2, "t", "A"), (2, "t", "B"), (None, "t", "A"), (None, "t", "B")}
    parsed = T.parse_topics(docs)
    for found in (T.dangling_in(docs), T.dangling(parsed)):
        rows = [tuple(r) for r in found.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == expected
    # entities of another row of the document count where rows are parsed
    rest = T.parse_topics(spark.createDataFrame([(2, "topic: t\nentities:\nB|x")], "doc_id long, text string"))
    assert [tuple(r) for r in T.dangling(parsed.union(rest)).where("doc_id = 2").collect()] == [(2, "t", "A")]
    # the texts are made, and read, once; nothing is joined to itself
    plan = QUERIES["dangling_refs"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "LeftAnti" not in plan and plan.count("Aggregate") == 1
    assert T.dangling(parsed)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
