"""Modes, the SQL guard, packing and chunking."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import chunks as K
from tessera.operators import retrieval as R
from tessera.plans import sqlapi


def test_modes(spark):
    assert R.mode_filter("  SR_bids_ALL_super_throttled ")[1] is R.SUPER_THROTTLED
    assert R.mode_filter("sr_bids_all_throttled")[1] is R.THROTTLED
    assert R.mode_filter("unheard of")[0] is None and R.mode_filter(None)[1] is R.DEFAULT
    for mode, (_, fields) in R.MODES.items():
        for suffix in ("", "_throttled", "_super_throttled"):
            if fields:
                with pytest.raises(ValueError):
                    R.mode_filter(mode + suffix, "  ")
            else:
                assert R.mode_filter(mode + suffix)[0] is not None


@pytest.mark.parametrize("text", ["SELECT 1", "SELECT updated_at FROM (SELECT 1 AS updated_at)", "WITH a AS (SELECT 1 AS x) SELECT * FROM a", "SELECT 'drop table x' AS s", "VALUES (1)"])
def test_queries_pass(spark, text):
    sqlapi.check(spark, text)


@pytest.mark.parametrize(
    "text",
    ["DROP TABLE x", "drop\ntable x", "DELETE FROM x", "INSERT INTO x VALUES (1)", "UPDATE x SET a = 1", "ALTER TABLE x ADD COLUMN y INT", "CREATE TABLE x (a INT)", "GRANT ALL ON x TO y", "REVOKE ALL ON x FROM y",
     "MERGE INTO x USING y ON x.a = y.a WHEN MATCHED THEN DELETE", "TRUNCATE TABLE x", "SET a = b", "CACHE TABLE x", "SHOW TABLES", "EXPLAIN SELECT 1", "WITH a AS (SELECT 1 AS x) INSERT INTO t SELECT * FROM a", "SELECT 1; SELECT 2", "CALL f()", "BEGIN SELECT 1; END", ""],
)
def test_others_do_not(spark, text):
    with pytest.raises(sqlapi.NotAQuery):
        sqlapi.check(spark, text)


def test_execution(spark):
    assert sqlapi.execute(spark, "SELECT :d AS d", {"d": "it's"}).first()["d"] == "it's"
    assert sqlapi.answer(spark, "SELECT 1 AS a WHERE false").startswith("The query ran")
    assert sqlapi.answer(spark, "SELECT * FROM nowhere").startswith("Error")
    shown = sqlapi.answer(spark, "SELECT id FROM range(100)").splitlines()
    assert len(shown) == 52 and shown[-1] == "... only the first 50 rows are shown"
    assert len(sqlapi.answer(spark, "SELECT id FROM range(50)").splitlines()) == 51
    assert len(sqlapi.answer(spark, "SELECT id, count(*) AS n FROM range(100) GROUP BY id ORDER BY id").splitlines()) == 101  # groups are all shown
    assert sqlapi.list_tables(spark, ["nowhere"])["nowhere"][0].startswith("Error")
    spark.range(1).createOrReplaceTempView("seen")
    assert sqlapi.table_schema(spark, None, ' "seen" ') == {"id": "bigint"}


@pytest.mark.parametrize("n,most,least,expected", [(7, 3, 1, [3, 3, 1]), (120, 100, 50, [60, 60]), (320, 100, 50, [100, 100, 60, 60]), (640, 200, 100, [200, 200, 120, 120]), (5, 10, 3, [5]), (0, 10, 3, [])])
def test_packing(spark, n, most, least, expected):
    assert K.pack_counts(n, most, least) == expected
    rows = K.job_numbers(spark.range(n).withColumnRenamed("id", "place"), "place", most, least)
    assert [r["n"] for r in rows.groupBy("job").agg(F.count("*").alias("n")).orderBy("job").collect()] == expected


def test_chunks_cover_their_text(spark):
    text = " ".join(f"Sentence number {i} is here." for i in range(50))
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "x" * 500 + ". End.")], "doc_id long, text string")
    found = K.sentence_chunks(docs, size=200, overlap=30).orderBy("doc_id", "chunk").collect()
    mine = [r["text"] for r in found if r["doc_id"] == 1]
    assert all(len(t) <= 200 for t in mine) and mine[0].startswith("Sentence number 0") and mine[-1].endswith("49 is here.")
    assert all(b.split(".")[0] in a for a, b in zip(mine, mine[1:]))  # the overlap
    assert {r["doc_id"] for r in found} == {1, 4}


def test_semantic_cuts_against_plain_python(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(40, 8))
    df = spark.createDataFrame([(1, i, [float(x) for x in v]) for i, v in enumerate(vectors)], "g long, i long, v array<double>")
    cuts = {r["i"] for r in K.breaks(K.distances(df, "g", "i", "v"), "g", 90).where("is_break").collect()}
    d = np.array([round(1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b), 6) for a, b in zip(vectors, vectors[1:])])
    assert cuts == set(np.flatnonzero(d > np.percentile(d, 90)).tolist())


def test_failed_windows_stop_the_run(spark):
    from pyspark.errors import PySparkException

    rows = spark.createDataFrame([("a", None), ("b", "refused")], "token string, error string")
    with pytest.raises(PySparkException):
        K.assert_complete(rows).collect()


def test_embedding_runs(spark):
    from tessera.operators import embedding as E

    requests = spark.range(250).selectExpr("id AS place", "concat('t', id) AS token", "concat('text ', id % 40) AS text")
    rows = E.batch_run(requests, max_records=200).orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(250)) and all(r["error"] is None and len(r["embedding"]) == E.DIMENSIONS for r in rows)
    assert [sum(r["job"] == j for r in rows) for j in (1, 2)] == [125, 125] and rows[0]["embedding"] == rows[40]["embedding"] != rows[1]["embedding"]
    with pytest.raises(ValueError):
        E.batch_run(requests, max_records=199)
    with pytest.raises(ValueError):
        E.batch_run(requests.limit(99))


def test_nodes_from_sentences(spark):
    import numpy as np

    from tessera.operators import embedding as E

    text = " ".join(f"Sentence number {i} is here." for i in range(60))
    docs = spark.createDataFrame([(1, text, {"a": "b"}, "origin"), (2, "Only one.", {}, None), (3, "", {"c": "d"}, None), (4, None, {}, "x")], "doc_id long, text string, metadata map<string,string>, source_id string")
    got = {}
    for r in E.semantic_nodes(docs, percentile=90).collect():
        got.setdefault(r["doc_id"], []).append(r)
    parts = [f"Sentence number {i} is here." for i in range(60)]
    vectors = [np.array(E.HashEmbedder().vector(" ".join(parts[max(0, i - 3) : i + 4]))) for i in range(60)]
    d = [round(1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b), 6) for a, b in zip(vectors, vectors[1:])]
    cuts = [0, *(i + 1 for i, x in enumerate(d) if x > np.percentile(d, 90)), 60]
    mine = sorted(got[1], key=lambda r: r["chunk"])
    assert [r["text"] for r in mine] == [" ".join(parts[a:b]) for a, b in zip(cuts, cuts[1:])]
    assert all(r["metadata"] == {"a": "b"} and r["source_id"] == "origin" for r in mine)
    assert [(r["text"], r["source_id"]) for r in got[2]] == [("Only one.", "2")] and [(r["chunk"], r["text"]) for r in got[3] + got[4]] == [(0, ""), (0, "")]

    class Refusing(E.HashEmbedder):
        def vector(self, text):
            raise ValueError("refused")

    with pytest.raises(Exception, match="failed: ValueError: refused"):
        E.semantic_nodes(docs, Refusing).collect()


def test_metadata_strategies(spark):
    from tessera.operators import corpus as C

    old = spark.createDataFrame([("k", 1, "A"), ("k", 2, "B"), ("z", 1, "C")], "key string, ord int, department string")
    new = spark.createDataFrame([("k", 0, "N")], old.schema)
    assert {r["key"]: r["department"] for r in C.load_metadata("historic", historic=old).collect()} == {"k": "B", "z": "C"}
    assert {r["key"]: r["department"] for r in C.load_metadata("export", historic=old, export=new).collect()} == {"k": "N", "z": "C"}
    keys = spark.createDataFrame([("p/Body/report.v1.pdf",), ("p/Other/x",), ("p/alone.pdf",)], "key string")
    bodies = spark.createDataFrame([("Body", "Parent")], "alb string, parent string")
    assert {tuple(r) for r in C.load_metadata("folder", keys=keys, bodies=bodies, prefix="p/").collect()} == {("p/Body/report.v1.pdf", "Parent", "Body", "report.v1"), ("p/Other/x", "Other", None, "x")}
    with pytest.raises(ValueError):
        C.load_metadata("folder")
    assert C.load_metadata("unheard of") is None
    refs = spark.range(10)
    assert C.filtered(refs).count() == 10 and C.filtered(refs, lambda x: x.where("id > 3"), lambda x: x.where("id < 6")).count() == 2


def test_batches_over_many_partitions(spark):
    from tessera.operators import corpus as C

    rows = spark.range(1003).selectExpr("(id * 7919) % 1003 AS k", "concat('x', id) AS other").repartition(9)
    got = {r["k"]: r["batch"] for r in C.batches(rows, 100, ["k"]).collect()}
    assert got == {k: k // 100 + 1 for k in range(1003)}


def test_fused_ranks(spark):
    """Best rank of each retriever, sources named, ties by id, nothing found."""
    one = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "id string, rank long")
    two = spark.createDataFrame([("c", 1), ("b", 1)], "id string, rank long")
    found = [tuple(r) for r in R.fused({"x": one, "y": two}, 10).collect()]
    assert [(i, s) for i, _, s in found] == [("b", "x,y"), ("a", "x"), ("c", "y")]
    assert found[0][1] == pytest.approx(1 / 62 + 1 / 61, abs=1e-9)
    assert R.fused({"x": one, "y": two}, 1).count() == 1
    assert R.fused({"x": one.where("false"), "y": two.where("false")}, 5).count() == 0


def test_composite_names_its_retrievers(spark):
    hits = spark.createDataFrame([(10, 1, 1), (11, 1, 2)], "chunk long, entity long, rank long")
    rows = [("s1", 10, 1, 7), ("s2", 12, 1, 8), ("s3", 13, 2, 7), ("s4", 13, 2, 9), ("s5", 11, 3, 9), ("s6", None, None, None)]
    statements = spark.createDataFrame(rows, "id string, chunk long, s long, o long")
    assert {r["id"]: r["sources"] for r in R.composite(hits, statements, 24, 72).collect()} == {"s1": "chunk,entity", "s2": "entity", "s3": "context", "s5": "chunk"}
    assert R.composite(hits.where("false"), statements, 24, 72).count() == 0
