"""Queries over graph and vector retrieval, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import retrieval as R
from ..operators import search as S
from ..operators import vector_index as I
from ..store import scratch
from ..tables import load, run_sql, view

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(make):
        QUERIES[name or make.__name__] = make
        if sql:
            SQL[name or make.__name__] = sql
        return make

    return add


BASE = 1_000_000_000  # part ids as entities
START, CAP = 7, 50
ENDS = [BASE + p for p in range(1, 40)]

_EDGES = f"SELECT DISTINCT l_suppkey AS a, {BASE} + l_partkey AS b FROM lineitem"
_BOTH = f"(SELECT a, b FROM ({_EDGES}) UNION SELECT b, a FROM ({_EDGES}))"
_EXPANDED = f"""SELECT DISTINCT id FROM (
SELECT unnest([{START}, e]) AS id FROM (SELECT b AS e FROM e2 WHERE a = {START}) WHERE e IN ({', '.join(map(str, ENDS))})
UNION ALL SELECT unnest([{START}, m, e]) FROM (SELECT f.b AS m, g.b AS e FROM e2 f JOIN e2 g ON f.b = g.a WHERE f.a = {START} AND g.b <> {START}) WHERE e IN ({', '.join(map(str, ENDS))}))"""


def edges(spark, d):
    return load(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), (F.lit(BASE) + F.col("l_partkey")).alias("b")).distinct()


def suppliers_as_ends(spark, d):
    """Parts lead back to suppliers, so two hops from a supplier reach suppliers; ends are parts and suppliers."""
    return ENDS


@query(f"WITH e2 AS {_BOTH} SELECT id FROM ({_EXPANDED}) ORDER BY id LIMIT {CAP}")
def entity_expand(spark, d):
    return G.expand(edges(spark, d), START, ENDS, CAP)


@query(f"WITH e2 AS {_BOTH} SELECT DISTINCT id FROM (SELECT {START} AS id UNION ALL SELECT b FROM e2 WHERE a = {START} UNION ALL SELECT g.b FROM e2 f JOIN e2 g ON f.b = g.a WHERE f.a = {START}) ORDER BY id LIMIT {CAP}")
def hub_expand(spark, d):
    """From a supplier to any node, over stored neighbour lists."""
    return G.Adjacency.build(edges(spark, d), scratch(spark, "adjacency"), 16).expand(START, None, CAP)


@query(f"WITH e2 AS {_BOTH} SELECT a AS node, count(*) AS degree FROM e2 GROUP BY a")
def node_degrees(spark, d):
    return G.Adjacency.build(edges(spark, d), scratch(spark, "adjacency"), 16).degrees()


_END_SUPPLIERS = [3, 11, 19]
_S_EXPANDED = f"""SELECT DISTINCT id FROM (SELECT unnest([{START}, m, e]) AS id FROM (SELECT f.b AS m, g.b AS e FROM e2 f JOIN e2 g ON f.b = g.a WHERE f.a = {START} AND g.b IN (3, 11, 19)))"""
_FACTS = f"""e2 AS {_BOTH}, ids AS (SELECT id FROM ({_S_EXPANDED}) ORDER BY id LIMIT {CAP}),
facts AS (SELECT statement_id AS fact, s_id AS s, o_id AS o FROM statements WHERE s_id IN (SELECT id FROM ids) AND o_id IN (SELECT id FROM ids) ORDER BY fact LIMIT 72)"""


def _facts(spark, d):
    entities = G.expand(edges(spark, d), START, _END_SUPPLIERS, CAP)
    facts = view(spark, d, "statements").select(F.col("statement_id").alias("fact"), F.col("s_id").alias("s"), F.col("o_id").alias("o"))
    return G.facts_among(facts, entities, 3 * R.DEFAULT.limit)


@query(f"WITH {_FACTS} SELECT fact, s, o FROM facts")
def entity_facts(spark, d):
    return _facts(spark, d)


@query(f"""WITH {_FACTS} SELECT id FROM (SELECT fact AS id FROM facts UNION SELECT prev FROM statements WHERE statement_id IN (SELECT fact FROM facts) AND prev IS NOT NULL
UNION SELECT statement_id FROM statements WHERE prev IN (SELECT fact FROM facts)) ORDER BY id LIMIT 24""")
def fact_statements(spark, d):
    previous = view(spark, d, "statements").select(F.col("statement_id").alias("id"), "prev")
    return G.statements_of(_facts(spark, d), previous, R.DEFAULT.limit)


@query(f"""WITH e2 AS {_BOTH} SELECT f.a AS p, f.b AS n1, g.b AS n2 FROM e2 f LEFT JOIN e2 g ON f.b = g.a AND g.b <> f.a
WHERE f.a IN (SELECT s_suppkey FROM supplier WHERE contains(s_name, '00000004')) ORDER BY p, n1, n2 NULLS LAST LIMIT 100""")
def neighbourhood(spark, d):
    starts = load(spark, d, "supplier").where(F.contains("s_name", F.lit("00000004"))).select(F.col("s_suppkey").alias("id"))
    return G.neighbourhood(edges(spark, d), starts, 100)


@query("""SELECT id, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds, count(DISTINCT kind) AS n_kinds, count(*) AS connections
FROM (SELECT l_suppkey AS id, l_returnflag AS kind FROM lineitem) GROUP BY id HAVING count(DISTINCT kind) > 1""")
def cross_source_entities(spark, d):
    return G.cross_source(load(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_returnflag").alias("kind")))


_CHUNKS = "SELECT source_id AS chunk, s_id AS id, quantity AS value FROM statements"


@query(f"WITH c AS ({_CHUNKS}) SELECT DISTINCT x.id AS anchor, y.id AS other FROM c x JOIN c y ON x.chunk = y.chunk AND x.id <> y.id AND y.value IS NOT NULL WHERE x.id IN (3, 5, 8) ORDER BY anchor, other LIMIT 150")
def supplier_network(spark, d):
    chunks = run_sql(spark, d, _CHUNKS)
    return G.network(chunks, chunks.where(F.col("id").isin(3, 5, 8)).select("id").distinct(), 150)


_PROGRAMMES = "SELECT source_id AS chunk, o_id AS id, quantity AS value FROM statements"


@query(f"WITH c AS ({_PROGRAMMES}) SELECT DISTINCT x.id AS anchor, y.id AS other FROM c x JOIN c y ON x.chunk = y.chunk AND x.id <> y.id AND y.value IS NOT NULL WHERE x.id % 100 = 7 ORDER BY anchor, other LIMIT 150")
def programme_network(spark, d):
    chunks = run_sql(spark, d, _PROGRAMMES)
    return G.network(chunks, chunks.where(F.col("id") % 100 == 7).select("id").distinct(), 150)


# -- modes ----------------------------------------------------------------------

_KINDS = "CASE doc_id % 4 WHEN 0 THEN 'business_case' WHEN 1 THEN 'sr_bids_2025' WHEN 2 THEN 'contract_finder' ELSE 'letter' END"
_PASSAGES = f"""SELECT doc_id, {_KINDS} AS document_type, source AS department, CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END AS department_name, lang AS alb, concat('contract ', source) AS contract_name FROM documents"""
_ENTITY = {"metadata_filtered_business_case_department": "src4", "metadata_filtered_business_case_alb": "fr", "metadata_filtered_sr_bids_department": "src5", "metadata_filtered_sr_bids_alb": "de", "metadata_filtered_contract_finder_department": "src2", "search_by_project": "src1", "department_all_sources": "src3"}
_WHERE = {
    "metadata_filtered_business_case_department": "contains(document_type, 'business_case') AND department = 'src4'",
    "metadata_filtered_business_case_alb": "contains(document_type, 'business_case') AND alb = 'fr'",
    "metadata_filtered_sr_bids_department": "contains(document_type, 'sr_bids_2025') AND department_name = 'src5'",
    "metadata_filtered_sr_bids_alb": "contains(document_type, 'sr_bids_2025') AND alb = 'de'",
    "metadata_filtered_contract_finder_department": "contains(document_type, 'contract_finder') AND department_name = 'src2'",
    "search_by_project": "contains(document_type, 'contract_finder') AND contains(contract_name, 'src1')",
    "department_all_sources": "department = 'src3' OR department_name = 'src3'",
    "business_case_all": "contains(document_type, 'business_case')",
    "sr_bids_all": "contains(document_type, 'sr_bids_2025')",
    "contract_finder_all": "contains(document_type, 'contract_finder')",
    "default": "true",
}


def _mode(mode: str):
    def run(spark, d):
        return R.apply_mode(run_sql(spark, d, _PASSAGES), mode, _ENTITY.get(mode))[0].select("doc_id", "document_type")

    return run


for _name, _sql in _WHERE.items():
    query(f"SELECT doc_id, document_type FROM ({_PASSAGES}) WHERE {_sql}", f"mode_{_name}")(_mode(_name))


# -- vectors ----------------------------------------------------------------------

_COSINE = "round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6)"


def _query_vector(spark, d, vec_id: int) -> list[float]:
    return load(spark, d, "embeddings").where(F.col("vec_id") == vec_id).first()["embedding"]


@query(f"SELECT v.vec_id, {_COSINE} AS score FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY score DESC, v.vec_id LIMIT 10")
def vector_topk(spark, d):
    return R.vector_topk(load(spark, d, "embeddings"), _query_vector(spark, d, 0), 10)


@query(f"SELECT v.vec_id, {_COSINE} AS score FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 3) q WHERE v.label IN (2, 4) ORDER BY score DESC, v.vec_id LIMIT 5")
def vector_topk_filtered(spark, d):
    return R.vector_topk(load(spark, d, "embeddings"), _query_vector(spark, d, 3), R.SUPER_THROTTLED.top_k, F.col("label").isin(2, 4))


@query(f"""SELECT query_id, label, vec_id, score, rank FROM (SELECT q.vec_id AS query_id, v.label, v.vec_id, {_COSINE} AS score, CAST(row_number() OVER (PARTITION BY q.vec_id, v.label ORDER BY {_COSINE} DESC, v.vec_id) AS INTEGER) AS rank
FROM embeddings v, (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0) q) WHERE rank <= 10""")
def kb_search_all(spark, d):
    vectors = load(spark, d, "embeddings")
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return S.search_all(vectors, asked, 10).select("query_id", "label", "vec_id", "score", "rank")


@query()
def vector_index_search(spark, d):
    """The ten nearest of every twentieth vector, from an index of all vectors."""
    vectors = load(spark, d, "embeddings")
    model, path = I.fit(vectors), scratch(spark, "index")
    I.build(vectors, model, path)
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return I.search(spark, path, model, asked, 10)


@query(f"""WITH hits AS (SELECT v.vec_id AS chunk, v.vec_id % 100 AS entity, row_number() OVER (ORDER BY {_COSINE} DESC, v.vec_id) AS rank FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 0) q QUALIFY rank <= 10),
entities AS (SELECT entity, min(rank) AS hit FROM hits GROUP BY entity),
chunk_found AS (SELECT statement_id AS id, row_number() OVER (ORDER BY h.rank, statement_id) AS rank FROM statements JOIN hits h ON source_id = h.chunk QUALIFY rank <= 72),
entity_found AS (SELECT statement_id AS id, o_id, row_number() OVER (ORDER BY hit, statement_id) AS rank FROM statements JOIN entities ON s_id = entity QUALIFY rank <= 72),
context_found AS (SELECT id, row_number() OVER (ORDER BY id) AS rank FROM (SELECT DISTINCT statement_id AS id FROM statements WHERE o_id IN (SELECT o_id FROM entity_found) AND s_id NOT IN (SELECT entity FROM entities)) QUALIFY rank <= 72),
found AS (SELECT id, min(rank) AS rank, source FROM (SELECT id, rank, 'chunk' AS source FROM chunk_found UNION ALL SELECT id, rank, 'entity' FROM entity_found UNION ALL SELECT id, rank, 'context' FROM context_found) GROUP BY id, source)
SELECT id, round(sum(CAST(1 AS DOUBLE) / (60 + rank)), 9) AS score, string_agg(source, ',' ORDER BY source) AS sources FROM found GROUP BY id ORDER BY score DESC, id LIMIT 24""")
def composite_search(spark, d):
    """Three retrievers over the ten vectors nearest to one: their chunks, their entities, and the entities' context."""
    hits = R.vector_topk(load(spark, d, "embeddings"), _query_vector(spark, d, 0), R.DEFAULT.top_k)
    hits = R.ranked(hits.withColumn("less", -F.col("score")), ["less", "vec_id"], R.DEFAULT.top_k).select(F.col("vec_id").alias("chunk"), (F.col("vec_id") % 100).alias("entity"), "rank")
    statements = view(spark, d, "statements").select(F.col("statement_id").alias("id"), F.col("source_id").alias("chunk"), F.col("s_id").alias("s"), F.col("o_id").alias("o"))
    return R.composite(hits, statements, R.DEFAULT.limit, 3 * R.DEFAULT.limit)
