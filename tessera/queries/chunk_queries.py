"""Queries over chunking, packing and topic texts, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunks as K
from ..operators import embedding as E
from ..operators import packing as P
from ..operators import presets as PR
from ..operators import topics as T
from ..tables import load, run_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(make):
        QUERIES[make.__name__] = make
        if sql:
            SQL[make.__name__] = sql
        return make

    return add


# RE2 has no look-behind: a mark that no text holds goes after each end, and is cut at
_SENTENCES = r"list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda y: y <> '')"
_D_SENTENCES = f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS i, s[i] AS sentence, s FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents), LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i)"


@query(f"SELECT doc_id, i, sentence FROM ({_D_SENTENCES})")
def sentences(spark, d):
    return K.sentence_rows(load(spark, d, "documents"))


@query(f"SELECT doc_id, i, array_to_string(s[greatest(i - 3, 0) + 1 : i + 4], ' ') AS text, doc_id || ':' || i AS token FROM ({_D_SENTENCES})")
def sentence_windows(spark, d):
    return K.windows(load(spark, d, "documents"))


_DISTANCES = """SELECT label, vec_id, round(1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(next AS DOUBLE[])), 6) AS distance
FROM (SELECT label, vec_id, embedding, lead(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS next FROM embeddings) WHERE next IS NOT NULL"""


def _distances(spark, d):
    return K.distances(load(spark, d, "embeddings"), "label", "vec_id", "embedding")


@query(_DISTANCES)
def cosine_distances(spark, d):
    return _distances(spark, d)


_BREAKS = f"SELECT d.label, d.vec_id, distance > level AS is_break FROM ({_DISTANCES}) d JOIN (SELECT label, quantile_cont(distance, 0.97) AS level FROM ({_DISTANCES}) GROUP BY label) l ON d.label = l.label"


@query(_BREAKS)
def semantic_breaks(spark, d):
    return K.breaks(_distances(spark, d), "label").select("label", "vec_id", "is_break")


@query(f"""SELECT label, chunk, string_agg(CAST(vec_id AS VARCHAR), ' ' ORDER BY vec_id) AS text, count(*) AS n FROM (
SELECT e.label, e.vec_id, CAST(coalesce(sum(CASE WHEN is_break THEN 1 END) OVER (PARTITION BY e.label ORDER BY e.vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS chunk
FROM embeddings e LEFT JOIN ({_BREAKS}) b ON e.label = b.label AND e.vec_id = b.vec_id) GROUP BY label, chunk""")
def semantic_chunks(spark, d):
    cuts = K.breaks(_distances(spark, d), "label").where("is_break")
    rows = load(spark, d, "embeddings").select("label", "vec_id", F.col("vec_id").cast("string").alias("text"))
    return K.chunks(rows, cuts, "label", "vec_id", "text").withColumn("chunk", F.col("chunk").cast("long"))


@query()
def sentence_chunks(spark, d):
    return K.sentence_chunks(load(spark, d, "documents"))


_W = r"list_filter(string_split_regex(text, '\s+'), lambda y: y <> '')"


@query(f"""SELECT doc_id, CAST(c AS INTEGER) AS chunk, array_to_string(w[c * 240 + 1 : c * 240 + 300], ' ') AS text
FROM (SELECT doc_id, {_W} AS w FROM documents), LATERAL (SELECT unnest(range(0, CAST(greatest(ceil((len(w) - 300) / 240.0), 0) AS BIGINT) + 1)) AS c) WHERE len(w) > 0""")
def fixed_chunks(spark, d):
    return K.fixed_chunks(load(spark, d, "documents"))


@query("""SELECT doc_id, CAST(CASE WHEN rest < 50 AND full_ > 0 AND job >= full_ - 1 THEN full_ - 1 + CASE WHEN doc_id - (full_ - 1) * 300 < floor((300 + rest) / 2) THEN 0 ELSE 1 END ELSE job END + 1 AS BIGINT) AS job
FROM (SELECT doc_id, floor(doc_id / 300) AS job, floor((n - 1) / 300) AS full_, n - floor((n - 1) / 300) * 300 AS rest FROM documents, (SELECT count(*) AS n FROM documents))""")
def pack_jobs_count(spark, d):
    return K.job_numbers(load(spark, d, "documents").select("doc_id"), "doc_id", 300, 50).select("doc_id", "job")


_BATCHES = "SELECT user_id, n, CAST(greatest(100 - n, 0) AS BIGINT) AS padding FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) e"


@query(_BATCHES)
def batch_padding(spark, d):
    """How many requests each user's batch lacks to the least that a batch service takes."""
    return run_sql(spark, d, _BATCHES)


_RESULTS = "SELECT doc_id % 700 AS token, doc_id AS ord, CASE WHEN doc_id % 9 <> 0 THEN n_chars END AS embedding, CASE WHEN doc_id % 9 = 0 THEN 'refused' END AS error FROM documents WHERE doc_id % 4 <> 1"


@query(f"""SELECT d.doc_id AS place, d.doc_id AS token, r.embedding, CASE WHEN r.token IS NULL THEN 'no result' ELSE r.error END AS error FROM documents d LEFT JOIN (
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ord DESC) AS k FROM ({_RESULTS})) WHERE k = 1) r ON d.doc_id = r.token""")
def reattach_results(spark, d):
    return K.reattach(load(spark, d, "documents").select(F.col("doc_id").alias("place"), F.col("doc_id").alias("token")), run_sql(spark, d, _RESULTS))


# -- topic texts, made from line items ---------------------------------------------

_LINES = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, p_name, CASE WHEN l_suppkey % 3 = 0 THEN 'Private Organisation' WHEN l_suppkey % 3 = 1 THEN 'Government Organisation' ELSE 'Person' END AS kind
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""


def _topic_texts(spark, d):
    rows = run_sql(spark, d, _LINES)
    entity = F.when(F.col("l_linenumber") % 5 != 0, F.concat_ws("|", "s_name", "kind"))
    relation = F.concat_ws("|", "s_name", F.lit("SUPPLIES"), "p_name")
    parts = rows.groupBy(F.col("l_orderkey").alias("doc_id")).agg(*[F.array_join(F.sort_array(F.collect_set(x)), "\n").alias(n) for n, x in (("e", entity), ("p", F.concat_ws("|", "p_name", F.lit("Product"))), ("r", relation))])
    text = F.concat(F.lit("topic: order "), F.col("doc_id").cast("string"), F.lit("\n\nentities:\n"), "e", F.lit("\n"), "p", F.lit("\nproposition: goods were supplied\nentity-entity relationships:\n"), "r", F.lit("\nentity-attributes:\nignored line\n"))
    return parts.select("doc_id", text.alias("text"))


@query(f"""WITH l AS ({_LINES}) SELECT doc_id, topic, kind, a, b, c FROM (
SELECT DISTINCT l_orderkey AS doc_id, 'order ' || l_orderkey AS topic, 'topic' AS kind, 'order ' || l_orderkey AS a, NULL AS b, NULL AS c FROM l
UNION ALL SELECT DISTINCT l_orderkey, 'order ' || l_orderkey, 'proposition', 'goods were supplied', NULL, NULL FROM l
UNION ALL SELECT DISTINCT l_orderkey, 'order ' || l_orderkey, 'entity', s_name, kind, NULL FROM l WHERE l_linenumber % 5 <> 0
UNION ALL SELECT DISTINCT l_orderkey, 'order ' || l_orderkey, 'entity', p_name, 'Product', NULL FROM l
UNION ALL SELECT DISTINCT l_orderkey, 'order ' || l_orderkey, 'relation', s_name, 'SUPPLIES', p_name FROM l)""")
def parse_topics(spark, d):
    return T.parse_topics(_topic_texts(spark, d))


@query(f"""WITH l AS ({_LINES}) SELECT DISTINCT l_orderkey AS doc_id, s_name AS a, CASE kind WHEN 'Private Organisation' THEN 'Supplier' WHEN 'Government Organisation' THEN 'Government Departments' ELSE kind END AS b FROM l WHERE l_linenumber % 5 <> 0
UNION ALL SELECT DISTINCT l_orderkey, p_name, 'Product' FROM l""")
def validate_entities(spark, d):
    return T.remap_classes(T.parse_topics(_topic_texts(spark, d))).select("doc_id", "a", "b")


@query(f"WITH l AS ({_LINES}) SELECT DISTINCT l_orderkey AS doc_id, s_name AS name FROM l WHERE NOT EXISTS (SELECT 1 FROM l m WHERE m.l_orderkey = l.l_orderkey AND m.s_name = l.s_name AND m.l_linenumber % 5 <> 0)")
def dangling_refs(spark, d):
    return T.dangling_in(_topic_texts(spark, d)).select("doc_id", "name")


_JOB = (200, 400_000, 50)  # requests, bytes, fewest requests


@query(f"""WITH RECURSIVE r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place, sum(strlen(text) + 64) OVER (ORDER BY doc_id) AS upto, strlen(text) + 64 AS size FROM documents),
following AS (SELECT a.place, least(a.place + {_JOB[0]}, greatest(a.place + 1, (SELECT count(*) FROM r b WHERE b.upto <= a.upto - a.size + {_JOB[1]}))) AS next FROM r a),
starts(place) AS (SELECT 0::BIGINT UNION ALL SELECT f.next FROM starts s JOIN following f ON f.place = s.place WHERE f.next < (SELECT count(*) FROM r)),
numbered AS (SELECT place, row_number() OVER (ORDER BY place) AS job, lag(place) OVER (ORDER BY place) AS before FROM starts),
tail AS (SELECT n.job, n.before, (SELECT count(*) FROM r) AS n FROM numbered n WHERE n.job = (SELECT count(*) FROM starts) AND n.job > 1 AND (SELECT count(*) FROM r) - n.place < {_JOB[2]})
SELECT r.doc_id, r.place, coalesce((SELECT CASE WHEN r.place < t.before THEN NULL WHEN r.place < t.before + (t.n - t.before) // 2 THEN t.job - 1 ELSE t.job END FROM tail t), (SELECT max(n.job) FROM numbered n WHERE n.place <= r.place)) AS job FROM r""")
def pack_jobs(spark, d):
    """Requests, a document each, packed by count and bytes."""
    requests = load(spark, d, "documents").select("doc_id", (F.octet_length("text") + 64).alias("bytes"))
    return P.pack_jobs(requests, ["doc_id"], "bytes", *_JOB).select("doc_id", "place", "job")


@query("SELECT vec_id AS token, CASE WHEN vec_id % 7 <> 0 THEN CAST(len(embedding) AS INTEGER) END AS dimensions, CASE WHEN vec_id % 7 = 0 THEN 'refused' END AS error FROM embeddings")
def batch_results(spark, d):
    """Batch output lines: JSON rows with either a vector or an error, joined to their requests."""
    from ..sources.batch import read_results

    lines = load(spark, d, "embeddings").select(
        F.to_json(F.struct(F.col("vec_id").cast("string").alias("recordId"), F.when(F.col("vec_id") % 7 != 0, F.struct(F.col("embedding"))).alias("modelOutput"), F.when(F.col("vec_id") % 7 == 0, F.lit("refused")).alias("error"))).alias("value")
    )
    requests = load(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("record_id"), F.col("vec_id").alias("token"))
    return read_results(lines, requests).select("token", F.size("embedding").alias("dimensions"), "error")


_STATES = "SELECT doc_id % 50 AS job, doc_id AS ord, CASE WHEN doc_id % 7 = 0 THEN 'Completed' WHEN doc_id % 7 = 1 THEN 'PartiallyCompleted' WHEN doc_id % 7 = 2 THEN 'Failed' WHEN doc_id % 7 = 3 THEN 'Expired' ELSE 'InProgress' END AS status FROM documents"


@query(f"SELECT job, status, status <> 'InProgress' AS ended, status IN ('Completed', 'PartiallyCompleted') AS succeeded FROM (SELECT job, arg_max(status, ord) AS status FROM ({_STATES}) GROUP BY job)")
def job_states(spark, d):
    return E.job_states(run_sql(spark, d, _STATES))


@query()
def semantic_nodes(spark, d):
    """Chunks of whole documents from their own sentences, by the offline embedder."""
    docs = load(spark, d, "documents").select("doc_id", "text", F.create_map(F.lit("lang"), "lang").alias("metadata"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("file-"), F.col("doc_id").cast("string"))).alias("source_id"))
    return E.semantic_nodes(docs).select("doc_id", "chunk", "text", "sentences", F.col("metadata")["lang"].alias("lang"), "source_id")


@query(f"""SELECT doc_id, CAST(c AS BIGINT) AS chunk, array_to_string(w[c * 135 + 1 : c * 135 + 150], ' ') AS text
FROM (SELECT doc_id, {_W} AS w FROM documents), LATERAL (SELECT unnest(range(0, CAST(greatest(ceil((len(w) - 150) / 135.0), 0) AS BIGINT) + 1)) AS c) WHERE len(w) > 0""")
def preset_chunks(spark, d):
    """Chunks by a named strategy with settings of its own."""
    return PR.cut_documents(load(spark, d, "documents"), {"strategy": "FIXED_SIZE", "max_tokens": 150, "overlap_percentage": 10}).select("doc_id", "chunk", "text")
