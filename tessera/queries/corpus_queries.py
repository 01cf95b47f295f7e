"""Queries over the corpus operators, with SQL for each that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import corpus as C
from ..operators import patterns as PT
from ..operators import text_search as TS
from ..store import scratch
from ..tables import TABLES, load, run_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(make):
        QUERIES[make.__name__] = make
        if sql:
            SQL[make.__name__] = sql
        return make

    return add


# -- pieces of the checking SQL ------------------------------------------------


def d_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def d_clean(x: str) -> str:
    return f"CASE WHEN {d_strip(x)} <> '' AND lower({d_strip(x)}) <> 'nan' THEN {d_strip(x)} END"


def d_key(x: str) -> str:
    return rf"regexp_replace(lower(trim(regexp_replace(replace({x}, '&', ' and '), '\s+', ' ', 'g'))), '^the ', '')"


def d_partial(x: str) -> str:
    t = d_strip(x)
    n = f"replace({t}, '-', '')"
    whole = rf"CASE WHEN regexp_matches({t}, '^\d{{4}}$') THEN {n} || '0101' WHEN regexp_matches({t}, '^(\d{{6}}|\d{{4}}-\d{{2}})$') THEN {n} || '01' WHEN regexp_matches({t}, '^(\d{{8}}|\d{{4}}-\d{{2}}-\d{{2}})$') THEN {n} END"
    return f"CASE WHEN ({whole}) >= '1000' THEN CAST(try_strptime({whole}, '%Y%m%d') AS DATE) END"


def d_export(x: str) -> str:
    t = d_strip(x)
    head = f"regexp_extract({t}, '^[^T ]*')"
    out = rf"coalesce({d_partial(head)}, CAST(try_strptime({t}, '%d %B %Y') AS DATE), CASE WHEN regexp_matches({t}, '^\d{{1,2}}-[A-Za-z]{{3}}-\d{{2}}$') THEN CAST(try_strptime({t}, '%d-%b-%y') AS DATE) END)"
    return f"CASE WHEN {out} >= DATE '1990-01-01' THEN {out} END"


def d_names(x: str) -> str:
    """The names of a comma list, in order, repeats kept."""
    found = rf"regexp_extract_all({x}, '.*?\.[A-Za-z0-9]{{1,5}}\s*(?:,|$)|.+$')"
    return f"list_filter(list_transform({found}, lambda y: {d_strip("regexp_replace(y, ',$', '')")}), lambda y: y <> '')"


def d_distinct(x: str) -> str:
    return f"list_filter({x}, lambda y, i: list_position({x}, y) = i)"


# -- fixtures and analogs, legal in both engines ----------------------------------

#: Whole texts and names with what surrounds them in exports: blanks, tabs, ends of lines, ``nan``, nothing.
TEXTS = """SELECT doc_id AS id, CASE doc_id % 10 WHEN 0 THEN concat('  ', text, chr(9), chr(10)) WHEN 1 THEN concat('The  ', source) WHEN 2 THEN 'NaN ' WHEN 3 THEN ' '
WHEN 4 THEN concat(lang, ' & ', upper(source)) WHEN 5 THEN concat('the ', lang) WHEN 6 THEN concat('Thelma ', source) ELSE text END AS x FROM documents"""
_MONTHS = "'January,February,March,April,May,June,July,August,September,October,November,December'"
#: Dates of orders in every form that exports have, days that some months lack among them.
DATES = f"""SELECT id, CASE id % 17 WHEN 0 THEN y WHEN 1 THEN concat(y, m) WHEN 2 THEN concat(y, '-', m) WHEN 3 THEN concat(y, m, d) WHEN 4 THEN concat(y, '-', m, '-', d) WHEN 5 THEN concat(' ', y, ' ')
WHEN 6 THEN concat(y, '-', m, d) WHEN 7 THEN concat(y, '-', m, '-', d, 'T10:15:00') WHEN 8 THEN concat(y, '-', m, '-', d, ' 10:15') WHEN 9 THEN concat(d, '-', substr(name, 1, 3), '-', substr(y, 3, 2))
WHEN 10 THEN concat(d, ' ', name, ' ', y) WHEN 11 THEN concat(d, '/', m, '/', y) WHEN 12 THEN concat(name, ' ', y) WHEN 13 THEN concat(y, m, '31') WHEN 14 THEN concat('31-', substr(name, 1, 3), '-', substr(y, 3, 2)) WHEN 15 THEN concat('09', m) END AS x
FROM (SELECT o_orderkey AS id, CAST(year(o_orderdate) AS STRING) AS y, lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m, lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d, split_part({_MONTHS}, ',', CAST(month(o_orderdate) AS INTEGER)) AS name FROM orders) o"""
_WHOLE = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
MONEY = f"""SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN concat('£', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',', lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0'))
WHEN 1 THEN concat('"', {_WHOLE}, '"') WHEN 2 THEN concat({_WHOLE}, '.7') WHEN 3 THEN '' WHEN 4 THEN concat('-', {_WHOLE}) WHEN 5 THEN o_orderpriority END AS x FROM orders"""


def mangled(name: str, k: str) -> str:
    return f"CASE {k} % 6 WHEN 0 THEN upper({name}) WHEN 1 THEN concat('The ', {name}) WHEN 2 THEN concat('  ', lower({name}), ' ') WHEN 3 THEN {name} WHEN 4 THEN concat('Office of ', {name}) ELSE concat({name}, '_test') END"


#: Submitters: names of nations (bodies, whose parents are regions) and of regions (departments), as people write them.
ORGS = f"""SELECT c_custkey AS id, {mangled("CASE WHEN c_custkey % 4 = 0 THEN r_name ELSE n_name END", 'c_custkey')} AS submitter
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
BODIES = "SELECT n_name AS alb, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey"
DEPARTMENTS = "SELECT r_name AS department FROM region"
_NAME = "CASE WHEN doc_id % 7 = 0 THEN concat('Annex A, part ', CAST(doc_id AS {s}), '.pdf') WHEN doc_id % 11 = 0 THEN concat('note', CAST(doc_id AS {s})) ELSE concat('doc', CAST(doc_id % 900 AS {s}), '.docx') END"
_ROW_FIELDS = f"""row_no, concat('S', CAST(row_no % 40 AS {{s}})) AS spend_id, {mangled("concat('NATION_', CAST(row_no % 27 AS {s}))", 'row_no')} AS submitter,
CASE WHEN row_no % 4 = 0 THEN NULL WHEN row_no % 6 = 0 THEN '2025-03-01T10:15:00' WHEN row_no % 6 = 1 THEN '30-Mar-26' WHEN row_no % 6 = 2 THEN ' 01 April 2025' WHEN row_no % 6 = 3 THEN 'soon' ELSE '202406' END AS date1,
CASE WHEN row_no % 8 = 0 THEN '2023' WHEN row_no % 8 = 4 THEN '' ELSE 'unused' END AS date2, CASE WHEN row_no % 9 = 0 THEN ' nan ' ELSE names END AS files, concat('case ', CAST(row_no AS {{s}})) AS case_name"""


def _export(spark: bool) -> str:
    s = "STRING" if spark else "VARCHAR"
    name = _NAME.format(s=s)
    joined = f"array_join(transform(array_sort(collect_list(struct(doc_id, {name} AS name))), x -> x.name), ', ')" if spark else f"string_agg({name}, ', ' ORDER BY doc_id)"
    return f"SELECT {_ROW_FIELDS.format(s=s)} FROM (SELECT CAST(floor(doc_id / 4) AS BIGINT) AS row_no, {joined} AS names FROM documents GROUP BY CAST(floor(doc_id / 4) AS BIGINT)) g"


def _bucket(spark: bool) -> str:
    s = "STRING" if spark else "VARCHAR"
    name = _NAME.format(s=s)
    return f"""SELECT DISTINCT key FROM (SELECT concat('files/', {name}) AS key FROM documents WHERE doc_id % 5 <> 0 UNION ALL SELECT concat('files/', {name}, '.metadata.json') FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT concat('files/extra', CAST(doc_id AS {s}), '.pdf') FROM documents WHERE doc_id % 13 = 0 UNION ALL SELECT concat('files/run', CAST(doc_id AS {s}), '.JSON') FROM documents WHERE doc_id % 50 = 0) k"""


_REFS = {
    spark: f"SELECT concat(source, '/', CAST(doc_id AS {'STRING' if spark else 'VARCHAR'}), CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.html' ELSE '.csv' END) AS key, md5(text) AS version, source, doc_id FROM documents"
    for spark in (True, False)
}


CELLS = {spark: f"SELECT row_no AS id, files AS x FROM ({_export(spark)})" for spark in (True, False)}
KEYS = {spark: f"SELECT key AS id, key AS x FROM ({_bucket(spark)})" for spark in (True, False)}
SUBMITTERS = f"SELECT id, concat(submitter, CASE id % 7 WHEN 0 THEN ' FOR TESTING' WHEN 1 THEN ' Contest' WHEN 2 THEN ' Test ' ELSE '' END) AS x FROM ({ORGS}) o"


def frame(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return run_sql(spark, sf_dir, text)


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, _export(True))


def bucket_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, _bucket(True))


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, _REFS[True])


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.read_rows(export_rows(spark, sf_dir), frame(spark, sf_dir, BODIES), frame(spark, sf_dir, DEPARTMENTS))


_ORG_JOIN = f"""LEFT JOIN ({BODIES}) b ON {d_key('b.alb')} = {d_key(d_clean('e.submitter'))} LEFT JOIN ({DEPARTMENTS}) r ON {d_key('r.department')} = {d_key(d_clean('e.submitter'))}"""
_D_ROWS = f"""rows_ AS (
  SELECT e.*, coalesce(b.parent, r.department, {d_clean('e.submitter')}) AS department, b.alb,
    CASE WHEN b.alb IS NULL AND r.department IS NULL THEN {d_clean('e.submitter')} END AS unrecognised,
    CASE WHEN {d_clean('files')} IS NULL THEN [] ELSE {d_distinct(d_names('files'))} END AS names, coalesce({d_clean('date1')}, {d_clean('date2')}) AS raw_date,
    coalesce(regexp_matches({d_strip('e.submitter')}, '(?i)(?:^|[^a-z])test(?:ing)?$'), false) AS is_test
  FROM ({_export(False)}) e {_ORG_JOIN}),
dated AS (SELECT *, {d_export('raw_date')} AS date FROM rows_),
files_ AS (SELECT row_no, spend_id, department, alb, date, case_name AS project_name, unnest(names) AS name, generate_subscripts(names, 1) AS file_no FROM dated WHERE NOT is_test),
listed_ AS (
  SELECT name, arg_max(struct_pack(spend_id, department, alb, date, project_name), row_no * 100000 + file_no) AS v, min(row_no * 100000 + file_no) AS ord FROM files_ GROUP BY name),
listed AS (SELECT name, v.spend_id, v.department, v.alb, v.date, v.project_name, ord FROM listed_),
keys AS ({_bucket(False)})"""

# -- scalars -------------------------------------------------------------------


@query(f"SELECT id, {d_clean('x')} AS y FROM ({TEXTS})")
def clean_text(spark, d):
    return frame(spark, d, TEXTS).select("id", S.clean_text(F.col("x")).alias("y"))


@query(f"SELECT id, {d_key('x')} AS y FROM ({TEXTS})")
def name_key(spark, d):
    return frame(spark, d, TEXTS).select("id", S.name_key(F.col("x")).alias("y"))


@query(f"SELECT id, coalesce(regexp_matches({d_strip('x')}, '(?i)(?:^|[^a-z])test(?:ing)?$'), false) AS y FROM ({SUBMITTERS})")
def test_rows(spark, d):
    return frame(spark, d, SUBMITTERS).select("id", S.is_test_name(F.col("x")).alias("y"))


@query(f"SELECT id, {d_partial('x')} AS y FROM ({DATES})")
def partial_date(spark, d):
    return frame(spark, d, DATES).select("id", S.partial_date(F.col("x")).alias("y"))


@query(f"SELECT id, {d_export('x')} AS y FROM ({DATES})")
def read_date(spark, d):
    return frame(spark, d, DATES).select("id", S.export_date(F.col("x")).alias("y"))


@query(f"SELECT row_no, raw_date, {d_export('raw_date')} AS date FROM (SELECT row_no, coalesce({d_clean('date1')}, {d_clean('date2')}) AS raw_date FROM ({_export(False)}))")
def case_date(spark, d):
    return _read(spark, d).select("row_no", "raw_date", "date")


@query(f"SELECT id, array_to_string(CASE WHEN {d_clean('x')} IS NULL THEN [] ELSE {d_distinct(d_names('x'))} END, '|') AS y FROM ({CELLS[False]})")
def file_names(spark, d):
    return frame(spark, d, CELLS[True]).select("id", F.array_join(S.file_names(F.col("x")), "|").alias("y"))


@query(f"SELECT id, unnest(list_filter(list_transform(string_split(coalesce(x, ''), ','), lambda y: {d_strip('y')}), lambda y: y <> '')) AS y FROM ({CELLS[False]})")
def explode_files(spark, d):
    return frame(spark, d, CELLS[True]).select("id", F.explode(S.plain_names(F.col("x"))).alias("y"))


@query(f"SELECT id, CASE WHEN regexp_full_match(regexp_replace(x, '[£,\"]', '', 'g'), '-?[0-9]+') THEN CAST(regexp_replace(x, '[£,\"]', '', 'g') AS BIGINT) END AS y FROM ({MONEY})")
def parse_money(spark, d):
    return frame(spark, d, MONEY).select("id", S.parse_money(F.col("x")).alias("y"))


@query("SELECT o_orderkey, '£' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS y FROM orders")
def format_money(spark, d):
    return load(spark, d, "orders").select("o_orderkey", S.format_money(F.col("o_totalprice")).alias("y"))


@query(rf"SELECT id, CASE WHEN regexp_matches(lower(x), '\.pdf$') THEN 'application/pdf' WHEN regexp_matches(lower(x), '\.docx$') THEN '{S.CONTENT_TYPES['docx']}' WHEN regexp_matches(lower(x), '\.json$') THEN 'application/json' WHEN regexp_matches(lower(x), '\.csv$') THEN 'text/csv' WHEN regexp_matches(lower(x), '\.html$') THEN 'text/html' ELSE 'application/octet-stream' END AS y FROM (SELECT doc_id AS id, key AS x FROM ({_REFS[False]}))")
def content_type(spark, d):
    return refs(spark, d).select(F.col("doc_id").alias("id"), F.col("key").alias("x")).select("id", S.content_type(F.col("x")).alias("y"))


@query(f"SELECT id, CASE WHEN x <> '' AND NOT ends_with(x, '.metadata.json') THEN x || '.metadata.json' END AS y, NOT ends_with(x, '.metadata.json') AND NOT ends_with(lower(x), '.json') AS is_document FROM ({KEYS[False]})")
def sidecar_keys(spark, d):
    return frame(spark, d, KEYS[True]).select("id", S.sidecar_key(F.col("x")).alias("y"), S.is_document_key(F.col("x")).alias("is_document"))


@query(f"SELECT id, coalesce(nullif(regexp_replace(regexp_replace(lower(coalesce(x, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'cross-government') AS y FROM ({TEXTS})")
def slugify(spark, d):
    return frame(spark, d, TEXTS).select("id", S.slug(F.col("x")).alias("y"))


def _two(part: str) -> str:
    return f"lpad(CAST(CAST({part}(ts) AS INTEGER) AS STRING), 2, '0')"


_DAY = f"concat(CAST(year(ts) AS STRING), '-', {_two('month')}, '-', {_two('day')})"
_TIMES = f"""SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN concat({_DAY}, 'T', {_two('hour')}, ':', {_two('minute')}, ':', {_two('second')}) WHEN 1 THEN {_DAY} WHEN 2 THEN event_type
WHEN 3 THEN CAST(1704164645000 + event_id AS STRING) END AS x FROM events"""


@query(f"SELECT id, coalesce(TRY_CAST(x AS BIGINT), epoch_ms(TRY_CAST(x AS TIMESTAMP)), -1) AS y FROM ({_TIMES})")
def iso_to_millis(spark, d):
    return frame(spark, d, _TIMES).select("id", S.iso_to_millis(F.col("x")).alias("y"))


_ROWS = """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN '' WHEN 2 THEN concat(p_name, chr(10), p_type) END AS a,
CASE p_partkey % 3 WHEN 0 THEN concat(' ', p_brand, ' ') ELSE ' ' END AS b, CASE p_partkey % 5 WHEN 0 THEN p_type WHEN 1 THEN '' END AS c FROM part"""


@query(f"SELECT id, CASE WHEN concat(trim(coalesce(a, '')), trim(coalesce(b, '')), trim(coalesce(c, ''))) <> '' THEN '| ' || concat_ws(' | ', trim(replace(coalesce(a, ''), chr(10), ' ')), trim(replace(coalesce(b, ''), chr(10), ' ')), trim(replace(coalesce(c, ''), chr(10), ' '))) || ' |' END AS y FROM ({_ROWS})")
def pipe_table(spark, d):
    return frame(spark, d, _ROWS).select("id", S.pipe_row(F.array("a", "b", "c")).alias("y"))


_PATTERNS = {"home": ["nation_1%", "%home%"], "trade": ["nation_2", "nation_3"], "asia": ["%4"]}


@query("SELECT n_name, dept FROM nation, (VALUES ('home', 'nation_1%'), ('home', '%home%'), ('trade', 'nation_2'), ('trade', 'nation_3'), ('asia', '%4')) AS p(dept, pattern) WHERE lower(n_name) LIKE pattern GROUP BY n_name, dept")
def dept_synonyms(spark, d):
    name = F.lower("n_name")
    matches = []
    for dept, patterns in _PATTERNS.items():
        one = F.lit(False)
        for p in patterns:
            one = one | name.like(p)
        matches.append(F.when(one, F.lit(dept)))
    return load(spark, d, "nation").select("n_name", F.explode(F.array_compact(F.array(*matches))).alias("dept"))


# -- organisations -----------------------------------------------------------------


@query(f"SELECT id, coalesce(b.parent, r.department, {d_clean('e.submitter')}) AS department, b.alb FROM ({ORGS}) e {_ORG_JOIN}")
def resolve_org(spark, d):
    return C.resolve_org(frame(spark, d, ORGS), frame(spark, d, BODIES), frame(spark, d, DEPARTMENTS), "submitter").select("id", "department", "alb")


@query(f"SELECT id, coalesce(b.parent, e.submitter) AS department, e.submitter AS alb FROM ({ORGS}) e LEFT JOIN ({BODIES}) b ON b.alb = e.submitter")
def resolve_org_exact(spark, d):
    bodies = frame(spark, d, BODIES).select(F.col("alb").alias("known"), "parent")
    return frame(spark, d, ORGS).join(bodies, F.col("submitter") == F.col("known"), "left").select("id", F.coalesce("parent", "submitter").alias("department"), F.col("submitter").alias("alb"))


@query(f"SELECT DISTINCT {d_clean('e.submitter')} AS name FROM ({ORGS}) e {_ORG_JOIN} WHERE b.alb IS NULL AND r.department IS NULL AND {d_clean('e.submitter')} IS NOT NULL")
def unrecognised(spark, d):
    return C.resolve_org(frame(spark, d, ORGS), frame(spark, d, BODIES), frame(spark, d, DEPARTMENTS), "submitter").where("unrecognised IS NOT NULL").select(F.col("unrecognised").alias("name")).distinct()


_ASKED = "SELECT * FROM (VALUES (0, 'the nation_1'), (1, 'Nowhere'), (2, 'NATION_2 '), (3, 'Office of Maps')) AS t(ord, name)"


@query(f"SELECT ord, name FROM ({_ASKED}) a WHERE NOT EXISTS (SELECT 1 FROM nation WHERE {d_key('n_name')} = {d_key('a.name')})")
def unmatched_departments(spark, d):
    return C.unmatched(frame(spark, d, _ASKED), load(spark, d, "nation").select(F.col("n_name").alias("name"))).select("ord", "name")


_FOLDERS = {
    spark: f"SELECT c_custkey AS id, concat(CASE WHEN c_custkey % 2 = 0 THEN 'root/' ELSE '' END, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE concat(CASE WHEN c_custkey % 3 = 0 THEN 'Other body' ELSE n_name END, '/') END, 'report.', CAST(c_custkey AS {'STRING' if spark else 'VARCHAR'}), '.pdf') AS key FROM customer JOIN nation ON c_nationkey = n_nationkey"
    for spark in (True, False)
}


@query(f"""SELECT id, coalesce(b.parent, folder) AS department, b.alb, project FROM (
SELECT id, CASE WHEN len(parts) >= 2 THEN parts[1] END AS folder, CASE WHEN len(parts) >= 2 THEN regexp_replace(parts[-1], '\\.[^.]*$', '') END AS project
FROM (SELECT id, string_split(regexp_replace(key, '^root/', ''), '/') AS parts FROM ({_FOLDERS[False]}))) f LEFT JOIN ({BODIES}) b ON b.alb = f.folder""")
def folder_metadata(spark, d):
    parts = F.split(F.regexp_replace("key", "^root/", ""), "/")
    rows = frame(spark, d, _FOLDERS[True]).withColumn("parts", parts)
    deep = F.size("parts") >= 2
    rows = rows.select("id", F.when(deep, F.col("parts")[0]).alias("folder"), F.when(deep, F.regexp_replace(F.element_at("parts", -1), r"\.[^.]*$", "")).alias("project"))
    return rows.join(frame(spark, d, BODIES), F.col("folder") == F.col("alb"), "left").select("id", F.coalesce("parent", "folder").alias("department"), "alb", "project")


# -- listing, joins and the ledger ------------------------------------------------


@query(f"SELECT key, CASE WHEN ends_with(lower(key), '.pdf') THEN 'application/pdf' ELSE '{S.CONTENT_TYPES['docx']}' END AS content_type, version FROM ({_REFS[False]}) WHERE starts_with(key, 'src1') AND (ends_with(lower(key), '.pdf') OR ends_with(lower(key), '.docx'))")
def list_documents(spark, d):
    return C.list_documents(refs(spark, d), "src1")


_FILES = {spark: f"SELECT concat(source, CASE WHEN doc_id % 2 = 0 THEN '/export.CSV' ELSE '/notes.txt' END, CAST(doc_id AS {'STRING' if spark else 'VARCHAR'}), CASE WHEN doc_id % 2 = 0 THEN '.Csv' ELSE '' END) AS key, n_chars % 500 AS modified FROM documents" for spark in (True, False)}


@query(f"SELECT arg_max(key, struct_pack(modified, key)) AS key FROM ({_FILES[False]}) WHERE starts_with(key, 'src2/') AND ends_with(lower(key), '.csv')")
def latest_file(spark, d):
    return C.latest_file(frame(spark, d, _FILES[True]), "src2/")


_META = {spark: f"SELECT key, source AS department, CAST(doc_id % 17 AS {'STRING' if spark else 'VARCHAR'}) AS spend_id FROM ({_REFS[spark]}) r WHERE doc_id % 3 <> 0" for spark in (True, False)}


@query(f"SELECT r.key, m.department, m.spend_id, CAST(CASE WHEN m.key IS NULL THEN 0 ELSE 2 END AS BIGINT) AS n FROM ({_REFS[False]}) r LEFT JOIN ({_META[False]}) m USING (key)")
def enrich_documents(spark, d):
    metadata = frame(spark, d, _META[True]).select("key", F.create_map(F.lit("department"), "department", F.lit("spend_id"), "spend_id").alias("metadata"))
    out = C.enrich(refs(spark, d), metadata)
    return out.select("key", F.try_element_at("metadata", F.lit("department")).alias("department"), F.try_element_at("metadata", F.lit("spend_id")).alias("spend_id"), F.size("metadata").cast("long").alias("n"))


@query(f"SELECT key, version FROM ({_REFS[False]}) WHERE key IN (SELECT key FROM ({_META[False]}) WHERE department IN ('src1', 'src3'))")
def filter_departments(spark, d):
    return C.filter_departments(refs(spark, d), frame(spark, d, _META[True]), ["src1", "src3"]).select("key", "version")


_LEDGER = {
    spark: f"SELECT concat('text#docs#', key, '#', CASE WHEN doc_id % 5 = 0 THEN 'older' ELSE version END) AS document_key, 'docs' AS source_name, CAST(doc_id AS BIGINT) AS processed_at, 'v1' AS code_version FROM ({_REFS[spark]}) r WHERE doc_id % 2 = 0 UNION ALL SELECT concat('other#docs#', key, '#', version), 'other', CAST(doc_id AS BIGINT), 'v1' FROM ({_REFS[spark]}) r WHERE doc_id % 2 = 1"
    for spark in (True, False)
}


@query(f"SELECT key, version FROM ({_REFS[False]}) r WHERE NOT EXISTS (SELECT 1 FROM ({_LEDGER[False]}) l WHERE l.document_key = 'text#docs#' || r.key || '#' || r.version)")
def ledger_pending(spark, d):
    return C.ledger_pending(refs(spark, d), frame(spark, d, _LEDGER[True]), "text", "docs").select("key", "version")


_NEW = {spark: f"SELECT document_key, source_name, processed_at + 100000 AS processed_at, 'v2' AS code_version FROM ({_LEDGER[spark]}) l WHERE processed_at % 3 = 0 UNION ALL SELECT concat(document_key, 'x'), source_name, processed_at, 'v2' FROM ({_LEDGER[spark]}) l WHERE processed_at % 50 = 0" for spark in (True, False)}


@query(f"SELECT document_key, source_name, processed_at, code_version FROM (SELECT *, row_number() OVER (PARTITION BY document_key ORDER BY n DESC, processed_at DESC) AS k FROM (SELECT 0 AS n, * FROM ({_LEDGER[False]}) UNION ALL SELECT 1, * FROM ({_NEW[False]}))) WHERE k = 1")
def ledger_upsert(spark, d):
    return C.ledger_upsert(frame(spark, d, _LEDGER[True]), frame(spark, d, _NEW[True]))


@query(f"SELECT document_key, processed_at FROM ({_LEDGER[False]}) WHERE source_name = 'docs'")
def ledger_list(spark, d):
    return frame(spark, d, _LEDGER[True]).where("source_name = 'docs'").select("document_key", "processed_at")


_HISTORIC, _EXPORTED = (
    {spark: f"SELECT {key} AS key, doc_id AS ord, source AS department, {extra} AS project FROM documents WHERE {where}" for spark in (True, False)}
    for key, extra, where in (("doc_id % 300", "lang", "doc_id % 2 = 0"), ("doc_id % 450", "CAST(NULL AS VARCHAR(9))", "doc_id % 3 = 0"))
)


@query(f"SELECT key, department, project FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY k DESC, ord DESC) AS n FROM (SELECT 0 AS k, * FROM ({_HISTORIC[False]}) UNION ALL SELECT 1, * FROM ({_EXPORTED[False]}))) WHERE n = 1")
def merge_metadata(spark, d):
    return C.merge_metadata(frame(spark, d, _HISTORIC[True]), frame(spark, d, _EXPORTED[True].replace("VARCHAR(9)", "STRING")))


@query(f"WITH {_D_ROWS} SELECT name, spend_id, department, date, ord FROM listed")
def last_wins(spark, d):
    return C.listed(_read(spark, d)).select("name", "spend_id", "department", "date", (F.col("ord.row_no") * 100000 + F.col("ord.file_no") + 1).alias("ord"))


@query(f"WITH {_D_ROWS} SELECT row_no, CAST(file_no AS BIGINT) AS file_no, name, spend_id, department, alb, date, project_name FROM files_")
def row_to_sidecars(spark, d):
    return C.row_to_sidecars(_read(spark, d)).withColumn("file_no", (F.col("file_no") + 1).cast("long"))


@query(f"WITH {_D_ROWS} SELECT name, spend_id, department, date FROM listed WHERE {d_key('department')} IN ('region_1', 'region_2') ORDER BY date IS NULL, date DESC, coalesce(spend_id, ''), ord LIMIT 40".replace("'region_1', 'region_2'", "'asia', 'europe', 'region_1', 'region_2'"))
def choose_documents(spark, d):
    return C.choose_documents(C.listed(_read(spark, d)), 40, ["ASIA", "The Europe", "Region_1", "REGION_2"]).select("name", "spend_id", "department", "date")


_PLAN = "SELECT l.name, CASE WHEN k.key IS NULL THEN 'missing' WHEN s.key IS NOT NULL THEN 'replace' ELSE 'new' END AS action FROM chosen l LEFT JOIN keys k ON k.key = 'files/' || l.name AND NOT ends_with(lower(k.key), '.json') LEFT JOIN keys s ON s.key = 'files/' || l.name || '.metadata.json'"


@query(f"WITH {_D_ROWS}, chosen AS (SELECT * FROM listed) {_PLAN}")
def label_plan(spark, d):
    return C.label_plan(C.listed(_read(spark, d)), bucket_keys(spark, d)).select("name", "action")


@query(f"WITH {_D_ROWS} SELECT key FROM keys WHERE NOT ends_with(lower(key), '.json') AND NOT EXISTS (SELECT 1 FROM listed WHERE key = 'files/' || name)")
def bucket_not_listed(spark, d):
    return C.bucket_not_listed(bucket_keys(spark, d), C.listed(_read(spark, d)))


LIMIT = 100


@query(f"""WITH {_D_ROWS}, chosen AS (SELECT * FROM listed ORDER BY date IS NULL, date DESC, coalesce(spend_id, ''), ord LIMIT {LIMIT}), p AS ({_PLAN})
SELECT * FROM (SELECT count(*) AS rows_read, CAST(countif(is_test) AS BIGINT) AS test_rows, CAST(countif(NOT is_test AND len(names) = 0) AS BIGINT) AS rows_without_files, CAST(countif(NOT is_test AND len(names) > 0 AND raw_date IS NOT NULL AND date IS NULL) AS BIGINT) AS unreadable_dates, CAST(countif(NOT is_test AND unrecognised IS NOT NULL) AS BIGINT) AS unrecognised_rows FROM dated),
(SELECT count(*) AS listed, CAST(countif(date IS NULL) AS BIGINT) AS listed_without_date FROM listed),
(SELECT CAST(countif(action = 'missing') AS BIGINT) AS to_missing, CAST(countif(action = 'replace') AS BIGINT) AS to_replace, CAST(countif(action = 'new') AS BIGINT) AS to_new, count(*) AS chosen FROM p),
(SELECT count(*) AS bucket_not_listed FROM keys WHERE NOT ends_with(lower(key), '.json') AND NOT EXISTS (SELECT 1 FROM listed WHERE key = 'files/' || name))""")
def plan_summary(spark, d):
    return C.plan_summary(export_rows(spark, d), bucket_keys(spark, d), frame(spark, d, BODIES), frame(spark, d, DEPARTMENTS), limit=LIMIT)


@query(f"WITH {_D_ROWS} SELECT raw_date AS value, count(*) AS n FROM dated WHERE raw_date IS NOT NULL AND date IS NULL GROUP BY raw_date ORDER BY n DESC, raw_date LIMIT 3")
def top_unreadable(spark, d):
    return C.top_values(_read(spark, d), "unreadable_date", 3).withColumnRenamed("unreadable_date", "value")


_STATUS = "SELECT doc_id, CASE WHEN source = 'src0' THEN 'filtered_out' WHEN doc_id % 4 = 0 THEN 'skipped' WHEN n_chars < 300 THEN 'failed' ELSE 'processed' END AS status FROM documents"


@query(f"SELECT count(*) AS total, CAST(countif(status = 'filtered_out') AS BIGINT) AS filtered_out, CAST(countif(status = 'skipped') AS BIGINT) AS skipped, CAST(countif(status = 'processed') AS BIGINT) AS processed, CAST(countif(status = 'failed') AS BIGINT) AS failed FROM ({_STATUS})")
def extraction_summary(spark, d):
    return C.extraction_summary(frame(spark, d, _STATUS))


@query(f"SELECT DISTINCT department FROM ({_META[False]}) WHERE department IS NOT NULL")
def departments(spark, d):
    return frame(spark, d, _META[True]).where("department IS NOT NULL").select("department").distinct()


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 100) + 1 AS BIGINT) AS batch FROM documents")
def batches(spark, d):
    return C.batches(load(spark, d, "documents").select("doc_id"), 100, ["doc_id"])


@query("SELECT o_orderkey, coalesce(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1, false) AS is_latest FROM orders")
def is_latest(spark, d):
    return C.is_latest(load(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "is_latest")


_NAMED = """SELECT concat('in/', CASE WHEN c_custkey % 2 = 0 THEN concat(y, m, d, ' Letter to ', n_name, ' - review ', CAST(c_custkey AS STRING), '.docx') WHEN c_custkey % 9 = 1 THEN concat('note ', n_name, '.pdf')
ELSE concat('llm_dbr_report_', lower(n_name), '_', m, y) END) AS key, CASE WHEN c_custkey % 2 = 0 THEN n_name WHEN c_custkey % 9 <> 1 THEN replace(lower(n_name), '_', ' ') END AS department,
CASE WHEN c_custkey % 2 = 0 THEN concat(y, '-', m, '-', d) WHEN c_custkey % 9 <> 1 THEN concat(y, '-', m, '-01') END AS date, CASE WHEN c_custkey % 2 = 0 THEN 'dbr_readout' WHEN c_custkey % 9 <> 1 THEN 'dbr_report' END AS document_type
FROM (SELECT c_custkey, n_name, CAST(2015 + c_custkey % 11 AS STRING) AS y, lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') AS m, lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') AS d FROM customer JOIN nation ON c_nationkey = n_nationkey) c"""


@query(f"""SELECT key, department, CAST(date AS DATE) AS date, document_type, document_type IS NOT NULL AND row_number() OVER (PARTITION BY document_type, lower(department) ORDER BY date DESC, key DESC) = 1 AS is_latest
FROM (SELECT DISTINCT * FROM ({_NAMED}))""")
def latest_by_name(spark, d):
    """Letters and reports by their file names alone."""
    return C.named_documents(frame(spark, d, _NAMED).select("key").distinct(), "key")


_LIKE = """SELECT DISTINCT p_brand AS name, CASE p_partkey % 4 WHEN 0 THEN concat('%', split_part(p_name, ' ', 1), '%') WHEN 1 THEN concat('%', split_part(p_name, ' ', 2)) WHEN 2 THEN concat(substr(p_name, 1, 2), '_%', substr(p_name, 5, 2), '%') ELSE concat(split_part(p_name, ' ', 1), ' %') END AS pattern FROM part"""


@query(f"SELECT DISTINCT p_partkey, name FROM part JOIN ({_LIKE}) ON p_name LIKE pattern")
def like_patterns(spark, d):
    """Parts by the patterns of every brand."""
    return PT.like_any(load(spark, d, "part"), "p_partkey", "p_name", frame(spark, d, _LIKE), "name", "pattern")


_OPENINGS = "SELECT item_id, concat('%', substr(text, 1, 40), '%') AS pattern FROM benchmark"


@query(f"SELECT DISTINCT doc_id, item_id FROM documents JOIN ({_OPENINGS}) ON text LIKE pattern")
def benchmark_mentions(spark, d):
    """Documents that hold the opening of a benchmark item, whole texts, all items in one pass."""
    return PT.like_any(load(spark, d, "documents"), "doc_id", "text", frame(spark, d, _OPENINGS), "item_id", "pattern")


@query("SELECT doc_id, lang, CAST(3 AS BIGINT) AS n FROM documents")
def visible_metadata(spark, d):
    docs = load(spark, d, "documents")
    domain = F.create_map(F.lit("lang"), "lang", F.lit("source"), "source", F.lit("key"), F.lit("domain"))
    books = F.create_map(F.lit("key"), F.col("doc_id").cast("string"), F.lit("version"), F.lit("1"))
    seen = docs.select("doc_id", C.visible_metadata(domain, books, ["version"]).alias("m"))
    return seen.select("doc_id", F.try_element_at("m", F.lit("lang")).alias("lang"), F.size("m").cast("long").alias("n"))


@query("""SELECT DISTINCT p.department, p.name AS left_name, s.name AS right_name FROM (SELECT p_partkey % 25 AS department, p_name AS name FROM part) p JOIN (SELECT p_partkey % 25 AS department, split_part(p_name, ' ', 1) AS name FROM part) s
ON p.department = s.department AND (contains(lower(p.name), lower(s.name)) OR contains(lower(s.name), lower(p.name)))""")
def name_crosslink(spark, d):
    part = load(spark, d, "part")
    left = part.select((F.col("p_partkey") % 25).alias("department"), F.col("p_name").alias("left_name")).distinct()
    right = part.select((F.col("p_partkey") % 25).alias("department"), F.split("p_name", " ")[0].alias("right_name")).distinct()
    return C.name_crosslink(left, right)


_WEB_QUERIES = ["the strategy of the region", "and then other reading", "est pour la nation"]


@query(f"""WITH w AS (SELECT page_id, url, regexp_extract_all(lower(regexp_replace(html, '<[^>]*>', ' ', 'g')), '[a-z0-9]+') AS w FROM pages),
asked AS (SELECT DISTINCT query_id, unnest(string_split(q, ' ')) AS term FROM (VALUES {", ".join(f"({i}, '{q}')" for i, q in enumerate(_WEB_QUERIES))}) AS t(query_id, q)),
hits AS (SELECT page_id, term, len(list_filter(w, lambda x: x = term)) AS tf, len(w) AS dl FROM w, (SELECT DISTINCT term FROM asked) WHERE list_contains(w, term)),
idf AS (SELECT term, ln(1 + ((SELECT count(*) FROM pages) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM hits GROUP BY term),
scored AS (SELECT query_id, page_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (SELECT avg(len(w)) FROM w)))), 6) AS score FROM hits JOIN asked USING (term) JOIN idf USING (term) GROUP BY query_id, page_id)
SELECT CAST(query_id AS BIGINT) AS query_id, page_id, url, score, CAST(rank AS INTEGER) AS rank FROM (
SELECT query_id, page_id, url, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, page_id) AS rank FROM scored JOIN pages USING (page_id) WHERE regexp_matches(url, '^[a-z]+://([^/?#]*\\.)?example\\.org([/?#]|$)')) WHERE rank <= 5""")
def web_search_pages(spark, d):
    """The five best pages of one domain for each query, by words of the whole page."""
    pages = load(spark, d, "pages")
    index = scratch(spark, "text-index")
    TS.build(pages.select(F.col("page_id").alias("id"), TS.plain_text(F.col("html")).alias("text")), index)
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    inside = pages.where(host.endswith(".example.org") | (host == "example.org")).select(F.col("page_id").alias("id"), "url")
    queries = spark.createDataFrame(list(enumerate(_WEB_QUERIES)), "query_id long, query string")
    return TS.search(index, queries, 5, inside).join(inside, "id").select("query_id", F.col("id").alias("page_id"), "url", "score", "rank")


@query(f"SELECT 'default' AS database, unnest([{', '.join(repr(n) for n in TABLES)}]) AS name UNION ALL SELECT 'no_such_database', 'Error: no database no_such_database'")
def list_tables(spark, d):
    from ..plans.sqlapi import list_tables as listing

    for name in TABLES:
        load(spark, d, name).createOrReplaceTempView(name)
    names = listing(spark, ["default", "no_such_database"])
    # other views of the session aren't the tables'
    return spark.createDataFrame([(db, name) for db, found in names.items() for name in found if name in TABLES or db != "default"], "database string, name string")


@query("SELECT * FROM (VALUES ('l_orderkey', 'bigint'), ('l_partkey', 'bigint'), ('l_suppkey', 'bigint'), ('l_linenumber', 'int'), ('l_quantity', 'double'), ('l_extendedprice', 'double'), ('l_discount', 'double'), ('l_tax', 'double'), ('l_returnflag', 'string'), ('l_linestatus', 'string'), ('l_shipdate', 'timestamp_ntz')) AS t(name, type)")
def table_schema(spark, d):
    from ..plans.sqlapi import table_schema as schema

    load(spark, d, "lineitem").createOrReplaceTempView("lineitem")
    return spark.createDataFrame(list(schema(spark, None, ' "lineitem" ').items()), "name string, type string")


@query("SELECT doc_id, doc_id % 6 IN (0, 5) AS ok FROM documents")
def sidecar_check(spark, d):
    """Labels of six kinds, four of them out of shape, through the strict checker."""
    from ..sources.sidecar import checked

    kind = F.col("doc_id") % 6
    fields = F.when(kind == 0, '"date": 20250101').when(kind == 1, '"date": 20250230').when(kind == 2, '"alb": ""').when(kind == 3, '"unknown": 1').when(kind == 4, '"is_latest": 1').otherwise('"is_latest": false')
    text = F.concat(F.lit('{"metadataAttributes": {"document_type": "letter", '), fields, F.lit("}}"))
    return checked(load(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), text.alias("text"))).select(F.col("key").cast("long").alias("doc_id"), F.col("error").isNull().alias("ok"))


@query(f"SELECT doc_id FROM ({_STATUS}) WHERE status = 'failed'")
def failed_keys(spark, d):
    return C.failed_keys(frame(spark, d, _STATUS), "doc_id")


@query("SELECT DISTINCT source AS name FROM documents WHERE source <> ''")
def source_names(spark, d):
    return load(spark, d, "documents").where("source <> ''").select(F.col("source").alias("name")).distinct()


_TASKS = "SELECT o_orderkey AS task, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS created FROM orders"


@query(f"SELECT task, created FROM ({_TASKS}) ORDER BY created DESC NULLS LAST, task LIMIT 50")
def newest_tasks(spark, d):
    return frame(spark, d, _TASKS).orderBy(F.col("created").desc_nulls_last(), "task").limit(50)


@query("SELECT o_orderkey FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) >= 20000101")
def date_range_filter(spark, d):
    return load(spark, d, "orders").where(S.date_number(F.col("o_orderdate")) >= 20000101).select("o_orderkey")


@query("SELECT doc_id, lang, CAST(8 AS BIGINT) AS n, CAST(2 AS BIGINT) AS n_visible FROM documents")
def to_documents(spark, d):
    docs = load(spark, d, "documents")
    outputs = docs.select("doc_id", F.col("doc_id").cast("string").alias("key"), F.col("source").alias("source_name"), F.lit("text/plain").alias("content_type"), F.md5("text").alias("version"), "text",
                          F.create_map(F.lit("lang"), "lang", F.lit("source"), "source", F.lit("key"), F.lit("old")).alias("metadata"), F.lit("2025-01-01").alias("extracted_at"), F.lit("v1").alias("code_version"))
    found = C.to_documents(outputs)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("metadata")["lang"].alias("lang"), F.size("metadata").cast("long").alias("n"), F.size("visible").cast("long").alias("n_visible"))


_ARNS = """SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN concat('arn:aws:sts::1:assumed-role/', lower(c_mktsegment), '.', c_name, '-admin/session') WHEN 1 THEN concat('arn:aws:sts::1:assumed-role/', lower(c_mktsegment), '-role/x')
WHEN 2 THEN concat('arn:aws:iam::1:user/', c_name, '.', c_mktsegment) ELSE c_name END AS x FROM customer"""


@query(f"""SELECT id, left('cli/' || regexp_replace(CASE WHEN contains(split_part(name, '-', 1), '.') THEN split_part(name, '-', 1) ELSE name END, '[^A-Za-z0-9_-]', '-', 'g'), 128) AS y
FROM (SELECT id, CASE WHEN contains(x, ':assumed-role/') THEN split_part(split_part(x, ':assumed-role/', 2), '/', 1) ELSE regexp_extract(x, '[^/]*$') END AS name FROM ({_ARNS}))""")
def started_by(spark, d):
    return frame(spark, d, _ARNS).select("id", S.started_by(F.col("x")).alias("y"))


@query()
def extract_text(spark, d):
    from ..sources.extract import extract

    return extract(load(spark, d, "pages").select(F.col("page_id").cast("string").alias("key"), F.lit("text/html").alias("content_type"), F.col("html").cast("binary").alias("content")))
