"""The given tables, and the views of the domain over them.

The views (contracts, cases, projects, assessments, workforce, graph) are written once as SQL for both engines, so
that a query over them has the same meaning here and in the SQL that checks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans.dialect import DUCKDB, SPARK, Dialect

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _views(x: Dialect) -> dict[str, str]:
    points = ",\n         ".join(f"CASE WHEN {x.json_int('props', 'k')} % 11 = {i - 1} AND value < 40 THEN 'point {i}' ELSE '' END AS points_notmet_{i}" for i in range(1, 12))
    return {
        "contracts": f"""
  SELECT o_orderkey AS contract_id, l_linenumber AS line_no, l_partkey AS part_id, l_suppkey AS supplier_id, n_name AS buyer_name, s_name AS seller_name,
         p_name AS title, {x.pounds('l_extendedprice')} AS value, CAST(o_orderdate AS DATE) AS date, CAST(l_shipdate AS DATE) AS end_date,
         p_type AS digital_spend_category, l_returnflag AS lifecycle_stage, l_linestatus AS delivery_model, p_brand AS named_commercial_technologies,
         CASE WHEN o_orderkey % 7 = 0 THEN 'Yes' ELSE 'No' END AS direct_award, CASE WHEN l_linenumber % 4 = 0 THEN 'Yes' ELSE 'No' END AS extension
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
        "cases": f"""
  SELECT o_orderkey AS spendid, n_name AS organisationsubmitter, o_orderstatus AS casestatus, o_orderpriority AS riskrating,
         {x.thousands('o_totalprice')} AS spendamount, {x.thousands('o_totalprice * 0.8')} AS approvedamount, CAST(o_orderdate AS DATE) AS startdate,
         concat('case ', CAST(o_custkey AS {x.string})) AS casename, CASE WHEN o_orderkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS ai_flag,
         CASE WHEN o_orderkey % 5 = 0 THEN concat('Supplier#', lpad(CAST(o_custkey % 10 AS {x.string}), 9, '0')) WHEN o_orderkey % 5 = 1 THEN '' END AS proposedsupplier
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
        "projects": f"""
  SELECT p_partkey AS project_id, p_name AS {x.name('Project Name')}, concat('NATION_', CAST(p_partkey % 25 AS {x.string})) AS {x.name('Department')},
         p_size * 10 AS {x.name('Whole Life Cost (£m)')}, CASE WHEN p_size < 15 THEN 'Red' WHEN p_size < 35 THEN 'Amber' ELSE 'Green' END AS {x.name('Delivery Confidence')}
  FROM part""",
        "assessments": f"""
  SELECT event_id, user_id AS service_id, concat('service ', CAST(user_id AS {x.string})) AS service_name, concat('NATION_', CAST(user_id % 25 AS {x.string})) AS organisation,
         event_type AS stage, CASE WHEN value < 40 THEN 'Not met' ELSE 'Met' END AS outcome, ts,
         {points}
  FROM events""",
        "workforce": f"""
  SELECT c_custkey AS row_id, n_name AS department, c_mktsegment AS profession, CASE WHEN c_custkey % 3 = 0 THEN 'Contractor' ELSE 'Civil servant' END AS employment,
         CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(CAST(c_custkey % 5 AS DOUBLE) / 4 AS {x.string}) END AS fte,
         CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(c_custkey % 700 + 200 AS {x.string}) END AS day_rate
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "reviews": """
  SELECT n_name AS department, r_name AS grp, CAST(n_nationkey * 1000 + 500 AS BIGINT) AS sr25_total, CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_nationkey * 900 AS BIGINT) END AS sr21_total
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "statements": f"""
  SELECT statement_id, source_id, s_id, o_id, quantity, lag(statement_id) OVER (PARTITION BY source_id ORDER BY line, o_id, s_id) AS prev
  FROM (SELECT concat_ws('-', lpad(CAST(l_orderkey AS {x.string}), 12, '0'), CAST(l_linenumber AS {x.string}), CAST(l_partkey AS {x.string}), CAST(l_suppkey AS {x.string})) AS statement_id,
        l_orderkey AS source_id, l_linenumber AS line, l_suppkey AS s_id, 1000000000 + l_partkey AS o_id, l_quantity AS quantity FROM lineitem) l""",
    }


def view_sql(name: str, dialect: Dialect = DUCKDB) -> str:
    """The SQL text of a view in one of the two dialects."""
    return _views(dialect)[name]


def with_views(text: str, dialect: Dialect) -> str:
    """``text`` with the views that it names as common table expressions in front."""
    import re

    used = [k for k in _views(dialect) if re.search(rf"\b{k}\b", text)]
    if not used:
        return text
    ctes = ", ".join(f"{k} AS ({view_sql(k, dialect)}\n)" for k in used)
    body = text.lstrip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"


def run_sql(spark: SparkSession, sf_dir: str, text: str, args: dict | None = None) -> DataFrame:
    """SQL over the given tables and the views. Values come as named parameters, never as text."""
    import re

    whole = with_views(text, SPARK)
    for name in TABLES:
        if re.search(rf"\b{name}\b", whole):
            load(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(whole, args=args)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run_sql(spark, sf_dir, f"SELECT * FROM {name}")
