"""The canned analytical questions over contracts, cases, projects, assessments and workforce, with derived metrics.

Each is a function of the dialect that returns SQL; the engine runs it as a Spark plan, the tests and the correctness
check as SQL on the same tables. Every LIMIT has a total order, every sum of money is of whole pounds.
"""

from __future__ import annotations

from collections.abc import Callable

from .dialect import Dialect

WORKLOAD: dict[str, Callable[[Dialect], str]] = {}


def canned(make: Callable[[Dialect], str]) -> Callable[[Dialect], str]:
    WORKLOAD[make.__name__] = make
    return make


DEPARTMENT = "nation_1"


@canned
def count_flag(x):
    return "SELECT count(*) AS n FROM cases WHERE ai_flag = 'Yes'"


@canned
def amount_filter(x):
    return f"SELECT spendid, organisationsubmitter, {x.money('spendamount')} AS amount FROM cases WHERE {x.money('spendamount')} < 100000"


@canned
def cases_by_org(x):
    return "SELECT organisationsubmitter, count(*) AS n FROM cases GROUP BY organisationsubmitter ORDER BY n DESC, organisationsubmitter"


@canned
def flag_and_amount(x):
    return f"SELECT spendid, casestatus, {x.money('spendamount')} AS amount FROM cases WHERE ai_flag = 'Yes' AND {x.money('spendamount')} > 200000"


@canned
def spend_by_category(x):
    return f"SELECT digital_spend_category, count(*) AS contracts, {x.total(x.money('value'))} AS total FROM contracts GROUP BY digital_spend_category"


@canned
def top_suppliers(x):
    return f"""SELECT seller_name, count(*) AS contracts, {x.total(x.money('value'))} AS total FROM contracts
WHERE lower(buyer_name) LIKE '%{DEPARTMENT}%' GROUP BY seller_name ORDER BY total DESC NULLS LAST, seller_name LIMIT 50"""


@canned
def stage_outcomes(x):
    return "SELECT stage, outcome, count(*) AS n FROM assessments GROUP BY stage, outcome ORDER BY stage, outcome"


@canned
def fte_mix(x):
    return f"""SELECT department, sum({x.number('fte')}) AS fte, CAST(sum(CASE WHEN employment = 'Contractor' THEN 1 ELSE 0 END) AS BIGINT) AS contractors,
count(*) AS n FROM workforce GROUP BY department"""


@canned
def avg_day_rate(x):
    return f"SELECT profession, round(avg({x.number('day_rate')}), 6) AS avg_rate, count({x.number('day_rate')}) AS n FROM workforce WHERE employment = 'Contractor' GROUP BY profession"


@canned
def project_cases(x):
    return "SELECT spendid, casename, organisationsubmitter, casestatus, riskrating, spendamount, startdate, ai_flag FROM cases WHERE lower(casename) LIKE '%case 11%'"


@canned
def project_contracts(x):
    return "SELECT contract_id, line_no, part_id, supplier_id, title, seller_name, value FROM contracts WHERE lower(title) LIKE '%red%' AND lower(buyer_name) LIKE '%nation_2%'"


@canned
def quoted_columns(x):
    return f"""SELECT project_id, {x.name('Project Name')} AS project_name, {x.name('Whole Life Cost (£m)')} AS whole_life_cost, {x.name('Delivery Confidence')} AS confidence
FROM projects WHERE lower({x.name('Project Name')}) LIKE '%widget%' AND {x.name('Whole Life Cost (£m)')} > 400"""


@canned
def supplier_totals(x):
    return f"""SELECT seller_name, buyer_name, count(*) AS contracts, {x.total(x.money('value'))} AS total FROM contracts
WHERE lower(seller_name) LIKE '%00000000%' AND lower(buyer_name) LIKE '%{DEPARTMENT}%' GROUP BY seller_name, buyer_name ORDER BY total DESC NULLS LAST, seller_name, buyer_name"""


@canned
def lockin_extensions(x):
    return """SELECT contract_id, line_no, part_id, supplier_id, title, lifecycle_stage, end_date FROM contracts
WHERE lifecycle_stage IN ('R', 'A') AND lower(seller_name) LIKE '%00000001%' ORDER BY end_date DESC NULLS LAST, contract_id, line_no, part_id, supplier_id"""


@canned
def direct_awards(x):
    return "SELECT contract_id, line_no, part_id, supplier_id, seller_name, value FROM contracts WHERE direct_award = 'Yes' AND lower(buyer_name) LIKE '%nation_3%'"


@canned
def extension_flags(x):
    return "SELECT contract_id, line_no, part_id, supplier_id, seller_name FROM contracts WHERE extension = 'Yes' AND lower(buyer_name) LIKE '%nation_4%'"


@canned
def supplier_footprint(x):
    return f"""SELECT seller_name, count(*) AS contracts, count(DISTINCT buyer_name) AS departments, {x.total(x.money('value'))} AS total FROM contracts
GROUP BY seller_name ORDER BY total DESC NULLS LAST, seller_name LIMIT 50"""


@canned
def category_breakdown(x):
    return f"SELECT digital_spend_category, count(DISTINCT seller_name) AS suppliers, count(*) AS contracts, {x.total(x.money('value'))} AS total FROM contracts GROUP BY digital_spend_category"


@canned
def delivery_split(x):
    return f"SELECT delivery_model, count(DISTINCT seller_name) AS suppliers, count(*) AS contracts, {x.total(x.money('value'))} AS total FROM contracts GROUP BY delivery_model"


@canned
def pipeline_exposure(x):
    return f"""SELECT proposedsupplier, count(*) AS n, {x.total(x.money('spendamount'))} AS total FROM cases
WHERE proposedsupplier IS NOT NULL AND proposedsupplier <> '' GROUP BY proposedsupplier ORDER BY total DESC NULLS LAST, proposedsupplier LIMIT 30"""


def _any_like(columns: list[str], terms: list[str]) -> str:
    return "(" + " OR ".join(f"lower({c}) LIKE '%{t}%'" for c in columns for t in terms) + ")"


@canned
def synonym_contracts(x):
    match = _any_like(["title", "digital_spend_category", "named_commercial_technologies"], ["red", "steel", "brass", "brand#3", "bolt"])
    return f"SELECT contract_id, line_no, part_id, supplier_id, title, value FROM contracts WHERE {match} ORDER BY contract_id, line_no, part_id, supplier_id LIMIT 50"


@canned
def synonym_cases(x):
    return f"SELECT spendid, casename, riskrating FROM cases WHERE {_any_like(['casename', 'riskrating'], ['urgent', 'case 9'])}"


@canned
def org_exposure(x):
    return f"""SELECT organisationsubmitter, count(*) AS n, {x.total(x.money('spendamount'))} AS total FROM cases WHERE {_any_like(['riskrating'], ['urgent', 'high'])}
GROUP BY organisationsubmitter ORDER BY total DESC NULLS LAST, organisationsubmitter LIMIT 20"""


@canned
def dept_risk(x):
    return f"""SELECT organisationsubmitter, {x.total(x.money('spendamount'))} AS requested, {x.total(x.money('approvedamount'))} AS approved,
round(avg(CAST(substr(riskrating, 1, 1) AS DOUBLE)), 6) AS avg_risk FROM cases WHERE regexp_like(riskrating, '^[0-9]') GROUP BY organisationsubmitter""".replace("regexp_like", "regexp_like" if x.spark else "regexp_matches")


@canned
def sr_totals(x):
    return "SELECT department, grp, sr25_total, sr21_total FROM reviews"


@canned
def top_contracts(x):
    return f"SELECT contract_id, line_no, title, seller_name, value FROM contracts ORDER BY {x.money('value')} DESC NULLS LAST, contract_id, line_no, part_id, supplier_id LIMIT 20"


@canned
def gmpp_dept(x):
    return f"SELECT project_id, {x.name('Project Name')} AS project_name, {x.name('Delivery Confidence')} AS confidence FROM projects WHERE lower({x.name('Department')}) LIKE '%{DEPARTMENT}%'"


@canned
def amber_red(x):
    c = x.name("Delivery Confidence")
    return f"SELECT project_id, {x.name('Project Name')} AS project_name, {c} AS confidence FROM projects WHERE {x.name('Department')} LIKE '%NATION_7%' AND ({c} LIKE '%Amber%' OR {c} LIKE '%Red%')"


POINTS = [f"points_notmet_{i}" for i in range(1, 12)]


@canned
def failed_points(x):
    return "SELECT " + ", ".join(f"CAST(sum(CASE WHEN {p} <> '' THEN 1 ELSE 0 END) AS BIGINT) AS {p}" for p in POINTS) + " FROM assessments"


@canned
def failed_points_unnest(x):
    return f"SELECT point, count(*) AS n FROM assessments {x.unnest(POINTS, 'point')} WHERE point <> '' GROUP BY point"


@canned
def scoped_suppliers(x):
    return f"""SELECT seller_name, count(*) AS contracts, {x.total(x.money('value'))} AS total FROM contracts
WHERE lower(buyer_name) LIKE '%{DEPARTMENT}%' AND {_any_like(['title', 'digital_spend_category'], ['red', 'promo'])} GROUP BY seller_name ORDER BY total DESC NULLS LAST, seller_name LIMIT 50"""


@canned
def scoped_direct_awards(x):
    return f"SELECT contract_id, line_no, part_id, supplier_id, seller_name FROM contracts WHERE direct_award = 'Yes' AND {_any_like(['title'], ['blue'])} AND lower(buyer_name) LIKE '%{DEPARTMENT}%'"


@canned
def scoped_extensions(x):
    return f"SELECT contract_id, line_no, part_id, supplier_id, seller_name FROM contracts WHERE extension = 'Yes' AND {_any_like(['title'], ['blue'])} AND lower(buyer_name) LIKE '%{DEPARTMENT}%'"


@canned
def scoped_projects(x):
    return f"SELECT project_id, {x.name('Project Name')} AS project_name FROM projects WHERE {_any_like([x.name('Project Name')], ['green', 'bolt'])} AND {x.name('Delivery Confidence')} LIKE '%Red%'"


@canned
def scoped_outcomes(x):
    return "SELECT stage, outcome, count(*) AS n FROM assessments WHERE lower(organisation) LIKE '%nation_1%' GROUP BY stage, outcome"


@canned
def label_counts(x):
    return """SELECT label, count(*) AS n FROM (
SELECT 'supplier' AS label, s_suppkey AS id FROM supplier UNION ALL SELECT 'part', p_partkey FROM part UNION ALL SELECT 'statement', l_orderkey FROM lineitem UNION ALL SELECT 'source', o_orderkey FROM orders) z GROUP BY label"""


@canned
def top3_share(x):
    return f"""WITH totals AS (SELECT buyer_name, seller_name, sum({x.money('value')}) AS v FROM contracts GROUP BY buyer_name, seller_name),
ranked AS (SELECT buyer_name, v, row_number() OVER (PARTITION BY buyer_name ORDER BY v DESC NULLS LAST, seller_name) AS k FROM totals)
SELECT buyer_name, round(100.0 * CAST(sum(CASE WHEN k <= 3 THEN v ELSE 0 END) AS DOUBLE) / CAST(sum(v) AS DOUBLE), 6) AS top3_share FROM ranked GROUP BY buyer_name"""


@canned
def multi_programme_suppliers(x):
    return "SELECT seller_name, count(DISTINCT digital_spend_category) AS programmes FROM contracts GROUP BY seller_name HAVING count(DISTINCT digital_spend_category) >= 3"


@canned
def single_supplier_programmes(x):
    return "SELECT title, buyer_name, date, min(seller_name) AS seller_name FROM contracts GROUP BY title, buyer_name, date HAVING count(DISTINCT seller_name) = 1"


@canned
def cross_dept_suppliers(x):
    return "SELECT seller_name, count(DISTINCT buyer_name) AS buyers FROM contracts GROUP BY seller_name HAVING count(DISTINCT buyer_name) >= 2"


@canned
def supplier_card(x):
    return f"""SELECT seller_name, count(*) AS contracts, {x.total(x.money('value'))} AS total, {x.collect('digital_spend_category')} AS programmes, {x.collect('buyer_name')} AS departments,
max(end_date) AS last_end, CAST(sum(CASE WHEN extension = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS extensions, max(direct_award) AS any_direct_award FROM contracts GROUP BY seller_name"""


@canned
def confidence_tier(x):
    return """WITH seen AS (SELECT seller_name AS entity, 'contracts' AS src FROM contracts UNION SELECT proposedsupplier, 'cases' FROM cases WHERE proposedsupplier <> '' UNION SELECT s_name, 'register' FROM supplier WHERE s_acctbal > 0)
SELECT entity, count(DISTINCT src) AS sources, CASE WHEN count(DISTINCT src) >= 3 THEN 'high' WHEN count(DISTINCT src) = 2 THEN 'medium' ELSE 'low' END AS confidence FROM seen GROUP BY entity"""


@canned
def triangulation(x):
    return f"""WITH a AS (SELECT organisation AS dept, max(CASE WHEN outcome = 'Not met' THEN 1 ELSE 0 END) AS failed FROM assessments GROUP BY organisation),
c AS (SELECT organisationsubmitter AS dept, max(CASE WHEN riskrating LIKE '1%' THEN 1 ELSE 0 END) AS risky FROM cases GROUP BY organisationsubmitter),
p AS (SELECT {x.name('Department')} AS dept, max(CASE WHEN {x.name('Delivery Confidence')} = 'Red' THEN 1 ELSE 0 END) AS red FROM projects GROUP BY {x.name('Department')})
SELECT coalesce(a.dept, c.dept, p.dept) AS dept,
CASE WHEN failed = 1 AND risky = 1 THEN 'confirmed concern' WHEN failed = 1 AND red = 1 THEN 'delivery concern' WHEN failed IS NULL AND red = 1 THEN 'unassessed project' WHEN risky = 1 AND red IS NULL THEN 'spend only' ELSE 'consistent' END AS flag
FROM a FULL OUTER JOIN c ON a.dept = c.dept FULL OUTER JOIN p ON coalesce(a.dept, c.dept) = p.dept"""


@canned
def freshness(x):
    return """SELECT contract_id, line_no, part_id, supplier_id, CASE WHEN end_date < DATE '1998-01-01' THEN 'historical' WHEN date >= DATE '2000-01-01' THEN 'strong' WHEN date < DATE '1999-01-01' THEN 'stale' ELSE 'usable' END AS evidence
FROM contracts"""


@canned
def progression(x):
    return """WITH now AS (SELECT department, sr25_total FROM reviews WHERE sr25_total > 3000), was AS (SELECT department, sr21_total FROM reviews WHERE sr21_total IS NOT NULL)
SELECT coalesce(now.department, was.department) AS department, sr21_total, sr25_total, CASE WHEN sr21_total IS NULL THEN 'new' WHEN sr25_total IS NULL THEN 'ended' ELSE 'continued' END AS state
FROM now FULL OUTER JOIN was ON now.department = was.department"""


@canned
def ranked_orgs(x):
    return f"""WITH e AS (SELECT buyer_name AS org, 'contracts' AS src, {x.money('value')} AS v FROM contracts UNION ALL SELECT organisationsubmitter, 'cases', {x.money('spendamount')} FROM cases UNION ALL SELECT department, 'reviews', sr25_total FROM reviews)
SELECT org, count(DISTINCT src) AS sources, {x.total('v')} AS total FROM e GROUP BY org ORDER BY sources DESC, total DESC NULLS LAST, org"""


@canned
def merge_results(x):
    return f"""WITH m AS (SELECT seller_name AS entity, 'top' AS src FROM contracts WHERE direct_award = 'Yes' UNION ALL SELECT proposedsupplier, 'pipeline' FROM cases WHERE proposedsupplier <> '' UNION ALL SELECT seller_name, 'extension' FROM contracts WHERE extension = 'Yes')
SELECT entity, {x.collect('src')} AS sources, count(*) AS mentions FROM m GROUP BY entity"""

